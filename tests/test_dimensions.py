from pyspark.sql import functions as F

from cohortforge.plans.validate import range_violations


def test_ranges_past_ten_thousand_count(spark):
    ranges = spark.range(10_050).select(F.concat(F.lit("f"), "id").alias("field"), F.lit(0).alias("least"), F.lit(5).alias("most"))
    cells = ranges.select("field", F.lit("9").alias("value"))
    assert range_violations(cells, ranges).count() == 10_050

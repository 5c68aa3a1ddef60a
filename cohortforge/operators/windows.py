"""Order-aware operators: fills, ranks, counters, minted ids, first and last of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.functions.scalars import pseudonym, reduce_id


def filled(df: DataFrame, key: str, columns: Sequence[str], order: str) -> DataFrame:
    """Missing values taken from the row before in the group, else from the one after."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(key).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.last(c, True).over(before), F.first(c, True).over(after)) for c in columns})


def counted(df: DataFrame, key: str, order: str, into: str = "n") -> DataFrame:
    return df.withColumn(into, F.row_number().over(Window.partitionBy(key).orderBy(order)))


def duplicated(*keys: str) -> Column:
    return F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1


def first_of(df: DataFrame, keys: Sequence[str], *order) -> DataFrame:
    """The first row of each key; pass descending columns for the last."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def second_of_two(df: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key)
    return df.withColumn("_n", F.row_number().over(w.orderBy(order))).withColumn("_all", F.count(F.lit(1)).over(w)).where("_n = 2 and _all = 2").drop("_n", "_all")


def repetitions(df: DataFrame, key: str, value: str, order: str, into: str = "repetition") -> DataFrame:
    """A counter that starts again whenever the value changes in order."""
    w = Window.partitionBy(key).orderBy(order)
    changed = F.coalesce((F.lag(value).over(w) != F.col(value)).cast("int"), F.lit(1))
    out = df.withColumn("_island", F.sum(changed).over(w))
    return out.withColumn(into, F.row_number().over(Window.partitionBy(key, "_island").orderBy(order))).drop("_island")


def dense_ranked(df: DataFrame, value: str, key: str | None = None, into: str = "rank", missing: int = -1) -> DataFrame:
    """Dense rank of values within a key, ``missing`` where there is none."""
    if not key:  # different values are numbered across partitions
        ranks = numbered(df.select(value).where(F.col(value).isNotNull()).distinct(), [value], "_rank")
        return df.join(ranks, value, "left").select(*df.columns, F.coalesce("_rank", F.lit(missing)).cast("int").alias(into))
    w = Window.partitionBy(key, F.col(value).isNull()).orderBy(value)
    return df.withColumn(into, F.when(F.col(value).isNull(), F.lit(missing)).otherwise(F.dense_rank().over(w)))


def numbered(df: DataFrame, order: Sequence[str], into: str = "_number", parts: int | None = None) -> DataFrame:
    """1, 2, ... over the whole table in the given order, without moving it into one partition.

    Rows are range-partitioned and sorted once; a row's number is its place in its partition and the rows of the partitions
    before, of which one small row each is joined by broadcast.
    """
    from cohortforge.operators.tables import kept_once

    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = kept_once(sorted_.withColumn("_place", F.monotonically_increasing_id()))  # partition in the upper bits, row below
    part, row = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    offsets = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn(into, row + 1 + F.col("_before")).select(*df.columns, into)


def padded(number, width: int = 6) -> Column:
    """A number as text with zeros before it; one of more digits than that stays whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def minted(new: DataFrame, held: DataFrame, key: str, into: str = "anon_id", width: int = 6) -> DataFrame:
    """Held ids as they are, and new keys numbered on from them in key order, zero-padded."""
    fresh = new.select(key).where(F.col(key).isNotNull()).distinct().join(held, key, "left_anti")
    start = held.count()
    made = numbered(fresh, [key]).select(key, padded(F.col("_number") + start, width).alias(into))
    return held.select(key, into).unionByName(made)


def shortened_ids(df: DataFrame, column: str, into: str = "short_id") -> DataFrame:
    """Ids cut to 8 characters, to 16 where 8 collide with another id's; lower case."""
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    short = reduce_id(column, 8)
    clash = F.count(F.lit(1)).over(Window.partitionBy(short)) > 1
    table = ids.select(F.col(column).alias("_id"), F.lower(F.when(clash, reduce_id(column, 16)).otherwise(short)).alias(into))
    return df.join(table, df[column] == table["_id"], "left").drop("_id")


#: Candidates of one id that a round of ``pseudonyms`` looks at, so that no row gets large.
MOST_AHEAD = 1 << 16


def pseudonyms(ids: DataFrame, key: bytes, column: str = "id", held: DataFrame | None = None, digits: int = 6, most: int = 1000) -> DataFrame:
    """column, pseudonym: keyed numbers without collisions, as if ids came one by one in order.

    An id's candidates are the keyed numbers of itself, then of itself with "1", "2", ... at its end.  Each id takes the
    first candidate that no held pair and no id before it has.  All ids propose at once; of those that want one
    number the first id keeps it for now.  What an id keeps never gets free for one after it, so the others go on to their next candidate
    that nobody before them keeps; the fewer they are, the further they look ahead in a round, until nobody has to.
    Held pairs stay as they are.  Null ids are left out, repeated ones count once.  More ids than free numbers raise ValueError.
    """
    from cohortforge.operators.tables import discarded, kept_once, stored

    fresh = ids.select(column).where(F.col(column).isNotNull()).distinct()
    taken = None
    if held is not None:
        held = kept_once(held.select(column, "pseudonym"))
        fresh = fresh.join(held.select(column), column, "left_anti")
        taken = held.select("pseudonym").where("pseudonym is not null").distinct()
    candidate = pseudonym(F.concat(F.col(column), F.when(F.col("tries") > 0, F.col("tries").cast("string")).otherwise("")), key, digits)
    placed = fresh.withColumn("tries", F.lit(0).cast("long")).withColumn("pseudonym", candidate)
    if taken is not None:  # a held number's row has no id and comes first
        placed = placed.unionByName(taken, allowMissingColumns=True)
    place = F.row_number().over(Window.partitionBy("pseudonym").orderBy(F.col(column).asc_nulls_first()))
    ahead, before = 1, None
    for _ in range(most):
        placed = stored(placed.withColumn("place", place))
        if before is not None:
            discarded(before)
        before = placed
        no_number = F.col(column).isNull() & ~F.col("pseudonym").rlike(f"^[0-9]{{{digits}}}\\z")
        n, others, losers = placed.agg(F.count("*"), F.count_if(no_number), F.count_if(F.col("place") > 1)).first()
        if n - others > 10**digits:
            raise ValueError(f"{n - others} ids and held numbers don't fit into {digits} digits; use more")
        if not losers:
            done = placed.where(F.col(column).isNotNull()).select(column, "pseudonym")
            return done if held is None else held.unionByName(done)
        ahead = max(1, min(2 * ahead, n // losers, MOST_AHEAD))  # no more candidates than rows
        keepers = placed.where("place = 1").drop("place")
        wanted = placed.where("place > 1").select(column, F.explode(F.sequence(F.col("tries") + 1, F.col("tries") + ahead)).alias("tries")).withColumn("pseudonym", candidate)
        met = wanted.join(keepers.select("pseudonym", F.col(column).alias("keeper"), F.lit(True).alias("kept")), "pseudonym", "left")
        is_open = F.col("kept").isNull() | F.coalesce(F.col("keeper") > F.col(column), F.lit(False))
        # who finds none goes to the last one looked at, loses it and looks on from there
        moved = met.groupBy(column).agg(F.coalesce(F.min(F.when(is_open, F.col("tries"))), F.max("tries")).alias("tries"))
        placed = keepers.unionByName(moved.withColumn("pseudonym", candidate))
    raise ValueError("ids still collide; use more digits")

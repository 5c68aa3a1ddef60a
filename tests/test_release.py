from cohortforge.plans import release
from cohortforge.plans.deidentify import release_issues


def test_unexpected_tasks_are_compared_as_whole_labels(spark):
    tasks = ["Reading", "reading ", "not-reading", "reading-passage-private", None]
    features = spark.createDataFrame([("p", "s", t) for t in tasks], "participant_id string, session_id string, task_name string")
    sessions = spark.createDataFrame([("s",)], "session_id string")
    none = spark.createDataFrame([], "participant_id string")
    issues = lambda allowed: [tuple(r) for r in release_issues({"features": features, "sessions": sessions}, none, none, allowed, "sessions").collect()]
    assert issues(["Reading"]) == [("unexpected_task", "features", 2)]
    assert issues([]) == [("unexpected_task", "features", 4)]


def test_remap_report_lists_unchanged_ids(spark):
    values = [str(i) for i in range(200)]
    before = spark.createDataFrame([(v,) for v in values * 2] + [(None,)], "id string")
    mapping = spark.createDataFrame([(v, f"n{v}") for v in values if int(v) % 3 == 0] + [("1", "1")], "old_id string, new_id string")
    same = sorted(v for v in values if int(v) % 3)
    row = release.remap_report(before, mapping, "id").first()
    assert (row.n, row.n_unchanged, row.n_unchanged_ids, row.ids) == (401, 2 * len(same), len(same), ",".join(same))
    gone = release.remap_report(before, spark.createDataFrame([(v, f"n{v}") for v in values], "old_id string, new_id string"), "id").first()
    assert (gone.n_unchanged_ids, gone.ids) == (0, None)

"""One-pass counters against the row-wise ones; the latest-run snapshot against the window."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reviewlake.operators import counters as CN
from reviewlake.operators import monitor as M
from reviewlake.operators.clean import clean_reviews, cleaning_stats, tag_reviews
from reviewlake.plans import ingest as IG
from reviewlake.plans import latest as LT
from reviewlake.plans.jobs import read_history, record_run
from reviewlake.sources.fixture import with_batch_no

AS_OF = "2024-02-01 00:00:00"
COLS = "arrival_seq bigint, reviewId string, userName string, score string, content string, at string, app_id string"
feed = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d", "e", None]), st.sampled_from(["1", "5", "bad", None, "0.6"]), st.sampled_from(["x", "y", None])),
    max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=feed, size=st.integers(1, 9))
def test_counts_equal_the_row_wise_ones(spark, rows, size):
    df = spark.createDataFrame([(i, k, "u", s, "t", None, a) for i, (k, s, a) in enumerate(rows)], COLS)
    assert CN.cleaning_counts(df).collect() == cleaning_stats(tag_reviews(df)).collect()
    b = with_batch_no(df, size)
    c = IG.incremental_clean(b, AS_OF)
    want = IG.batch_metrics(b, c, IG.incremental_inserted(c))
    got = CN.batch_counts(b)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    apps = spark.createDataFrame([("x",), ("z",)], "app_id string")
    stored = spark.createDataFrame([("a",), ("q",)], "review_id string")
    run = IG.standard_run(df, apps, stored, AS_OF, AS_OF)
    assert CN.standard_counts(df, apps, stored).collect() == IG.standard_run_summary(df, run).collect()
    assert clean_reviews(df, AS_OF).count() == CN.cleaning_counts(df).first().valid_records


@pytest.mark.parametrize("count", [CN.cleaning_counts, lambda df: CN.batch_counts(df)])
def test_one_scan_without_texts(spark, scratch, count):
    path = scratch("feed")
    spark.createDataFrame([(1, "a", "u", "5", "text", None, "x", 0)], COLS + ", batch_no bigint").write.parquet(path)
    plan = count(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Window" not in plan and "content" not in plan


def counts(spark, rows):
    return spark.createDataFrame(rows, "app_id string, fetched bigint, cleaned bigint, inserted bigint, batches bigint")


def test_snapshot_gives_the_baselines_of_the_window(spark, scratch):
    root = scratch("runs")
    runs = [("r1", "2024-01-01", [("a", 100, 90, 90), ("b", 50, 40, 40), (None, 1, 1, 1)]),
            ("r2", "2024-01-02", [("a", 10, 9, 9), ("c", 5, 5, 5)]),
            ("r4", "2024-01-04", [("a", 0, 0, 0), ("b", 50, 40, 0), (None, 0, 0, 0)]),
            ("r3", "2024-01-03", [("a", 70, 70, 70)]),  # recorded late: its baseline is r2, not r4
            ("r5", "2024-01-05", [("a", 7, 7, 7), ("c", 5, 5, 5)])]
    for run_id, day, rows in runs:
        if run_id == "r5":  # the run before died after its history was written
            LT.begin(spark, root)
        record_run(spark, root, counts(spark, [(*r, 1) for r in rows]), run_id, "standard", f"{day} 00:00:00", 1.0, f"{root}/_stage/{run_id}")
    got = {(r.run_id, r.app_id): r.monitoring.previous_run_id for r in read_history(spark, root).collect()}
    assert got == {("r1", "a"): None, ("r1", "b"): None, ("r1", None): None, ("r2", "a"): "r1", ("r2", "c"): None,
                   ("r4", "a"): "r2", ("r4", "b"): "r1", ("r4", None): "r1", ("r3", "a"): "r2", ("r5", "a"): "r4", ("r5", "c"): "r2"}
    latest = {r.app_id: r.run_id for r in LT.snapshot(spark, root).collect()}
    assert latest == {"a": "r5", "b": "r4", "c": "r5", None: "r4"}
    # in order, the enriched row is the one that the window over the whole history gives
    window = {(r.run_id, r.app_id): r.monitoring for r in M.with_monitoring_struct(M.run_monitoring(read_history(spark, root).drop("monitoring"))).collect()}
    stored = {(r.run_id, r.app_id): r.monitoring for r in read_history(spark, root).collect()}
    assert all(stored[k] == window[k] for k in stored if k != ("r4", "a"))  # r4 was judged before r3 came
    new = spark.createDataFrame([], M.HISTORY_SCHEMA)
    judged = M.judge_runs(LT.previous_of(new, LT.snapshot(spark, root)))
    assert "Window" not in judged._jdf.queryExecution().executedPlan().toString()
    assert judged.inputFiles() and all("/latest_runs/" in f for f in judged.inputFiles())

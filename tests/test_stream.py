"""Streaming ingest: equals the batch plan, survives replays; batch-boundary semantics."""

from pyspark.sql import functions as F

from reviewlake.plans import ingest as IG
from reviewlake.plans.catalog import AS_OF, BATCH_ROWS, RUN_TS, TIME_COL, raw
from reviewlake.sources.fixture import with_batch_no
from reviewlake.streaming import ingest as SI

SF = "/root/testdata/sf0.001"
COLS = "arrival_seq bigint, reviewId string, userName string, score string, content string, at string"


def test_invalid_first_copy_only_shadows_within_its_batch(spark):
    rows = [(0, "a", "u", "bad", "x", None), (1, "a", "u", "4", "y", None),   # batch 0: lost
            (2, "b", "u", "bad", "x", None), (3, "c", "u", "5", "z", None),   # batch 1
            (4, "b", "u", "3", "w", None), (5, "a", "u", "2", "v", None)]    # batch 2: b and a valid here
    df = with_batch_no(spark.createDataFrame(rows, COLS), 2)
    ins = {r.reviewId: (r.batch_no, r.score) for r in IG.incremental_inserted(IG.incremental_clean(df, AS_OF)).collect()}
    assert ins == {"c": (1, 5), "b": (2, 3), "a": (2, 2)}
    one_batch = {r.reviewId for r in IG.incremental_inserted(IG.incremental_clean(df.withColumn("batch_no", F.lit(0)), AS_OF)).collect()}
    assert one_batch == {"c"}


def test_stream_equals_batch_and_replay_is_harmless(spark, scratch):
    root = scratch("stream")
    landing, table, metrics = f"{root}/landing", f"{root}/reviews", f"{root}/metrics"
    b = with_batch_no(raw(spark, SF), BATCH_ROWS // 5)
    SI.write_landing(b, landing)
    SI.run_ingest(spark, landing, table, metrics, f"{root}/ckpt", AS_OF, RUN_TS, time_col=TIME_COL,
                  max_files_per_trigger=3)
    got = spark.read.parquet(table).select("review_id", "batch_no", "score")
    want = IG.incremental_reviews(b, AS_OF, RUN_TS, time_col=TIME_COL).select("review_id", "batch_no", "score")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    # a lost checkpoint replays every file: the anti-join keeps the table unchanged
    SI.run_ingest(spark, landing, table, metrics, f"{root}/ckpt2", AS_OF, RUN_TS, time_col=TIME_COL,
                  max_files_per_trigger=3)
    again = spark.read.parquet(table).select("review_id", "batch_no", "score")
    assert again.count() == want.count() and again.exceptAll(want).count() == 0

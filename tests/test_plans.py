"""Plan shape: pushdown, pre-limited dedupe, top-k, broadcast only behind checks."""

from reviewlake.plans.catalog import Q

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dedupe_is_prelimited_before_shuffle(spark):
    p = _plan(Q["clean_reviews"](spark, SF))
    lines = p.splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(reviewId" in line]
    # plan text is top-down: the final limit sits above the exchange, the partial one below it
    assert len(limits) == 2 and exchanges and limits[0] < exchanges[0] < limits[1]


def test_latest_is_topk(spark):
    p = _plan(Q["reviews_latest"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = Q["reviews_table_read_pruned"](spark, SF)
    p = _plan(df)
    assert "PartitionFilters: [(coalesce(app_id" in p
    assert "PushedFilters: [IsNotNull(reviewed_at)" in p


def test_feed_scan_reads_only_needed_columns(spark):
    p = _plan(Q["duplicate_ids"](spark, SF))
    # events is read for the id and the join keys only: no ts, value, props
    scan = [line for line in p.splitlines() if "events.parquet" in line or "ReadSchema" in line]
    text = " ".join(scan)
    assert "props" not in text and "value" not in text


def test_no_python_udfs_anywhere(spark):
    for name in ("clean_reviews", "language_mix", "word_count_stats", "incremental_ingest", "run_anomalies"):
        p = _plan(Q[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_no_cartesian_products(spark):
    for name, fn in Q.items():
        if name.startswith(("stream_", "csv_", "landing_", "reviews_table_", "run_history_")):
            continue
        df = fn(spark, SF)
        p = _optimized(df)
        assert "Join Cross" not in p and "CartesianProduct" not in p, name
        assert "NestedLoopJoin" not in _plan(df), name


def test_bucketed_store_is_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(Q["insert_new_reviews_bucketed"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    scan = [line for line in p.splitlines() if "FileScan parquet spark_catalog" in line]
    assert scan and "Bucketed: true" in scan[0]

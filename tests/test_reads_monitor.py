"""Read methods' argument rules and run monitoring on inline history."""

import datetime as dt

import pytest

from reviewlake.operators import monitor as M
from reviewlake.operators import reads as R
from reviewlake.sources import files as FL

T0 = dt.datetime(2024, 1, 10, 12)
REV = "review_id string, app_id string, score int, content string, reviewed_at timestamp_ntz, thumbs_up_count bigint"


def _reviews(spark):
    return spark.createDataFrame([
        ("a", "x", 5, "50% OFF_a\\b great", T0, 3), ("b", "x", 2, "Grand", T0 - dt.timedelta(days=3), 9),
        ("c", "x", 4, "gr8", T0 + dt.timedelta(days=1), 1), ("d", "y", 1, "À la carte", T0, None),
    ], REV)


def test_argument_rules(spark):
    r = _reviews(spark)
    assert R.search_reviews(r, "x", "   ").count() == 0
    assert R.reviews_by_score(r, "x", 4, 2).count() == 0
    assert R.reviews_by_score(r, "x", 0, 5).count() == 0
    assert R.recent_reviews(r, "x", "2024-01-12", days=0).count() == 0
    with pytest.raises(ValueError):
        R.reviews_by_date_range(r, "x", "not a date", "2024-01-12")


def test_search_literal_and_like(spark):
    r = _reviews(spark)
    assert [x.review_id for x in R.search_reviews(r, "x", "50% off_").collect()] == ["a"]
    assert R.search_reviews(r, "x", "%").count() == 1  # literal percent sign
    assert R.search_reviews(r, "x", "b\\").count() == 0  # trailing backslash is fine
    assert sorted(x.review_id for x in R.search_reviews(r, "x", "g%a", mode="like").collect()) == ["a", "b"]
    assert R.search_reviews(r, "x", "a\\", mode="like").count() == 1
    assert [x.review_id for x in R.search_reviews(r, "y", "à la").collect()] == ["d"]  # Unicode case folding


def test_newest_first_and_limit(spark):
    r = _reviews(spark)
    assert [x.review_id for x in R.get_reviews(r, "x").collect()] == ["c", "a", "b"]
    assert [x.review_id for x in R.get_reviews(r, None, limit=2).collect()] == ["c", "a"]
    assert R.get_reviews(r, None, limit=0).count() == 4


def test_date_range_inclusive_and_recent(spark):
    r = _reviews(spark)
    assert sorted(x.review_id for x in R.reviews_by_date_range(r, "x", "2024-01-07 12:00:00", "2024-01-10 12:00:00").collect()) == ["a", "b"]
    assert sorted(x.review_id for x in R.recent_reviews(r, "x", "2024-01-12 00:00:00", days=2).collect()) == ["a", "c"]


def test_feed_order(spark):
    r = _reviews(spark)
    assert [x.review_id for x in R.feed_order(r, "MOST_RELEVANT").collect()][:2] == ["b", "a"]
    try:
        R.feed_order(r, "OLDEST")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


HIST = ("run_id string, mode string, app_id string, end_time_utc timestamp_ntz, status string, "
        "total_reviews_fetched bigint, total_reviews_inserted bigint")


def test_anomalies_and_baselines(spark):
    d = lambda k: dt.datetime(2024, 1, k)
    h = spark.createDataFrame([
        ("r1", "standard", "x", d(1), "success", 100, 50),
        ("r2", "standard", "x", d(2), "failed", 0, 0),        # zero after nonzero: drops + zero flags
        ("r3", "standard", "x", d(3), "success", 100, 10),    # baseline is the failed run: pct null
        ("r4", "incremental", "x", d(4), "success", 10, 10),  # other mode: no baseline
        ("r5", "standard", "x", d(5), "success", 10, 1),      # -90 %: material drops
    ], HIST)
    m = {r.run_id: r for r in M.run_monitoring(h).collect()}
    assert m["r1"].previous_run_id is None and m["r1"].anomalies == []
    assert m["r2"].anomalies == ["run_failed", "material_fetched_drop", "material_inserted_drop",
                                 "zero_inserted_after_nonzero_baseline", "zero_fetched_after_nonzero_baseline"]
    assert m["r3"].previous_status == "failed" and m["r3"].fetched_change_pct is None and m["r3"].anomalies == []
    assert m["r4"].previous_run_id is None
    assert m["r5"].fetched_change_pct == -90.0 and m["r5"].inserted_change_pct == -90.0
    assert m["r5"].material_change_detected is True
    latest = {(r.app_id, r.mode): r.run_id for r in M.latest_runs(h).collect()}
    assert latest == {("x", "standard"): "r5", ("x", "incremental"): "r4"}


def test_history_skips_blank_and_malformed_lines(spark, scratch):
    path = scratch("history")
    spark.createDataFrame([('{"run_id": "r1", "mode": "standard", "app_id": "x", "status": "success"}',),
                           ("",), ("{not json",), ('{"run_id": "r2", "mode": "standard", "app_id": "x"}',)],
                          "value string").coalesce(1).write.text(path)
    rows = FL.read_json_lines(spark, path, M.HISTORY_SCHEMA).collect()
    assert sorted(r.run_id for r in rows) == ["r1", "r2"]


def test_batch_events(spark):
    m = spark.createDataFrame([(0, 10, 8, 8), (1, 10, 0, 0), (2, 10, 5, 0)],
                              "batch_no long, fetched_count long, cleaned_count long, inserted_count long")
    got = sorted((r.batch_no, r.event) for r in M.batch_events(m).collect())
    assert got == [(0, "batch_processed"), (1, "batch_clean_empty"), (2, "batch_insert_failed"), (2, "batch_processed")]


def test_csv_roundtrip_tricky_text(spark, scratch):
    rows = [(1, 'line one\nline two', 'say "hi", ok'), (2, "", None), (3, "ñandú 😀 中文", ",,,"), (4, None, "\\N?")]
    df = spark.createDataFrame(rows, "id bigint, a string, b string")
    path = scratch("csv")
    FL.write_csv(df, path)
    back = {r.id: (r.a, r.b) for r in FL.read_csv(spark, path, df.schema).collect()}
    assert back == {r[0]: (r[1], r[2]) for r in rows}


def test_history_lines_in_the_source_format(spark, scratch):
    path = scratch("history")
    lines = [
        '{"run_id": "a", "mode": "standard", "app_id": "x", "status": "success", '
        '"start_time_utc": "2026-01-20T10:30:00.123456+00:00", "end_time_utc": "2026-01-20T10:31:00+00:00", '
        '"total_reviews_fetched": 5, "monitoring": {"previous_run_id": null, "anomalies": []}}',
        '{"run_id": "b", "mode": "standard", "app_id": "x", "status": "failed", '
        '"start_time_utc": "2026-01-20T12:00:00.000000", "end_time_utc": "2026-01-20T14:30:00-02:30"}',
        "", "not json",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = {r.run_id: r for r in FL.read_run_history(spark, path, M.HISTORY_WITH_MONITORING).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].start_time_utc == dt.datetime(2026, 1, 20, 10, 30, 0, 123456)
    assert rows["a"].end_time_utc == dt.datetime(2026, 1, 20, 10, 31)
    assert rows["b"].end_time_utc == dt.datetime(2026, 1, 20, 17, 0)  # -02:30 -> UTC
    assert rows["a"].monitoring.anomalies == []


def test_profiles_on_empty_input(spark):
    from reviewlake.operators import profile as P

    empty = spark.createDataFrame([], "score int, content string, ts timestamp_ntz")
    assert P.sentiment_breakdown(empty).first().positive_pct is None
    assert P.emoji_share(empty).first().pct is None
    assert P.temporal_validity(empty, "ts").first().pct is None
    assert all(r.missing_pct is None for r in P.column_profile(empty).collect())
    assert P.empty_content(empty).first().empty_content == 0
    assert P.char_length_stats(empty).first().max_length == 0
    assert P.rating_distribution(empty).count() == 0


def test_date_bounds_with_offsets_and_bad_ones(spark):
    import datetime as dt

    import pytest

    from reviewlake.operators import reads as R

    df = spark.createDataFrame([("r", "a", dt.datetime(2024, 1, 1, 12), 5)], "review_id string, app_id string, reviewed_at timestamp_ntz, score int")
    for start in ("2024-01-01T00:00:00+00:00", "2024/01/01", "2024-01-01", "2024-01-01T13:00:00+02:00"):
        assert R.reviews_by_date_range(df, "a", start, "2024-01-02").count() == 1
    with pytest.raises(ValueError):
        R.reviews_by_date_range(df, "a", "someday", "2024-01-02")


def test_csv_keeps_white_space_and_binds_by_header(spark, scratch):
    from reviewlake.sources import files as FL

    df = spark.createDataFrame([("  lead and trail  ", "x ", 3)], "a string, b string, n int")
    path = scratch("csv")
    FL.write_csv(df.select("n", "b", "a"), path)
    other = "a string, b string, n int, gone string"
    schema = spark.createDataFrame([], other).schema
    assert [tuple(r) for r in FL.read_csv(spark, path, schema).collect()] == [("  lead and trail  ", "x ", 3, None)]

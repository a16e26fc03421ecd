"""Merges as joins: insert-or-ignore, upsert, foreign key, constraints, cascade."""

import datetime as dt

from pyspark.sql import functions as F

from reviewlake.operators import tables as TB
from reviewlake.operators.clean import clean_reviews

RUN1, RUN2 = "2024-02-01 06:00:00", "2024-02-02 06:00:00"
REV = ("review_id string, app_id string, score int, content string, reviewed_at timestamp_ntz, arrival_seq bigint")


def _rev(spark, rows):
    return spark.createDataFrame(rows, REV)


def test_insert_or_ignore_keeps_existing(spark):
    t = dt.datetime(2024, 1, 1)
    existing = _rev(spark, [("a", "x", 5, "old", t, 1)])
    incoming = _rev(spark, [("a", "x", 1, "new", t, 2), ("b", "x", 4, "b", t, 3)])
    for n in (2, None):  # broadcast path and shuffle path give the same rows
        new = TB.insert_new(existing, incoming, incoming_rows=n)
        assert sorted(r.review_id for r in new.collect()) == ["b"]


def test_ingest_twice_equals_once(spark):
    t = dt.datetime(2024, 1, 1)
    incoming = _rev(spark, [("a", "x", 5, "c", t, 1), ("b", "x", 4, "c", t, 2)])
    first = TB.insert_new(incoming.where(F.lit(False)), incoming)
    table = first
    second = TB.insert_new(table, incoming)
    assert first.count() == 2 and second.count() == 0


def test_upsert_keeps_created_at(spark):
    apps = TB.map_apps(spark.createDataFrame([("com.a", "A", 4.0), ("com.b", "B", 3.0)],
                                             "appId string, title string, score double"), RUN1)
    inc = TB.map_apps(spark.createDataFrame([("com.a", "A2", None), ("com.c", "C", 1.0)],
                                            "appId string, title string, score double"), RUN2)
    out = {r.app_id: r for r in TB.upsert(apps, inc, RUN2).collect()}
    assert set(out) == {"com.a", "com.b", "com.c"}
    assert out["com.a"].title == "A2" and out["com.a"].score is None  # every field replaced
    assert out["com.a"].created_at == dt.datetime(2024, 2, 1, 6) and out["com.a"].updated_at == dt.datetime(2024, 2, 2, 6)
    assert out["com.b"].updated_at == dt.datetime(2024, 2, 1, 6)
    assert out["com.c"].created_at == dt.datetime(2024, 2, 2, 6)


def test_category_from_list(spark):
    df = spark.createDataFrame([("com.a", "A", [{"name": "Tools", "id": "TOOLS"}])],
                               "appId string, title string, categories array<struct<name:string,id:string>>")
    r = TB.map_apps(df, RUN1).first()
    assert r.category == '[{"name":"Tools","id":"TOOLS"}]'


def test_app_without_title_is_kept_as_null(spark):
    r = TB.map_apps(spark.createDataFrame([("com.a", None)], "appId string, title string"), RUN1).first()
    assert r.app_id == "com.a" and r.title is None


def test_foreign_key_split(spark):
    t = dt.datetime(2024, 1, 1)
    reviews = _rev(spark, [("a", "x", 5, "c", t, 1), ("b", "y", 4, "c", t, 2)])
    apps = spark.createDataFrame([("x",)], "app_id string")
    for small in (10, 0):
        assert [r.review_id for r in TB.accepted_by_fk(reviews, apps, max_broadcast_rows=small).collect()] == ["a"]
        assert [r.review_id for r in TB.orphans_by_fk(reviews, apps, max_broadcast_rows=small).collect()] == ["b"]


def test_constraint_reasons(spark):
    t = dt.datetime(2024, 1, 1)
    inc = spark.createDataFrame([
        (None, "x", 5.0, "c", 1), ("a", None, 5.0, "c", 2), ("b", "x", None, "c", 3), ("c", "x", 0.6, "c", 4),
        ("d", "x", 5.0, None, 5), ("e", "x", 5.0, "c", 6), ("e", "x", 4.0, "c", 7), ("f", "x", 5.0, "c", 8),
        ("g", "zz", 5.0, "c", 9), ("h", "x", 3.0, "c", 10), (None, "x", 5.0, "c", 11),
        ("i", "x", 9.0, "c", 12), ("i", "x", 2.0, "c", 13),   # defective first copy: the next one goes in
        ("j", "zz", 2.0, "c", 14), ("j", "x", 2.0, "c", 15),  # orphan first copy, then a valid one
    ], "review_id string, app_id string, score double, content string, arrival_seq bigint")
    existing = _rev(spark, [("f", "x", 5, "c", t, 0)])
    apps = spark.createDataFrame([("x",)], "app_id string")
    for n, small in ((15, 100), (None, 0)):
        got = dict(TB.validate_reviews(inc, existing, apps, "arrival_seq", incoming_rows=n, max_broadcast_rows=small)
                   .select("arrival_seq", "reject_reason").collect())
        assert got == {1: "null_review_id", 2: "null_app_id", 3: "null_score", 4: "score_out_of_range",
                       5: "null_content", 6: None, 7: "duplicate_key", 8: "existing_key", 9: "orphan_app",
                       10: None, 11: "null_review_id", 12: "score_out_of_range", 13: None,
                       14: "orphan_app", 15: None}


def test_cascade_delete(spark):
    t = dt.datetime(2024, 1, 1)
    apps = spark.createDataFrame([("x",), ("y",)], "app_id string")
    reviews = _rev(spark, [("a", "x", 5, "c", t, 1), ("b", "y", 4, "c", t, 2)])
    a, r = TB.cascade_delete(apps, reviews, spark.createDataFrame([("y",)], "app_id string"))
    assert [x.app_id for x in a.collect()] == ["x"] and [x.review_id for x in r.collect()] == ["a"]


def test_mapping_uses_each_rows_app(spark):
    rows = [(1, "r1", "u", "5", "c", None, "com.a"), (2, "r2", "u", "4", "c", None, "com.b")]
    c = clean_reviews(spark.createDataFrame(rows, "arrival_seq bigint, reviewId string, userName string, score string, "
                                                  "content string, at string, app_id string"), "2024-02-01 00:00:00")
    m = TB.map_reviews(c, RUN1)
    assert m.columns == TB.REVIEW_COLUMNS
    assert sorted((r.review_id, r.app_id) for r in m.collect()) == [("r1", "com.a"), ("r2", "com.b")]
    stamped = TB.map_reviews(c, RUN1, app_id="com.z")
    assert {r.app_id for r in stamped.collect()} == {"com.z"}


def test_max_batches_bound(spark):
    from reviewlake.plans import ingest as IG
    from reviewlake.sources.fixture import with_batch_no

    rows = [(i, f"r{i % 7}", "u", "4", "c", None) for i in range(30)]
    df = with_batch_no(spark.createDataFrame(rows, "arrival_seq bigint, reviewId string, userName string, "
                                                   "score string, content string, at string"), 5)
    assert IG.bound_batches(df, 2).count() == 10
    assert IG.bound_batches(df, None).count() == 30 and IG.bound_batches(df, 0).count() == 30
    ins = IG.incremental_inserted(IG.incremental_clean(IG.bound_batches(df, 1), "2024-02-01 00:00:00"))
    assert sorted(r.reviewId for r in ins.collect()) == ["r0", "r1", "r2", "r3", "r4"]

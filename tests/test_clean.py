"""Cleaning rules on inline rows (branches the fixture views cannot reach)."""

import datetime as dt

from pyspark.sql import functions as F

from reviewlake.functions import coerce as C
from reviewlake.functions import text as T
from reviewlake.operators.clean import clean_apps, clean_reviews, cleaning_stats, tag_reviews

AS_OF = "2024-02-01 00:00:00"
COLS = "arrival_seq bigint, reviewId string, userName string, score string, content string, at string"


def test_numeric_gate(spark):
    vals = ["5", " 3 ", "4.5", "2.5", "1e0", ".5", "-1", "3d", "3f", "1_0", "0x3", "inf", "NaN", "bad", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = dict(df.select("x", C.to_double("x").alias("d")).collect())
    assert got["5"] == 5.0 and got[" 3 "] == 3.0 and got["4.5"] == 4.5 and got["1e0"] == 1.0 and got[".5"] == 0.5
    assert got["-1"] == -1.0
    for bad in ["3d", "3f", "1_0", "0x3", "inf", "NaN", "bad", ""]:
        assert got[bad] is None, bad


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (4.5,), (1.5,), (4.4,)], "x double")
    assert [r[0] for r in df.select(C.round_half_even_int("x")).collect()] == [2, 4, 4, 2, 4]


def test_timestamp_formats(spark):
    vals = ["2026", "Jan 20, 2026", "Feb 3, 2026", "2026-01-20T10:00:00Z", "2026-01-20 10:30:00",
            "2026-01-20", "2026-02-30", "garbage", "Foo 20, 2026", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = dict(df.select("x", C.to_timestamp_ntz("x").alias("t")).collect())
    assert got["2026"] is None
    assert got["Jan 20, 2026"] == dt.datetime(2026, 1, 20)
    assert got["Feb 3, 2026"] == dt.datetime(2026, 2, 3)
    assert got["2026-01-20T10:00:00Z"] == dt.datetime(2026, 1, 20, 10, 0)
    assert got["2026-01-20 10:30:00"] == dt.datetime(2026, 1, 20, 10, 30)
    assert got["2026-01-20"] == dt.datetime(2026, 1, 20)
    for bad in ["2026-02-30", "garbage", "Foo 20, 2026"]:
        assert got[bad] is None


def test_text_rules(spark):
    vals = ["nan", " nan ", "  Good app  ", " two　words ", "\x1cx\x1f", "  ", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    rows = df.select("x", T.clean_text("x", False).alias("c"), T.clean_text("x", True).alias("n"),
                     T.word_count("x").alias("w")).collect()
    got = {r.x: (r.c, r.n, r.w) for r in rows}
    assert got["nan"] == ("", None, 1)
    assert got[" nan "] == ("nan", "nan", 1)  # replaced before stripping: survives
    assert got["  Good app  "] == ("Good app", "Good app", 2)
    assert got[" two　words "] == ("two　words", "two　words", 2)
    assert got["\x1cx\x1f"] == ("x", "x", 1)
    assert got["  "] == ("", None, 0)
    assert got[None] == (None, None, 0)


def test_script_and_emoji(spark):
    vals = ["很好用的应用", "Отличное приложение", "تطبيق رائع جدا", "Great app", "ñandú àéîõü ok", "", None, "ok 😀"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = {r.x: (r.s, r.e) for r in df.select("x", T.script_class("x").alias("s"), T.has_emoji("x").alias("e")).collect()}
    assert got["很好用的应用"][0] == "chinese"
    assert got["Отличное приложение"][0] == "cyrillic"
    assert got["تطبيق رائع جدا"][0] == "arabic"
    assert got["Great app"] == ("english", False)
    assert got["ñandú àéîõü ok"][0] == "mixed"
    assert got[""][0] == "empty" and got[None] == ("empty", False)
    assert got["ok 😀"][1] is True


def test_reference_smoke_rows(spark):
    """Four reviews: a duplicate, padded text, string score and time, a missing user."""
    rows = [
        (1, "review_001", "John Doe", "5", "Great app!", "2026-01-19 09:00:00"),
        (2, "review_002", "Jane Smith", "4", "  Good app  ", "2026-01-18 09:00:00"),
        (3, "review_001", "John Doe", "5", "Great app!", "2026-01-19 09:00:00"),
        (4, "review_003", None, "3", "Average", "2026-01-20 10:30:00"),
    ]
    out = clean_reviews(spark.createDataFrame(rows, COLS), AS_OF).orderBy("arrival_seq").collect()
    assert [r.reviewId for r in out] == ["review_001", "review_002", "review_003"]
    assert [r.score for r in out] == [5, 4, 3]
    assert out[1].content == "Good app" and out[2].userName is None
    assert out[2].reviewed_at == dt.datetime(2026, 1, 20, 10, 30)


def test_first_copy_invalid_shadows_later_valid(spark):
    rows = [(1, "a", "u", "bad", "x", None), (2, "a", "u", "4", "y", None), (3, "b", "u", "4.5", "z", "nope")]
    out = clean_reviews(spark.createDataFrame(rows, COLS), AS_OF).collect()
    assert [(r.reviewId, r.score) for r in out] == [("b", 4)]
    assert out[0].reviewed_at == dt.datetime(2024, 2, 1) and out[0].reviewed_at_imputed is True


def test_scores_filtered_before_rounding(spark):
    rows = [(i, f"r{i}", "u", s, "c", None) for i, s in enumerate(["0.6", "5.4", "1.5", "4.5", "3.5", "5"])]
    out = clean_reviews(spark.createDataFrame(rows, COLS), AS_OF).orderBy("arrival_seq").collect()
    assert [r.score for r in out] == [2, 4, 4, 5]


def test_tagging_accounts_for_every_row(spark):
    rows = [(1, None, "u", "5", "c", None), (2, "a", "u", None, "c", None), (3, "a", "u", "4", "c", None),
            (4, "a", "u", "5", "c", None), (5, "b", "u", "9", "c", None), (6, "c", "u", "3", None, None)]
    df = spark.createDataFrame(rows, COLS)
    tagged = tag_reviews(df)
    reasons = dict(tagged.select("arrival_seq", "drop_reason").collect())
    assert reasons == {1: "missing_required", 2: "missing_required", 3: None, 4: "duplicate", 5: "invalid_score", 6: None}
    s = cleaning_stats(tagged).first()
    assert s.total_records == 6 and s.valid_records == clean_reviews(df, AS_OF).count() == 2
    assert s.valid_records + s.invalid_records == s.total_records


def test_clean_is_idempotent(spark):
    from reviewlake.plans.catalog import clean

    c1 = clean(spark, "/root/testdata/sf0.001")
    again = c1.withColumn("at", F.date_format("reviewed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")).withColumn(
        "score", F.col("score").cast("string")).withColumn("thumbsUpCount", F.col("thumbsUpCount").cast("string"))
    c2 = clean_reviews(again.drop("reviewed_at", "reviewed_at_imputed"), AS_OF)
    cols = ["reviewId", "userName", "score", "content", "reviewed_at", "thumbsUpCount"]
    assert c1.select(cols).exceptAll(c2.select(cols)).count() == 0
    assert c2.select(cols).exceptAll(c1.select(cols)).count() == 0


def test_clean_apps_coercion(spark):
    df = spark.createDataFrame([("com.x", "X", "4.5", "10000", "2024-01-15", "2026-01-20 10:30:00", "n/a")],
                               "appId string, title string, score string, ratings string, released string, "
                               "lastUpdatedOn string, price string")
    r = clean_apps(df).first()
    assert r.score == 4.5 and r.ratings == 10000.0 and r.price is None
    assert r.released == dt.datetime(2024, 1, 15) and r.lastUpdatedOn == dt.datetime(2026, 1, 20, 10, 30)


def test_source_format_landing(spark, scratch):
    from reviewlake.operators.tables import map_apps, map_reviews
    from reviewlake.sources import files as FL

    path = scratch("landing")
    spark.createDataFrame([
        ('{"reviewId": "a1", "userName": "Ann", "userImage": "http://x/y.png", "content": " Nice ", "score": 5, '
         '"thumbsUpCount": 3, "at": "2026-01-20 10:30:00", "appVersion": "1.2", "replyContent": null}',),
        ('{"reviewId": "a2", "score": "4.5", "content": "ok", "at": "Jan 21, 2026"}',),
    ], "value string").coalesce(1).write.text(path)
    raw = FL.with_arrival_order(FL.read_landing(spark, path))
    got = {r.reviewId: r for r in clean_reviews(raw, "2026-02-01 00:00:00").collect()}
    assert got["a1"].content == "Nice" and got["a1"].score == 5 and got["a1"].userImage == "http://x/y.png"
    assert got["a2"].score == 4 and got["a2"].reviewed_at == dt.datetime(2026, 1, 21) and got["a2"].userName is None
    m = map_reviews(clean_reviews(raw, "2026-02-01 00:00:00"), "2026-02-01 06:00:00", app_id="com.x")
    assert m.where("thumbs_up_count = 3").count() == 1

    apath = scratch("apps")
    spark.createDataFrame([('{"appId": "com.x", "title": "X", "categories": [{"name": "Tools", "id": "TOOLS"}], '
                            '"free": true, "minInstalls": 1000}',)], "value string").write.text(apath)
    app = map_apps(clean_apps(FL.read_landing(spark, apath, FL.SOURCE_APP_SCHEMA)), "2026-02-01 06:00:00").first()
    import json

    assert json.loads(app.category) == [{"name": "Tools", "id": "TOOLS"}]
    assert app.free is True and app.min_installs == 1000


def test_arrival_follows_file_names_for_unequal_files(spark, scratch):
    import json

    from reviewlake.operators.clean import clean_reviews
    from reviewlake.sources import files as FL

    import os

    path = scratch("unequal")
    os.makedirs(path)
    row = {"reviewId": "r1", "userName": "u", "score": "5", "at": "2024-01-01 00:00:00"}
    with open(f"{path}/batch-0001.json", "w") as f:
        f.write(json.dumps({**row, "content": "FIRST"}) + "\n")
    with open(f"{path}/batch-0002.json", "w") as f:
        f.write(json.dumps({**row, "content": "SECOND"}) + "\n")
        f.writelines(json.dumps({**row, "reviewId": f"x{i}", "content": "more " * 50}) + "\n" for i in range(500))
    got = clean_reviews(FL.with_arrival_order(FL.read_landing(spark, path)), "2024-02-01 00:00:00")
    assert [r.content for r in got.where("reviewId = 'r1'").collect()] == ["FIRST"]

"""First copies per key without moving the rows whose key comes once; samples, files and stored rows at volume."""

import glob
import random

from pyspark.sql import functions as F

from reviewlake.operators import clean as CL
from reviewlake.operators import reads as R
from reviewlake.plans import store as ST
from reviewlake.plans.catalog import AS_OF, Q
from reviewlake.sources import files as FL
from reviewlake.warehouse import ReviewWarehouse

SF = "/root/testdata/sf0.001"


def test_first_copies_equal_the_window_whatever_the_marks(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, f"k{rnd.randrange(400)}"]) if rnd.random() < 0.2 else f"k{rnd.randrange(3000)}", rnd.randrange(3), i, f"t{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "id string, b int, at int, text string")
    for keys in (["id"], ["b", "id"]):
        want = sorted(map(str, CL.first_copies(df, keys, ["at"], bounded=True).collect()))
        for slots in (1 << 26, 64, 1):  # few slots: nearly every mark is false
            monkeypatch.setattr(CL, "SLOTS", slots)
            assert sorted(map(str, CL.first_copies(df, keys, ["at"]).collect())) == want


def test_texts_of_ids_that_come_once_are_not_shuffled(spark):
    p = Q["clean_reviews"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    window, once = p.split("NOT coalesce((getbit")  # the marked rows come first, then the union's other side
    assert p.lstrip().startswith("Union") and "Window [row_number" in window and "Window" not in once


def test_sample_takes_the_smallest_hashes_of_few_rows(spark):
    df = spark.range(30000).select(F.concat(F.lit("r"), "id").alias("id"), F.lit("text").alias("text"))
    got = R.smallest_hashes(df, "id", 500)
    assert "substring(md5" in got._jdf.queryExecution().optimizedPlan().toString()  # far fewer rows meet in the top-n
    want = df.orderBy(F.md5("id"), "id").limit(500)
    assert [r.id for r in got.collect()] == [r.id for r in want.collect()]
    odd = spark.createDataFrame([(None,), ("a",), ("a",)], "id string")
    for n in (1, 2, 3, 9):
        assert R.smallest_hashes(odd, "id", n).collect() == odd.orderBy(F.md5("id"), "id").limit(n).collect()
    assert R.smallest_hashes(odd.limit(0), "id", 5).count() == 0


def test_stored_ranges_follow_the_volume_and_not_the_cores(spark, scratch):
    df = spark.range(40000).selectExpr(
        "concat('r', id) review_id", "'a' app_id", "timestamp_ntz '2024-01-01' reviewed_at", "sha2(cast(id as string), 512) content")
    path = scratch("store")
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ST.write_reviews(df, path, mode="errorifexists")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{path}/app_id=a/*.parquet")) > spark.sparkContext.defaultParallelism
    assert spark.read.parquet(path).count() == 40000


def test_packed_files_come_back_whole(spark, scratch):
    rows = [("a\nb", ' "q" ', None), ("", "\\N x", "z")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    csv, js = scratch("csv"), scratch("json")
    FL.write_csv(df, csv)
    FL.write_json_lines(df, js, packed=True)
    assert glob.glob(f"{csv}/*.csv.gz") and glob.glob(f"{js}/*.json.gz")
    assert sorted(map(str, FL.read_csv(spark, csv, df.schema).collect())) == sorted(map(str, df.collect()))
    assert sorted(map(str, FL.read_landing(spark, js, df.schema).collect())) == sorted(map(str, df.collect()))


def test_insert_stages_the_texts_once(spark, scratch, monkeypatch):
    from reviewlake import warehouse as W

    cols = "arrival_seq bigint, app_id string, reviewId string, score string, content string, at string"
    feed = spark.createDataFrame([(i, "ab"[i % 2], f"r{i}", "5", f"text {i}", None) for i in range(10)], cols)
    for bound in (2_000_000, 0):  # broadcast lists of rows, and shuffled ones
        monkeypatch.setattr(W, "BROADCAST_ROWS", bound)
        root = scratch("warehouse")
        wh = ReviewWarehouse(spark, root)
        wh.upsert_apps(spark.createDataFrame([("a", "title")], "appId string, title string"), "2024-02-01 06:00:00")
        first = wh.insert_reviews(CL.clean_reviews(feed, AS_OF), "2024-02-01 06:00:00", stage=f"{root}/_stage/one", frames=True)
        assert (first["cleaned"], first["inserted"], first["orphans"]) == (10, 5, 5) and first["new"].count() == 5
        again = wh.insert_reviews(CL.clean_reviews(feed, AS_OF), "2024-02-02 06:00:00")
        assert (again["cleaned"], again["inserted"], again["orphans"]) == (10, 0, 5)
        assert wh.reviews().count() == 5 and spark.read.parquet(f"{root}/quarantine").count() == 10
        assert spark.read.parquet(f"{root}/_stage/one/judged").columns == ["__order", "reject_reason"]

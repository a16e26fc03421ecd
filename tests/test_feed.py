"""Resumable page reads over a landing table; ragged page union; field contract."""

import pytest
from pyspark.sql import functions as F

from reviewlake.sources import feed as FD
from reviewlake.sources.fixture import raw_reviews, table


def test_pages_cover_the_feed_without_overlap(spark):
    feed = spark.createDataFrame([(i * 3, f"r{i}") for i in range(25)], "arrival_seq long, reviewId string")
    assert FD.feed_slice(feed, None, 0).count() == 0
    seen, token = [], None
    while True:
        page = FD.feed_slice(feed, token, 7)
        rows = [r.arrival_seq for r in page.orderBy("arrival_seq").collect()]
        if not rows:
            break
        assert len(rows) <= 7 and all(r > (token if token is not None else -1) for r in rows)
        assert {r.next_token for r in page.collect()} == {rows[-1]}
        seen += rows
        token = FD.next_token(page)
    assert seen == [i * 3 for i in range(25)]


def test_ragged_union_and_contract(spark):
    a = spark.createDataFrame([(1, "r1", "x", "5")], "arrival_seq long, reviewId string, content string, score string")
    b = spark.createDataFrame([(2, None, "4")], "arrival_seq long, reviewId string, score string")
    u = FD.pages_union([a, b])
    assert u.where("arrival_seq = 2").first().content is None
    c = {(r.field): (r.missing_rows, r.all_missing) for r in
         FD.required_field_conformance(u.withColumn("g", u.arrival_seq * 0), ["g"]).collect()}
    assert c == {"reviewId": (1, False), "content": (1, False), "score": (0, False)}


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_every_document_is_read_whole(spark, sf):
    d = f"/root/testdata/sf{sf}"
    shown = raw_reviews(spark, d).select(F.expr("substring(content, 2, length(content) - 2)").alias("text"))
    lost = table(spark, d, "documents").select("text").where("text IS NOT NULL").join(shown, "text", "left_anti")
    assert lost.count() == 0

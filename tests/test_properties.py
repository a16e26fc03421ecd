"""Properties: batch split of an all-valid feed = one batch; reasons + valid = total."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reviewlake.operators.clean import clean_reviews, cleaning_stats, tag_reviews
from reviewlake.plans import ingest as IG
from reviewlake.sources.fixture import with_batch_no

AS_OF = "2024-02-01 00:00:00"
COLS = "arrival_seq bigint, reviewId string, userName string, score string, content string, at string"

feed = st.lists(
    st.tuples(st.integers(0, 15), st.sampled_from(["1", "2", "3", "4", "5", "4.5", "bad", None, "0.6"]),
              st.sampled_from([" hi ", "nan", None, "x y"])),
    min_size=1, max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=feed)
def test_reasons_partition_the_feed(spark, rows):
    df = spark.createDataFrame(
        [(i, f"r{k}", "u", s, c, None) for i, (k, s, c) in enumerate(rows)], COLS)
    s = cleaning_stats(tag_reviews(df)).first()
    assert s.valid_records + s.duplicates_removed + s.missing_required_removed + s.invalid_score_removed == s.total_records
    assert s.valid_records == clean_reviews(df, AS_OF).count()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=st.lists(st.integers(0, 12), min_size=1, max_size=40), size=st.integers(1, 9))
def test_all_valid_batches_equal_one_batch(spark, ids, size):
    df = spark.createDataFrame([(i, f"r{k}", "u", "4", "c", None) for i, k in enumerate(ids)], COLS)
    one = {r.reviewId: r.arrival_seq for r in clean_reviews(df, AS_OF).collect()}
    b = with_batch_no(df, size)
    many = {r.reviewId: r.arrival_seq for r in IG.incremental_inserted(IG.incremental_clean(b, AS_OF)).collect()}
    assert one == many


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("\t\n\x0b\x0c\r\x1c\x1f \x85\xa0   "
                                                             "    　ab ñ😀中")),
                              max_size=8), min_size=1, max_size=200))
def test_strip_and_words_match_python(spark, texts):
    from reviewlake.functions.text import ustrip, word_count

    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for r in df.select("x", ustrip("x").alias("s"), word_count("x").alias("w")).collect():
        assert r.s == r.x.strip() and r.w == len(r.x.split())

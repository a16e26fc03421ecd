"""Golden values on sf0.01, computed independently in the survey (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from reviewlake.plans.catalog import Q

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q(spark):
    return lambda name: Q[name](spark, SF)


def test_cleaning_and_incremental_counts(q):
    assert q("clean_reviews").count() == 8381
    s = q("run_status").first()
    assert (s.total_reviews_cleaned, s.total_reviews_inserted, s.total_duplicates_or_existing) == (8696, 8400, 296)


def test_profile_values(q):
    langs = {r.script: r.review_count for r in q("language_mix").collect()}
    assert langs == {"arabic": 255, "chinese": 259, "cyrillic": 210, "empty": 354, "english": 6942, "mixed": 361}
    assert q("emoji_share").first().with_emoji == 205
    m = q("rating_moments").first()
    assert (m.mean_score, m.median_score, m.mode_score, m.std_score) == (2.991051, 3.0, 3, 1.392202)
    assert q("rating_skew").first().skewness == 0.005619


def test_merge_values(q):
    assert q("orphan_reviews").count() == 1653
    assert q("clean_reviews").where(F.lower("content").contains("50% off_")).count() == 373


def test_daily_counts_on_events(spark):
    from reviewlake.operators.profile import daily_count_stats
    from reviewlake.sources.fixture import table

    s = daily_count_stats(table(spark, SF, "events"), "ts").first()
    assert (s.mean_per_day, s.median_per_day, s.min_per_day, s.max_per_day) == (333.333333, 332.0, 302, 364)

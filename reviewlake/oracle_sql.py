"""Independent SQL (DuckDB dialect) for every checkable query.

Written from the semantics, not generated from the Spark plans: the check
runs both and compares rows.  Tables ``events documents part ...`` are views
over the same Parquet files.  Shared pieces are CTE strings.

Fixed values mirrored from the Spark side: white-space class, numeric and
timestamp gates, script ranges and thresholds, emoji ranges, the as-of time,
the run time, the load cutoff and the batch size.
"""

from __future__ import annotations

AS_OF = "2024-02-01 00:00:00"
RUN_TS = "2024-02-01 06:00:00"
RUN_TS2 = "2024-02-02 06:00:00"
CUTOFF = "2024-01-16 00:00:00"
BATCH_ROWS = 500

# RE2 has no Unicode White_Space class: list it (plus U+001C..U+001F).
WS = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f"
NUM_RE = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
ISO_RE = r"\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?Z?"
MDY_RE = r"([A-Z][a-z]{2}) (\d{1,2}), (\d{4})"
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
EMOJI_RE = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]"


# ---------------------------------------------------------------- expressions
def num(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '{NUM_RE}') THEN try_cast({x} AS DOUBLE) END)"


def ts(x: str) -> str:
    month = (f"CASE regexp_extract({x}, '{MDY_RE}', 1) "
             + " ".join(f"WHEN '{m}' THEN '{i:02d}'" for i, m in enumerate(MONTHS, 1)) + " END")
    iso = f"CASE WHEN regexp_full_match({x}, '{ISO_RE}') THEN try_cast(regexp_replace({x}, 'Z$', '') AS TIMESTAMP) END"
    mdy = (f"CASE WHEN regexp_full_match({x}, '{MDY_RE}') THEN try_cast(regexp_extract({x}, '{MDY_RE}', 3) || '-' || "
           f"({month}) || '-' || lpad(regexp_extract({x}, '{MDY_RE}', 2), 2, '0') AS TIMESTAMP) END")
    return f"coalesce({iso}, {mdy})"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def txt(x: str, blank_to_null: bool) -> str:
    e = strip(f"(CASE WHEN {x} = 'nan' THEN '' ELSE {x} END)")
    return f"nullif({e}, '')" if blank_to_null else e


def words(x: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({x}, ''), '[^{WS}]+')) AS BIGINT)"


def _share(x: str, rng: str) -> str:
    return f"(length(regexp_replace({x}, '[^{rng}]', '', 'g'))::DOUBLE / length({x}))"


def script(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN 'empty' "
            f"WHEN {_share(x, r'\x{4e00}-\x{9fff}')} > 0.3 THEN 'chinese' "
            f"WHEN {_share(x, r'\x{0400}-\x{04ff}')} > 0.3 THEN 'cyrillic' "
            f"WHEN {_share(x, r'\x{0600}-\x{06ff}')} > 0.3 THEN 'arabic' "
            f"WHEN {_share(x, r'\x{0000}-\x{007f}')} > 0.8 THEN 'english' ELSE 'mixed' END)")


def emoji(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '{EMOJI_RE}'), false)"


def pct(n: str, total: str) -> str:
    return f"round(({n})::DOUBLE * 100.0 / ({total})::DOUBLE, 4)"


def r6(x: str) -> str:
    return f"round(({x})::DOUBLE, 6)"


def tsl(v: str) -> str:
    return f"TIMESTAMP '{v}'"


# ---------------------------------------------------------------- fixture views
RAW_REVIEWS = r"""raw_reviews AS (
SELECT e.event_id AS arrival_seq,
 concat('com.', e.event_type) AS app_id,
 CASE WHEN e.event_id % 97 = 0 THEN NULL
      WHEN e.event_id % 26 = 0 AND e.event_id > 600 THEN concat('r', cast(e.event_id - 600 AS string))
      WHEN e.event_id % 13 = 0 THEN concat('r', cast(e.event_id - 1 AS string))
      ELSE concat('r', cast(e.event_id AS string)) END AS reviewId,
 CASE WHEN e.user_id % 11 = 0 THEN NULL WHEN e.user_id % 11 = 1 THEN 'nan' WHEN e.user_id % 11 = 2 THEN '  '
      ELSE concat(' user', cast(e.user_id AS string), ' ') END AS userName,
 CASE WHEN e.event_id % 41 = 0 THEN NULL WHEN e.event_id % 43 = 0 THEN 'bad' WHEN e.event_id % 47 = 0 THEN '0.6'
      WHEN e.event_id % 53 = 0 THEN '5.4' WHEN e.event_id % 59 = 0 THEN '4.5' WHEN e.event_id % 61 = 0 THEN '2.5'
      WHEN e.event_id % 67 = 0 THEN ' 3 ' ELSE cast(1 + e.user_id % 5 AS string) END AS score,
 CASE WHEN e.plain THEN concat(' ', d.text, ' ') WHEN e.event_id % 71 = 0 THEN NULL WHEN e.event_id % 70 = 0 THEN ' ' WHEN e.event_id % 69 = 0 THEN 'nan'
      WHEN e.event_id % 31 = 0 THEN '很好用的应用' WHEN e.event_id % 37 = 0 THEN 'Отличное приложение'
      WHEN e.event_id % 29 = 0 THEN 'تطبيق رائع جدا' WHEN e.event_id % 23 = 0 THEN 'Great app 😀🚀'
      WHEN e.event_id % 19 = 0 THEN 'ñandú àéîõü ok' WHEN e.event_id % 17 = 0 THEN concat('50% off_a', chr(92), 'b')
      WHEN e.event_id % 16 = 0 THEN concat(chr(160), 'two', '　words', chr(160))
      ELSE concat(' ', d.text, ' ') END AS content,
 CASE WHEN e.event_id % 73 = 0 THEN 'garbage' WHEN e.event_id % 79 = 0 THEN NULL ELSE cast(e.ts AS string) END AS at_text,
 CASE WHEN e.user_id % 9 = 0 THEN NULL WHEN e.user_id % 9 = 1 THEN 'n/a' ELSE cast(e.user_id % 50 AS string) END AS thumbsUpCount,
 CASE WHEN e.user_id % 7 = 0 THEN NULL ELSE concat('1.', cast(e.user_id % 20 AS string)) END AS reviewCreatedVersion,
 CAST(NULL AS string) AS replyContent, CAST(NULL AS string) AS repliedAt, e.props AS extra
FROM (SELECT event_id, ts, user_id, event_type, props, event_id % (SELECT greatest(count(*), 1) FROM documents) AS shows, false AS plain FROM events
 UNION ALL SELECT event_id + (SELECT count(*) FROM events), ts, user_id, event_type, props, event_id, true FROM events
 WHERE event_id IN (SELECT doc_id FROM documents EXCEPT SELECT event_id % (SELECT greatest(count(*), 1) FROM documents) FROM events
  WHERE event_id % 71 <> 0 AND event_id % 70 <> 0 AND event_id % 69 <> 0 AND event_id % 31 <> 0 AND event_id % 37 <> 0
   AND event_id % 29 <> 0 AND event_id % 23 <> 0 AND event_id % 19 <> 0 AND event_id % 17 <> 0 AND event_id % 16 <> 0)) e
JOIN documents d ON d.doc_id = e.shows
)"""

RAW_APPS = r"""raw_apps AS (
SELECT concat('com.', coalesce(t.event_type, concat('part', cast(p.p_partkey AS string)))) AS appId, p.p_name AS title, p.p_brand AS developer, p.p_type AS genre,
 cast(p.p_size AS string) AS score, cast(p.p_partkey * 100 AS string) AS ratings, 'Jan 20, 2026' AS released,
 '2026-01-20 10:30:00' AS lastUpdatedOn, cast(p.p_retailprice AS string) AS price
FROM part p LEFT JOIN (SELECT event_type, row_number() OVER (ORDER BY event_type) AS k FROM (SELECT DISTINCT event_type FROM events) x WHERE event_type <> 'error') t ON p.p_partkey = t.k
)"""

BATCHED = f"""raw_batched AS (SELECT *, CAST(floor(arrival_seq / {BATCH_ROWS}) AS BIGINT) AS batch_no FROM raw_reviews)"""


def clean_cte(name: str = "clean", src: str = "raw_reviews", batch: bool = False) -> str:
    """Cleaning chain over ``src`` as CTEs ending in ``name``."""
    part = "batch_no, " if batch else ""
    extra = "batch_no, " if batch else ""
    return f"""{name}_c1 AS (
  SELECT * REPLACE (coalesce(content, '') AS content) FROM {src} WHERE reviewId IS NOT NULL AND score IS NOT NULL),
{name}_c2 AS (
  SELECT * FROM {name}_c1 QUALIFY row_number() OVER (PARTITION BY {part}reviewId ORDER BY arrival_seq) = 1),
{name}_c3 AS (SELECT *, {num('score')} AS score_num, {ts('at_text')} AS at_ts FROM {name}_c2),
{name} AS (
  SELECT reviewId, {txt('userName', True)} AS userName, CAST(round_even(score_num, 0) AS INTEGER) AS score,
    {txt('content', False)} AS content, coalesce(at_ts, {tsl(AS_OF)}) AS reviewed_at,
    reviewCreatedVersion, {num('thumbsUpCount')} AS thumbsUpCount, {txt('replyContent', True)} AS replyContent,
    repliedAt, arrival_seq, app_id, extra, {extra}at_ts IS NULL AS reviewed_at_imputed
  FROM {name}_c3 WHERE score_num BETWEEN 1 AND 5)"""


def reviews_cte(name: str = "reviews", src: str = "clean", run_ts: str = RUN_TS, keep: str = "") -> str:
    """Mapped ``reviews`` table without ``raw_data``."""
    keep = f", {keep}" if keep else ""
    return f"""{name} AS (
  SELECT reviewId AS review_id, app_id, userName AS user_name, score, content, reviewed_at,
    reviewCreatedVersion AS review_created_version, CAST(round_even(thumbsUpCount, 0) AS BIGINT) AS thumbs_up_count,
    replyContent AS reply_content, {ts('repliedAt')} AS replied_at,
    {tsl(run_ts)} AS created_at, {tsl(run_ts)} AS updated_at{keep}
  FROM {src})"""


def clean_apps_cte(name: str = "clean_apps", src: str = "raw_apps") -> str:
    return f"""{name} AS (
  SELECT appId, title, developer, genre, {num('score')} AS score, {num('ratings')} AS ratings,
    {ts('released')} AS released, {ts('lastUpdatedOn')} AS lastUpdatedOn, {num('price')} AS price
  FROM {src})"""


def apps_cte(name: str = "apps", src: str = "clean_apps", run_ts: str = RUN_TS) -> str:
    """Mapped ``apps`` table without ``raw_data``."""
    return f"""{name} AS (
  SELECT coalesce(appId, '') AS app_id, title, developer, genre, CAST(NULL AS VARCHAR) AS category, score,
    CAST(round_even(ratings, 0) AS BIGINT) AS ratings, CAST(NULL AS BIGINT) AS reviews_count,
    CAST(NULL AS VARCHAR) AS installs, CAST(NULL AS BIGINT) AS min_installs, CAST(NULL AS BIGINT) AS real_installs,
    price, CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS BOOLEAN) AS free, released,
    lastUpdatedOn AS last_updated, CAST(NULL AS VARCHAR) AS version, CAST(NULL AS VARCHAR) AS content_rating,
    CAST(NULL AS VARCHAR) AS description, {tsl(run_ts)} AS created_at, {tsl(run_ts)} AS updated_at
  FROM {src})"""


TYPED = f"""typed AS (
  SELECT *, {num('score')} AS score_num, {ts('at_text')} AS at_ts, {num('thumbsUpCount')} AS thumbs_num FROM raw_reviews)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = [RAW_REVIEWS]
CLEAN = [RAW_REVIEWS, clean_cte()]
REVIEWS = [RAW_REVIEWS, clean_cte(), reviews_cte()]
APPS = [RAW_APPS, clean_apps_cte(), apps_cte()]


# ---------------------------------------------------------------- queries
ORACLE: dict[str, str] = {}


def o(name: str, sql: str) -> None:
    ORACLE[name] = sql


o("raw_scan", with_(*BASE) + "SELECT * FROM raw_reviews")
o("clean_reviews", with_(*CLEAN) + "SELECT * FROM clean")
o("dedupe_first", with_(*BASE) + """SELECT reviewId, arrival_seq, score FROM raw_reviews
WHERE reviewId IS NOT NULL AND score IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY reviewId ORDER BY arrival_seq) = 1""")
o("cleaning_stats", with_(*BASE, f"""tagged AS (
  SELECT CASE WHEN NOT ok THEN 'missing_required' WHEN rn > 1 THEN 'duplicate'
              WHEN NOT coalesce({num('score')} BETWEEN 1 AND 5, false) THEN 'invalid_score' END AS drop_reason
  FROM (SELECT *, row_number() OVER (PARTITION BY reviewId, ok ORDER BY arrival_seq) AS rn
        FROM (SELECT *, reviewId IS NOT NULL AND score IS NOT NULL AS ok FROM raw_reviews)))""") + """
SELECT count(*) AS total_records, count(*) FILTER (WHERE drop_reason IS NULL) AS valid_records,
  count(*) FILTER (WHERE drop_reason IS NOT NULL) AS invalid_records,
  count(*) FILTER (WHERE drop_reason = 'duplicate') AS duplicates_removed,
  count(*) FILTER (WHERE drop_reason = 'missing_required') AS missing_required_removed,
  count(*) FILTER (WHERE drop_reason = 'invalid_score') AS invalid_score_removed
FROM tagged""")
o("clean_apps", with_(RAW_APPS, clean_apps_cte()) + "SELECT * FROM clean_apps")
o("word_counts", with_(*CLEAN) + f"SELECT reviewId, {words('content')} AS word_count FROM clean")
o("text_normalized", with_(*BASE) + f"""SELECT arrival_seq, {txt('userName', True)} AS user_name_clean,
  {txt("coalesce(content, '')", False)} AS content_clean, {txt('content', True)} AS content_or_null FROM raw_reviews""")
o("script_class", with_(*CLEAN) + f"SELECT reviewId, {script('content')} AS script FROM clean")
o("has_emoji", with_(*CLEAN) + f"SELECT reviewId, {emoji('content')} AS has_emoji FROM clean")
o("coerce_numeric", with_(*BASE, TYPED) + """SELECT arrival_seq, score_num,
  CAST(round_even(score_num, 0) AS INTEGER) AS score_rounded, thumbs_num FROM typed""")
o("coerce_timestamp", with_(*BASE, TYPED) + "SELECT arrival_seq, at_ts FROM typed")
o("date_parts", with_(*BASE, TYPED) + """SELECT arrival_seq, CAST(at_ts AS DATE) AS review_day,
  strftime(at_ts, '%Y-%m-%d') AS review_date, dayname(at_ts) AS weekday, CAST(hour(at_ts) AS INTEGER) AS hour
FROM typed WHERE at_ts IS NOT NULL""")

o("rating_distribution", with_(*CLEAN) + f"""SELECT score, review_count, {pct('review_count', 'total')} AS pct FROM (
  SELECT score, count(*) AS review_count, sum(count(*)) OVER () AS total FROM clean GROUP BY score)
WHERE score IS NOT NULL""")
o("rating_distribution_filled", with_(*BASE, TYPED) + f"""SELECT CAST(b.s AS INTEGER) AS score_num,
  CAST(coalesce(g.n, 0) AS BIGINT) AS review_count, {pct('coalesce(g.n, 0)', '(SELECT count(*) FROM typed)')} AS pct
FROM range(1, 6) b(s) LEFT JOIN (SELECT score_num, count(*) AS n FROM typed GROUP BY score_num) g ON g.score_num = b.s""")
o("rating_moments", with_(*CLEAN) + f"""SELECT {r6('avg(score)')} AS mean_score, {r6('median(score)')} AS median_score,
  (SELECT score FROM clean GROUP BY score ORDER BY count(*) DESC, score LIMIT 1) AS mode_score,
  {r6('stddev_samp(score)')} AS std_score FROM clean""")
o("rating_skew", with_(*CLEAN, """m AS (SELECT avg(score) AS mu FROM clean),
k AS (SELECT avg(power(score - mu, 3)) / power(avg(power(score - mu, 2)), 1.5) AS sk FROM clean, m)""") + f"""
SELECT {r6('sk')} AS skewness,
  CASE WHEN sk < -0.5 THEN 'negative' WHEN sk > 0.5 THEN 'positive' ELSE 'balanced' END AS skew_label FROM k""")
o("sentiment_breakdown", with_(*CLEAN) + f"""SELECT positive, neutral, negative,
  {pct('positive', 'total')} AS positive_pct, {pct('neutral', 'total')} AS neutral_pct, {pct('negative', 'total')} AS negative_pct
FROM (SELECT count(*) FILTER (WHERE score >= 4) AS positive, count(*) FILTER (WHERE score = 3) AS neutral,
  count(*) FILTER (WHERE score <= 2) AS negative, count(*) AS total FROM clean)""")

o("word_count_stats", with_(*CLEAN) + f"""SELECT {r6('avg(w)')} AS mean_words, {r6('median(w)')} AS median_words,
  min(w) AS min_words, max(w) AS max_words FROM (SELECT {words('content')} AS w FROM clean)""")
_HIST = f"""SELECT word_count, review_count, {pct('review_count', 'sum(review_count) OVER ()')} AS pct FROM (
  SELECT {words('content')} AS word_count, count(*) AS review_count FROM clean GROUP BY 1)"""
o("word_count_hist", with_(*CLEAN) + _HIST)
o("word_count_hist_head", with_(*CLEAN) + _HIST + " ORDER BY word_count LIMIT 10")
o("char_length_stats", with_(*CLEAN) + f"""SELECT {r6('coalesce(avg(length(content)), 0)')} AS avg_length,
  CAST(coalesce(max(length(content)), 0) AS BIGINT) AS max_length, CAST(coalesce(min(length(content)), 0) AS BIGINT) AS min_length
FROM clean""")
o("language_mix", with_(*CLEAN) + f"""SELECT script, review_count, {pct('review_count', 'sum(review_count) OVER ()')} AS pct
FROM (SELECT {script('content')} AS script, count(*) AS review_count FROM clean GROUP BY 1)""")
o("emoji_share", with_(*CLEAN) + f"""SELECT with_emoji, total, {pct('with_emoji', 'total')} AS pct FROM (
  SELECT count(*) FILTER (WHERE {emoji('content')}) AS with_emoji, count(*) AS total FROM clean)""")

o("temporal_validity", with_(*BASE, TYPED) + f"""SELECT valid_timestamps, total, {pct('valid_timestamps', 'total')} AS pct
FROM (SELECT count(at_ts) AS valid_timestamps, count(*) AS total FROM typed)""")
o("temporal_range", with_(*BASE, TYPED) + """SELECT min(at_ts) AS earliest, max(at_ts) AS latest,
  CAST(floor(epoch_us(max(at_ts) - min(at_ts)) / 86400000000) AS BIGINT) AS span_days FROM typed WHERE at_ts IS NOT NULL""")
_DAILY = "SELECT CAST(at_ts AS DATE) AS review_day, count(*) AS review_count FROM typed WHERE at_ts IS NOT NULL GROUP BY 1"
o("daily_counts", with_(*BASE, TYPED) + _DAILY)
o("daily_count_stats", with_(*BASE, TYPED) + f"""SELECT {r6('avg(review_count)')} AS mean_per_day,
  {r6('median(review_count)')} AS median_per_day, min(review_count) AS min_per_day, max(review_count) AS max_per_day,
  count(*) AS days_present FROM ({_DAILY})""")
o("date_distribution", with_(*CLEAN) + """SELECT strftime(reviewed_at, '%Y-%m-%d') AS review_date, count(*) AS review_count
FROM clean WHERE NOT reviewed_at_imputed GROUP BY 1""")
o("day_of_week_counts", with_(*BASE, TYPED) + f"""SELECT weekday_no, weekday, review_count,
  {pct('review_count', 'sum(review_count) OVER ()')} AS pct FROM (
  SELECT CAST(isodow(at_ts) AS INTEGER) AS weekday_no, dayname(at_ts) AS weekday, count(*) AS review_count
  FROM typed WHERE at_ts IS NOT NULL GROUP BY 1, 2)""")
_HOURS = f"""SELECT hour, review_count, {pct('review_count', 'sum(review_count) OVER ()')} AS pct FROM (
  SELECT CAST(hour(at_ts) AS INTEGER) AS hour, count(*) AS review_count FROM typed WHERE at_ts IS NOT NULL GROUP BY 1)"""
o("hour_counts", with_(*BASE, TYPED) + _HOURS)
o("hour_counts_head", with_(*BASE, TYPED) + _HOURS + " ORDER BY hour LIMIT 5")

RAW_COLUMNS = [("arrival_seq", "bigint"), ("app_id", "string"), ("reviewId", "string"), ("userName", "string"),
               ("score", "string"), ("content", "string"), ("at_text", "string"), ("thumbsUpCount", "string"),
               ("reviewCreatedVersion", "string"), ("replyContent", "string"), ("repliedAt", "string"),
               ("extra", "string")]
_PROFILE = "SELECT count(*) AS total_rows, " + ", ".join(
    f"count({c}) AS nn_{c}" for c, _ in RAW_COLUMNS) + " FROM raw_reviews"
_UNPIVOT = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, nn_{c} AS non_null, total_rows FROM prof" for c, t in RAW_COLUMNS)
o("column_profile", with_(*BASE, f"prof AS ({_PROFILE})", f"u AS ({_UNPIVOT})")
  + f"SELECT column_name, data_type, non_null, total_rows, {pct('total_rows - non_null', 'total_rows')} AS missing_pct FROM u")
o("field_completeness", with_(*BASE, f"prof AS ({_PROFILE})", f"u AS ({_UNPIVOT})") + f"""SELECT column_name, non_null, total_rows,
  {pct('non_null', 'total_rows')} AS completeness_pct,
  CASE WHEN column_name IN ('reviewId', 'content', 'score') THEN 'critical'
       WHEN column_name IN ('reviewCreatedVersion', 'replyContent', 'repliedAt') THEN 'non_critical' ELSE 'other' END AS field_class,
  non_null = total_rows AS is_complete FROM u""")
_NUMS = " UNION ALL ".join(f"""SELECT '{c}' AS column_name, count({c}) AS count, {r6(f'avg({c})')} AS mean,
  {r6(f'stddev_samp({c})')} AS std, {r6(f'min({c})')} AS min, {r6(f'quantile_cont({c}, 0.25)')} AS p25,
  {r6(f'quantile_cont({c}, 0.5)')} AS p50, {r6(f'quantile_cont({c}, 0.75)')} AS p75, {r6(f'max({c})')} AS max FROM typed"""
                           for c in ("score_num", "thumbs_num"))
o("numeric_summary", with_(*BASE, TYPED) + _NUMS)
o("duplicate_ids", with_(*BASE) + """SELECT CAST(count(reviewId) - count(DISTINCT reviewId)
  + greatest(count(*) FILTER (WHERE reviewId IS NULL) - 1, 0) AS BIGINT) AS duplicate_ids FROM raw_reviews""")
o("invalid_scores", with_(*BASE, TYPED) + "SELECT count(*) FILTER (WHERE score_num < 1 OR score_num > 5) AS invalid_scores FROM typed")
o("empty_content", with_(*BASE) + f"""SELECT empty_content, total, {pct('empty_content', 'total')} AS pct FROM (
  SELECT count(*) FILTER (WHERE {strip("coalesce(content, '')")} = '') AS empty_content, count(*) AS total FROM raw_reviews)""")

# ---------------------------------------------------------------- tables and reads
o("reviews_mapped", with_(*REVIEWS) + "SELECT * FROM reviews")
o("apps_mapped", with_(*APPS) + "SELECT * FROM apps")
o("raw_json", with_(*CLEAN) + """SELECT reviewId AS review_id, reviewId AS j_review_id, CAST(score AS VARCHAR) AS j_score,
  content AS j_content, userName AS j_user_name, CAST(arrival_seq AS VARCHAR) AS j_arrival_seq, app_id AS j_app_id FROM clean""")
o("raw_json_apps", with_(RAW_APPS, clean_apps_cte()) + """SELECT coalesce(appId, '') AS app_id, appId AS j_app_id, title AS j_title,
  CAST(ratings AS VARCHAR) AS j_ratings FROM clean_apps""")
o("app_summary", with_(*APPS) + """SELECT app_id, title, developer, genre, score, ratings, reviews_count, installs, released,
  last_updated FROM apps""")
_RV = with_(*REVIEWS)
_NEWEST = " ORDER BY reviewed_at DESC NULLS LAST, review_id"
o("reviews_all", _RV + "SELECT * FROM reviews")
o("reviews_by_app", _RV + "SELECT * FROM reviews WHERE app_id = 'com.view'")
o("reviews_latest", _RV + "SELECT * FROM reviews" + _NEWEST + " LIMIT 100")
o("reviews_by_date_range", _RV + """SELECT * FROM reviews WHERE app_id = 'com.click'
  AND reviewed_at BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'""")
o("reviews_by_score_range", _RV + "SELECT * FROM reviews WHERE app_id = 'com.purchase' AND score BETWEEN 2 AND 4")
o("reviews_recent", _RV + "SELECT * FROM reviews WHERE app_id = 'com.view' AND reviewed_at >= TIMESTAMP '2024-01-25 00:00:00'")
o("search_reviews", _RV + "SELECT * FROM reviews WHERE app_id = 'com.signup' AND contains(lower(content), lower('50% OFF_'))")
o("search_reviews_like", _RV + "SELECT * FROM reviews WHERE app_id = 'com.signup' AND lower(content) LIKE '%gr_at%app%'")
o("app_lookup", with_(*APPS) + "SELECT * FROM apps WHERE app_id = 'com.view'")
o("review_count_by_app", _RV + "SELECT count(*) AS review_count FROM reviews WHERE app_id = 'com.view'")
o("preview", with_(*CLEAN) + "SELECT reviewId, userName, score, reviewed_at, content FROM clean ORDER BY arrival_seq LIMIT 3")
o("sample_reviews", with_(*CLEAN) + f"""SELECT reviewId, content, {script('content')} AS script FROM clean
ORDER BY md5(reviewId), reviewId LIMIT 5000""")
o("language_mix_sample", with_(*CLEAN, "s AS (SELECT * FROM clean WHERE md5(reviewId) < '8')") + f"""
SELECT script, review_count, {pct('review_count', 'sum(review_count) OVER ()')} AS pct
FROM (SELECT {script('content')} AS script, count(*) AS review_count FROM s GROUP BY 1)""")
o("feed_order_rating", _RV + """SELECT * FROM reviews
ORDER BY score DESC NULLS LAST, reviewed_at DESC NULLS LAST, review_id LIMIT 200""")
o("feed_order_relevant", _RV + """SELECT * FROM reviews
ORDER BY thumbs_up_count DESC NULLS LAST, reviewed_at DESC NULLS LAST, review_id LIMIT 200""")

_RA = with_(*REVIEWS, *APPS)
o("table_counts", _RA + """SELECT 'apps' AS table_name, count(*) AS row_count FROM apps
UNION ALL SELECT 'reviews', count(*) FROM reviews""")
o("reviews_by_app_counts", _RV + "SELECT app_id, count(*) AS review_count FROM reviews GROUP BY app_id")
o("reviews_by_score_counts", _RV + "SELECT score, count(*) AS review_count FROM reviews GROUP BY score")
o("statistics", _RA + """SELECT 'table' AS section, 'apps' AS item, count(*) AS value FROM apps
UNION ALL SELECT 'table', 'reviews', count(*) FROM reviews
UNION ALL SELECT 'app', app_id, count(*) FROM reviews GROUP BY app_id
UNION ALL SELECT 'score', CAST(score AS VARCHAR), count(*) FROM reviews GROUP BY score""")

# ---------------------------------------------------------------- merges
LOADS = [f"""typed2 AS (SELECT *, {ts('at_text')} AS at_ts2 FROM raw_reviews)""",
         f"load1 AS (SELECT * EXCLUDE (at_ts2) FROM typed2 WHERE at_ts2 < {tsl(CUTOFF)})",
         f"load2 AS (SELECT * EXCLUDE (at_ts2) FROM typed2 WHERE at_ts2 IS NULL OR at_ts2 >= {tsl(CUTOFF)})"]
o("insert_new_reviews", with_(RAW_REVIEWS, *LOADS, clean_cte("c1", "load1"), clean_cte("c2", "load2"),
                              reviews_cte("r1", "c1"), reviews_cte("r2", "c2", RUN_TS2))
  + "SELECT * FROM r2 WHERE NOT EXISTS (SELECT 1 FROM r1 WHERE r1.review_id = r2.review_id)")

RAW_APPS_UPDATE = r"""raw_apps_update AS (
SELECT concat('com.', coalesce(t.event_type, concat('part', cast(p.p_partkey AS string)))) AS appId, p.p_name AS title, p.p_brand AS developer, p.p_type AS genre,
 cast(p.p_size AS string) AS score, cast(p.p_partkey * 100 AS string) AS ratings, 'Jan 20, 2026' AS released,
 '2026-01-25T08:00:00Z' AS lastUpdatedOn, cast(p.p_retailprice AS string) AS price
FROM part p LEFT JOIN (SELECT event_type, row_number() OVER (ORDER BY event_type) + 10 AS k FROM (SELECT DISTINCT event_type FROM events) x WHERE event_type <> 'view') t ON p.p_partkey = t.k
)"""
_APP_DATA = ["title", "developer", "genre", "category", "score", "ratings", "reviews_count", "installs", "min_installs",
             "real_installs", "price", "currency", "free", "released", "last_updated", "version", "content_rating",
             "description"]
o("upsert_apps", with_(RAW_APPS, clean_apps_cte(), apps_cte("old"), RAW_APPS_UPDATE,
                       clean_apps_cte("clean_new", "raw_apps_update"), apps_cte("new", "clean_new", RUN_TS2))
  + "SELECT coalesce(n.app_id, o.app_id) AS app_id, "
  + ", ".join(f"CASE WHEN n.app_id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in _APP_DATA)
  + f""", CASE WHEN n.app_id IS NOT NULL THEN coalesce(o.created_at, {tsl(RUN_TS2)}) ELSE o.created_at END AS created_at,
  CASE WHEN n.app_id IS NOT NULL THEN {tsl(RUN_TS2)} ELSE o.updated_at END AS updated_at
FROM old o FULL OUTER JOIN new n ON o.app_id = n.app_id""")
o("accepted_reviews", _RA + "SELECT * FROM reviews r WHERE EXISTS (SELECT 1 FROM apps a WHERE a.app_id = r.app_id)")
o("orphan_reviews", _RA + "SELECT * FROM reviews r WHERE NOT EXISTS (SELECT 1 FROM apps a WHERE a.app_id = r.app_id)")
o("constraint_rejects", with_(RAW_REVIEWS, *LOADS, clean_cte("c1", "load1"), reviews_cte("r1", "c1"), *APPS, f"""inc AS (
  SELECT arrival_seq, reviewId AS review_id, app_id, {num('score')} AS score, content FROM raw_reviews)""", """d AS (
  SELECT *, CASE WHEN review_id IS NULL THEN 'null_review_id' WHEN app_id IS NULL THEN 'null_app_id'
    WHEN score IS NULL THEN 'null_score' WHEN NOT (score BETWEEN 1 AND 5) THEN 'score_out_of_range'
    WHEN content IS NULL THEN 'null_content'
    WHEN NOT EXISTS (SELECT 1 FROM apps a WHERE a.app_id = inc.app_id) THEN 'orphan_app' END AS defect FROM inc)""",
  """k AS (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY arrival_seq) AS rn,
    EXISTS (SELECT 1 FROM r1 WHERE r1.review_id = d.review_id) AS ex FROM d WHERE defect IS NULL)""") + """
SELECT arrival_seq, review_id, app_id, CASE WHEN rn > 1 THEN 'duplicate_key' WHEN ex THEN 'existing_key' END AS reject_reason FROM k
UNION ALL SELECT arrival_seq, review_id, app_id, defect FROM d WHERE defect IS NOT NULL""")
o("cascade_delete_apps", with_(*APPS) + "SELECT * FROM apps WHERE app_id NOT IN (SELECT app_id FROM apps WHERE score < 25)")
o("cascade_delete_reviews", _RA + """SELECT review_id, app_id, score FROM reviews
WHERE app_id NOT IN (SELECT app_id FROM apps WHERE score < 25)""")

# ---------------------------------------------------------------- incremental run
INC = [RAW_REVIEWS, BATCHED, clean_cte("cb", "raw_batched", batch=True),
       "ins AS (SELECT * FROM cb QUALIFY row_number() OVER (PARTITION BY reviewId ORDER BY batch_no, arrival_seq) = 1)"]
o("incremental_ingest", with_(*INC, reviews_cte("r", "ins", keep="batch_no")) + "SELECT * FROM r")
_METRICS = with_(*INC, """f AS (SELECT batch_no, count(*) AS fetched_count FROM raw_batched GROUP BY 1),
c AS (SELECT batch_no, count(*) AS n FROM cb GROUP BY 1),
i AS (SELECT batch_no, count(*) AS n FROM ins GROUP BY 1),
m AS (SELECT f.batch_no, f.fetched_count, CAST(coalesce(c.n, 0) AS BIGINT) AS cleaned_count,
  CAST(coalesce(i.n, 0) AS BIGINT) AS inserted_count,
  CAST(greatest(coalesce(c.n, 0) - coalesce(i.n, 0), 0) AS BIGINT) AS duplicates_or_existing,
  coalesce(c.n, 0) = 0 AS clean_empty
  FROM f LEFT JOIN c USING (batch_no) LEFT JOIN i USING (batch_no))""")
o("batch_metrics", _METRICS + "SELECT * FROM m")
o("run_status", _METRICS + """SELECT count(*) AS batches_processed, CAST(sum(fetched_count) AS BIGINT) AS total_reviews_fetched,
  CAST(sum(cleaned_count) AS BIGINT) AS total_reviews_cleaned, CAST(sum(inserted_count) AS BIGINT) AS total_reviews_inserted,
  CAST(sum(duplicates_or_existing) AS BIGINT) AS total_duplicates_or_existing,
  CASE WHEN coalesce(sum(fetched_count), 0) = 0 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN coalesce(sum(inserted_count), 0) > 0 THEN 'success' ELSE 'failed' END AS reference_status FROM m""")
o("feed_slice", with_(*BASE) + """SELECT arrival_seq, reviewId, app_id, max(arrival_seq) OVER () AS next_token
FROM (SELECT * FROM raw_reviews ORDER BY arrival_seq LIMIT 200)""")
o("feed_slice_resume", with_(*BASE) + """SELECT arrival_seq, reviewId, app_id, max(arrival_seq) OVER () AS next_token
FROM (SELECT * FROM raw_reviews WHERE arrival_seq > (SELECT max(arrival_seq) FROM (SELECT arrival_seq FROM raw_reviews
  ORDER BY arrival_seq LIMIT 200)) ORDER BY arrival_seq LIMIT 200)""")
o("pages_union", with_(RAW_REVIEWS, BATCHED) + """SELECT * FROM raw_batched WHERE batch_no % 2 = 0
UNION ALL BY NAME SELECT * EXCLUDE (extra, reviewCreatedVersion) FROM raw_batched WHERE batch_no % 2 = 1""")
o("required_field_conformance", with_(RAW_REVIEWS, BATCHED, """g AS (SELECT app_id, batch_no, count(*) AS total_rows,
  count(*) FILTER (WHERE reviewId IS NULL) AS m_reviewId, count(*) FILTER (WHERE content IS NULL) AS m_content,
  count(*) FILTER (WHERE score IS NULL) AS m_score FROM raw_batched GROUP BY 1, 2)""") + " UNION ALL ".join(
    f"SELECT app_id, batch_no, '{f}' AS field, m_{f} AS missing_rows, total_rows, m_{f} = total_rows AS all_missing FROM g"
    for f in ("reviewId", "content", "score")))

# ---------------------------------------------------------------- monitoring
HISTORY = [RAW_REVIEWS, f"""hist_base AS (
  SELECT app_id, reviewId, {ts('at_text')} AS at_ts, {num('score')} BETWEEN 1 AND 5 AS ok FROM raw_reviews)""",
           """hist_g AS (
  SELECT app_id, CAST(at_ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok,
    count(DISTINCT CASE WHEN ok THEN reviewId END) AS n_new FROM hist_base WHERE at_ts IS NOT NULL GROUP BY 1, 2)""",
           """hist_f AS (
  SELECT *, CASE WHEN app_id = 'com.view' THEN 'incremental' ELSE 'standard' END AS mode,
    CAST(day AS TIMESTAMP) + INTERVAL 2 HOUR AS st,
    CASE WHEN dayofmonth(day) % 7 = 0 THEN 0 WHEN dayofmonth(day) % 5 = 0 THEN 1 ELSE 20 END AS factor FROM hist_g)""",
           """history AS (
  SELECT concat_ws('-', app_id, mode, strftime(day, '%Y%m%d')) AS run_id, mode, app_id, 'warehouse/reviews' AS db_path,
    st AS start_time_utc, st + to_seconds(n) AS end_time_utc, CAST(n AS DOUBLE) AS duration_seconds,
    CASE WHEN n * factor = 0 THEN 'failed' ELSE 'success' END AS status, CAST(NULL AS BIGINT) AS target_reviews,
    true AS fetch_app_info, CAST(CASE WHEN n * factor = 0 THEN 0 ELSE ceil(n / 100) END AS BIGINT) AS batches_processed,
    CAST(n * factor AS BIGINT) AS total_reviews_fetched, CAST(n_ok * factor AS BIGINT) AS total_reviews_cleaned,
    CAST(n_new * factor AS BIGINT) AS total_reviews_inserted,
    CAST(greatest(n_ok * factor - n_new * factor, 0) AS BIGINT) AS total_duplicates_or_existing,
    CASE WHEN n * factor = 0 THEN 'fetch_reviews' END AS error_stage,
    CASE WHEN n * factor = 0 THEN 'No reviews fetched' END AS error_message FROM hist_f)""",
           """prev AS (
  SELECT *, lag(run_id) OVER w AS previous_run_id, lag(status) OVER w AS previous_status,
    lag(total_reviews_fetched) OVER w AS previous_fetched, lag(total_reviews_inserted) OVER w AS previous_inserted
  FROM history WINDOW w AS (PARTITION BY app_id, mode ORDER BY end_time_utc, run_id))""",
           """mon AS (
  SELECT *, CASE WHEN previous_run_id IS NOT NULL AND coalesce(previous_fetched, 0) > 0 THEN
      round(((coalesce(total_reviews_fetched, 0) - previous_fetched)::DOUBLE / previous_fetched::DOUBLE) * 100.0, 2) END AS fetched_change_pct,
    CASE WHEN previous_run_id IS NOT NULL AND coalesce(previous_inserted, 0) > 0 THEN
      round(((coalesce(total_reviews_inserted, 0) - previous_inserted)::DOUBLE / previous_inserted::DOUBLE) * 100.0, 2) END AS inserted_change_pct
  FROM prev)""",
           """anom AS (
  SELECT *, list_filter([
    CASE WHEN status = 'failed' THEN 'run_failed' END,
    CASE WHEN previous_run_id IS NOT NULL AND fetched_change_pct <= -80 THEN 'material_fetched_drop' END,
    CASE WHEN previous_run_id IS NOT NULL AND inserted_change_pct <= -80 THEN 'material_inserted_drop' END,
    CASE WHEN previous_run_id IS NOT NULL AND coalesce(total_reviews_inserted, 0) = 0 AND coalesce(previous_inserted, 0) > 0
         THEN 'zero_inserted_after_nonzero_baseline' END,
    CASE WHEN previous_run_id IS NOT NULL AND coalesce(total_reviews_fetched, 0) = 0 AND coalesce(previous_fetched, 0) > 0
         THEN 'zero_fetched_after_nonzero_baseline' END], lambda x: x IS NOT NULL) AS anomalies FROM mon)"""]
_H = with_(*HISTORY)
o("previous_run", _H + """SELECT run_id, app_id, mode, previous_run_id, previous_status, previous_fetched, previous_inserted FROM prev""")
o("run_change_pct", _H + "SELECT run_id, fetched_change_pct, inserted_change_pct FROM mon")
o("run_anomalies", _H + """SELECT run_id, array_to_string(anomalies, ',') AS anomaly_list, len(anomalies) > 0 AS material_change_detected
FROM anom""")
o("latest_run", _H + """SELECT app_id, mode, run_id, end_time_utc, status FROM history
QUALIFY row_number() OVER (PARTITION BY app_id, mode ORDER BY end_time_utc DESC, run_id DESC) = 1""")
o("run_events", _H + """SELECT run_id, 0 AS seq, 'run_started' AS event, CAST(NULL AS BIGINT) AS fetched, CAST(NULL AS VARCHAR) AS error_stage
FROM history UNION ALL
SELECT run_id, 1, CASE WHEN status = 'success' THEN 'run_completed' ELSE 'run_failed' END, total_reviews_fetched, error_stage
FROM history""")

# ---------------------------------------------------------------- files, stores, streaming
o("csv_roundtrip", with_(*BASE) + "SELECT * FROM raw_reviews")
o("csv_roundtrip_apps", ORACLE["apps_mapped"])
o("landing_json_scan", with_(*BASE) + "SELECT * FROM raw_reviews WHERE CAST(floor(arrival_seq / 500) AS BIGINT) % 2 = 0 "
  "UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS extra, CAST(NULL AS VARCHAR) AS reviewCreatedVersion) "
  "FROM raw_reviews WHERE CAST(floor(arrival_seq / 500) AS BIGINT) % 2 = 1")
o("reviews_table_scan", ORACLE["reviews_all"])
o("reviews_table_read_pruned", ORACLE["reviews_by_date_range"])
_FLAT = """SELECT run_id, app_id, mode, status, start_time_utc, total_reviews_fetched, total_reviews_inserted, previous_run_id,
  fetched_change_pct, array_to_string(anomalies, ',') AS anomaly_list FROM anom"""
o("run_history_roundtrip", _H + _FLAT)
o("run_history_scan", _H + _FLAT)
o("stream_ingest", ORACLE["incremental_ingest"])
o("stream_batch_metrics", ORACLE["batch_metrics"])

o("batch_events", _METRICS + """SELECT batch_no, CASE WHEN cleaned_count = 0 THEN 'batch_clean_empty' ELSE 'batch_processed' END AS event,
  inserted_count FROM m
UNION ALL SELECT batch_no, 'batch_insert_failed', inserted_count FROM m WHERE cleaned_count > 0 AND inserted_count = 0""")
_STD = with_(RAW_REVIEWS, *LOADS, clean_cte("c1", "load1"), clean_cte("c2", "load2"), reviews_cte("r1", "c1"),
             reviews_cte("r2", "c2", RUN_TS2), RAW_APPS, clean_apps_cte(), apps_cte(),
             "acc AS (SELECT * FROM r2 WHERE app_id IN (SELECT app_id FROM apps))",
             "ins AS (SELECT * FROM acc WHERE NOT EXISTS (SELECT 1 FROM r1 WHERE r1.review_id = acc.review_id))")
o("standard_run", _STD + "SELECT * FROM ins")
o("standard_run_summary", _STD + """, t AS (SELECT (SELECT count(*) FROM load2) AS f, (SELECT count(*) FROM c2) AS c,
  (SELECT count(*) FROM r2 WHERE app_id NOT IN (SELECT app_id FROM apps)) AS o, (SELECT count(*) FROM ins) AS i)
SELECT f AS total_reviews_fetched, c AS total_reviews_cleaned, o AS total_orphans, i AS total_reviews_inserted,
  CAST(greatest(c - i, 0) AS BIGINT) AS total_duplicates_or_existing,
  CASE WHEN f = 0 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN i > 0 THEN 'success' ELSE 'failed' END AS reference_status FROM t""")

_JOB = with_(*REVIEWS, *APPS, """per_app AS (
  SELECT r.app_id, count(*) AS f FROM raw_reviews r GROUP BY 1),
c1 AS (SELECT app_id, count(*) AS c FROM reviews GROUP BY 1),
i1 AS (SELECT app_id, count(*) AS i FROM reviews WHERE app_id IN (SELECT app_id FROM apps) GROUP BY 1),
runs AS (
  SELECT 'run-1' AS run_id, p.app_id, p.f, coalesce(c1.c, 0) AS c, coalesce(i1.i, 0) AS i FROM per_app p
    LEFT JOIN c1 USING (app_id) LEFT JOIN i1 USING (app_id)
  UNION ALL
  SELECT 'run-2', p.app_id, p.f, coalesce(c1.c, 0), 0 FROM per_app p LEFT JOIN c1 USING (app_id)),
mon AS (
  SELECT *, lag(run_id) OVER w AS prev_id, lag(i) OVER w AS prev_i, lag(f) OVER w AS prev_f FROM runs
  WINDOW w AS (PARTITION BY app_id ORDER BY run_id))""")
o("standard_job_replay", _JOB + """SELECT run_id, app_id, CASE WHEN f = 0 THEN 'failed' ELSE 'success' END AS status,
  CAST(f AS BIGINT) AS total_reviews_fetched, CAST(c AS BIGINT) AS total_reviews_cleaned, CAST(i AS BIGINT) AS total_reviews_inserted,
  CAST(greatest(c - i, 0) AS BIGINT) AS total_duplicates_or_existing, prev_id AS previous_run_id,
  CASE WHEN prev_id IS NOT NULL AND prev_i > 0 THEN round(((i - prev_i)::DOUBLE / prev_i::DOUBLE) * 100.0, 2) END AS inserted_change_pct,
  array_to_string(list_filter([
    CASE WHEN f = 0 THEN 'run_failed' END,
    CASE WHEN prev_id IS NOT NULL AND prev_f > 0 AND round(((f - prev_f)::DOUBLE / prev_f::DOUBLE) * 100.0, 2) <= -80 THEN 'material_fetched_drop' END,
    CASE WHEN prev_id IS NOT NULL AND prev_i > 0 AND round(((i - prev_i)::DOUBLE / prev_i::DOUBLE) * 100.0, 2) <= -80 THEN 'material_inserted_drop' END,
    CASE WHEN prev_id IS NOT NULL AND i = 0 AND prev_i > 0 THEN 'zero_inserted_after_nonzero_baseline' END,
    CASE WHEN prev_id IS NOT NULL AND f = 0 AND prev_f > 0 THEN 'zero_fetched_after_nonzero_baseline' END],
    lambda x: x IS NOT NULL), ',') AS anomaly_list
FROM mon""")
o("standard_job_tables", _RA + "SELECT * FROM reviews WHERE app_id IN (SELECT app_id FROM apps)")

o("raw_json_variant", with_(*CLEAN) + """SELECT reviewId AS review_id, score AS v_score, arrival_seq AS v_arrival_seq,
  thumbsUpCount AS v_thumbs, reviewed_at_imputed AS v_imputed FROM clean""")
o("insert_new_reviews_bucketed", ORACLE["insert_new_reviews"])
o("numeric_summary_distributed", ORACLE["numeric_summary"])
o("incremental_job_history", with_(*INC, RAW_APPS, """r1 AS (
  SELECT f.app_id, f.fetched, coalesce(c.cleaned, 0) AS cleaned, coalesce(i.inserted, 0) AS inserted, f.batches FROM
    (SELECT app_id, count(*) AS fetched, count(DISTINCT batch_no) AS batches FROM raw_batched GROUP BY 1) f
    LEFT JOIN (SELECT app_id, count(*) AS cleaned FROM cb GROUP BY 1) c USING (app_id)
    LEFT JOIN (SELECT app_id, count(*) AS inserted FROM ins GROUP BY 1) i USING (app_id)),
runs AS (
  SELECT 'inc-1' AS run_id, coalesce(r1.app_id, a.appId) AS app_id, coalesce(fetched, 0) AS fetched, coalesce(cleaned, 0) AS cleaned,
    coalesce(inserted, 0) AS inserted, coalesce(batches, 0) AS batches FROM r1 FULL JOIN raw_apps a ON a.appId = r1.app_id
  UNION ALL SELECT 'inc-2', appId, 0, 0, 0, 0 FROM raw_apps),
mon AS (SELECT *, lag(run_id) OVER w AS prev_id, lag(fetched) OVER w AS prev_f, lag(inserted) OVER w AS prev_i
  FROM runs WINDOW w AS (PARTITION BY app_id ORDER BY run_id))""") + """
SELECT run_id, app_id, 'incremental' AS mode, CASE WHEN fetched = 0 THEN 'failed' ELSE 'success' END AS status,
  CAST(batches AS BIGINT) AS batches_processed, CAST(fetched AS BIGINT) AS total_reviews_fetched,
  CAST(cleaned AS BIGINT) AS total_reviews_cleaned, CAST(inserted AS BIGINT) AS total_reviews_inserted,
  prev_id AS previous_run_id,
  array_to_string(list_filter([
    CASE WHEN fetched = 0 THEN 'run_failed' END,
    CASE WHEN prev_id IS NOT NULL AND prev_f > 0 AND round(((fetched - prev_f)::DOUBLE / prev_f::DOUBLE) * 100.0, 2) <= -80 THEN 'material_fetched_drop' END,
    CASE WHEN prev_id IS NOT NULL AND prev_i > 0 AND round(((inserted - prev_i)::DOUBLE / prev_i::DOUBLE) * 100.0, 2) <= -80 THEN 'material_inserted_drop' END,
    CASE WHEN prev_id IS NOT NULL AND inserted = 0 AND prev_i > 0 THEN 'zero_inserted_after_nonzero_baseline' END,
    CASE WHEN prev_id IS NOT NULL AND fetched = 0 AND prev_f > 0 THEN 'zero_fetched_after_nonzero_baseline' END],
    lambda x: x IS NOT NULL), ',') AS anomaly_list
FROM mon""")

# ---------------------------------------------------------------- incremental run with the tables' promises
# accepted: the first copy in feed order among those whose app is stored; orphans: every copy whose app is not
_CHECKED = with_(*INC, *APPS, """known AS (SELECT * FROM cb WHERE app_id IN (SELECT app_id FROM apps)),
acc AS (SELECT * FROM known QUALIFY row_number() OVER (PARTITION BY reviewId ORDER BY batch_no, arrival_seq) = 1),
orph AS (SELECT * FROM cb WHERE app_id NOT IN (SELECT app_id FROM apps)),
pb AS (SELECT f.batch_no, fetched_count, coalesce(cleaned_count, 0) AS cleaned_count, coalesce(inserted_count, 0) AS inserted_count,
    coalesce(orphan_count, 0) AS orphan_count
  FROM (SELECT batch_no, count(*) AS fetched_count FROM raw_batched GROUP BY 1) f
  LEFT JOIN (SELECT batch_no, count(*) AS cleaned_count FROM cb GROUP BY 1) c USING (batch_no)
  LEFT JOIN (SELECT batch_no, count(*) AS inserted_count FROM acc GROUP BY 1) i USING (batch_no)
  LEFT JOIN (SELECT batch_no, count(*) AS orphan_count FROM orph GROUP BY 1) p USING (batch_no))""")
o("stream_quarantine", _CHECKED + """SELECT reviewId AS review_id, app_id, score, batch_no, arrival_seq, 'orphan_app' AS reject_reason FROM orph""")
o("stream_readmission", _CHECKED + """, late AS (
  SELECT * FROM orph WHERE reviewId NOT IN (SELECT reviewId FROM acc)
  QUALIFY row_number() OVER (PARTITION BY reviewId ORDER BY batch_no, arrival_seq) = 1),
""" + reviews_cte("r1", "acc") + ",\n" + reviews_cte("r2", "late", RUN_TS2) + "\nSELECT * FROM r1 UNION ALL SELECT * FROM r2")
o("stream_max_batches", _CHECKED + """SELECT CASE WHEN batch_no = (SELECT min(batch_no) FROM pb) THEN 'run-1' ELSE 'run-2' END AS run_id,
  batch_no, fetched_count, cleaned_count, inserted_count, orphan_count FROM pb""")
o("stream_events", _CHECKED + """SELECT 'run-1' AS run_id, batch_no, CASE WHEN cleaned_count = 0 THEN 'batch_clean_empty' ELSE 'batch_processed' END AS event,
  inserted_count, CAST(NULL AS BIGINT) AS readmitted_count FROM pb
UNION ALL SELECT 'run-1', batch_no, 'batch_insert_failed', inserted_count, NULL FROM pb WHERE cleaned_count > 0 AND inserted_count = 0
UNION ALL SELECT 'run-2', batch_no, 'orphans_readmitted', NULL, orphan_count FROM pb WHERE orphan_count > 0""")
o("failed_run_history", _CHECKED.replace("raw_batched AS (SELECT *, ", "raw_batched AS (SELECT * FROM (SELECT *, ").replace(
    "AS batch_no FROM raw_reviews)", "AS batch_no FROM raw_reviews) WHERE batch_no > 0)") + """, per AS (
  SELECT coalesce(a.app_id, f.app_id) AS app_id, coalesce(f.n, 0) AS fetched, coalesce(f.b, 0) AS batches, coalesce(i.n, 0) AS inserted
  FROM apps a FULL JOIN (SELECT app_id, count(*) AS n, count(DISTINCT batch_no) AS b FROM raw_batched GROUP BY 1) f ON a.app_id = f.app_id
  LEFT JOIN (SELECT app_id, count(*) AS n FROM acc GROUP BY 1) i ON i.app_id = coalesce(a.app_id, f.app_id)),
h AS (
  SELECT 'run-1' AS run_id, app_id, CASE WHEN fetched = 0 THEN 'failed' ELSE 'success' END AS status, true AS fetch_app_info, batches, fetched, inserted,
    CASE WHEN fetched = 0 THEN 'fetch_reviews' END AS error_stage, CASE WHEN fetched = 0 THEN 'No reviews fetched' END AS error_kind, 0 AS pf, 0 AS pi
  FROM per
  UNION ALL SELECT 'run-2', app_id, 'failed', false, 0, 0, 0, 'fetch_reviews', 'LateBatch', fetched, inserted FROM per WHERE app_id IN (SELECT app_id FROM apps))
SELECT run_id, app_id, status, fetch_app_info, CAST(batches AS BIGINT) AS batches_processed, CAST(fetched AS BIGINT) AS total_reviews_fetched,
  CAST(inserted AS BIGINT) AS total_reviews_inserted, error_stage, error_kind,
  array_to_string(list_filter([CASE WHEN status = 'failed' THEN 'run_failed' END,
    CASE WHEN pf > 0 AND fetched <= 0.2 * pf THEN 'material_fetched_drop' END, CASE WHEN pi > 0 AND inserted <= 0.2 * pi THEN 'material_inserted_drop' END,
    CASE WHEN inserted = 0 AND pi > 0 THEN 'zero_inserted_after_nonzero_baseline' END,
    CASE WHEN fetched = 0 AND pf > 0 THEN 'zero_fetched_after_nonzero_baseline' END], lambda x: x IS NOT NULL), ',') AS anomaly_list
FROM h""")

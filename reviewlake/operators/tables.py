"""Curated tables and merges, expressed as joins on Parquet data.

Spark has no MERGE or CHECK on plain Parquet tables, so:
  * insert-or-ignore  = anti-join of the incoming rows on the key, then append
  * upsert            = full outer join on the key, incoming-else-existing
  * foreign key       = semi-join (accepted) / anti-join (orphans, quarantined)
  * constraints       = a reason-coded validation column; rejects are kept
  * cascade delete    = anti-join of both tables on the deleted app ids

Join strategy: the probe side that can grow without bound (existing reviews)
is never broadcast.  A side is broadcast only after ``fits`` has counted at most
``max_rows`` rows of it; otherwise the join shuffles on the key (review id,
or app id for the small apps table) and AQE handles skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.coerce import to_double, to_timestamp_ntz
from reviewlake.operators.clean import first_copies, split_marked, ts_literal
from reviewlake.plans.joins import fits

BROADCAST_ROWS = 2_000_000  # key-only rows (one string each) we allow in a broadcast

# Table layouts.
REVIEW_COLUMNS = [
    "review_id", "app_id", "user_name", "score", "content", "reviewed_at",
    "review_created_version", "thumbs_up_count", "reply_content", "replied_at",
    "raw_data", "created_at", "updated_at",
]
APP_COLUMNS = [
    "app_id", "title", "developer", "genre", "category", "score", "ratings",
    "reviews_count", "installs", "min_installs", "real_installs", "price", "currency",
    "free", "released", "last_updated", "version", "content_rating", "description",
    "raw_data", "created_at", "updated_at",
]
# (table column, source field, type) for apps
APP_FIELDS = [
    ("title", "title", "string"),
    ("developer", "developer", "string"),
    ("genre", "genre", "string"),
    ("score", "score", "double"),
    ("ratings", "ratings", "bigint"),
    ("reviews_count", "reviews", "bigint"),
    ("installs", "installs", "string"),
    ("min_installs", "minInstalls", "bigint"),
    ("real_installs", "realInstalls", "bigint"),
    ("price", "price", "double"),
    ("currency", "currency", "string"),
    ("free", "free", "boolean"),
    ("released", "released", "timestamp_ntz"),
    ("last_updated", "lastUpdatedOn", "timestamp_ntz"),
    ("version", "version", "string"),
    ("content_rating", "contentRating", "string"),
    ("description", "description", "string"),
]
REJECT_REASONS = [
    "null_review_id", "null_app_id", "null_score", "score_out_of_range", "null_content",
    "duplicate_key", "existing_key", "orphan_app",
]


def _field(df: DataFrame, name: str, typ: str):
    if name not in df.columns:
        return F.lit(None).cast(typ)
    c = F.col(name)
    if typ == "bigint":
        return F.bround(c.try_cast("double"), 0).try_cast("bigint")
    if typ == "timestamp_ntz":
        return to_timestamp_ntz(c) if dict(df.dtypes)[name] == "string" else c.cast("timestamp_ntz")
    return c.try_cast(typ) if typ != "string" else c.cast("string")


def raw_json(df: DataFrame):
    """Whole-row JSON text (nulls written as null) for the ``raw_data`` column."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})


# ---------------------------------------------------------------- mapping
def map_reviews(clean: DataFrame, run_ts, app_id: str | None = None, keep: list[str] | None = None,
                capture: list[str] | None = None) -> DataFrame:
    """Cleaned reviews -> the 13-column ``reviews`` layout.

    Each row keeps its own ``app_id`` so all apps load in one job; pass
    ``app_id`` to stamp a single app as the per-app loader does.
    ``capture``: the columns of the JSON capture (all, if not given).
    """
    df = clean if app_id is None else clean.withColumn("app_id", F.lit(app_id))
    ts = ts_literal(run_ts)
    replied = _field(df, "repliedAt", "timestamp_ntz")
    thumbs = F.bround(F.col("thumbsUpCount"), 0).try_cast("bigint") if "thumbsUpCount" in df.columns else F.lit(None).cast("bigint")
    return df.select(
        F.col("reviewId").alias("review_id"),
        F.col("app_id").cast("string").alias("app_id"),
        (F.col("userName") if "userName" in df.columns else F.lit(None).cast("string")).alias("user_name"),
        F.col("score").cast("int").alias("score"),
        F.col("content").alias("content"),
        F.col("reviewed_at").alias("reviewed_at"),
        (F.col("reviewCreatedVersion") if "reviewCreatedVersion" in df.columns else F.lit(None).cast("string")).alias("review_created_version"),
        thumbs.alias("thumbs_up_count"),
        (F.col("replyContent") if "replyContent" in df.columns else F.lit(None).cast("string")).alias("reply_content"),
        replied.alias("replied_at"),
        raw_json(clean.select(*[F.col(f"`{c}`") for c in capture]) if capture else clean).alias("raw_data"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
        *[F.col(c) for c in (keep or [])],
    )


def map_apps(apps: DataFrame, run_ts) -> DataFrame:
    """Cleaned app metadata (source field names) -> the 22-column ``apps`` layout.

    ``category`` is the category text, else the JSON of ``categories``.
    """
    ts = ts_literal(run_ts)
    if "category" in apps.columns:
        cat = F.col("category").cast("string") if dict(apps.dtypes)["category"] == "string" else F.to_json("category")
    else:
        cat = F.lit(None).cast("string")
    if "categories" in apps.columns:
        cats = F.col("categories")
        cats = cats if dict(apps.dtypes)["categories"] == "string" else F.to_json(cats)
        cat = F.coalesce(cat, cats)
    cols = [F.coalesce(F.col("appId"), F.lit("")).alias("app_id")]
    for tcol, src, typ in APP_FIELDS:
        cols.append(_field(apps, src, typ).alias(tcol))
        if tcol == "genre":
            cols.append(cat.alias("category"))
    cols += [raw_json(apps).alias("raw_data"), ts.alias("created_at"), ts.alias("updated_at")]
    return apps.select(*cols).select(*APP_COLUMNS)


# ---------------------------------------------------------------- merges
def insert_new(existing: DataFrame, incoming: DataFrame, key: str = "review_id",
               incoming_rows: int | None = None, max_broadcast_rows: int = BROADCAST_ROWS, keys_first: bool = False) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing`` (insert-or-ignore).

    ``incoming`` must already be unique on ``key`` (the cleaner guarantees it).

    * ``incoming_rows`` known and within ``max_broadcast_rows`` (a micro-batch
      the caller has persisted and counted): the stored keys are probed
      map-side against a broadcast of the incoming keys — the large table is
      scanned (key column only, runtime Bloom filters help) but never shuffled.
    * ``keys_first`` (a backfill of unknown size with long rows): the keys of both
      sides are joined by themselves; only incoming rows that may clash are shuffled,
      at the price of reading the incoming side twice.
    * otherwise (a backfill of unknown size): one shuffled anti-join on the
      key; no extra job is spent sizing the incoming side, and AQE splits
      skewed partitions.
    """
    if incoming_rows is not None and incoming_rows <= max_broadcast_rows:
        keys = incoming.select(key)
        clashes = existing.select(key).join(F.broadcast(keys), key, "left_semi")
        # clashes is a subset of the incoming keys: bounded by the same count
        return incoming.join(F.broadcast(clashes), key, "left_anti")
    if keys_first:
        clashes = incoming.select(key).join(existing.select(key), key, "left_semi")
        again, alone = split_marked(incoming, clashes, [key])
        return again.join(existing.select(key), key, "left_anti").union(alone)
    return incoming.join(existing.select(key), key, "left_anti")


def first_writer_wins(rows: DataFrame, key: str, order_cols: list[str], bounded: bool = False) -> DataFrame:
    """Sequential insert-or-ignore of a feed in ``order_cols`` order: first row per key."""
    return first_copies(rows, [key], order_cols, bounded)


def upsert(existing: DataFrame, incoming: DataFrame, run_ts, key: str = "app_id") -> DataFrame:
    """Insert-or-update on ``key``: an incoming row replaces every field, keeps the
    stored ``created_at`` and stamps ``updated_at``; untouched rows stay as stored.

    ``incoming`` is unique on ``key``.  Returns the whole new table version.
    """
    ts = ts_literal(run_ts)
    cols = [c for c in existing.columns if c not in (key, "created_at", "updated_at")]
    o = existing.alias("o")
    n = incoming.withColumn("__in", F.lit(True)).alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    hit = F.coalesce(F.col("n.__in"), F.lit(False))
    out = [F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key)]
    out += [F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in cols]
    out += [
        F.when(hit, F.coalesce(F.col("o.created_at"), ts)).otherwise(F.col("o.created_at")).alias("created_at"),
        F.when(hit, ts).otherwise(F.col("o.updated_at")).alias("updated_at"),
    ]
    return j.select(*out).select(*existing.columns)


def _key_side(apps: DataFrame, key: str, max_rows: int) -> DataFrame:
    keys = apps.select(key).where(F.col(key).isNotNull())
    return F.broadcast(keys) if fits(keys, max_rows) else keys


def accepted_by_fk(reviews: DataFrame, apps: DataFrame, key: str = "app_id",
                   max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Reviews whose app exists."""
    return reviews.join(_key_side(apps, key, max_broadcast_rows), key, "left_semi")


def orphans_by_fk(reviews: DataFrame, apps: DataFrame, key: str = "app_id",
                  max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Reviews whose app does not exist (quarantined, never silently dropped)."""
    return reviews.join(_key_side(apps, key, max_broadcast_rows), key, "left_anti")


def validate_reviews(incoming: DataFrame, existing: DataFrame, apps: DataFrame,
                     order_col: str, incoming_rows: int | None = None,
                     max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every incoming row with ``reject_reason`` (null = would be inserted).

    A row is rejected for its own defects first, in the order a row store
    checks them: NOT NULL (id, app, score, content), CHECK 1..5, then the
    foreign key to ``apps``.  Key conflicts are judged among the rows without
    defects — as insert-or-ignore skips a defective copy and inserts the next
    one: the first such copy by ``order_col`` (unique) is inserted unless its
    id is stored (``existing_key``); later copies are ``duplicate_key``.

    Skew: per id, a partial ``min`` aggregation gives the first clean arrival
    and a key-level join tells whether the id is stored (probed against a
    broadcast of the incoming keys when the caller's ``incoming_rows`` is
    within the bound); rows meet these facts on (id, arrival) — unique per
    row, so a hot id is spread over all tasks.  ``apps`` is broadcast behind a
    bounded row check.
    """
    if dict(incoming.dtypes).get("score") == "string":  # untyped rows: gate-cast, never a throwing cast
        incoming = incoming.withColumn("score", to_double(F.col("score")))
    # app_id is the apps table's primary key: no distinct needed, and without an
    # aggregate on this side a shuffled fallback join stays eligible for AQE's
    # skew-partition splitting (a hot app)
    akeys = apps.select("app_id").where(F.col("app_id").isNotNull()).withColumn("__app", F.lit(True))
    if fits(akeys, max_broadcast_rows):
        akeys = F.broadcast(akeys)
    inc = incoming.join(akeys, "app_id", "left")
    defect = (
        F.when(F.col("review_id").isNull(), F.lit("null_review_id"))
        .when(F.col("app_id").isNull(), F.lit("null_app_id"))
        .when(F.col("score").isNull(), F.lit("null_score"))
        .when(~F.col("score").between(1, 5), F.lit("score_out_of_range"))
        .when(F.col("content").isNull(), F.lit("null_content"))
        .when(F.col("__app").isNull(), F.lit("orphan_app"))
    )
    inc = inc.withColumn("reject_reason", defect).drop("__app")
    clean = inc.where(F.col("reject_reason").isNull())
    first = clean.groupBy("review_id").agg(F.min(order_col).alias(order_col))
    ekeys = existing.select("review_id").where(F.col("review_id").isNotNull())
    if incoming_rows is not None and incoming_rows <= max_broadcast_rows:
        ekeys = F.broadcast(ekeys.join(F.broadcast(clean.select("review_id")), "review_id", "left_semi"))
    first = first.join(ekeys.distinct().withColumn("__exists", F.lit(True)), "review_id", "left")
    first = first.withColumn("__first", F.lit(True))
    clean = clean.join(first, ["review_id", order_col], "left").withColumn(
        "reject_reason",
        F.when(F.col("__first").isNull(), F.lit("duplicate_key"))
        .when(F.coalesce(F.col("__exists"), F.lit(False)), F.lit("existing_key")),
    ).drop("__first", "__exists")
    return clean.unionByName(inc.where(F.col("reject_reason").isNotNull()))


def cascade_delete(apps: DataFrame, reviews: DataFrame, app_ids: DataFrame,
                   max_broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Delete apps and, by cascade, their reviews: (new apps, new reviews)."""
    ids = app_ids.select("app_id").where(F.col("app_id").isNotNull())
    ids = F.broadcast(ids) if fits(ids, max_broadcast_rows) else ids
    return apps.join(ids, "app_id", "left_anti"), reviews.join(ids, "app_id", "left_anti")

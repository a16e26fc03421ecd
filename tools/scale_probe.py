"""Scale and skew probe (not part of the test suite).

Builds once, under a scratch folder, a feed of ``factor`` x the sf0.1 review
feed in which one review id holds a third of all rows and one app another
third, then times the row-level operators on it.  Usage:

    python tools/scale_probe.py [factor] [scratch_parent]
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from pyspark.sql import functions as F  # noqa: E402

from reviewlake.operators import clean as CL  # noqa: E402
from reviewlake.operators import tables as TB  # noqa: E402
from reviewlake.plans import ingest as IG  # noqa: E402
from reviewlake.session import ENGINE_CONF  # noqa: E402
from reviewlake.sources import fixture as FX  # noqa: E402

AS_OF, RUN_TS = "2024-02-01 00:00:00", "2024-02-01 06:00:00"


def build(spark, factor: int, path: str) -> None:
    base = FX.raw_reviews(spark, "/root/testdata/sf0.1")
    n = 100_000  # arrival numbers per copy (sf0.1 feed size)
    rep = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("copy"))
    seq = F.col("arrival_seq") + F.col("copy") * F.lit(n)
    third = (F.xxhash64(seq) % 3 + 3) % 3
    out = rep.select(
        seq.alias("arrival_seq"),
        F.when(third == 1, F.lit("com.hot")).otherwise(F.col("app_id")).alias("app_id"),
        F.when(third == 0, F.lit("r-hot")).otherwise(
            F.concat(F.col("reviewId"), F.lit("-"), F.col("copy").cast("string"))).alias("reviewId"),
        *[c for c in base.columns if c not in ("arrival_seq", "app_id", "reviewId")],
    )
    # many files, as a landing area has: the scan is split across tasks
    out.repartition(64).write.mode("errorifexists").parquet(path)


def main() -> None:
    factor = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    parent = sys.argv[2] if len(sys.argv) > 2 else "/tmp"
    path = os.path.join(parent, f"reviewlake-scale-{factor}-files64")
    import glob
    import statistics
    import tempfile

    from pyspark.sql import SparkSession

    log_dir = tempfile.mkdtemp(prefix="run-", dir=parent)
    b = (SparkSession.builder.master("local[8]").appName("reviewlake-scale")
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "64")
         .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
         .config("spark.eventLog.compress", "false"))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThreshold", "64MB")
    if not os.path.exists(path):
        t0 = time.perf_counter()
        build(spark, factor, path)
        print(f"built {path} in {time.perf_counter() - t0:.1f}s", file=sys.stderr)
    raw = spark.read.parquet(path)
    rows = raw.count()
    batched = FX.with_batch_no(raw, 50_000)
    clean = CL.clean_reviews(raw, AS_OF, time_col="at_text")
    existing = TB.map_reviews(CL.clean_reviews(raw.where(F.col("arrival_seq") % 2 == 0), AS_OF, time_col="at_text"), RUN_TS)
    incoming = TB.map_reviews(CL.clean_reviews(raw.where(F.col("arrival_seq") % 2 == 1), AS_OF, time_col="at_text"), RUN_TS)
    jobs = {
        "clean_reviews": clean,
        "cleaning_stats": CL.cleaning_stats(CL.tag_reviews(raw)),
        "incremental_ingest": IG.incremental_reviews(batched, AS_OF, RUN_TS, time_col="at_text"),
        "insert_new_shuffle": TB.insert_new(existing, incoming),
        "constraint_rejects": TB.validate_reviews(
            raw.select("arrival_seq", F.col("reviewId").alias("review_id"), "app_id", "score", "content"),
            existing, FX.raw_apps(spark, "/root/testdata/sf0.1").select(F.col("appId").alias("app_id")),
            order_col="arrival_seq"),
        "rating_by_app": clean.groupBy("app_id", "score").count(),
    }
    # a small batch (1 % of the feed) arriving into the large table: the
    # broadcast key probe (size known) against the shuffled anti-join
    table_dir = tempfile.mkdtemp(prefix="run-", dir=parent)
    TB.map_reviews(clean, RUN_TS).select("review_id").write.mode("overwrite").parquet(f"{table_dir}/table")
    stored = spark.read.parquet(f"{table_dir}/table")
    small = TB.map_reviews(CL.clean_reviews(raw.where(F.col("arrival_seq") % 100 == 7), AS_OF, time_col="at_text"),
                           RUN_TS).select("review_id", "app_id", "score").persist()
    n_small = small.count()
    jobs["small_batch_insert_broadcast_probe"] = TB.insert_new(stored, small, incoming_rows=n_small)
    jobs["small_batch_insert_shuffle"] = TB.insert_new(stored, small)
    times = {}
    for name, df in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 2)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    # the stored layout with a hot app (a third of the rows): range partitioning
    # on (app, time, id) must spread it over the write tasks
    from reviewlake.plans.store import write_reviews

    spark.sparkContext.setJobGroup("write_stored_layout", "write_stored_layout")
    jobs["write_stored_layout"] = None
    t0 = time.perf_counter()
    write_reviews(TB.map_reviews(clean, RUN_TS), f"{table_dir}/stored", mode="overwrite")
    times["write_stored_layout"] = round(time.perf_counter() - t0, 2)
    print(f"write_stored_layout: {times['write_stored_layout']}s", file=sys.stderr)
    spark.stop()
    # task skew per operator from the event log: the largest task vs the median
    stage_job, tasks = {}, {}
    for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(f) or "appstatus" in os.path.basename(f):
            continue
        with open(f) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    grp = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = grp
                elif e["Event"] == "SparkListenerTaskEnd":
                    ti, tm = e["Task Info"], e.get("Task Metrics") or {}
                    rec = (tm.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"], rec))
    skew = {}
    for sid, ts in tasks.items():
        grp = stage_job.get(sid)
        if grp not in jobs or len(ts) < 4:
            continue
        d = sorted(x[0] for x in ts)
        r = sorted(x[1] for x in ts)
        worst = skew.setdefault(grp, {"max_task_ms": 0, "median_task_ms": 0, "max_shuffle_records": 0,
                                      "median_shuffle_records": 0})
        if d[-1] > worst["max_task_ms"]:
            worst.update(max_task_ms=d[-1], median_task_ms=int(statistics.median(d)),
                         max_shuffle_records=r[-1], median_shuffle_records=int(statistics.median(r)))
    print(json.dumps({"rows": rows, "factor": factor, "seconds": times,
                      "clean_rows_per_sec": round(rows / times["clean_reviews"]),
                      "slowest_stage_per_operator": skew, "event_log": log_dir}))


if __name__ == "__main__":
    main()

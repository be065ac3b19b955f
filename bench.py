"""Headline timings at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``.

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit", "queries", "sf", ...}.
Landing files are prepared first (not timed: they stand for the producer's drop), and the
same flow runs once untimed on the smallest input so JVM class loading and code generation
are not charged to the first timed step.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerflow.operators.latest import latest_per_key  # noqa: E402
from ledgerflow.operators.quality import tag_failures  # noqa: E402
from ledgerflow.plans import catalog  # noqa: E402
from ledgerflow.plans.fixtures import landing_fixture  # noqa: E402
from ledgerflow.plans.medallion import bronze_batch, process_silver_batch, silver_current, silver_table  # noqa: E402
from ledgerflow.plans.upsert import UpsertTable  # noqa: E402
from ledgerflow.session import local_session, work_dir  # noqa: E402
from ledgerflow.spec import transactions_spec  # noqa: E402
from ledgerflow.streaming.bronze import run_bronze  # noqa: E402
from ledgerflow.streaming.silver import run_silver  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def sf_of(path: str) -> str:
    base = os.path.basename(path)
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8, app="ledgerflow-bench")
    spec = transactions_spec()
    timings: dict[str, float] = {}
    counts: dict[str, int] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        if isinstance(out, int):
            counts[name] = out
        return out

    landing = landing_fixture(spark, SF_DIR)
    landing_x = landing_fixture(spark, SF_DIR, extra_field=True)

    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        from ledgerflow.plans.medallion import run_pipeline

        run_pipeline(spark, spec, landing_fixture(spark, warm), work_dir(spark, "bench-warmup"), buckets=8)

    # (a) bronze: file stream → flatten → parquet, drained with availableNow
    bronze = work_dir(spark, "bench-bronze")
    timed("bronze_stream", lambda: (run_bronze(spark, landing, bronze, work_dir(spark, "bench-ckpt-b"), spec), spark.read.parquet(bronze).count())[1])

    # (b) silver: foreachBatch validate → quarantine → dedup → upsert log
    table = silver_table(spark, work_dir(spark, "bench-silver"), spec)
    timed(
        "silver_stream",
        lambda: run_silver(
            spark, bronze, table, work_dir(spark, "bench-q"), work_dir(spark, "bench-ckpt-s"), spec
        ),
    )
    # (c) merge-on-read over the uncompacted log, then after compaction
    # a second silver stream adds 10 update batches (10% of keys each) to the same table
    li = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")

    # the update batches arrive as their own bronze files (written untimed, as a stream's new files)
    b = spark.read.parquet(bronze)
    arrivals = []
    for i in range(10):
        p = work_dir(spark, f"bench-arrival-{i}")
        part = b.where(F.pmod(F.xxhash64("transaction_id"), F.lit(10)) == i)
        part.withColumn("ingestion_ts", F.current_timestamp()).write.parquet(p)
        arrivals.append(p)

    def updates():
        for i, p in enumerate(arrivals):
            process_silver_batch(spark.read.parquet(p), 1 + i, spec, table, work_dir(spark, "bench-q2"), writer="bench")

    timed("silver_10_update_batches", updates)
    timed("silver_current_log", lambda: silver_current(table, spec).count())
    timed("silver_compact", lambda: table.compact())
    timed("silver_current_compacted", lambda: silver_current(table, spec).count())

    # (d) rescue path vs fast path (batch read of the same documents)
    timed("bronze_fast_batch", lambda: bronze_batch(spark, landing_x, spec).count())
    timed("bronze_rescue_batch", lambda: bronze_batch(spark, landing_x, spec, rescue=True).where(F.col("_rescued_data").isNotNull()).count())

    # (e) 1, 10, 50 rules tagged in one projection, on the casted rows (materialized untimed)
    casted_path = work_dir(spark, "bench-casted")
    catalog._casted_l(spark, SF_DIR).write.parquet(casted_path)
    casted = spark.read.parquet(casted_path)
    for n in (1, 10, 50):
        rules = {f"min_value_{i}": f"transaction_value_amount >= {i * 1000}" for i in range(n)}
        timed(f"rules_{n}", lambda r=rules: tag_failures(casted, r).where(F.col("_failure_reason") != "").count())

    # (f) latest row per key on the largest table, and upserts of events batches
    seq = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    timed("dedup_lineitem", lambda: latest_per_key(li, ["l_orderkey", "l_linenumber"], seq).count())

    def upserts():
        t = UpsertTable(spark, work_dir(spark, "bench-events"), catalog.EVENT_KEYS, catalog.EVENT_SEQ, buckets=16)
        for i, b in enumerate(catalog.OUT_OF_ORDER):
            t.append(catalog.events_batch(spark, SF_DIR, b), i)
        return t.current().count()

    timed("upsert_events_5_batches", upserts)

    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "ledgerflow_headline_total",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "rows": counts,
                "sf": sf_of(SF_DIR),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()

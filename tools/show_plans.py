"""Print the formatted physical plans of the key operators (bronze, dedup, merge-on-read, rules).

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ledgerflow.operators.latest import latest_by_max, latest_per_key  # noqa: E402
from ledgerflow.plans.fixtures import landing_fixture  # noqa: E402
from ledgerflow.plans.medallion import bronze_batch, silver_view  # noqa: E402
from ledgerflow.plans.upsert import UpsertTable  # noqa: E402
from ledgerflow.session import local_session, work_dir  # noqa: E402
from ledgerflow.spec import transactions_spec  # noqa: E402


def show(title, df):
    print(f"\n==================== {title}")
    df.explain("formatted")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spec = transactions_spec()
    landing = landing_fixture(spark, sf)
    bronze = bronze_batch(spark, landing, spec)
    show("bronze (map-only: scan → generate → project)", bronze)
    show("silver view (casts + rules in one projection)", silver_view(bronze, spec))
    ev = spark.read.parquet(f"{sf}/events.parquet")
    show(
        "latest per key with a key filter (partial WindowGroupLimit before the exchange, filter pushed to scan)",
        latest_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"]).where(F.col("user_id") == 5),
    )
    show(
        "latest per key, aggregate form (partial max_by before the exchange)",
        latest_by_max(ev, ["user_id", "event_type"], ["ts", "event_id"]),
    )
    t = UpsertTable(spark, work_dir(spark, "plans"), ["user_id", "event_type"], ["ts", "event_id"], buckets=16)
    t.append(ev.where("event_id % 2 = 0"), 0)
    t.compact()
    t.append(ev.where("event_id % 2 = 1"), 1)
    show("merge-on-read: one full scan of the base against the broadcast log rows, one key-only scan for inserts", t.current())
    show("bucket-restricted read (folder pruning of the base, row-group filter on the log)", t.current(buckets={3}))


if __name__ == "__main__":
    main()

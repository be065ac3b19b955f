"""ledgerflow: landing JSON → bronze → validated, deduplicated silver on plain Spark.

Every transformation is a function ``DataFrame -> DataFrame`` parameterised by a
:class:`~ledgerflow.spec.TableSpec`; storage is plain parquet.

Typical use::

    from ledgerflow import transactions_spec, run_pipeline, silver_current
    out = run_pipeline(spark, transactions_spec(), "s3a://…/landing", "s3a://…/tables/tx")
    silver = silver_current(out["table"], transactions_spec())
"""

from ledgerflow.operators.latest import latest_by_max, latest_per_key
from ledgerflow.operators.quality import expect_all, expect_all_or_drop, split, tag_failures, to_quarantine
from ledgerflow.plans.medallion import (
    bronze_batch,
    ingest_changed,
    process_silver_batch,
    run_pipeline,
    silver_current,
    silver_table,
    silver_view,
)
from ledgerflow.plans.upsert import UpsertTable
from ledgerflow.sources.landing import read_landing
from ledgerflow.spec import TableSpec, transactions_spec
from ledgerflow.streaming.bronze import run_bronze, start_bronze_stream
from ledgerflow.streaming.silver import run_silver, start_silver_stream

__all__ = [
    "TableSpec",
    "UpsertTable",
    "bronze_batch",
    "expect_all",
    "expect_all_or_drop",
    "ingest_changed",
    "latest_by_max",
    "latest_per_key",
    "process_silver_batch",
    "read_landing",
    "run_bronze",
    "run_pipeline",
    "run_silver",
    "silver_current",
    "silver_table",
    "silver_view",
    "split",
    "start_bronze_stream",
    "start_silver_stream",
    "tag_failures",
    "to_quarantine",
    "transactions_spec",
]

"""Keyed upsert, replay filter and batch counts as native streaming operators.

* **Upsert**: the winner per key is an aggregate, ``max_by(row, sequence)``, whose state Spark keeps in RocksDB and
  checkpoints; in update mode a batch emits the winners of the keys it touched, written to a folder of its own
  (overwritten on a replay). The current table is the last emission of each key. No base is read or merged, no
  Python runs on rows, and a batch costs what it holds. State is dealt over ``spark.sql.shuffle.partitions`` as of the
  first start and survives lost executors through the checkpoint.
* **Snapshot**: the log folded into one table; :func:`current` then reads it and the batches after it only.
* **Replay filter**: a delivery is passed once. Its state is dropped once the watermark on the *arrival* time has passed
  it, so it stays bounded; rows late by their own time arrive as recently as others and are kept.
* **Counts**: rule counts observed on the stream itself, taken from its progress by a listener; no second pass.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ledgerflow.operators.latest import latest_by_max
from ledgerflow.operators.quality import batch_counts
from ledgerflow.session import Fs, settings
from ledgerflow.sources.landing import NO_AGE_LIMIT

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCH = "batch_id"
SNAPSHOTS = "_snapshots"  # the leading underscore hides it from readers of the log
ARRIVED = "arrived_at"


def state_in_rocksdb(spark: SparkSession):
    """The setting holds while a query starts (its checkpoint remembers it) and is put back after."""
    return settings(spark, {PROVIDER: ROCKSDB})


def read_files(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files under ``path`` as a stream, with the time each file arrived (``arrived_at``)."""
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFileAge", NO_AGE_LIMIT)
    if max_files is not None:
        r = r.option("maxFilesPerTrigger", int(max_files))
    return r.parquet(path).withColumn(ARRIVED, F.col("_metadata.file_modification_time"))


def start_upsert(changes: DataFrame, keys, sequence_by, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Stream of changes → log of winners under ``path``. ``sequence_by`` orders the versions of a key; the order
    in which they arrive plays no part, and two versions of equal sequence are one version delivered twice."""
    best = latest_by_max(changes, keys, sequence_by)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    w = best.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    with state_in_rocksdb(changes.sparkSession):
        return w.start()


def _snapshot_of(spark: SparkSession, path: str) -> int | None:
    fs = Fs(spark)
    done = [d for d in fs.ls(f"{path}/{SNAPSHOTS}") if re.fullmatch(r"upto=\d+", d) and fs.exists(f"{path}/{SNAPSHOTS}/{d}/_SUCCESS")]
    return max((int(d[5:]) for d in done), default=None)


def current(spark: SparkSession, path: str, keys) -> DataFrame:
    """One row per key: the last emission of each, from the newest snapshot and the batches after it."""
    log = spark.read.parquet(path)
    columns = [c for c in log.columns if c != BATCH]
    upto = _snapshot_of(spark, path)
    if upto is not None:
        base = spark.read.parquet(f"{path}/{SNAPSHOTS}/upto={upto}").withColumn(BATCH, F.lit(upto))
        log = base.unionByName(log.where(F.col(BATCH) > upto))
    return latest_by_max(log, keys, [BATCH]).select(*columns)


def snapshot(spark: SparkSession, path: str, keys) -> int:
    """Fold the log so far; returns the last batch in it. Run it between two runs of the stream or beside one: a batch
    written meanwhile stays in the log."""
    upto = max(int(d.split("=")[1]) for d in Fs(spark).ls(path) if d.startswith(f"{BATCH}="))
    rows = current(spark, path, keys) if _snapshot_of(spark, path) is not None else latest_by_max(spark.read.parquet(path).where(F.col(BATCH) <= upto), keys, [BATCH]).drop(BATCH)
    rows.write.mode("overwrite").parquet(f"{path}/{SNAPSHOTS}/upto={upto}")
    return upto


def once(rows: DataFrame, delivery, horizon: str = "7 days", arrived: str = ARRIVED) -> DataFrame:
    """Rows whose ``delivery`` columns were not seen before within ``horizon`` of arrival time."""
    return rows.withWatermark(arrived, horizon).dropDuplicatesWithinWatermark(list(delivery))


class BatchCounts(StreamingQueryListener):
    """Per batch id of one query, the values observed under ``name``."""

    def __init__(self, name: str):
        self.name, self.batches, self.ended = name, {}, threading.Event()
        self._run = None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            self._run = event.progress.runId
            self.batches[event.progress.batchId] = seen.asDict()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId == self._run or self._run is None:
            self.ended.set()


def run_observed(rows: DataFrame, rules: dict[str, str], name: str, start) -> dict[int, dict[str, int]]:
    """Run ``start(stream)`` to its end on the rows with their rule counts observed; returns the counts per batch.

    The counts ride along the query's own write: n_input, n_valid and failed_<rule> of every row that passes."""
    spark = rows.sparkSession
    counts = BatchCounts(name)
    spark.streams.addListener(counts)
    try:
        query = start(rows.observe(name, *batch_counts(rules)))
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        counts.ended.wait(30)  # progress comes before the end, on the same bus
    finally:
        spark.streams.removeListener(counts)
    return counts.batches

"""Bloom filters built by Spark and sent to the tasks, with a proven size bound.

``CELLS_PER_ROW`` cells per key, a power of two between ``MIN_CELLS`` and ``MAX_CELLS`` (2^28 bits,
32 MB): what is broadcast never exceeds 32 MB. Beyond 2^24 keys the false-positive share grows; a
false positive costs a shuffled row, never a wrong result, in every use here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import fresh, lean, mix64, ship

CELLS_PER_ROW = 16
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 28
SEGMENT = 1 << 20  # cells per segment row
PROBES = 4
FLUSH = 1 << 21  # cells a task holds before it sends them


def _cells(h: np.ndarray, cells: int) -> np.ndarray:
    """(PROBES, n) cell numbers of 64-bit hashes; one key's probes stay in one segment."""
    seg = min(SEGMENT, cells)
    base = (h % np.uint64(cells // seg)) * np.uint64(seg)
    again = mix64(h)
    step = (again >> np.uint64(40)) | np.uint64(1)
    return np.stack([base + (again + np.uint64(i) * step) % np.uint64(seg) for i in range(PROBES)]).astype(np.int64)


def bloom_bits(hashes: DataFrame, cells: int, again_only: bool) -> np.ndarray:
    """Bits of the cells hit (at least twice, if ``again_only``) over all rows of ``hashes`` (one long column).

    Tasks combine their cells (a hot hash sends one entry per flush) and send, per segment, the
    sorted cells seen and those seen again; a segment merges by
    ``again |= again' | (seen & seen')``. Sent bytes follow the rows, not tasks times filter.
    """
    seg = min(SEGMENT, cells)

    def flush(held):
        found, n = np.unique(np.concatenate(held), return_counts=True)
        cut = np.searchsorted(found, np.arange(0, cells + seg, seg))
        for k in np.flatnonzero(np.diff(cut)):
            part, twice = found[cut[k] : cut[k + 1]] - k * seg, n[cut[k] : cut[k + 1]] > 1
            yield pa.RecordBatch.from_pydict(
                {"k": [int(k)], "seen": [part.astype(np.int32).tobytes()], "again": [part[twice].astype(np.int32).tobytes()]},
                schema=_SEGMENTS,
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if len(h):
                held.append(_cells(h, cells).ravel())
            if sum(map(len, held)) > FLUSH:
                yield from flush(held)
                held = []
        if held:
            yield from flush(held)

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = np.zeros(seg, bool), np.zeros(seg, bool)
        for batch in batches:
            for s, a in zip(batch.column("seen").to_pylist(), batch.column("again").to_pylist(), strict=True):
                s = np.frombuffer(s, np.int32)
                again[s[seen[s]]] = True
                again[np.frombuffer(a, np.int32)] = True
                seen[s] = True
        yield pa.RecordBatch.from_pydict({"k": [key[0].as_py()], "bits": [np.packbits(again if again_only else seen).tobytes()]}, schema=_MERGED)

    merged = hashes.mapInArrow(lean(count), "k int, seen binary, again binary").groupBy("k").applyInArrow(merge, "k int, bits binary")
    bits = np.zeros(cells // 8, np.uint8)
    for k, again in merged.toLocalIterator():  # cells / 8 bytes in all, at most MAX_CELLS / 8
        bits[k * (seg // 8) : (k + 1) * (seg // 8)] = np.frombuffer(again, np.uint8)
    return bits


_SEGMENTS = pa.schema([("k", pa.int32()), ("seen", pa.binary()), ("again", pa.binary())])
_MERGED = pa.schema([("k", pa.int32()), ("bits", pa.binary())])


class Filter:
    """Called with a long column it gives a boolean column; ``plain`` tests an array of uint64 in a task."""

    def __init__(self, column, plain):
        self.column, self.plain = column, plain

    def __call__(self, key):
        return self.column(key)


def _filter(hashes: DataFrame, again_only: bool, cells_per_row: int, max_cells: int):
    spark = hashes.sparkSession
    ship(spark)
    rows = hashes.count()
    cells = MIN_CELLS
    while cells < min(max_cells, rows * cells_per_row):
        cells *= 2
    sent = spark.sparkContext.broadcast(bloom_bits(hashes, cells, again_only))

    def plain(h: np.ndarray) -> np.ndarray:
        bits, hit = sent.value, np.ones(len(h), bool)
        for c in _cells(h, cells):
            hit &= (bits[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
        return hit

    @F.pandas_udf("boolean")
    def probe(h: pd.Series) -> pd.Series:
        return pd.Series(plain(h.to_numpy().astype(np.int64).view(np.uint64)))

    return Filter(probe, plain)


def repeat_filter(hashes: DataFrame, cells_per_row: int = CELLS_PER_ROW, max_cells: int = MAX_CELLS):
    """A :class:`Filter`, false only if the hash surely occurs at most once in ``hashes``."""
    return _filter(hashes, True, cells_per_row, max_cells)


def member_filter(keys: DataFrame, cells_per_row: int = CELLS_PER_ROW, max_cells: int = MAX_CELLS):
    """A :class:`Filter`, false only if the key surely is not in ``keys`` (one long column)."""
    return _filter(keys, False, cells_per_row, max_cells)


#: more files than this are matched by a shuffle instead of a broadcast of their names
FILES_SENT = 100_000
_ROW_BITS = 40


def with_rid(docs: DataFrame, rid: str) -> DataFrame:
    """``docs`` (a scan of stored files) plus a row number that every scan of them gives alike.

    It is made of the file's place in the sorted file list and the row's place in its file, so it depends neither on
    how a scan is split nor on the executors there are. A frame without files (built in the session) is numbered by
    partition, which its own rows fix.
    """
    spark, path, at, no = docs.sparkSession, fresh(docs, "lf_path"), fresh(docs, "lf_at"), fresh(docs, "lf_no")
    if not docs.inputFiles():
        return docs.withColumn(rid, F.monotonically_increasing_id())
    # names as the scan itself gives them, from the files' footers (no column is read)
    files = sorted(r[0] for r in docs.select(F.col("_metadata.file_path")).distinct().collect())
    names = spark.createDataFrame(list(enumerate(files)), f"{no} long, {path} string")
    rows = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(at))
    rows = rows.join(F.broadcast(names) if len(files) <= FILES_SENT else names, path, "left")
    number = F.when(F.col(no).isNull(), F.raise_error(F.lit("a file is missing in the list of input files"))).otherwise(F.shiftleft(no, _ROW_BITS) + F.col(at))
    return rows.select(*docs.columns, number.cast("long").alias(rid))


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rid, doc_id, text of ``docs``, whatever other columns it has."""
    rid = fresh(docs, "lf_rid")
    return with_rid(docs, rid).select(F.col(rid).alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def take_rows(rows: DataFrame, key: str, keys: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keys`` on a long ``key``; rows surely without partner never shuffle."""
    return rows.where(member_filter(keys.select(key))(key)).join(keys, key, how)


def remove_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` (a stored table) without the row numbers in ``dropped`` (column ``rid``), same columns.

    Rows surely not dropped pass straight through; only the few others shuffle.
    """
    rid, maybe = fresh(docs, "lf_rid"), fresh(docs, "lf_maybe")
    dropped = dropped.select(F.col("rid").alias(rid))
    rows = with_rid(docs, rid)
    rows = rows.withColumn(maybe, member_filter(dropped)(rid))
    stay = rows.where(F.col(maybe)).join(dropped, rid, "left_anti")
    return rows.where(~F.col(maybe)).select(*docs.columns).unionByName(stay.select(*docs.columns))

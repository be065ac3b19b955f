"""Helpers shared by the operators of this subpackage.

Texts cross to Python as Arrow batches; a batch is cut into chunks of whole documents of
about ``CHUNK_BYTES`` and worked on as one flat byte array, so memory per task follows the
chunk (or the largest single document), never the partition.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import SHUFFLE_CLEANUP, Fs, work_dir

CHUNK_BYTES = 1 << 20
ARROW_LIMIT, ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

#: byte classes of ASCII texts; bytes of 0x80 and more belong to letters
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over the 256 byte values, true inside the inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors once per Spark context (``addPyFile``)."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerflow_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ledgerflow-pkg-"), "ledgerflow_pkg.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("ledgerflow", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._ledgerflow_shipped = True


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    While it is written, Arrow batches hold at most ``ARROW_BYTES``, so rows with long texts or sets
    do not add up to a large batch on both sides of a Python task. Once it is written, its shuffle files go:
    what follows reads the table.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    meanwhile = {ARROW_LIMIT: str(ARROW_BYTES), SHUFFLE_CLEANUP: "true"}
    before = {k: spark.conf.get(k, None) for k in meanwhile}
    for k, v in meanwhile.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    back = spark.read.schema(df.schema).parquet(path)
    back._lf_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that no frame still to be run reads (later tables are files of their own)."""
    for table in tables:
        Fs(table.sparkSession).delete(table._lf_path)


def lean(task):
    """An Arrow task that hands unused memory back after each batch, and all that the C library kept at its end: Spark
    keeps Python workers for the next stages, and what they hold counts against the executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in task(batches):
            yield batch
            del batch
            pa.default_memory_pool().release_unused()
        trim()

    return run


def trim() -> None:
    """Hand freed memory back to the system (a no-op where the C library cannot)."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def release() -> None:
    """:func:`trim` for memory that a fit has freed, cycles included."""
    import gc

    gc.collect()
    trim()


@dataclass
class Chunk:
    """``n`` whole documents from row ``first`` of a batch, as one byte array."""

    first: int
    n: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, n + 1 entries, from 0


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return col if pa.types.is_large_string(col.type) else col.cast(pa.large_string())


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string array into chunks of whole documents; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield Chunk(first, last - first, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``limit`` bytes: what a task holds beside it follows the part."""
    step = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
    for first in range(0, batch.num_rows, step):
        yield batch.slice(first, step)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (xor-shift-multiply), on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """``_BASE ** i`` modulo 2^64 for i below ``n`` (grown by doubling, kept per process)."""
    global _POWERS
    while len(_POWERS) < n:
        step = _POWERS[-1:] * _BASE
        _POWERS = np.concatenate([_POWERS, _POWERS * step])
    return _POWERS[:n]


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_INV_POWERS = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _INV_POWERS
    while len(_INV_POWERS) < n:
        step = _INV_POWERS[-1:] * _INVERSE
        _INV_POWERS = np.concatenate([_INV_POWERS, _INV_POWERS * step])
    return _INV_POWERS[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of the mixed bytes; differences hash any substring."""
    out = np.zeros(len(data) + 1, np.uint64)
    if len(data):
        np.cumsum(_BYTE_MIX[data] * powers(len(data)), out=out[1:])
    return out


_BYTE_MIX = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def substring_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``; equal strings hash equal wherever they stand."""
    inv = inverse_powers(len(sums))
    return mix64((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64))


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # per document: index of its first word, n + 1 entries
    sums: np.ndarray  # prefix sums of the lower-cased bytes


def words_of(chunk: Chunk, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes per document (never across documents), lower-cased hashes."""
    low = LOWER[chunk.data]
    mask = is_word[low]
    start, end = spans_of(mask)
    if len(start):
        inner = chunk.offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(mask))]
        joined = np.unique(inner[mask[inner] & mask[inner - 1]])  # a word may touch the next document's
        if len(joined):
            start = np.sort(np.concatenate([start, joined]))
            end = np.sort(np.concatenate([end, joined]))
    sums = prefix_sums(low)
    return Words(start, end, substring_hash(sums, start, end), np.searchsorted(start, chunk.offsets), sums)


def segment_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i+1]]`` in float64 (0 for empty segments)."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]

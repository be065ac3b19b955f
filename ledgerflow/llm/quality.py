"""Operator 8: quality by Bradley-Terry pairwise ranking.

A document's worth is ``w . x`` over text statistics ``x``; training draws preference pairs
(a document labelled 1 over one labelled 0) and minimises the logistic loss
``log(1 + exp(-w . (x_i - x_j)))`` on their feature differences. The cut is a quantile of
the training scores (the share of rows labelled 0); the score shown is a logistic curve through the
cut, ``THRESHOLD`` at the cut itself. The statistics of every whole text are taken once, for the fit and
the scores. All labelled rows are learnt from, in groups that tasks rank at a time; their weights are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import Chunk, byte_class, chunks, discard, fold, lean, ship, stored, text_column, words_of

GROUP = 5000  # labelled rows ranked by one task
RARE = 200  # rows of either class that a group should have
RANKS = 1_000_000  # the cut's rank is exact up to so many labelled rows, within a millionth of them beyond
THRESHOLD = 0.3

_SOLID = ~byte_class((9, 13), (32, 32))
_LETTER = byte_class((65, 90), (97, 122), (128, 255))
_UPPER = byte_class((65, 90))
_DIGIT = byte_class((48, 57))
_LINE = byte_class((10, 10))
_PUNCT = byte_class((33, 47), (58, 64), (91, 96), (123, 126))
#: the punctuation counted on its own
_MARKS = b"!#$%&*|.,?:;/<>@=_"
EXTRA = 5  # statistics that are no shares
BASE = 10 + len(_MARKS) + EXTRA


def _per_doc(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[first[1:]] - total[first[:-1]]).astype(np.float64)


def base(chunk: Chunk) -> np.ndarray:
    """(documents, ``BASE`` statistics): shares of characters and words, repetition, length; all finite."""
    data, offsets = chunk.data, chunk.offsets
    words = words_of(chunk, _SOLID)
    n_words = np.diff(words.first).astype(np.float64)
    n_bytes = np.diff(offsets).astype(np.float64)
    w, b = np.maximum(n_words, 1), np.maximum(n_bytes, 1)
    chars = np.stack([np.bincount(data[offsets[i] : offsets[i + 1]], minlength=256) for i in range(chunk.n)]).astype(np.float64)
    letters = chars @ _LETTER
    doc = np.repeat(np.arange(chunk.n), np.diff(words.first))
    same = np.zeros(len(words.hash), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    key = np.sort((words.hash >> np.uint64(24)) | (doc.astype(np.uint64) << np.uint64(40)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key >> np.uint64(40)).astype(np.int64)[new], minlength=chunk.n).astype(np.float64)
    length = words.end - words.start
    solid = np.add.reduceat(np.concatenate([length, [0]]), np.minimum(words.first[:-1], len(length))) * (n_words > 0) / w
    bare = ~_LETTER[data[words.start]] if len(words.start) else np.zeros(0, bool)
    shares = [
        chars @ _UPPER / np.maximum(letters, 1),
        letters / b,
        chars @ _DIGIT / b,
        chars @ _PUNCT / w,
        chars @ _LINE / w,
        _per_doc(same, words.first) / w,
        _per_doc(bare, words.first) / w,
        distinct / w,
        _per_doc(length <= 3, words.first) / w,
        _per_doc(length >= 12, words.first) / w,
    ] + [chars[:, m] / w for m in _MARKS]
    x = np.minimum(np.stack(shares, axis=1), 5.0)
    size = np.log1p(n_words)
    extra = np.stack([size, size**2 / 10, np.minimum(solid, 40) / 10, distinct / w * size, (n_words == 0).astype(float)], axis=1)
    return np.concatenate([x, extra], axis=1)


def expand(rows: np.ndarray) -> np.ndarray:
    """The features of :func:`base` rows: shares also by their root and cut off early."""
    x, extra = rows[:, :-EXTRA], rows[:, -EXTRA:]
    return np.concatenate([x, np.sqrt(x), np.minimum(x * 20, 1.0), extra], axis=1)


def features(chunk: Chunk) -> np.ndarray:
    """(documents, features), all finite."""
    return expand(base(chunk))


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, chunk: Chunk) -> np.ndarray:
        z = np.clip((self.worth(features(chunk)) - self.cut) * self.slope + np.log(THRESHOLD / (1 - THRESHOLD)), -40, 40)
        return 1 / (1 + np.exp(-z))


def ranking(z: np.ndarray, y: np.ndarray, steps: int = 1500, batch: int = 1024, rate: float = 0.03, decay: float = 1e-4) -> np.ndarray:
    """Weights that rank the rows labelled 1 over those labelled 0 (standardised features, both classes present)."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    draw = np.random.default_rng(8)
    width = z.shape[1]
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        d = z[draw.choice(good, batch)] - z[draw.choice(bad, batch)]
        g = -(d / (1 + np.exp(np.clip(d @ w, -40, 40)))[:, None]).mean(axis=0) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, whether there is a text, and ``x``, the :func:`base` statistics of the whole text, of every row (null counts as empty)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [base(c) for c in chunks(text_column(batch, "text"))]
            x = np.concatenate(parts) if parts else np.zeros((0, 0))
            ends = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], lists], names=["doc_id", "written", "x"])

    rows = docs.select("doc_id", F.col("text").isNotNull().alias("written"), "text")
    return rows.mapInArrow(lean(run), T.StructType([*rows.schema.fields[:2], T.StructField("x", T.ArrayType(T.DoubleType()))]))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _totals(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and standard deviation of each feature over all ``rows``: one record of sums a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, 0.0, 0.0
        for batch in batches:
            if batch.num_rows:
                x = expand(_matrix(batch.column(0)))
                n, total, square = n + len(x), total + x.sum(axis=0), square + (x * x).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([list(total)]), pa.array([list(square)])], names=["n", "total", "square"])

    parts = rows.select("x").mapInArrow(lean(run), "n long, total array<double>, square array<double>").collect()
    n = sum(r.n for r in parts)
    mean = np.sum([r.total for r in parts], axis=0) / n
    return n, mean, np.sqrt(np.maximum(np.sum([r.square for r in parts], axis=0) / n - mean * mean, 0))


def train_on(table: DataFrame, labels: DataFrame, size: int = GROUP) -> QualityModel:
    """Model learnt from all labelled rows with a text of ``table`` (as of :func:`measured`) outside the held-out fold (crc32(doc_id) mod 5 is 0).

    The rows are dealt by key to groups of about ``size``; each group is ranked in a task of its own and the weights
    are averaged by rows. Where a class has fewer than ``RARE`` rows a group, its rows go to several groups. Mean and
    scale of the features and the cut are those of all rows.
    """
    spark, width = table.sparkSession, expand(np.zeros((1, BASE))).shape[1]
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold("doc_id", 5) != 0))
    marks = marks.select("doc_id", F.col("quality").cast("int").alias("y")).distinct()
    rows = stored(table.where("written").join(marks, "doc_id"), "quality-labelled")
    count = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(count) < 2:  # every score is the base rate's side of the cut
        discard(rows)
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(width), -1.0 if 1 in count else 1.0, 1.0)
    n, mean, scale = _totals(rows)
    scale = np.maximum(scale, 1e-3)
    groups = max(1, round(n / size))
    copies = {y: min(groups, -(-RARE * groups // k)) for y, k in count.items()}
    turn = F.explode(F.sequence(F.lit(0), F.when(F.col("y") == 1, copies[1]).otherwise(copies[0]) - 1))
    dealt = rows.select("y", "x", F.xxhash64("doc_id", F.lit("quality")).alias("h"), turn.alias("turn"))
    dealt = dealt.select("y", "x", F.pmod(F.col("h") + F.col("turn"), F.lit(groups)).alias("g"))

    def fit(group: pa.Table) -> pa.Table:
        y, x = group["y"].to_numpy(), _matrix(group["x"].combine_chunks())
        order = np.lexsort([*x.T, y])  # the same draws whatever order the rows come in
        x, y = x[order], y[order]
        both = len(y) > 0 and y.min() != y.max()
        w = ranking(np.clip((expand(x) - mean) / scale, -8, 8), y) if both else np.zeros(width)
        return pa.table({"n": pa.array([len(y) if both else 0]), "w": pa.array([list(w)], pa.list_(pa.float64()))})

    fits = dealt.groupBy("g").applyInArrow(fit, "n long, w array<double>").collect()
    total = sum(r.n for r in fits)
    if not total:  # no group has both classes
        fits, total = [], 1
    weights = sum((r.n / total * np.array(r.w) for r in sorted(fits, key=lambda r: (r.n, r.w))), np.zeros(width))
    model = QualityModel(mean, scale, weights, 0.0, 1.0)
    # the cut lies between the worths of ranks k and k + 1, k the number of rows labelled 0
    ranks = [min(count[0] + i, n) / n for i in (0, 1)]
    worth = with_worth(rows, model).agg(F.percentile_approx("worth", ranks, RANKS)).first()[0]
    discard(rows)
    return QualityModel(mean, scale, weights, float(np.mean(worth)), 1.0)


def with_worth(table: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and worth of every row of ``table``."""
    sent = table.sparkSession.sparkContext.broadcast((model.mean, model.scale, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(*sent.value, 0.0, 1.0)
        for batch in batches:
            worth = own.worth(expand(_matrix(batch.column(1)))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(worth)], names=["doc_id", "worth"])

    return table.select("doc_id", "x").mapInArrow(lean(run), T.StructType([table.schema["doc_id"], T.StructField("worth", T.DoubleType())]))


def with_score(docs: DataFrame, model: QualityModel, score: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus a double column 0..1. A null text counts as empty."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast((model.mean, model.scale, model.weights, model.cut, model.slope))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(*sent.value)
        for batch in batches:
            parts = [own.score(c) for c in chunks(text_column(batch, text_col))]
            col = pa.array(np.concatenate(parts) if parts else np.zeros(0))
            yield pa.RecordBatch.from_arrays(batch.columns + [col], names=batch.schema.names + [score])

    return docs.mapInArrow(lean(run), T.StructType(docs.schema.fields + [T.StructField(score, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, size: int = GROUP) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on) for every row of ``docs``.

    Repeated rows score alike, a null doc_id counts as the empty text in the fold, empty tables give
    no rows; without labels of both classes all rows fall on the side of the only class seen.
    """
    table = stored(measured(docs), "quality-measured")
    model = train_on(table, labels, size)
    z = F.least(F.greatest((F.col("worth") - model.cut) * model.slope + float(np.log(THRESHOLD / (1 - THRESHOLD))), F.lit(-40.0)), F.lit(40.0))
    scored = with_worth(table, model).select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

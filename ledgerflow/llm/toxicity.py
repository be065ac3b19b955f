"""Operator 5: toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores ``p = sigmoid(bias + sum of word weights)``
over hashed words and word beginnings
(the first ``STEMS`` bytes, so an inflected offence counts like its stem); sentence scores combine by noisy-or, ``P = 1 - prod(1 - p)``, and only the
document's label is known in training. The leak is taken out of the product, ``P = 1 - prod((1 - p) / (1 - sigmoid(bias)))``,
in the fit as in scoring, so sentences without evidence add nothing at any length. Faint evidence is noise that would add up
over a long document: a sentence counts from a margin of evidence on, the greatest with which the toxic learning rows are
still found (``FOUND`` of those found without a margin). The trained sentence scores
then locate the offending sentences. Training is numpy gradient descent (Adam) on a bounded sample of labelled documents:
``SAMPLE`` documents, each of at most ``SAMPLE_CHARS`` characters, ``SAMPLE_BYTES`` in all (bounds of the fit alone); scoring
reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import Chunk, byte_class, chunks, fold, fresh, lean, release, segment_sum, ship, substring_hash, text_column, words_of

SAMPLE = 5000
SAMPLE_CHARS = 65_536
BUCKETS = 1 << 20
STEMS = (4, 5, 6, 7, 8, 10)  # bytes of the lower-cased UTF-8 word
THRESHOLD = 0.3
MIN_DOCS = 4  # a bucket in fewer sampled documents keeps weight 0

SAMPLE_BYTES = 32 << 20
MARGINS = tuple(k / 4 for k in range(33))  # evidence (logit) that a sentence must have to count; the greatest that holds is taken
FOUND = 0.98

_WORD = byte_class((97, 122), (128, 255))
_STOP = byte_class((10, 10), (13, 13), (33, 33), (46, 46), (63, 63))


@dataclass
class ToxicModel:
    weights: np.ndarray  # float32 per word bucket
    bias: float
    leak: float = -np.inf  # logit of a sentence without evidence; -inf for the constant base rate
    margin: float = 0.0

    def sentences(self, chunk: Chunk):
        """Words, sentence bounds (as words), sentence logits, first sentence per document."""
        words, sent = bags(chunk)
        first_sentence = np.searchsorted(sent[:-1], words.first)
        worth = np.zeros(len(words.start), np.float32)
        for h in buckets(words):
            worth += self.weights[h]
        return words, sent, segment_sum(worth, sent) + self.bias, first_sentence

    def score(self, chunk: Chunk) -> np.ndarray:
        _, _, z, first = self.sentences(chunk)
        return 1.0 - np.exp(-segment_sum(_worth(z, self.leak, self.bias + self.margin), first))


def _worth(z: np.ndarray, leak: float, least: float) -> np.ndarray:
    """-log of the chance that a sentence does not offend, the leak taken out; 0 below the logit ``least``."""
    return np.where(z < least, 0.0, np.logaddexp(0, z) - np.logaddexp(0, leak))


def bags(chunk: Chunk):
    """Words and, as indices of words, the sentence bounds (every sentence has a word)."""
    words = words_of(chunk, _WORD)
    stops = np.concatenate([[0], np.cumsum(_STOP[chunk.data])])
    doc = np.searchsorted(chunk.offsets, words.start, side="right")
    place = stops[words.start]
    new = np.flatnonzero((np.diff(place) != 0) | (np.diff(doc) != 0)) + 1 if len(place) else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], new, [len(place)]]) if len(place) else np.zeros(1, np.int64)
    return words, bounds


def buckets(words) -> list[np.ndarray]:
    """Feature buckets of each word: the whole word and its beginnings (the whole word if shorter)."""
    out = [words.hash]
    for n in STEMS:
        out.append(substring_hash(words.sums, words.start, np.minimum(words.start + n, words.end)) ^ np.uint64(n))
    return [(h % np.uint64(BUCKETS)).astype(np.int32) for h in out]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep, size: int, chars: int) -> list[tuple[str, int, float]]:
    """(text, label, weight) of at most ``size`` rows in pseudo-random order of doc_id, from rows where ``keep`` holds.

    Of the rarer class up to half of the sample is taken; the weights (1 on average over the rarer
    class's rows) restore the shares that the two classes have among all labelled rows. Texts of more than ``chars``
    characters, and those beyond a class's share of ``SAMPLE_BYTES``, are left out of the fit.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & keep).select("doc_id", F.col(label).alias("y"))
    total = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    rarer = min(total, key=total.get) if len(total) == 2 else None
    take = {y: min(n, size // 2 if y == rarer else size) for y, n in total.items()}
    if rarer is not None:
        take[1 - rarer] = min(take[1 - rarer], size - take[rarer])
    pairs: list[tuple[str, int, float]] = []
    for y, n in sorted(take.items()):
        chosen = rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id", F.lit(label))).limit(n).select("doc_id").distinct()
        texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.length("text") <= chars).select("text")
        weight = 1.0 if rarer is None else (total[y] / take[y]) / (total[rarer] / take[rarer])
        room = SAMPLE_BYTES * n // max(1, sum(take.values()))
        for r in texts.limit(n).toLocalIterator():
            room -= len(r.text.encode())
            if room >= 0:
                pairs.append((r.text, y, weight))
    return pairs


def train(pairs: list[tuple], steps: int = 360, batch: int = 256, rate: float = 0.05, shrink: float = 2e-4, min_docs: int = MIN_DOCS) -> ToxicModel:
    """Fit on (text, label) or (text, label, weight); without both classes the model is the constant base rate."""
    y = np.array([p[1] for p in pairs], dtype=np.float64)
    weight = np.array([p[2] if len(p) > 2 else 1.0 for p in pairs])
    if not len(y) or y.min() == y.max():
        rate_ = float(y.mean()) if len(y) else 0.0
        return ToxicModel(np.zeros(BUCKETS, np.float32), -30.0 if rate_ < 0.5 else 3.0)
    parts = []
    for chunk in chunks(pa.array([p[0] for p in pairs], pa.large_string())):
        words, sent = bags(chunk)
        h = np.stack(buckets(words), axis=1)
        first = np.searchsorted(sent[:-1], words.first)
        for i in range(chunk.n):
            s = sent[first[i] : first[i + 1] + 1] if first[i + 1] > first[i] else np.zeros(1, np.int64)
            parts.append((h[words.first[i] : words.first[i + 1]], s - words.first[i] if len(s) > 1 else s))
    df = np.zeros(BUCKETS, np.int32)
    for h, _ in parts:
        df[np.unique(h)] += 1
    # buckets that count get the numbers 0 .. k - 1, all others k, whose weight stays 0
    usable = np.flatnonzero(df >= min_docs)
    k = len(usable)
    number = np.full(BUCKETS, k, np.int32)
    number[usable] = np.arange(k)
    for h, _ in parts:
        h[:] = number[h]
    order = np.random.default_rng(5)
    w, b = np.zeros(k + 1), -4.0
    m, v, mb, vb, t = np.zeros(k + 1), np.zeros(k + 1), 0.0, 0.0, 0

    def logits(ids, w, b):
        h = np.concatenate([parts[i][0] for i in ids])
        n_sent = np.array([len(parts[i][1]) - 1 for i in ids])
        n_words = np.concatenate([np.diff(parts[i][1]) for i in ids])
        z = segment_sum(w[h].sum(axis=1), np.concatenate([[0], np.cumsum(n_words)])) + b
        return h, n_sent, n_words, z, np.logaddexp(0, z)

    per_epoch = max(1, len(parts) // batch)
    for _ in range(-(-steps // per_epoch)):
        for ids in np.array_split(order.permutation(len(parts)), per_epoch):
            h, n_sent, n_words, z, soft = logits(ids, w, b)
            s = np.maximum(segment_sum(soft - np.logaddexp(0, b), np.concatenate([[0], np.cumsum(n_sent)])), 1e-9)
            g_s = np.where(y[ids] > 0, -1.0 / np.maximum(np.expm1(np.minimum(s, 50)), 1e-9), 1.0)
            g_s = np.clip(g_s, -50, 1) * weight[ids] / weight[ids].sum()
            g_z = np.repeat(g_s, n_sent) * np.exp(z - soft)  # exp(z - log(1 + e^z)) is the sigmoid
            g = np.bincount(h.ravel(), weights=np.repeat(np.repeat(g_z, n_words), h.shape[1]), minlength=k + 1)
            g[k] = 0
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = np.maximum(w - rate * (m / (1 - 0.9**t) + shrink) / (np.sqrt(v / (1 - 0.999**t)) + shrink), 0)
            w[k] = 0
            gb = g_z.sum() - (g_s * n_sent).sum() * np.exp(b - np.logaddexp(0, b))
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    _, n_sent, _, z, _ = logits(np.flatnonzero(y > 0), w, b)
    first = np.concatenate([[0], np.cumsum(n_sent)])
    found = [(segment_sum(_worth(z, b, b + x), first) >= -np.log1p(-THRESHOLD)).mean() for x in MARGINS]
    margin = max(x for x, share in zip(MARGINS, found, strict=True) if share >= FOUND * found[0])
    full = np.zeros(BUCKETS, np.float32)
    full[usable] = w[:k]
    return ToxicModel(full, float(b), float(b), margin)


def train_on(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> ToxicModel:
    """Model learnt from labels of rows outside the held-out fold (crc32(doc_id) mod 4 is 2)."""
    model = train(labelled_sample(docs, labels, "toxic", fold("doc_id", 4) != 2, size, SAMPLE_CHARS))
    release()
    return model


def with_score(docs: DataFrame, model: ToxicModel, score: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus a double column 0..1. Null and empty texts score 0 (no sentence offends)."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast((model.weights, model.bias, model.leak, model.margin))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ToxicModel(*sent.value)
        for batch in batches:
            parts = [own.score(c) for c in chunks(text_column(batch, text_col))]
            col = pa.array(np.clip(np.concatenate(parts), 0.0, 1.0) if parts else np.zeros(0))
            yield pa.RecordBatch.from_arrays(batch.columns + [col], names=batch.schema.names + [score])

    return docs.mapInArrow(lean(run), T.StructType(docs.schema.fields + [T.StructField(score, T.DoubleType())]))


def offending(docs: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """The sentences whose own score reaches ``threshold``: doc_id, start, end (bytes of the UTF-8 text), score."""
    spark = docs.sparkSession
    ship(spark)
    sent_model = spark.sparkContext.broadcast((model.weights, model.bias))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ToxicModel(*sent_model.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for c in chunks(text_column(batch, "text")):
                words, sent, z, first = own.sentences(c)
                p = np.exp(z - np.logaddexp(0, z))
                hit = np.flatnonzero(p >= threshold)
                doc = np.searchsorted(first, hit, side="right") - 1
                base = c.offsets[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[c.first + d] for d in doc], pa.int64()),
                        pa.array(words.start[sent[hit]] - base, pa.int64()),
                        pa.array(words.end[sent[hit + 1] - 1] - base, pa.int64()),
                        pa.array(p[hit]),
                    ],
                    schema=schema,
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), "doc_id long, start long, end long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on) for every row of ``docs``.

    Repeated rows score alike, a null doc_id counts as the empty text in the fold, empty tables give
    no rows, and without labels of both classes the score is the constant base rate's side.
    """
    model = train_on(docs, labels, size)
    rows = docs.select(F.col("doc_id"), F.col("text"))
    scored = with_score(rows, model, "score")
    return scored.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def reject_toxic(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with its columns."""
    score = fresh(docs, "lf_toxic")
    return with_score(docs, model, score).where(F.col(score) < threshold).select(*docs.columns)

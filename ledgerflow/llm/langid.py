"""Operator 1: language identification by averaged hashed subword embeddings.

Words, with their boundaries, give byte n-grams (``GRAMS`` long) hashed into ``BUCKETS`` rows of an
embedding table; a text is the average of its rows, a linear softmax on it gives the language.
Table and softmax are trained together by stochastic gradient descent in numpy on a bounded sample:
``SAMPLE`` rows, cut into pieces of 1 to ``PIECE`` words so that short texts are learnt as well as long
ones (a bound of the fit alone; prediction reads every whole text). A temperature and a rejection
threshold are calibrated on pieces kept out of the descent: ``accepted`` is false where the
calibrated probability is below the threshold that keeps errors among accepted pieces within ``RISK``.

Since the model is linear, an embedding row times the softmax matrix is one row of per-bucket language
scores, so prediction is one gather and one sum per subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import LOWER, Chunk, byte_class, chunks, fold, lean, ship, text_column

SAMPLE = 2000
SAMPLE_CHARS = 32_768
PIECE = 400
BUCKETS = 1 << 16
DIM = 16
GRAMS = (2, 3, 4)
RISK = 0.01
MAX_LANGS = 1000

_WORD = byte_class((97, 122), (128, 255))


def subwords(chunk: Chunk) -> list[np.ndarray]:
    """Per n-gram length, the bucket of the subword that starts at each byte, 0 where none does.

    Bytes that are no letters become one boundary mark; a subword may begin or end with the mark but
    not hold it inside, and never crosses into the next document.
    """
    low = LOWER[chunk.data]
    text = np.where(_WORD[low], low, np.uint8(32))
    inside = text != 32
    out = []
    for n in GRAMS:
        size = max(len(text) - n + 1, 0)
        key = np.full(size, n, np.uint32)
        for i in range(n):
            key = key * np.uint32(0x01000193) + text[i : i + size]
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x846CA68B)
        bucket = np.zeros(len(text), np.int32)
        valid = inside[:size] | inside[n - 1 : n - 1 + size] if n == 2 else np.logical_and.reduce([inside[i : i + size] for i in range(1, n - 1)])
        bucket[:size] = ((key >> np.uint32(32 - 16)) | np.uint32(1)) * valid
        for i in range(1, n):
            at = chunk.offsets[1:-1] - i
            bucket[at[at >= 0]] = 0
        out.append(bucket)
    return out


def subword_sums(chunk: Chunk, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: sum of the table rows of its subwords, and their number. Row 0 must be zero."""
    total, n = np.zeros((chunk.n, table.shape[1])), np.zeros(chunk.n)
    full = np.flatnonzero(np.diff(chunk.offsets))
    if len(full):
        for bucket in subwords(chunk):
            total[full] += np.add.reduceat(table[bucket], chunk.offsets[full], axis=0)
            n[full] += np.add.reduceat(bucket != 0, chunk.offsets[full], dtype=np.int64)
    return total, n


@dataclass
class LangModel:
    langs: list[str]
    table: np.ndarray  # (BUCKETS, languages) float32: embedding times softmax matrix
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, chunk: Chunk) -> np.ndarray:
        total, n = subword_sums(chunk, self.table)
        z = (total / np.maximum(n, 1)[:, None] + self.bias) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def sample_rows(docs: DataFrame, keep, size: int, chars: int) -> list[tuple[str, str]]:
    """At most ``size`` (text, lang) rows in pseudo-random order of doc_id; the texts never pass through the sort."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & keep).select("doc_id")
    chosen = rows.orderBy(F.xxhash64("doc_id", F.lit("lang"))).limit(size).distinct()
    pairs = docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id", "left_semi")
    pairs = pairs.where((F.length("text") <= chars) & F.col("lang").isNotNull())
    return [(t, y) for t, y in pairs.select("text", "lang").limit(size).toLocalIterator()]


def _pieces(texts: list[str], labels: np.ndarray, draw) -> tuple[list[str], np.ndarray]:
    out, y = [], []
    for text, label in zip(texts, labels, strict=True):
        words = text.split()
        for _ in range(4):
            n = int(np.exp(draw.uniform(0, np.log(PIECE))))
            at = int(draw.integers(0, max(1, len(words) - n + 1)))
            out.append(" ".join(words[at : at + n]))
            y.append(label)
    return out, np.array(y)


def train(pairs: list[tuple[str, str]], epochs: int = 6, rate: float = 4.0, batch: int = 64) -> LangModel:
    """Fit on (text, language); with no pair the model knows no language (everything is ``und``)."""
    langs = sorted({y for _, y in pairs})
    if not langs:
        return LangModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    draw = np.random.default_rng(1)
    index = {name: i for i, name in enumerate(langs)}
    texts, y = _pieces([t for t, _ in pairs], np.array([index[lang] for _, lang in pairs]), draw)
    bags: list[np.ndarray] = []
    for chunk in chunks(pa.array(texts, pa.large_string())):
        grams = subwords(chunk)
        for i in range(chunk.n):
            bag = np.concatenate([g[chunk.offsets[i] : chunk.offsets[i + 1]] for g in grams])
            bags.append(bag[bag != 0])
    usable = np.array([i for i, bag in enumerate(bags) if len(bag)])
    held = usable[draw.random(len(usable)) < 0.15]
    fit = np.setdiff1d(usable, held)
    emb = draw.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    steps, t = epochs * max(1, len(fit) // batch), 0
    for _ in range(epochs):
        for ids in np.array_split(draw.permutation(fit), max(1, len(fit) // batch)) if len(fit) else []:
            lr = rate * (1 - t / (steps + 1)) / len(ids)
            t += 1
            rows = np.concatenate([bags[i] for i in ids])
            sizes = np.array([len(bags[i]) for i in ids])
            cut = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(emb[rows], cut, axis=0) / sizes[:, None]
            z = mean @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(ids)), y[ids]] -= 1
            back = (p @ out.T) / sizes[:, None]
            out -= (lr * (mean.T @ p)).astype(np.float32)
            bias -= (lr * p.sum(axis=0)).astype(np.float32)
            step = np.repeat(back * (lr * EMB_GAIN), sizes, axis=0).astype(np.float32)
            order = np.argsort(rows, kind="stable")
            first = np.flatnonzero(np.diff(rows[order], prepend=-1))
            emb[rows[order][first]] -= np.add.reduceat(step[order], first, axis=0)
    emb[0] = 0
    model = LangModel(langs, emb @ out, bias.astype(np.float64), 1.0, 0.0)
    return _calibrated(model, [texts[i] for i in held], y[held])


EMB_GAIN = 8.0  # embedding rows see far fewer updates than the softmax


def _calibrated(model: LangModel, texts: list[str], y: np.ndarray) -> LangModel:
    if not len(y):
        return model
    p = np.concatenate([model.probabilities(c) for c in chunks(pa.array(texts, pa.large_string()))])
    z = np.log(np.maximum(p, 1e-30))

    def scaled(temperature):
        e = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
        return e / e.sum(axis=1, keepdims=True)

    grid = np.exp(np.linspace(np.log(0.1), np.log(5), 40))
    model.temperature = float(min(grid, key=lambda k: -np.log(np.maximum(scaled(k)[np.arange(len(y)), y], 1e-12)).mean()))
    p = scaled(model.temperature)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    risk = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    within = np.flatnonzero(risk <= RISK)
    model.reject_below = float(top[order][within[-1]]) if len(within) else 1.0
    return model


def predict(docs: DataFrame, model: LangModel) -> DataFrame:
    """doc_id, lang_pred, score, accepted per row; ``und`` with score 0 if the text is null or has no letter."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast((model.langs, model.table, model.bias, model.temperature, model.reject_below))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LangModel(*sent.value)
        names = np.array([*own.langs, "und"], dtype=object)
        for batch in batches:
            known = batch.column(2).to_numpy(zero_copy_only=False).astype(bool) & bool(own.langs)
            best, score = np.full(batch.num_rows, len(names) - 1), np.zeros(batch.num_rows)
            for c in chunks(text_column(batch, "text")) if own.langs else ():
                p = own.probabilities(c)
                part = slice(c.first, c.first + c.n)
                best[part], score[part] = p.argmax(axis=1), p.max(axis=1)
            best[~known], score[~known] = len(names) - 1, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(known & (score >= own.reject_below))],
                schema=schema,
            )

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), "text", letters.alias("letters"))
    return rows.mapInArrow(lean(run), "doc_id long, lang_pred string, score double, accepted boolean")


def language(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted for every row of ``docs``.

    Learns from text and non-null lang of rows whose crc32(doc_id) mod 4 is not 2 (a null doc_id
    counts as the empty text, and is never learnt from). Without any labelled row all texts are
    ``und``. Repeated rows are predicted alike; empty tables give no rows; other columns are ignored.
    """
    model = train(sample_rows(docs, fold("doc_id", 4) != 2, size, SAMPLE_CHARS))
    return predict(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted"
    )

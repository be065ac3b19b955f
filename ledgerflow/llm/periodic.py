"""Operator 11: periodic runs of words by seed and extend along diagonals.

A run is a stretch of words with smallest period ``q`` and at least ``max(6, 4 q)`` words that cannot grow. At
lag ``q`` it matches itself over ``max(5, 3 q)`` words or more. Lags are taken by octave, ``lo <= q < 2 lo``, and
``k = max(5, 3 lo)`` is the overlap that every lag of the octave guarantees:

* *Index.* The k-grams of a document are hashed and sorted with their place. A gram that is alone in its document
  is dropped for all longer ``k`` too, so ordinary text leaves after the first octave.
* *Seeds.* Each occurrence is paired with the next one of the same document; a pair whose distance is a lag of the
  octave is a seed on that diagonal. ``k`` words are more than a period, so inside a run the next occurrence is exactly
  one smallest period away: pairs are linear in the words, no run is missed, and no multiple of a period is seeded.
* *Extend.* A seed grows in both directions word by word (in doubling blocks). A table holds, per lag, how far the
  diagonal is covered; seeds before that are skipped, so a run is extended once.

Words are compared by 64-bit hashes. The plan is map-only: a document is whole in one task, in chunks of about
``CHUNK_BYTES``, so copies, hot sources and long documents move nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import Chunk, byte_class, chunks, fresh, lean, mix64, prefix_sums, powers, inverse_powers, ship, spans_of, substring_hash, text_column

MIN_LENGTH, MIN_EXPONENT = 6, 4

_WORD = ~byte_class((9, 13), (32, 32))

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)


def words_as_written(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(hash per word, index of the first word per document with n + 1 entries); words never cross documents."""
    start, end = spans_of(_WORD[chunk.data])
    inner = chunk.offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(chunk.data))]
    mask = _WORD[chunk.data]
    joined = np.unique(inner[mask[inner] & mask[inner - 1]])
    if len(joined):
        start, end = np.sort(np.concatenate([start, joined])), np.sort(np.concatenate([end, joined]))
    return substring_hash(prefix_sums(chunk.data), start, end), np.searchsorted(start, chunk.offsets)


def _forward(h: np.ndarray, i: int, lag: int, end: int) -> int:
    """First place from ``i`` on where the word differs from the one ``lag`` later (``end - lag`` if none)."""
    step = 32
    while i + lag < end:
        m = min(step, end - lag - i)
        differs = h[i : i + m] != h[i + lag : i + lag + m]
        j = int(differs.argmax())
        if differs[j]:
            return i + j
        i, step = i + m, step * 2
    return i


def _backward(h: np.ndarray, i: int, lag: int, first: int) -> int:
    """Smallest place from which on all words up to ``i`` equal those ``lag`` later."""
    step = 32
    while i > first:
        m = min(step, i - first)
        differs = h[i - m : i] != h[i - m + lag : i + lag]
        if differs.any():
            return i - int(differs[::-1].argmax())
        i, step = i - m, step * 2
    return i


def find_runs(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(n, 3) starts, lengths, periods (starts as places in ``h``) of the runs in documents ``h[first[i]:first[i + 1]]``."""
    longest = int(np.diff(first).max(initial=0))
    if longest < MIN_LENGTH:
        return np.zeros((0, 3), np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin, end = first[doc], first[doc + 1]
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h)), out=sums[1:])
    inverse, own = inverse_powers(len(h) + 1), mix64(doc.astype(np.uint64) + np.uint64(1))
    alive, lo, found = np.arange(len(h)), 1, [np.zeros((0, 2), np.int64)]
    while len(alive) and max(MIN_LENGTH, MIN_EXPONENT * lo) <= longest:
        k = max(MIN_LENGTH - 1, (MIN_EXPONENT - 1) * lo)
        alive = alive[alive + k <= end[alive]]
        if not len(alive):
            break
        gram = mix64((sums[alive + k] - sums[alive]) * inverse[alive]) ^ own[alive]
        order = np.argsort(gram, kind="stable")
        ranked, place = gram[order], alive[order]
        same = ranked[1:] == ranked[:-1]
        left, lag = place[:-1][same], (place[1:] - place[:-1])[same]
        near = (lag >= lo) & (lag < 2 * lo)
        found.append(np.stack([left[near], lag[near]], axis=1))
        repeated = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        alive, lo = np.sort(place[repeated]), lo * 2
    seeds = np.concatenate(found)
    seeds = seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))]
    # a seed right after one of the same lag lies on the stretch that one extends over
    head = np.ones(len(seeds), bool)
    head[1:] = (np.diff(seeds[:, 0]) != 1) | (np.diff(seeds[:, 1]) != 0)
    covered: dict[int, int] = {}
    runs = []
    for at, lag in seeds[head].tolist():
        if covered.get(lag, -1) > at:
            continue
        s, t = _backward(h, at, lag, int(begin[at])), _forward(h, at, lag, int(end[at]))
        covered[lag] = t
        if t - s + lag >= max(MIN_LENGTH, MIN_EXPONENT * lag):
            runs.append((s, t - s + lag, lag))
    out = np.array(runs, np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def with_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus three columns (last), named by :func:`ledgerflow.llm.common.fresh`.

    ``lf_words`` (long), ``lf_runs`` (array of start, length, period, by start, then period) and ``lf_collapsed``: the
    words joined by one space, without those that a run holds after its first period. Words are
    ``[^\\x20\\x09-\\x0D]+``, compared as written. Null and blank texts have no words, no runs and the empty collapsed text;
    repeated rows get equal results, an empty table an empty one; other columns pass through, whatever their names.
    """
    ship(docs.sparkSession)
    names = [fresh(docs, n) for n in ("lf_words", "lf_runs", "lf_collapsed")]
    kinds = [T.LongType(), RUNS, T.StringType()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])
        for batch in batches:
            n_words, sizes, rows, texts = [], [], [], []
            for c in chunks(text_column(batch, text_col)):
                h, first = words_as_written(c)
                runs = find_runs(h, first)
                keep = np.ones(len(h), bool)
                for s, length, period in runs.tolist():
                    keep[s + period : s + length] = False
                of = np.searchsorted(runs[:, 0], first)
                full = np.add.reduceat(np.concatenate([~keep, [False]]), first[:-1]) if c.n else np.zeros(0)
                raw = c.data.tobytes()
                for i in range(c.n):
                    words = raw[c.offsets[i] : c.offsets[i + 1]].split()  # bytes split at the six ASCII spaces
                    if words and full[i]:
                        words = [words[j] for j in np.flatnonzero(keep[first[i] : first[i + 1]]).tolist()]
                    texts.append(b" ".join(words))
                n_words.append(np.diff(first))
                sizes.append(np.diff(of))
                runs[:, 0] -= np.repeat(first[:-1], np.diff(of))
                rows.append(runs)
            flat = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1)
            triples = pa.StructArray.from_arrays([pa.array(flat[:, k], pa.int64()) for k in range(3)], fields=list(part))
            columns = [
                pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), triples),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(batch.columns + columns, names=batch.schema.names + names)

    return docs.mapInArrow(lean(run), T.StructType(docs.schema.fields + [T.StructField(n, t) for n, t in zip(names, kinds, strict=True)]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs, collapsed: one row per row of ``docs``, edge cases as in :func:`with_runs`."""
    rows = with_runs(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return rows.select("doc_id", F.col("lf_words").alias("n_words"), F.col("lf_runs").alias("runs"), F.col("lf_collapsed").alias("collapsed"))


def collapse_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the text of documents that hold a run collapsed; other texts stay as written."""
    rows = with_runs(docs, text_col)
    runs, collapsed = rows.columns[-2:]
    text = F.when(F.size(runs) > 0, F.col(collapsed)).otherwise(rows[text_col])
    return rows.select(*[text.alias(c) if c == text_col else rows[c] for c in docs.columns])

"""Operator 2: benchmark decontamination with an FM-index per shard.

The benchmark is cut into windows (``WINDOW`` consecutive words; a shorter item is one window).
A shard is a chunk of whole documents: its words are numbered by the benchmark's vocabulary, runs of
words of that vocabulary (at least as long as the shortest window; no occurrence can stand anywhere
else) form the shard's text, and the text gets a suffix array, its Burrows-Wheeler transform and a
wavelet matrix over it. All windows are searched backwards at once through the wavelet ranks, the
occurrences are located by walking to sampled suffix positions, and their word spans are merged per
document. Documents never shuffle.

The benchmark is sent to the tasks in blocks of at most ``BLOCK_BYTES`` of its text, one pass each, so
what is broadcast is bounded however large the benchmark grows; results of several blocks merge by row.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerflow.llm.bloom import numbered, remove_rows, with_rid
from ledgerflow.llm.common import Chunk, byte_class, chunks, fresh, lean, ship, spans_of, stored, text_column, words_of

WINDOW = 10
BLOCK_BYTES = 16 << 20
SAMPLE_EVERY = 8

_WORD = byte_class((48, 57), (97, 122), (128, 255))


@dataclass
class Windows:
    """Distinct windows of a benchmark block: rows of symbols (1..V, 0 pads), lengths, and their items."""

    vocab: np.ndarray  # sorted word hashes; symbol = place + 1
    rows: np.ndarray  # (windows, WINDOW) int32
    length: np.ndarray
    items: np.ndarray  # item ids as text
    owner: np.ndarray  # item per window use, grouped by window
    first: np.ndarray  # windows + 1 entries into owner


def windows_of(items: list[tuple[object, str | None]], width: int = WINDOW) -> Windows:
    """Windows of (item_id, text) rows. A null id's windows still count as hits but name no item."""
    texts = pa.array([t or "" for _, t in items], pa.large_string())
    hashes: list[np.ndarray] = []
    for chunk in chunks(texts):
        words = words_of(chunk, _WORD)
        hashes += [words.hash[words.first[i] : words.first[i + 1]] for i in range(chunk.n)]
    vocab = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
    names = np.array(sorted({str(i) for i, _ in items if i is not None}), dtype=object)
    place = {name: k for k, name in enumerate(names)}
    rows, length, owner = [], [], []
    for (item, _), h in zip(items, hashes, strict=True):
        if not len(h):
            continue
        sym = np.searchsorted(vocab, h).astype(np.int32) + 1
        n = min(len(sym), width)
        own = np.zeros((max(len(sym) - width + 1, 1), width), np.int32)
        own[:, :n] = np.lib.stride_tricks.sliding_window_view(sym, n)
        rows.append(own)
        length.append(np.full(len(own), n))
        owner.append(np.full(len(own), -1 if item is None else place[str(item)]))
    if not rows:
        empty = np.zeros(0, np.int64)
        return Windows(vocab, np.zeros((0, width), np.int32), empty, names, empty, np.zeros(1, np.int64))
    all_rows, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.ravel(), np.concatenate(owner)], axis=1), axis=0)
    pairs = pairs[pairs[:, 1] >= 0]
    first = np.searchsorted(pairs[:, 0], np.arange(len(all_rows) + 1))
    return Windows(vocab, all_rows, (all_rows > 0).sum(axis=1), names, pairs[:, 1], first)


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Rank of every suffix, by doubling over the suffixes not yet told apart.

    ``text`` ends with a value that occurs once, as does every run of it, so suffixes differ within
    their run and no comparison passes its end.
    """
    n = len(text)
    _, first, inverse = np.unique(text, return_index=True, return_inverse=True)
    count = np.bincount(inverse)
    rank = (np.cumsum(count) - count)[inverse]
    active = np.flatnonzero(count[inverse] > 1)
    h = 1
    while len(active):
        key = rank[active] * np.int64(n) + rank[active + h]
        order = np.argsort(key)
        active, key = active[order], key[order]
        old = rank[active]
        place = np.arange(len(active))
        new_group = np.flatnonzero(np.diff(key, prepend=-1))
        old_group = np.flatnonzero(np.diff(old, prepend=-1))
        size = np.diff(np.append(new_group, len(active)))
        start_new = np.repeat(new_group, size)
        start_old = np.repeat(old_group, np.diff(np.append(old_group, len(active))))
        rank[active] = old + (start_new - start_old)
        active = active[np.repeat(size, size) > 1] if len(place) else active
        h *= 2
    return rank


class WaveletMatrix:
    """Ranks of symbols over a sequence: one bit plane per bit, most significant first."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(seq) - int(self.ones[-1][-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, sym: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``sym`` occurs before place ``i``."""
        start, end = np.zeros(len(i), np.int64), i.astype(np.int64)
        for k in range(self.bits):
            one = ((sym >> (self.bits - 1 - k)) & 1).astype(bool)
            s, e = self.ones[k][start], self.ones[k][end]
            start = np.where(one, self.zeros[k] + s, start - s)
            end = np.where(one, self.zeros[k] + e, end - e)
        return end - start


@dataclass
class FmIndex:
    bwt: np.ndarray
    less: np.ndarray  # per symbol: suffixes that begin with a smaller one
    wavelet: WaveletMatrix
    sampled: np.ndarray  # text position per row, -1 where not sampled
    steps: int = field(default=SAMPLE_EVERY)

    @classmethod
    def build(cls, runs: np.ndarray, starts: np.ndarray, symbols: int) -> FmIndex:
        """``runs``: symbols with a 0 after every run; ``starts``: first position of each run."""
        n, ends = len(runs), np.flatnonzero(runs == 0)
        text = runs.astype(np.int64) + len(ends)
        text[ends] = np.arange(len(ends))  # every run ends in a value of its own
        rank = suffix_ranks(text)
        sa = np.empty(n, np.int64)
        sa[rank] = np.arange(n)
        bwt = np.where(sa > 0, runs[sa - 1], 0)
        count = np.bincount(runs, minlength=symbols + 1)
        pos = np.arange(n)
        mark = np.zeros(n, bool)
        mark[starts] = True
        mark |= pos % SAMPLE_EVERY == 0
        sampled = np.full(n, -1, np.int64)
        sampled[rank[mark]] = pos[mark]
        return cls(bwt, np.cumsum(count) - count, WaveletMatrix(bwt, max(int(symbols).bit_length(), 1)), sampled)

    def search(self, rows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of every phrase, by backward steps over all phrases at once."""
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), len(self.bwt))
        live = np.arange(len(rows))
        for k in range(1, rows.shape[1] + 1):
            live = live[(length[live] >= k) & (lo[live] < hi[live])]
            if not len(live):
                break
            sym = rows[live, length[live] - k]
            lo[live] = self.less[sym] + self.wavelet.rank(sym, lo[live])
            hi[live] = self.less[sym] + self.wavelet.rank(sym, hi[live])
        return lo, np.maximum(hi, lo)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of rows: step left until a sampled suffix, at most ``SAMPLE_EVERY`` times."""
        row, back, out = row.copy(), 0, np.full(len(row), -1, np.int64)
        open_ = np.arange(len(row))
        while len(open_):
            at = self.sampled[row[open_]]
            out[open_[at >= 0]] = at[at >= 0] + back
            open_ = open_[at < 0]
            sym = self.bwt[row[open_]]
            row[open_] = self.less[sym] + self.wavelet.rank(sym, row[open_])
            back += 1
        return out


def search_chunk(chunk: Chunk, win: Windows) -> tuple[np.ndarray, list]:
    """Words per document, and per document with hits (document, [(start, end)], items, words hit)."""
    words = words_of(chunk, _WORD)
    n_words = np.diff(words.first)
    if not len(win.rows) or not len(words.hash):
        return n_words, []
    place = np.minimum(np.searchsorted(win.vocab, words.hash), len(win.vocab) - 1)
    symbol = np.where(win.vocab[place] == words.hash, place + 1, 0).astype(np.int32)
    mask = symbol > 0
    lo, hi = spans_of(mask)
    cuts = words.first[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(mask))]
    cuts = np.unique(cuts[mask[cuts] & mask[cuts - 1]])
    lo, hi = np.sort(np.concatenate([lo, cuts])), np.sort(np.concatenate([hi, cuts]))
    long_enough = hi - lo >= win.length.min()
    lo, hi = lo[long_enough], hi[long_enough]
    if not len(lo):
        return n_words, []
    size = hi - lo + 1
    starts = np.cumsum(size) - size
    word = np.arange(int(size.sum())) - np.repeat(starts - lo, size)  # the word at each text position
    runs = np.where(word == np.repeat(hi, size), 0, symbol[np.minimum(word, len(symbol) - 1)])
    index = FmIndex.build(runs, starts, len(win.vocab))
    left, right = index.search(win.rows, win.length)
    found = np.flatnonzero(right > left)
    if not len(found):
        return n_words, []
    times = right[found] - left[found]
    which = np.repeat(found, times)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(left[found], times)
    begin = word[index.locate(rows)]
    edge = np.zeros(len(symbol) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + win.length[which], -1)
    hit = np.cumsum(edge[:-1]) > 0
    doc = np.searchsorted(words.first, begin, side="right") - 1
    out = []
    by_doc = np.unique(np.stack([doc, which], axis=1), axis=0)
    for d in np.unique(doc):
        a, b = words.first[d], words.first[d + 1]
        own = by_doc[by_doc[:, 0] == d, 1] if len(by_doc) < 64 else by_doc[np.searchsorted(by_doc[:, 0], d) : np.searchsorted(by_doc[:, 0], d, side="right"), 1]
        items = np.unique(np.concatenate([win.owner[win.first[w] : win.first[w + 1]] for w in own]))
        s, e = spans_of(hit[a:b])
        base = chunk.offsets[d]
        spans = [(int(x), int(y), int(words.start[a + x] - base), int(words.end[a + y - 1] - base)) for x, y in zip(s, e, strict=True)]
        out.append((int(d), spans, sorted(win.items[items].tolist()), int(hit[a:b].sum())))
    return n_words, out


_SPANS = "array<struct<first_word:long,end_word:long,start:long,end:long>>"
_SPAN_TYPE = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def _search(rows: DataFrame, win: Windows) -> DataFrame:
    """rid, doc_id, n_words, n_hit, items, spans per row of (rid, doc_id, text)."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(win)
    schema = pa.schema([("rid", pa.int64()), ("doc_id", to_arrow_type(rows.schema["doc_id"].dataType)), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", _SPAN_TYPE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, n_hit = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            items: list[list[str]] = [[] for _ in range(batch.num_rows)]
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for c in chunks(text_column(batch, "text")):
                n[c.first : c.first + c.n], found = search_chunk(c, sent.value)
                for d, s, i, k in found:
                    items[c.first + d], n_hit[c.first + d] = i, k
                    spans[c.first + d] = [dict(zip(("first_word", "end_word", "start", "end"), x, strict=True)) for x in s]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(n_hit), pa.array(items, pa.list_(pa.string())), pa.array(spans, _SPAN_TYPE)], schema=schema
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(lean(run), f"rid long, doc_id {kind}, n_words long, n_hit long, items array<string>, spans {_SPANS}")


def contamination(docs: DataFrame, bench: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: rid, doc_id, n_words, n_hit, items, spans (words and bytes of the UTF-8 text).

    Null texts have no words and items without words no window; empty tables give no rows or no hits;
    repeated rows and repeated items count as they stand; other columns are ignored. ``docs`` must be
    a stored table.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = numbered(docs).select("rid", "doc_id", "text")
    items = bench.select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    if blocks == 1:
        return _search(rows, windows_of([tuple(r) for r in items.toLocalIterator()], width))
    parts = None
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        part = _search(rows, windows_of([tuple(r) for r in own.toLocalIterator()], width))
        part = stored(part if k == 0 else part.where("n_hit > 0"), "decontaminate-block")
        parts = part if parts is None else parts.unionByName(part)
    return _merged(parts)


def _merged(parts: DataFrame) -> DataFrame:
    """Rows of several blocks to one per rid: words hit by any of them, spans joined where they meet."""
    by_row = parts.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("found"),
    )
    joined = """aggregate(found, cast(array() as array<struct<first_word:long,end_word:long,start:long,end:long>>),
        (acc, s) -> if(size(acc) > 0 and element_at(acc, -1).end_word >= s.first_word,
            concat(slice(acc, 1, size(acc) - 1), array(named_struct('first_word', element_at(acc, -1).first_word,
                'end_word', greatest(element_at(acc, -1).end_word, s.end_word), 'start', element_at(acc, -1).start,
                'end', greatest(element_at(acc, -1).end, s.end)))),
            concat(acc, array(s))))"""
    merged = by_row.withColumn("spans", F.expr(joined)).drop("found")
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end_word - s.first_word)")
    return merged.select("rid", "doc_id", "n_words", hit.alias("n_hit"), "items", "spans")


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` (a stored table) without any hit, with its columns; the texts never shuffle."""
    hit = contamination(docs, bench).where("n_hit > 0").select("rid")
    return remove_rows(docs, stored(hit, "decontaminate-hit"))


def cut_spans(docs: DataFrame, bench: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the merged spans cut out of the texts (same columns; texts without hits unchanged)."""
    rid, spans = fresh(docs, "lf_rid"), fresh(docs, "lf_spans")
    hits = contamination(docs.select("doc_id", F.col(text_col).alias("text")), bench).where("n_hit > 0")
    hits = stored(hits.select(F.col("rid").alias(rid), F.col("spans").alias(spans)), "decontaminate-spans")
    rows = with_rid(docs, rid).join(hits, rid, "left")
    raw = F.col(text_col).cast("binary")

    @F.udf("string")
    def cut(data, found):
        if not found:
            return None  # such rows keep their text
        keep, at = [], 0
        for s in found:
            keep.append(data[at : s["start"]])
            at = s["end"]
        return b"".join([*keep, data[at:]]).decode("utf-8")

    text = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(cut(raw, spans))
    return rows.withColumn(text_col, text).select(*docs.columns)

"""Operator 6: repeated substrings removed by a logarithmic family of suffix arrays.

Wanted: every byte covered by a ``LENGTH``-byte string (a window) that also starts anywhere else.

1. *Anchors.* Each window has a smallest ``GRAM``-byte gram (by hash, the leftmost of ties): its anchor.
   Equal windows have equal anchors at equal offsets, so only windows whose anchor gram occurs twice
   are candidates. Consecutive windows with the same anchor form a run; one hash per run (about one
   per ``(LENGTH - GRAM) / 2`` bytes) shuffles, and the rest drop out by a Bloom filter.
2. *Classes.* Runs with equal text form a class (128-bit digest, counted with map-side combining). Of each
   class of a shared gram one run is compared, and of a class of more runs the ends of another (a run is
   shorter than two windows, so its first and last window cover it); what holds for them holds for all
   runs of the class. All windows are compared where a class of the gram has a single run, else the ends.
3. *Index family.* These runs go, by anchor gram, to tasks that take them batch by batch. A new batch gets a
   suffix array of its windows, is merge-scanned against every existing level for matches of ``LENGTH``
   bytes, and becomes a level; levels of equal size merge, so sizes grow geometrically. Every match comes
   from a family. One ends after ``FAMILY_WINDOWS`` windows, where the gram changes: nothing later can match.
4. *Hot grams.* More than ``GROUP_MAX`` classes around one gram are split before they go to a family: each run
   is cut into pieces of half as many anchor offsets, and a piece goes by the bytes that all windows of its
   offsets hold. Equal windows meet in the same group still, and groups get smaller; this goes on, for the
   groups that are still hot, down to one window a piece, where all texts of a group are equal.

Documents whose bytes stay never shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerflow.llm.bloom import member_filter, numbered, take_rows
from ledgerflow.llm.common import Chunk, chunks, inverse_powers, lean, mix64, prefix_sums, ship, spans_of, stored, text_column

LENGTH = 400
#: text whose anchors a task seeks at once; its arrays are some seventy times as large
PART_BYTES = 1 << 18
GROUP_MAX = 512
BATCH_WINDOWS = 20_000
FAMILY_WINDOWS = 16 * BATCH_WINDOWS


def gram_size(length: int) -> int:
    return max(length * 3 // 5, 1)


def anchor_runs(chunk: Chunk, length: int) -> tuple[np.ndarray, ...]:
    """Per run of windows with one anchor: document, first window start, windows, anchor offset, gram hash."""
    k, n = gram_size(length), len(chunk.data)
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    if n < length:
        return none
    sums = prefix_sums(chunk.data)
    gram = mix64((sums[k:] - sums[:-k]) * inverse_powers(n + 1)[: n - k + 1] + np.uint64(k))
    pos_bits = np.uint64(31)  # smallest of a window: by the hash's upper 33 bits, then the place
    key = ((gram >> pos_bits) << pos_bits) | np.arange(len(gram), dtype=np.uint64)
    span, done = length - k + 1, 1
    while done * 2 <= span:
        key = np.minimum(key[:-done], key[done:])
        done *= 2
    if done < span:
        key = np.minimum(key[: len(key) - (span - done)], key[span - done :])
    anchor = (key & ((np.uint64(1) << pos_bits) - np.uint64(1))).astype(np.int64)  # one per window start
    inside = np.zeros(n + 1, np.int32)
    size = np.diff(chunk.offsets)
    big = size >= length
    inside[chunk.offsets[:-1][big]] += 1
    inside[chunk.offsets[1:][big] - length + 1] -= 1
    valid = np.flatnonzero(np.cumsum(inside)[: len(anchor)] > 0)
    if not len(valid):
        return none
    own = anchor[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (own[1:] != own[:-1]) | (np.diff(valid) != 1)
    first = np.flatnonzero(new)
    start = valid[first]
    windows = np.diff(np.append(first, len(valid)))
    doc = np.searchsorted(chunk.offsets, start, side="right") - 1
    return doc, start, windows, own[first] - start, gram[own[first]]


def _grams(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(text_column(batch, "text"), PART_BYTES):
                gram = anchor_runs(c, length)[4]
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64))], names=["gram"])

    return rows.select("text").mapInArrow(lean(run), "gram long")


_RUN = "rid long, gram long, c1 long, c2 long, start long, windows int, off int"
_RUN_SCHEMA = pa.schema([("rid", pa.int64()), ("gram", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()), ("off", pa.int32())])


def _runs(rows: DataFrame, maybe: tuple, length: int) -> DataFrame:
    """Runs whose gram may be shared: row, gram, digest of (anchor offset, text), place."""
    test = maybe

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column(0).to_numpy()
            for c in chunks(text_column(batch, "text"), PART_BYTES):
                doc, start, windows, offset, gram = anchor_runs(c, length)
                keep = np.flatnonzero(test(gram))
                raw = memoryview(np.ascontiguousarray(c.data))
                digest = b"".join(
                    hashlib.blake2b(raw[start[i] : start[i] + windows[i] - 1 + length], digest_size=16, salt=int(offset[i]).to_bytes(4, "little")).digest()
                    for i in keep
                )
                both = np.frombuffer(digest, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rids[c.first + doc[keep]]),
                        pa.array(gram[keep].view(np.int64)),
                        pa.array(both[:, 0].copy()),
                        pa.array(both[:, 1].copy()),
                        pa.array(start[keep] - c.offsets[doc[keep]]),
                        pa.array(windows[keep].astype(np.int32)),
                        pa.array(offset[keep].astype(np.int32)),
                    ],
                    schema=_RUN_SCHEMA,
                )

    return rows.mapInArrow(lean(run), _RUN)


class Level:
    """Windows of some runs in suffix order: the runs' text, window starts sorted, and who has a match."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, matched: np.ndarray):
        self.text, self.starts, self.matched = text, starts, matched
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        words = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(text)]
        self.words = np.ascontiguousarray(words).view(">u8").ravel().astype(np.uint64)  # 8 bytes from every place


def sorted_level(text: np.ndarray, starts: np.ndarray, length: int) -> Level:
    """Suffix array of the windows at ``starts``, to the depth of ``length`` bytes: sorted by eight bytes, then each
    block of equals by the next eight; windows that stay equal to the end match each other."""
    level = Level(text, starts, np.zeros(len(starts), bool))
    rank, live = np.zeros(len(starts), np.int64), np.arange(len(starts))
    for at in _depths(length):
        if not len(live):
            break
        word = level.words[starts[live] + at]
        order = np.lexsort((word, rank[live]))
        live, word = live[order], word[order]
        block, place = rank[live], np.arange(len(live))
        edge = np.ones(len(live) + 1, bool)  # first of a block
        edge[1:-1] = block[1:] != block[:-1]
        part = edge.copy()  # first of those equal to this depth
        part[1:-1] |= word[1:] != word[:-1]
        begin = np.maximum.accumulate(np.where(edge[:-1], place, 0))
        rank[live] = block + np.maximum.accumulate(np.where(part[:-1], place, 0)) - begin
        live = live[~(part[:-1] & part[1:])]
    level.matched[live] = True
    order = np.argsort(rank, kind="stable")
    level.starts, level.matched = starts[order], level.matched[order]
    return level


def _depths(length: int) -> list[int]:
    return [*range(0, length - 7, 8), *([max(length - 8, 0)] if length % 8 else [])]


def merge_scan(a: Level, b: Level, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both sorted lists merged: the place in ``a`` of each window of ``b``, which of ``b`` are in ``a``, which of ``a`` in ``b``.

    The lists are merged by their first eight bytes, then, inside each block of equal bytes that both
    hold, by the next eight, and so on; what has no partner in its block is settled.
    """
    place, in_a, in_b = np.zeros(len(b.starts), np.int64), np.zeros(len(b.starts), bool), np.zeros(len(a.starts), bool)
    ia, ib = np.arange(len(a.starts)), np.arange(len(b.starts))
    ga, gb = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)  # block of each window that is left
    for at in _depths(length):
        if not len(ia) or not len(ib):
            break
        words, rank = np.unique(np.concatenate([b.words[b.starts[ib] + at], a.words[a.starts[ia] + at]]), return_inverse=True)
        key = np.concatenate([gb, ga]) * np.int64(len(words)) + rank  # ascending in each list
        order = np.argsort(key, kind="stable")  # two ascending runs: one linear merge, ``b`` before its equals
        from_a = order >= len(ib)
        kb, ka = key[: len(ib)], key[len(ib) :]
        before = np.cumsum(from_a)[~from_a]  # windows of ``a`` below each of ``b``
        upto = np.cumsum(~from_a)[from_a]  # windows of ``b`` up to each of ``a``
        found = (before < len(ia)) & (ka[np.minimum(before, len(ia) - 1)] == kb)
        shared = (upto > 0) & (kb[np.maximum(upto - 1, 0)] == ka)
        same_block = (before > 0) & (ga[np.maximum(before - 1, 0)] == gb)
        place[ib] = np.where(same_block, ia[np.maximum(before - 1, 0)] + 1, ia[np.minimum(before, len(ia) - 1)])
        block = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        number = np.empty(len(order), np.int64)
        number[order] = block
        gb, ga = number[: len(ib)][found], number[len(ib) :][shared]
        ib, ia = ib[found], ia[shared]
    if len(ia) and len(ib):
        in_a[ib], in_b[ia] = True, True
    return place, in_a, in_b


class IndexFamily:
    """Levels of geometrically growing size over the windows added so far."""

    def __init__(self, length: int):
        self.length, self.levels = length, []

    def add(self, text: np.ndarray, starts: np.ndarray) -> None:
        new = sorted_level(text, starts, self.length)
        for level in self.levels:
            _, found, hit = merge_scan(level, new, self.length)
            new.matched |= found
            level.matched |= hit
        self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2].starts) <= 2 * len(self.levels[-1].starts):
            self.levels.append(self._merge(self.levels.pop(-2), self.levels.pop()))

    def _merge(self, a: Level, b: Level) -> Level:
        at = merge_scan(a, b, self.length)[0]
        place_b = at + np.arange(len(b.starts))
        starts = np.zeros(len(a.starts) + len(b.starts), np.int64)
        matched = np.zeros(len(starts), bool)
        rest = np.ones(len(starts), bool)
        rest[place_b] = False
        starts[place_b], matched[place_b] = b.starts + len(a.text), b.matched
        starts[rest], matched[rest] = a.starts, a.matched
        return Level(np.concatenate([a.text, b.text]), starts, matched)

    def matched(self) -> list[tuple[int, np.ndarray]]:
        """Matched window starts, over all added text in the order of adding."""
        out, base = [], 0
        for level in self.levels:
            out.append(level.starts[level.matched] + base)
            base += len(level.text)
        return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


def family_matches(runs: list[tuple], length: int, batch_windows: int = BATCH_WINDOWS) -> list[np.ndarray]:
    """For runs of one family, (text, number of windows or their starts), the windows of each that occur in it at least twice."""
    family = IndexFamily(length)
    bases, base, i = [], 0, 0
    while i < len(runs):
        texts, starts, size, count = [], [], 0, 0
        while i < len(runs) and (not count or count < batch_windows):
            text, own = runs[i]
            own = np.arange(own) if isinstance(own, int) else own
            starts.append(size + own)
            texts.append(np.frombuffer(text, np.uint8))
            bases.append(base + size)
            size += len(text)
            count += _weight(len(own), len(text))
            i += 1
        family.add(np.concatenate(texts), np.concatenate(starts))
        base += size
    hits = family.matched()
    edge = np.searchsorted(hits, np.array([*bases, base]))
    return [hits[edge[k] : edge[k + 1]] - bases[k] for k in range(len(runs))]


def _weight(windows: int, size: int) -> int:
    """What a run adds to a batch: its windows, and its text where that is long beside them."""
    return windows + size // 16


_FOUND = "p1 long, p2 long, hits array<struct<first:int,end:int>>"
_HITS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def _ranges(windows: int, hits: np.ndarray) -> list[dict]:
    mask = np.zeros(windows, bool)
    mask[hits] = True
    return [{"first": int(a), "end": int(b)} for a, b in zip(*spans_of(mask), strict=True)]


def _by_family(texts: DataFrame, length: int) -> DataFrame:
    """(p1, p2, hits) of the distinct texts with repeated windows; ``texts``: gram, p1, p2, windows, n, bytes."""

    def solve(held):
        mixed = {h[0] for h in held if h[4] == 1}  # grams of a text that occurs once: all windows are compared
        runs, first = [], []
        for gram, _, _, windows, n, text in held:
            ends = np.unique([0, windows - 1])
            first.append(len(runs))
            runs.append((text, windows if gram in mixed else ends))
            if n > 1:
                runs.append((text, ends))  # another run of the class
        hits = family_matches(runs, length)
        found = []
        for h, k in zip(held, first, strict=True):
            own = hits[k]
            if h[4] > 1 and len(own) and own[0] == 0 and own[-1] == h[3] - 1 and len(hits[k + 1]):
                own = np.arange(h[3])  # both ends match in two equal runs, so does all between
            if len(own):
                found.append((h[1], h[2], _ranges(h[3], own)))
        columns = [pa.array([f[k] for f in found], t) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, _HITS))]
        return pa.RecordBatch.from_arrays(columns, names=["p1", "p2", "hits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for batch in batches:
            for row in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if held and row[0] != held[-1][0] and count >= FAMILY_WINDOWS:
                    yield solve(held)  # nothing later can match these
                    held, count = [], 0
                held.append(row)
                count += _weight(row[3], len(row[5]))
        if held:
            yield solve(held)

    rows = texts.select("gram", "p1", "p2", "windows", "n", "bytes")
    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(lean(run), _FOUND)


_PIECE = "gram long, p1 long, p2 long, c1 long, c2 long, n long, off int, first int, windows int, bytes binary"
_PIECE_TYPES = (*[pa.int64()] * 6, *[pa.int32()] * 3, pa.binary())


def pieces_of(off: int, windows: int, text: bytes, length: int, width: int) -> Iterator[tuple[bytes, int, int, int]]:
    """A run cut at multiples of ``width`` anchor offsets: core, first window, windows, block.

    The core of a block is what all windows with an offset in it hold, so equal windows have equal
    blocks and cores, wherever their runs end. The anchor is at byte ``off`` of ``text``.
    """
    most = length - gram_size(length)
    for block in range((off - windows + 1) // width, off // width + 1):
        lo, hi = block * width, min(block * width + width - 1, most)
        first, end = off - min(off, hi), off - max(off - windows + 1, lo) + 1
        yield text[off - lo : off - hi + length], first, end - first, block


def _split(texts: DataFrame, length: int, width: int) -> DataFrame:
    """Pieces of ``width`` anchor offsets; ``gram`` is the hash of the core, p1 and p2 the digest of the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                c1, c2, n, off, begin, windows, text = (col[k].as_py() for col in batch.columns)
                out = []
                for core, first, count, block in pieces_of(off, windows, text, length, width):
                    piece = text[first : first + count - 1 + length]
                    mark = block.to_bytes(8, "little")
                    key = hashlib.blake2b(core, digest_size=8, salt=mark).digest()
                    own = hashlib.blake2b(piece, digest_size=16, salt=(off - first).to_bytes(8, "little")).digest()
                    ids = np.frombuffer(key + own, np.int64).tolist()
                    out.append((*ids, c1, c2, n, off - first, begin + first, count, piece))
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(_PIECE_TYPES)], names=[f.split()[0] for f in _PIECE.split(", ")])

    return texts.select("c1", "c2", "n", "off", "first", "windows", "bytes").mapInArrow(lean(run), _PIECE)


def _groups(texts: DataFrame, group_max: int) -> tuple:
    """Filters of the grams that need a comparison and of the hot ones (None if there are none)."""
    groups = texts.groupBy("gram").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.least("n", F.lit(2))).alias("runs"))
    groups = stored(groups.where("runs > 1"), "substring-groups")
    hot = groups.where(F.col("texts") > max(group_max, 1)).select("gram")
    return member_filter(groups.select("gram")), None if hot.isEmpty() else member_filter(hot)


def repeated_spans(docs: DataFrame, length: int = LENGTH, group_max: int = GROUP_MAX) -> DataFrame:
    """(rid, spans) of the rows with repeated windows; spans are unmerged (start, end) byte ranges."""
    ship(docs.sparkSession)
    rows = numbered(docs).select("rid", "text").where(F.octet_length("text") >= length)
    shared = _grams(rows, length).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    shared = stored(shared, "substring-grams")
    runs = stored(_runs(rows, member_filter(shared).plain, length), "substring-runs")
    classes = runs.groupBy("gram", "c1", "c2", "windows", "off").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "start")).alias("at"))
    classes = stored(classes, "substring-classes")
    need, hot = _groups(classes, group_max)
    texts = stored(_class_texts(docs, classes.where(need("gram")), length), "substring-texts")
    width = length - gram_size(length) + 1
    hot = hot if width > 1 else None
    cold = texts if hot is None else texts.where(~hot("gram"))
    found = _by_family(cold, length).select(F.col("p1").alias("c1"), F.col("p2").alias("c2"), "hits")
    while hot is not None and width > 1:
        width = (width + 1) // 2
        texts = stored(_split(texts.where(hot("gram")), length, width), "substring-pieces")
        each = texts.groupBy("gram", "p1", "p2", "windows").agg(F.sum("n").alias("n"), F.any_value("bytes").alias("bytes"))
        each = stored(each, "substring-distinct")
        need, hot = _groups(each, group_max)
        ready = need("gram") if hot is None or width == 1 else need("gram") & ~hot("gram")
        hits = texts.join(_by_family(each.where(ready), length), ["p1", "p2"])
        moved = F.transform("hits", lambda h: F.struct((h["first"] + F.col("first")).alias("first"), (h["end"] + F.col("first")).alias("end")))
        found = found.unionByName(hits.select("c1", "c2", moved.alias("hits")))
    found = stored(found, "substring-found")
    spans = runs.join(found, ["c1", "c2"]).select("rid", "start", F.explode("hits").alias("hit"))
    spans = spans.select("rid", F.struct((F.col("start") + F.col("hit.first")).alias("start"), (F.col("start") + F.col("hit.end") - 1 + length).alias("end")).alias("span"))
    return spans.groupBy("rid").agg(F.collect_list("span").alias("spans"))


def _class_texts(docs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """One run's bytes per class, as its only piece. Only rows that hold such a run shuffle."""
    wanted = classes.select(F.col("at.rid").alias("rid"), F.struct("gram", "c1", "c2", "n", "off", "windows", F.col("at.start").alias("start")).alias("run"))
    wanted = stored(wanted.groupBy("rid").agg(F.collect_list("run").alias("runs")), "substring-wanted")
    rows = take_rows(numbered(docs).select("rid", "text"), "rid", wanted)
    rows = rows.select(F.encode("text", "UTF-8").alias("raw"), F.explode("runs").alias("run"))
    piece = F.expr(f"substring(raw, cast(run.start as int) + 1, run.windows - 1 + {length})")
    own = [F.col("run.c1").alias("p1"), F.col("run.c2").alias("p2"), F.lit(0).alias("first")]
    return rows.select("run.gram", *own, "run.c1", "run.c2", "run.n", "run.off", "run.windows", piece.alias("bytes"))


def _kept(rows: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) of (doc_id, text, spans or null)."""
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    schema = pa.schema([("doc_id", id_type), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index("spans"))
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
            out: list[tuple] = []
            for k in range(batch.num_rows):
                raw = texts[k].as_py() or b""
                edge = np.zeros(len(raw) + 1, np.int32)
                for s in spans[k].as_py() or ():
                    edge[s["start"]] += 1
                    edge[s["end"]] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                out.append((len(raw), int(gone.sum()), len(spans_of(gone)[0]), np.frombuffer(raw, np.uint8)[~gone].tobytes()))
            columns = [pa.array([o[i] for o in out], schema.field(i + 1).type) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    return rows.select("doc_id", "text", "spans").mapInArrow(lean(run), f"doc_id {rows.dtypes[0][1]}, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, group_max: int = GROUP_MAX) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes) for every row of ``docs``.

    Texts are UTF-8 bytes, null counts as empty; matches never cross documents; overlapping
    occurrences count; strings are judged on the input. Repeated rows lose all their long strings
    (each starts elsewhere too). Empty tables give no rows; other columns are ignored. ``docs`` must
    be a stored table.
    """
    spans = stored(repeated_spans(docs, length, group_max), "substring-spans")
    rows = numbered(docs).withColumn("maybe", member_filter(spans.select("rid"))("rid"))
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    zero = F.lit(0).cast("long")
    whole = rows.where(~F.col("maybe")).select(
        "doc_id", F.octet_length(raw).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), raw.alias("kept")
    )
    cut = rows.where("maybe").join(spans, "rid", "left").select("doc_id", "text", "spans")
    return whole.unionByName(_kept(cut))

"""Operator 7: SentencePiece (merge type) encoding and decoding by a prefix table.

For every prefix of a text the last token of its encoding is unique. Going through the matches of
all pieces in the text (an Aho-Corasick automaton), a piece that ends a prefix is that last token if
and only if it is compatible with the last token of the prefix before it: the pair must be left alone
when its two texts are merged together. The table of last tokens then gives the ids backwards.

Pair compatibility undoes the two tokens' merges from the latest on and looks for a merge across
the border that would have come earlier. Pieces with a space mark hold it only in front, so a text
falls apart into units of spaces plus what follows, and each distinct unit is encoded once per cache.

The model file is read on the driver only; pieces and scores are broadcast (32,000 short texts).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerflow.llm.common import chunks, lean, ship, text_column

MARK = "▁"
CACHE_UNITS = 80_000  # encoded units a task keeps, and as many of the time before
CACHE_PAIRS = 300_000  # answered compatibility questions a task keeps
LONG_UNIT = 200  # longer units are encoded each time
OUTPUT_BYTES = 2 << 20  # of text taken at a time

CLOSING = ".,!?;:|#$%&*"

_UNIT = re.compile(r" +[^ \n]*|\n[^ \n]*|[^ \n]+")


def load_model(path: str) -> dict:
    """Pieces, ranks (0 merges first; equal scores rank alike) and special ids of a merge-type model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    score = [sp.get_score(i) for i in range(n)]
    order = {s: r for r, s in enumerate(sorted(set(score), reverse=True))}
    bytes_ = {}
    normal = []
    for i in range(n):
        if sp.is_byte(i):
            bytes_[int(sp.id_to_piece(i)[1:-1], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            normal.append((i, sp.id_to_piece(i), order[score[i]]))
    return {"pieces": normal, "bytes": bytes_, "eos": sp.eos_id(), "size": n}


class PieceCoder:
    """Encoder and decoder of one model; everything derives from pieces and their ranks."""

    def __init__(self, model: dict, ids_as_text: bool = False):
        import ahocorasick

        self.ids_as_text = ids_as_text

        self.eos = model["eos"]
        self.byte_id = model["bytes"]
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.text = {i: t for i, t, _ in model["pieces"]}
        self.shown = {i: t.replace(MARK, " ") for i, t, _ in model["pieces"]}
        self.shown_id = [str(i) for i in range(model["size"])]
        self.rank = {t: r for _, t, r in model["pieces"]}
        self.id = {t: i for i, t, _ in model["pieces"]}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.own: dict[int, int] = {}
        self.good: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for i, t, _ in model["pieces"]:
            last = self._last_merge(t)
            if last is None:
                continue  # the piece's own text never merges into it, so no encoding holds it
            if last:
                self.left[i], self.right[i], self.own[i] = self.id[t[:last]], self.id[t[last:]], self.rank[t]
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.newline = self._plain_unit("\n")
        self.splits_lines = not any("\n" in t for t in self.rank)
        self.joined = {t[k : k + 2] for t in self.rank for k in range(len(t) - 1)}
        self.cache: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.closings: dict[str, tuple] = {}

    def _last_merge(self, t: str) -> int | None:
        """Where the last merge that makes ``t`` splits it; 0 for one character, None if it never forms."""
        if len(t) == 1:
            return 0
        nxt = list(range(1, len(t) + 1))
        prev = list(range(-1, len(t) - 1))
        end = list(range(1, len(t) + 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(a, b):
            r = self.rank.get(t[a : end[b]])
            if r is not None:
                heapq.heappush(queue, (r, a, end[a], end[b]))

        for k in range(len(t) - 1):
            offer(k, k + 1)
        split = None
        while queue:
            _, a, mid, stop = heapq.heappop(queue)
            if end[a] != mid or nxt[a] >= len(t) or end[nxt[a]] != stop:
                continue
            b = nxt[a]
            split, end[a], nxt[a], end[b] = mid, stop, nxt[b], -1
            if nxt[a] < len(t):
                prev[nxt[a]] = a
                offer(a, nxt[a])
            if prev[a] >= 0:
                offer(prev[a], a)
        return split if end[0] == len(t) else None

    def compatible(self, a: int, b: int) -> bool:
        """Whether the texts of ``a`` and ``b``, side by side, merge into exactly these two tokens."""
        key = a * 65536 + b
        known = self.good.get(key)
        if known is not None:
            return known
        if len(self.good) > 2_000_000:
            self.good.clear()
        text, rank, own = self.text, self.rank, self.own
        before, answer = 1 << 60, True
        while True:
            across = rank.get(text[a] + text[b])
            if across is not None and across < before:
                answer = False
                break
            ra, rb = own.get(a, -1), own.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:  # the left token's merge came last; at equal rank a merge across would come after it
                before, a = ra, self.right[a]
            else:  # at equal rank a merge across would come before the right token's
                before, b = rb + 1, self.left[b]
        self.good[key] = answer
        return answer

    def _plain_unit(self, t: str) -> list[int]:
        """Ids of one unit: fill the table of last tokens by matches, then walk back."""
        n = len(t)
        last: list = [None] * (n + 1)
        good, compatible = self.good, self.compatible
        for end, (i, size) in self.automaton.iter(t):
            j = end + 1
            if last[j] is None:
                before = last[j - size]
                if before is None:
                    last[j] = i  # the text begins here, or behind a character that no piece holds
                else:
                    fits = good.get(before * 65536 + i)
                    if fits or (fits is None and compatible(before, i)):
                        last[j] = i
        ids: list[int] = []
        j = n
        while j > 0:
            i = last[j]
            if i is None:  # a character that no piece holds: its bytes, last first
                ids.extend(self.byte_id[b] for b in reversed(t[j - 1].encode("utf-8")))
                j -= 1
            else:
                ids.append(i)
                j -= len(self.text[i])
        ids.reverse()
        return ids

    def piece_text(self, ids) -> str:
        """Texts of ids one after the other; runs of byte ids as UTF-8, control ids as nothing."""
        try:
            return "".join([self.shown[i] for i in ids])
        except KeyError:
            pass
        out, held = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode("utf-8", errors="replace"))
                held.clear()
            out.append(self.shown.get(i, ""))
        if held:
            out.append(held.decode("utf-8", errors="replace"))
        return "".join(out)

    def decode(self, ids) -> str:
        """Text of a whole encoding: the space put in front of every text is taken off again."""
        text = self.piece_text(ids)
        return text[1:] if text.startswith(" ") else text

    def _made(self, ids: list[int]) -> tuple:
        kept = " ".join([self.shown_id[i] for i in ids]) if self.ids_as_text else tuple(ids)
        return kept, len(ids), self.piece_text(ids)

    def _entry(self, unit: str) -> tuple:
        """(ids, their number, text) of a unit: "x" stands for " x", "\nx" for itself.

        Closing punctuation is looked up on its own where no piece joins it to what stands before.
        """
        entry = self.old.get(unit)
        if entry is None:
            stem = unit.rstrip(CLOSING)
            if stem and len(stem) < len(unit) and stem[-1] not in " \n" and stem[-1] + unit[len(stem)] not in self.joined:
                head = self.cache.get(stem) or self._entry(stem)
                marks = unit[len(stem) :]
                tail = self.closings.get(marks)
                if tail is None:
                    tail = self._made(self._plain_unit(marks))
                    if len(self.closings) < CACHE_UNITS // 10 and len(marks) <= LONG_UNIT:
                        self.closings[marks] = tail
                entry = (f"{head[0]} {tail[0]}" if self.ids_as_text else head[0] + tail[0], head[1] + tail[1], head[2] + tail[2])
            elif unit[:1] == "\n":
                entry = self._made(self.newline + self._plain_unit(unit[1:]))
            else:
                entry = self._made(self._plain_unit(MARK + unit.replace(" ", MARK)))
        if len(unit) <= LONG_UNIT:
            if len(self.cache) >= CACHE_UNITS:
                self.old, self.cache = self.cache, {}
            self.cache[unit] = entry
        return entry

    def entries(self, text: str) -> list[tuple]:
        """Cache entries of a text's units, in order."""
        if not text:
            return []
        text = text.replace(MARK, " ")
        if not self.splits_lines:
            units = [u[1:] for u in re.findall(" +[^ ]*", " " + text)]
        elif "  " not in text and text[0] != " " and " \n" not in text:
            units = text.replace("\n", " \n").split(" ")
            if text[0] == "\n":
                units[0] = ""  # the space in front of the text stands alone
        else:
            units = [u[1:] if u[0] == " " else u for u in _UNIT.findall(" " + text)]
        known = self.cache
        out = [known.get(u) for u in units]
        if None in out:
            make = self._entry
            out = [e or self.cache.get(u) or make(u) for e, u in zip(out, units, strict=True)]
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids with the end id last; null counts as empty."""
        found = self.entries(text or "")
        ids = map(int, " ".join([e[0] for e in found]).split()) if self.ids_as_text else chain.from_iterable([e[0] for e in found])
        return [*ids, self.eos]


    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Numbers of ids, ids and decoded texts of many texts (nulls count as empty).

        The units of all texts are numbered by Arrow first, so each distinct unit of the batch is
        looked up once. Texts with runs of spaces, or empty, are taken apart one by one.
        """
        texts = pc.replace_substring(texts.fill_null(""), MARK, " ")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, " \n")))
        odd = pc.or_(odd, pc.equal(pc.binary_length(texts), 0))
        if not self.splits_lines:
            odd = pa.array(np.ones(len(texts), bool))
        plain = pc.split_pattern(pc.replace_substring(pc.if_else(odd, "", texts), "\n", " \n"), " ")
        units = plain.flatten().dictionary_encode()
        known, make = self.cache, self._entry
        found = []
        for u in units.dictionary.to_pylist():
            found.append(known.get(u) or make(u))
            known = self.cache
        offsets = plain.offsets.to_numpy()
        per_unit = np.array([e[1] for e in found], np.int64)
        index = units.indices
        total = np.concatenate([[0], np.cumsum(per_unit[index.to_numpy()])])
        n = total[offsets[1:]] - total[offsets[:-1]] + 1
        text = pc.binary_join(pa.ListArray.from_arrays(plain.offsets, pa.array([e[2] for e in found], pa.string()).take(index)), "")
        decoded = pc.utf8_slice_codeunits(text, 1)  # every one of these begins with the space put in front
        if self.ids_as_text:
            ids = pc.binary_join(pa.ListArray.from_arrays(plain.offsets, pa.array([e[0] for e in found], pa.string()).take(index)), " ")
            ids = pc.binary_join_element_wise(ids, str(self.eos), " ")
        else:
            flat = pa.array([e[0] for e in found], pa.list_(pa.int32())).take(index).flatten().to_numpy()
            flat = np.insert(flat, total[offsets[1:]], self.eos)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))
        rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(rows):
            return n, ids, decoded
        own = [self.encode(texts[int(k)].as_py()) for k in rows]
        n[rows] = [len(i) for i in own]
        place = np.arange(len(n))
        place[rows] = len(n) + np.arange(len(rows))  # the rows' own results stand behind the others
        own_ids = [" ".join(map(str, i)) for i in own] if self.ids_as_text else own
        ids = pa.concat_arrays([ids, pa.array(own_ids, ids.type)]).take(pa.array(place))
        decoded = pa.concat_arrays([decoded, pa.array([self.decode(i) for i in own], pa.string())]).take(pa.array(place))
        return n, ids, decoded


def tokenize(docs: DataFrame, model_path: str, ids_as_text: bool = False, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids, decoded for every row of ``docs``.

    ``ids`` is an array, or with ``ids_as_text`` the decimal ids joined by one space; the end id is
    included. A null or empty text is the end id alone and decodes to the empty text. Repeated rows
    are encoded alike; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    model = load_model(model_path)
    sent = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    ids_type = pa.string() if ids_as_text else pa.list_(pa.int32())
    schema = pa.schema([("doc_id", id_type), ("n_tokens", pa.int64()), ("ids", ids_type), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceCoder(sent.value, ids_as_text)  # of this task alone: its caches go with the task
        for batch in batches:
            texts = batch.column(1)
            for c in chunks(text_column(batch, "text"), OUTPUT_BYTES):
                n, ids, decoded = coder.encode_all(texts.slice(c.first, c.n))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(c.first, c.n), pa.array(n), ids.cast(ids_type), decoded], schema=schema)

    return rows.mapInArrow(lean(run), f"doc_id {rows.dtypes[0][1]}, n_tokens long, ids {'string' if ids_as_text else 'array<int>'}, decoded string")

"""Operator 12: phrase collocations by prefix-free parsing.

Each text is parsed into overlapping chunks: a window of ``longest - 1`` words whose content hashes to 0 modulo
``TRIGGER`` ends one chunk and begins the next, so equal passages are cut alike wherever they stand. Spark counts equal
chunks: the *dictionary* with parse frequencies. Every count is then taken inside distinct chunks, weighted by the
frequency. A phrase of up to ``longest`` words that begins before a chunk's closing window lies whole in that chunk, and
only there it is counted (the closing window belongs to the next chunk; the last chunk of a text owns all its words).

Phrases of three words and more are counted only where both of their shorter parts are frequent: these are tested in a
Bloom filter of at most 32 MB, whose false positives are counted and found rare. All counts are exact: tasks add up a
batch by dictionary codes of its words, Spark adds up the batches by the phrase itself.

Shuffled are chunks, phrases and their partial counts, never documents; a text copied a million times is one
entry per task. A hot word costs its partial counts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.bloom import member_filter
from ledgerflow.llm.common import byte_class, chunks, lean, mix64, prefix_sums, ship, slices, stored, substring_hash, spans_of, text_column, words_of

TRIGGER = 32
#: dictionary text that a task counts at once; its arrays are some thirty times as large
PART_BYTES = 2 << 20
_STOPS = b".,;:!?\x0a\x0b\x0c\x0d"
_STOP = byte_class(*[(b, b) for b in _STOPS])
_WORD = ~(_STOP | byte_class((9, 9), (32, 32)))
_TOKEN = ~byte_class((9, 13), (32, 32))


def _salt(lang: str) -> np.uint64:
    data = np.frombuffer(lang.encode(), np.uint8)
    return substring_hash(prefix_sums(data), np.array([0]), np.array([len(data)]))[0]


def parse(docs: DataFrame, longest: int, trigger: int) -> DataFrame:
    """(lang, chunk, tail, freq): the distinct chunks, words apart by a space, pieces by a line end."""
    window = longest - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for c in chunks(text_column(batch, "text")):
                words = words_of(c, _WORD)
                n = len(words.start)
                if not n:
                    continue
                size = words.end - words.start
                at = np.concatenate([[0], np.cumsum(size + 1)])
                low = np.where((c.data >= 65) & (c.data <= 90), c.data + 32, c.data).astype(np.uint8)
                out = np.full(at[-1], 32, np.uint8)
                bytes_of = np.repeat(np.arange(n), size)
                out[np.arange(len(bytes_of)) + bytes_of] = low[_WORD[low]]
                stops = np.concatenate([[0], np.cumsum(_STOP[c.data])])
                ends = np.append(stops[words.start[1:]] != stops[words.end[:-1]], True)  # a piece ends with this word
                out[at[1:][ends] - 1] = 10
                last = np.repeat(words.first[1:], np.diff(words.first))  # where the word's document ends
                key = np.zeros(n, np.uint64)
                for k in range(min(window, n)):
                    broken = ends[k - 1 : n - 1].astype(np.uint64) if k else np.uint64(0)
                    key[: n - k] = mix64(key[: n - k] + words.hash[k:] + broken)
                place, opening = np.arange(n), np.repeat(words.first[:-1], np.diff(words.first))
                cut = np.flatnonzero((key % np.uint64(trigger) == 0) & (place + window <= last) & (place > opening))
                begin = np.unique(np.concatenate([words.first[:-1][np.diff(words.first) > 0], cut]))
                until = np.append(begin[1:], n)
                tail = np.isin(until, words.first)
                stop = np.where(tail, until, until + window)
                buf = out.tobytes()
                doc = np.searchsorted(words.first, begin, side="right") - 1 + c.first
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([langs[d] for d in doc.tolist()], pa.string()),
                        "chunk": pa.array([buf[a:b] for a, b in zip(at[begin].tolist(), (at[stop] - 1).tolist(), strict=True)], pa.binary()).cast(pa.string()),
                        "tail": pa.array(tail),
                    }
                )

    rows = docs.mapInArrow(lean(run), "lang string, chunk string, tail boolean")
    return rows.groupBy("lang", "chunk", "tail").agg(F.count(F.lit(1)).alias("freq"))


def _counts(parsed: DataFrame, sizes: tuple[int, ...], window: int, both=None) -> DataFrame:
    """(lang, phrase, f) of phrases of ``sizes`` words over the dictionary; the empty phrase counts all words if 1 is asked.

    ``both``: a filter of phrase keys that the two parts without the last and without the first word have to pass.
    """

    passes = both.plain if both is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, PART_BYTES)):
            rows = batch.column(1).cast(pa.binary()).to_pylist()
            lang = batch.column(0).dictionary_encode()
            names, code = lang.dictionary.to_pylist(), lang.indices.to_numpy()
            data = b"\n".join(rows) + b"\n"
            raw = np.frombuffer(data, np.uint8)
            start, end = spans_of(_TOKEN[raw])
            # one byte is between two words, so a word and that byte reach up to the next one
            spaced = np.where(raw == 10, 32, raw).astype(np.uint8)
            cuts = pa.py_buffer(np.append(start, len(raw)).astype(np.int32))
            coded = pa.Array.from_buffers(pa.binary(), len(start), [None, cuts, pa.py_buffer(spaced)]).dictionary_encode()
            word, vocabulary = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            spelt = pc.binary_slice(coded.dictionary, 0, -1)
            row_at = np.cumsum([0] + [len(r) + 1 for r in rows])
            first = np.searchsorted(start, row_at)
            row = np.repeat(np.arange(len(rows)), np.diff(first))
            tail = batch.column(2).to_numpy(zero_copy_only=False)
            owned = np.arange(len(start)) < np.where(tail, first[1:], first[1:] - window)[row]
            freq = batch.column(3).to_numpy()[row]
            piece = np.concatenate([[0], np.cumsum(raw == 10)])[start]  # rows are apart by a line end too
            salts = np.array([_salt(n) for n in names], np.uint64)
            sums = prefix_sums(raw) if passes is not None else None
            langs, phrases, f = [], [], []
            for size in sizes:
                m = len(start) - size + 1
                if m <= 0:
                    continue
                at = np.flatnonzero(owned[:m] & (piece[:m] == piece[size - 1 :]))
                if passes is not None and len(at):
                    salt = salts[code[row[at]]]
                    for a in (0, 1):
                        ok = passes(substring_hash(sums, start[at + a], end[at + a + size - 2]) ^ salt)
                        at, salt = at[ok], salt[ok]
                key, top = code[row[at]].astype(np.int64), max(len(names), 1)
                for k in range(size):
                    if top > (1 << 62) // max(vocabulary, 1):
                        values, key = np.unique(key, return_inverse=True)
                        top = len(values)
                    key, top = key * vocabulary + word[at + k], top * vocabulary
                _, one, group = np.unique(key, return_index=True, return_inverse=True)
                total = np.zeros(len(one), np.int64)
                np.add.at(total, group, freq[at])
                keep = at[one]
                langs.append(lang.dictionary.take(pa.array(code[row[keep]])))
                parts = [spelt.take(pa.array(word[keep + k])) for k in range(size)]
                phrases.append(pc.binary_join_element_wise(*parts, b" ") if size > 1 else parts[0])
                f.append(total)
            if 1 in sizes:
                total = np.zeros(len(names), np.int64)
                np.add.at(total, code[row], np.where(owned, freq, 0))
                langs.append(lang.dictionary)
                phrases.append(pa.array([b""] * len(names), pa.binary()))
                f.append(total)
            del data, raw, spaced, coded, sums
            for each in zip(langs, phrases, f, strict=True):
                yield pa.RecordBatch.from_arrays([each[0], each[1].cast(pa.string()), pa.array(each[2], pa.int64())], names=["lang", "phrase", "f"])

    counted = parsed.select("lang", "chunk", "tail", "freq").mapInArrow(lean(run), "lang string, phrase string, f long")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _phrase_keys(phrases: DataFrame) -> DataFrame:
    """The 64-bit key of each (lang, phrase), as :func:`_counts` computes it inside chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for c in chunks(text_column(batch, "phrase")):
                keys.append(substring_hash(prefix_sums(c.data), c.offsets[:-1], c.offsets[1:]))
            salt = np.array([_salt(x) for x in batch.column(0).to_pylist()], np.uint64)
            key = (np.concatenate(keys) if keys else np.zeros(0, np.uint64)) ^ salt
            yield pa.RecordBatch.from_pydict({"key": pa.array(key.view(np.int64), pa.int64())})

    return phrases.select("lang", "phrase").mapInArrow(lean(run), "key long")


def _words(phrase: Column) -> Column:
    return F.split(phrase, " ")


def _part(words: Column, first: int, size: int) -> Column:
    return F.array_join(F.slice(words, first + 1, size), " ")


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, trigger: int = TRIGGER
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to ``longest`` words of each language.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``. ``a`` is the
    phrase's count (``least`` or more), ``n`` the language's words; the cut of the phrase in two parts with counts ``l``, ``r``
    whose ``floor(1000000 a a / (l r))`` is lowest gives the score (ties: the shorter first part). Phrases inside a longer one
    with ``share`` per cent of their count or more are left out, then the first ``top`` of a language stay, by score and
    ``a`` descending, then phrase.

    A null language is ``und``, a null text empty; repeated rows count as often as they occur; an empty table or texts without
    frequent phrases give no rows. Other columns are ignored, whatever their names.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    ship(docs.sparkSession)
    window = longest - 1
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    parsed = stored(parse(rows, longest, trigger), "phrase-chunks")
    counted = stored(_counts(parsed, (1, 2), window).where((F.col("f") >= least) | (F.col("phrase") == "")), "phrase-counts-2")
    by_size = {2: counted.where(F.col("phrase").contains(" "))}
    for size in range(3, longest + 1):
        both = member_filter(_phrase_keys(by_size[size - 1]))
        by_size[size] = stored(_counts(parsed, (size,), window, both).where(F.col("f") >= least), f"phrase-counts-{size}")
    every = counted
    for size in range(3, longest + 1):
        every = every.unionByName(by_size[size])
    # one row per candidate and part of a cut; one join brings the counts of all parts
    pieces = []
    for size, table in by_size.items():
        w = _words(F.col("phrase"))
        cuts = [F.struct(F.lit(k).alias("k"), F.lit(left).alias("left"), (_part(w, 0, k) if left else _part(w, k, size - k)).alias("part")) for k in range(1, size) for left in (True, False)]
        pieces.append(table.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.array(*cuts)).alias("cut")))
    parts = pieces[0]
    for p in pieces[1:]:
        parts = parts.unionByName(p)
    parts = parts.select("lang", "phrase", "a", "cut.k", "cut.left", F.col("cut.part").alias("part"))
    found = parts.join(every.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    sides = [F.max(F.when((F.col("k") == k) & (F.col("left") == left), F.col("f"))).alias(f"{'l' if left else 'r'}{k}") for k in range(1, longest) for left in (True, False)]
    wide = found.groupBy("lang", "phrase", "a").agg(*sides)

    def big(c: str) -> Column:
        return F.col(c).cast("decimal(18,0)")

    scored = [F.when(F.col(f"l{k}").isNotNull(), F.struct(_quotient(big("a"), big(f"l{k}"), big(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, longest)]
    wide = wide.select("lang", "phrase", "a", F.array_min(F.array_compact(F.array(*scored))).alias("best"))
    # the greatest count of a longer candidate around each shorter one
    inner = []
    for size in range(3, longest + 1):
        w = _words(F.col("phrase"))
        shorter = [_part(w, i, m) for m in range(2, size) for i in range(size - m + 1)]
        inner.append(by_size[size].select("lang", F.explode(F.array_distinct(F.array(*shorter))).alias("phrase"), "f"))
    if inner:
        around = inner[0]
        for t in inner[1:]:
            around = around.unionByName(t)
        around = around.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
        wide = wide.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < share * F.col("a"))).drop("around")
    order = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("a").desc(), F.col("phrase"))
    best = wide.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = counted.where(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    return best.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score")
    )


def _quotient(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)) on decimals of 38 digits: exact for counts below 10^15."""
    return F.call_function("div", (a * a).cast("decimal(31,0)") * F.lit(1000000).cast("decimal(7,0)"), l * r)

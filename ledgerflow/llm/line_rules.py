"""Operator 13: quality rules, line first, in DataFrame functions only.

A document is cut at ``\\n`` and every line with a word is judged by itself:

* punctuation: it ends in a terminal mark, and at most ``MARK_SHARE`` per cent of its characters are marks;
* navigation: fewer than two menu separators, or fewer than one to ``NAV_WORDS`` words;
* boilerplate: none of the ``BOILERPLATE`` phrases.

Failing lines are removed; then documents that lost more than ``LOST_SHARE`` per cent of their characters
(white space aside) are rejected. Before that, base rules reject documents of few words and documents whose
five-word windows recur.

Recurring windows are found inside the row: windows are hashed, sorted with their place, and neighbours with
equal hashes are compared word by word. No shuffle, no Python: the plan is projections over the scan, so a
task holds one document at a time, whatever its source or copies. Work per document is n log n in its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import fresh

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
REPEAT_SHARE = 20  # per cent of the words that recurring windows may cover
WINDOW = 5

# Fixed values of the line rules.
TERMINAL = ".!?…:;\"'”’»)。！？"
NAV_MARKS = "|»›•·>"
NAV_WORDS = 4
MARK_SHARE = 20
LOST_SHARE = 50
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "accept cookies",
    "enable javascript",
    "lorem ipsum",
    "skip to content",
    "skip to main content",
    "click here to",
    "read more",
    "sign up for",
    "subscribe to our",
    "follow us on",
    "share this",
    "powered by",
)


def _bare(text: Column) -> Column:
    """Without white space."""
    return F.translate(text, SPACES, "")


def _count_of(text: Column, marks: str) -> Column:
    return F.length(text) - F.length(F.translate(text, marks, ""))


def keeps_line(line: Column) -> Column:
    """True for a line that breaks none of the rules (lines without a word are never asked)."""
    last = F.right(F.rtrim(line, F.lit(SPACES)), F.lit(1))
    ends = F.contains(F.lit(TERMINAL), last)
    marks = F.length(F.regexp_replace(line, r"[\p{L}\p{M}\p{N}\x20\x09-\x0D]", ""))
    quiet = 100 * marks <= MARK_SHARE * F.length(_bare(line))
    seps = _count_of(line, NAV_MARKS)
    words = F.size(F.split(F.trim(line, F.lit(SPACES)), r"[\x20\x09-\x0D]+"))
    menu = (seps >= 2) & (NAV_WORDS * seps >= words)
    return ends & ~menu & quiet & ~F.lower(line).rlike("|".join(BOILERPLATE))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus one struct column (last) named by :func:`ledgerflow.llm.common.fresh` as ``lf_rules``.

    Its fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_removed_lines, lost_chars
    (longs), cleaned (the lines that stay, joined by ``\\n``), base_failed and kept. A null text counts as empty;
    a text without words has no lines, measures 0 and fails the base rules. Repeated rows are judged alike, an
    empty table gives an empty one, and no column of ``docs`` is touched, whatever its name.
    """
    out, own = fresh(docs, "lf_rules"), docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in own]).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = packed.select("row", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("w"), lines.alias("lines"))
    # hashes of the windows, in place order
    w = F.col("w")
    starts = F.slice("w", F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(0)))
    hashes = F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))
    df = df.select("row", "text", "w", "lines", hashes.alias("h"), F.filter("lines", keeps_line).alias("good"))
    # only documents with a recurring hash go on: windows sorted by hash, then place
    recurs = F.size(F.array_distinct("h")) < F.size("h")
    placed = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    df = df.select("row", "text", "w", "lines", "good", F.when(recurs, placed).alias("s"))

    def same(a: Column, b: Column) -> Column:
        equal = b["h"] == a["h"]
        for k in range(WINDOW):
            equal = equal & (F.get(w, a["at"] + k) == F.get(w, b["at"] + k))
        return F.coalesce(equal, F.lit(False))

    df = df.select("row", "text", "w", "lines", "good", "s", F.zip_with("s", F.slice("s", F.lit(2), F.size("s")), same).alias("eq"))
    either = F.zip_with("eq", F.concat(F.array(F.lit(False)), F.col("eq")), lambda x, y: x | y)  # equal to the next or to the one before
    at = F.sort_array(F.array_compact(F.zip_with("s", either, lambda a, hit: F.when(hit, a["at"]))))
    df = df.select("row", "text", "w", "lines", "good", at.alias("at"))
    gaps = F.zip_with("at", F.slice("at", F.lit(2), F.size("at")), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.coalesce(F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x), F.lit(0).cast("long"))
    df = df.select(
        "row",
        F.size("w").cast("long").alias("n_words"),
        F.length(_bare(F.col("text"))).cast("long").alias("word_chars"),
        _count_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("good")).cast("long").alias("n_removed_lines"),
        F.array_join("good", "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))
    df = df.select(
        "*", (F.col("word_chars") - F.length(_bare(F.col("cleaned")))).cast("long").alias("lost_chars"), failed.alias("base_failed")
    )
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= LOST_SHARE * F.col("word_chars"))
    fields = [c for c in df.columns if c not in ("row", "base_failed")]
    return df.select(*[F.col("row").getField(c).alias(c) for c in own], F.struct(*fields, "base_failed", kept.alias("kept")).alias(out))


def rule_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the fields of :func:`measured` (without the cleaned text), one row per row of ``docs``."""
    rows = measured(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    found = rows.columns[-1]
    names = [f.name for f in rows.schema[found].dataType.fields if f.name != "cleaned"]
    return rows.select("doc_id", *[F.col(f"{found}.{n}").alias(n) for n in names])


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with the columns of ``docs`` and failing lines removed from the text."""
    rows = measured(docs, text_col)
    found = rows.columns[-1]
    kept = rows.where(F.col(f"{found}.kept"))
    return kept.select(*[F.col(f"{found}.cleaned").alias(c) if c == text_col else kept[c] for c in docs.columns])

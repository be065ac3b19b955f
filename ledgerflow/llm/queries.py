"""The registered queries of this subpackage and their DuckDB oracles (where SQL can express them)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerflow.llm import (
    collocations, decontaminate, exact, langid, line_rules, ngram_join, periodic, pieces, pii, quality, sharding, substring_dedup, toxicity,
)

#: key of the demonstration query only; callers of the operator bring their own secret
PII_KEY = b"ledgerflow-demo"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).withColumn("n_found", F.size("found").cast("long"))


def op4_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents").select("doc_id"))


def op5_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    out = pieces.tokenize(_table(spark, sf_dir, "documents"), path, ids_as_text=True)
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.ngram_components(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


def _with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Of every tenth document (by hash of its id) the words from one place on repeat a stretch of its own words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", "text", words.alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w")
    rows = rows.select("doc_id", "text", "w", "g", n.alias("n"), F.when(n > 0, F.col("g") % n).alias("a"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    rows = rows.select("doc_id", "text", "w", "a", period.alias("p"))
    a, p = F.col("a"), F.col("p")
    again = F.transform("w", lambda x, i: F.when(i < a, x).otherwise(F.get("w", (a + (i - a) % p).cast("int"))))
    return rows.select("doc_id", F.when(p.isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_periodic_tails(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", "runs", "collapsed", best.alias("best"), F.array_join(lines, "").alias("lines"))
    length, period = -F.col("best.length"), F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(-1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_rules.rule_verdicts(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_removed_lines", "lost_chars",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_decontamination, op3_pii_pseudonyms, op4_shard_table, op5_toxicity_mil,
        op6_substring_dedup, op7_sentencepiece, op8_quality_ranking, op9_ngram_jaccard, op10_exact_dedup,
        op11_periodic_runs, op12_collocations, op13_line_rules,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLES = {
    "op10_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op2_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM win),
        occ AS (
            SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
        found AS (SELECT o.doc_id, o.i, o.n, win.item_id FROM occ o JOIN win ON o.n = win.n AND o.g = win.g),
        hits AS (
            SELECT doc_id, count(DISTINCT k) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
               sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)""",
}
_TERMINAL_SQL = line_rules.TERMINAL.replace("'", "''")
_LINE_OK = f"""
    contains('{_TERMINAL_SQL}', right(rtrim(x, e' \\t\\n\\x0b\\x0c\\r'), 1))
    AND 100 * length(regexp_replace(x, '[\\p{{L}}\\p{{M}}\\p{{N}}\\x20\\x09-\\x0D]', '', 'g')) <= {line_rules.MARK_SHARE} * length(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g'))
    AND NOT (length(x) - length(translate(x, '{line_rules.NAV_MARKS}', '')) >= 2
        AND {line_rules.NAV_WORDS} * (length(x) - length(translate(x, '{line_rules.NAV_MARKS}', ''))) >= len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')))
    AND NOT regexp_matches(lower(x), '{"|".join(line_rules.BOILERPLATE)}')"""
ORACLES["op13_line_rules"] = rf"""
        WITH d AS (
            SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(t, e'\n'), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
        g AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
        again AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        rep AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM again) GROUP BY doc_id),
        m AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
                   CAST(len(lines) AS BIGINT) AS n_lines, list_filter(lines, lambda x: {_LINE_OK}) AS good
            FROM d LEFT JOIN rep USING (doc_id)),
        v AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, CAST(n_lines - len(good) AS BIGINT) AS n_removed_lines,
                   word_chars - length(regexp_replace(array_to_string(good, ''), '[\x20\x09-\x0D]', '', 'g')) AS lost_chars FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND 100 * lost_chars <= {line_rules.LOST_SHARE} * word_chars AS kept, n_lines, n_removed_lines, lost_chars
        FROM v"""
ORACLES["op12_collocations"] = r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        q AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        size AS (SELECT unnest([1, 2, 3]) AS m),
        occ AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase FROM q, size WHERE len(w) >= m),
        f AS (SELECT lang, m, phrase, count(*) AS f FROM occ GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
        c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
        cut AS (SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM c),
        s AS (
            SELECT cut.lang, cut.m, cut.phrase, a, w, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1 : k], ' ')
                     JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[k + 1 :], ' ')
            QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, k) = 1),
        inner_ AS (
            SELECT lang, phrase, max(a) AS around
            FROM (SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase FROM c WHERE m = 3) GROUP BY ALL),
        kept AS (SELECT s.* FROM s LEFT JOIN inner_ i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.around IS NULL OR 100 * i.around < 50 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

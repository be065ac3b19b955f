"""Operators 11 to 13: brute force on small fixtures, DuckDB on whole tables, edge rows, clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import pytest
from test_llm_operators import EDGE, LOWER, SCHEMA, frame

import __spark_entry__ as E
from ledgerflow.llm import collocations, line_rules, periodic

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture()
def edge(spark, tmp_path):
    return frame(spark, tmp_path, EDGE)


@pytest.fixture()
def empty(spark, tmp_path):
    return frame(spark, tmp_path, [])


def oracle(name, sf=SF):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    res = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    return sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in res.fetchall()), key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ periodic runs
def brute_runs(words):
    """Every maximal stretch of every period, kept if no smaller period holds on it."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                part = words[i : i + length]
                if not any(all(part[x] == part[x + p] for x in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_brute_force(spark, tmp_path):
    rng = random.Random(3)
    texts = [None, "", " \n ", "a a a a a", "a a a a a a", "A a A a A a A a", "a b " * 4, "a a b " * 7 + "a", ("a b c d e " * 5 + "x ") * 5, "ab " * 300 + "ba " * 300]
    for _ in range(300):
        words = []
        while len(words) < rng.randrange(1, 90):
            part = [rng.choice("abc") for _ in range(rng.randrange(1, 7))]
            words += part * rng.randrange(1, 9)
        texts.append(rng.choice([" ", "\n", " \t "]).join(words))
    big = [f"w{i}" for i in range(3000)]
    texts += [" ".join(big * 4 + big[:17]), " ".join(big * 4)[:-5], " ".join((big[:700] + ["z"] * 9) * 4)]
    docs = frame(spark, tmp_path, list(enumerate(texts)))
    got = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        runs = brute_runs(words) if len(words) < 2000 else None
        found = [tuple(r) for r in got[i].runs]
        if runs is not None:
            assert found == runs, t
        assert got[i].n_words == len(words) and got[i].collapsed == brute_collapsed(words, found)
    assert [tuple(r) for r in got[len(texts) - 3].runs] == [(0, 12017, 3000)]
    assert (0, 2836, 709) in [tuple(r) for r in got[len(texts) - 1].runs]


def test_runs_query_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in E.queries()["op11_periodic_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    changed = 0
    for d, text in docs.items():
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(d).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        if n > 500:
            continue  # cubic above; longer ones are covered by the cases of the test before
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[d]
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert changed and any(r.n_runs for r in got.values())


# ------------------------------------------------------------------ collocations
def brute_collocations(rows, longest, least, share, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = collections.Counter()
        for p, a in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        best = []
        for p, a in cands.items():
            if inside[p] and 100 * inside[p] >= share * a:
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_brute_force(spark, longest):
    rng = random.Random(longest)
    passages = [" ".join(rng.choice(["The", "of", "é", "new", "york", "x1", "#"]) for _ in range(40)) for _ in range(4)]
    rows = [(None, None), ("en", ""), ("en", " . ,"), ("en", "the the the the"), ("de", "one two"), (None, "New  York\tcity. " * 30)]
    for _ in range(200):
        words = [rng.choice(["The", "of", "new", "york", "a", "bb", "É", "é", "z" * rng.randrange(1, 4), ",", ". And", "of\nthe"]) for _ in range(rng.randrange(0, 60))]
        rows.append((rng.choice(["en", "de", None]), " ".join([*words, rng.choice(passages)])))
    docs = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, freq long, chunk string").repartition(5)
    got = sorted(tuple(r) for r in collocations.collocations(docs, longest=longest, least=5, top=50, trigger=4).collect())
    assert got == brute_collocations(rows, longest, 5, 50, 50) and len(got) > 20


def test_phrase_parsing_counts_each_place_once(spark):
    text = "one two three four five six seven " * 400
    docs = spark.createDataFrame([("en", text)] * 7, "lang string, text string").repartition(3)
    parsed = collocations.parse(docs, 3, 4).collect()
    owned = sum((len(r.chunk.split()) - (0 if r.tail else 2)) * r.freq for r in parsed)
    assert owned == 7 * 2800 and len(parsed) < 40  # equal passages are cut alike


def test_quotient_is_exact(spark):
    cases = [(10**14 + 7, 10**14 + 9, 10**14 + 8), (999_999_999_999, 10**12, 10**12 + 1), (3, 7, 11)]
    df = spark.createDataFrame(cases, "a long, l long, r long").selectExpr(*[f"cast({c} as decimal(18,0)) {c}" for c in "alr"])
    got = {int(r.a): r.q for r in df.withColumn("q", collocations._quotient(df.a, df.l, df.r)).collect()}
    assert got == {a: 1000000 * a * a // (x * y) for a, x, y in cases}


def test_collocations_match_sql(spark):
    assert rows_of(E.queries()["op12_collocations"](spark, SF)) == oracle("op12_collocations")


# ------------------------------------------------------------------ line rules
def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = collections.defaultdict(list)
    for i in range(len(words) - 4):
        grams[tuple(words[i : i + 5])].append(i)
    again = {k for at in grams.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    chars = sum(map(len, words))
    return len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), len(words) < 10 or 100 * len(again) > 20 * len(words)


GOOD = "A plain sentence of some words stands here and it ends as it should end."
MENU = "Home | About | News | Sport | Contact."


def test_rules_brute_force_and_verdicts(spark, tmp_path, edge, empty):
    assert line_rules.rule_verdicts(empty).count() == 0 and line_rules.clean(empty).count() == 0
    texts = [
        GOOD, f"{GOOD}\n{MENU}", f"{MENU}\n{MENU}\n{GOOD}", "no mark at the end of this line of a dozen words or so\n" * 2, f"{GOOD}\nAll rights reserved.",
        "x y z a b " * 3, GOOD + "\r\n" + GOOD + "\r\n", "SO!! MANY!! MARKS!! IN!! ONE!! LINE!! THAT!! IT!! IS!! NO!! TEXT!!", "a\x0bb\x0cc " * 9, "\n\n", "ü 😀 é. " * 5,
        " ".join(f"w{i % 37}" for i in range(900)) + ".",
    ]
    docs = frame(spark, tmp_path, list(enumerate(texts)))
    got = {r.doc_id: r for r in line_rules.rule_verdicts(docs).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words, got[i].base_failed) == brute_rules(t)
    assert sorted(i for i in got if got[i].kept) == [0, 1, 4]
    kept = {r.doc_id: r for r in line_rules.clean(docs).collect()}
    assert line_rules.clean(docs).columns == docs.columns and {i: r.text for i, r in kept.items()} == {0: GOOD, 1: GOOD, 4: GOOD}
    rows = line_rules.rule_verdicts(edge).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(d for d, _ in EDGE)
    assert all(not r.kept and r.base_failed and r.n_words == 0 for r in rows if r.doc_id in (1, 2, 3))


def test_rules_match_sql_and_stay_native(spark):
    df = E.queries()["op13_line_rules"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert rows_of(df) == oracle("op13_line_rules")


def test_edge_rows(spark, edge, empty):
    for docs, n in ((edge, len(EDGE)), (empty, 0)):
        assert periodic.periodic_runs(docs).count() == n
        assert periodic.collapse_runs(docs).columns == docs.columns and periodic.collapse_runs(docs).count() == n
        assert periodic.with_runs(docs).schema.fields[: len(docs.columns)] == docs.schema.fields
    assert collocations.collocations(empty).count() == 0
    assert {r.lang for r in collocations.collocations(edge, least=2).collect()} == {"en"}
    none = spark.createDataFrame([], SCHEMA)
    assert line_rules.clean(none).count() == 0

"""Block rows of few sets are paired in one pass; only larger ones are carried through the turns."""

import random

import pytest

from ledgerflow.llm import ngram_join


def _texts():
    rng = random.Random(5)
    out = []
    for copies in (2, 3, 12, 40):  # families of near copies: rows of few and of many sets
        words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        for _ in range(copies):
            own = list(words)
            for _ in range(rng.randrange(1, 4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(own))
    out += [out[0], out[7], "one two", None, None, " ", " ".join(f"a{i}" for i in range(80))]  # copies, short, empty, alone
    return out


def _brute(texts, n, percent):
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in range(len(texts))}


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_small_rows_are_not_carried(spark, tmp_path, monkeypatch, n, percent):
    texts = _texts()
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    seen, plain = {}, ngram_join.stored

    def watched(df, name):
        out = plain(df, name)
        if name == "ngram-held":
            seen["least"] = min((r["count"] for r in out.groupBy("row").count().collect()), default=None)
            seen["rows"] = out.count()
        seen[name] = seen.get(name, 0) + 1
        return out

    monkeypatch.setattr(ngram_join, "stored", watched)
    found = ngram_join.ngram_components(spark.read.parquet(str(tmp_path / "docs")), n, percent)
    assert {r.doc_id: r.component_id for r in found.collect()} == _brute(texts, n, percent)
    assert seen["rows"] and seen["least"] > 6  # before, each shared block row was stored with a parity vector, and again each turn
    assert seen["ngram-shared"] == 4  # one hash range at a time

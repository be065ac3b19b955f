"""Operators of ledgerflow.llm: brute force on small fixtures, edge cases, round trips, held-out accuracy."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import bloom, components, decontaminate, exact, langid, ngram_join, pieces, pii, quality, sharding, substring_dedup, toxicity
from ledgerflow.llm.common import chunks

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, score double, rid long, lf_rid long, slot int, found string, n_words long"


def frame(spark, tmp_path, rows):
    """A stored documents table whose extra columns clash with names the operators use."""
    path = str(tmp_path / f"docs-{random.random()}")
    full = [(i, t, "en", "s", 0.5, 7, 8, 9, "f", 1) for i, t in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


LONG = " ".join(f"word{i % 977} filler{i}" for i in range(20_000))
EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "Same text here ok"), (5, "Same  text\there ok"), (5, "Same  text\there ok"), (None, "Same text here ok"), (None, None), (6, LONG), (7, LONG + " end"), (8, "ééé 😀 \x00 ok"), (9, "ééé 😀 \x00 ok")]


@pytest.fixture()
def edge(spark, tmp_path):
    return frame(spark, tmp_path, EDGE)


@pytest.fixture()
def empty(spark, tmp_path):
    return frame(spark, tmp_path, [])


@pytest.fixture()
def bench(spark):
    return spark.createDataFrame([(1, "word1 filler1 word2 filler2"), (1, "word1 filler1 word2 filler2"), (2, None), (3, "--"), (None, "same text")], "item_id long, text string")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_edge_rows_and_empty_tables(spark, edge, empty, bench):
    path = model_path()
    no = labels(spark)
    for docs, n in ((edge, len(EDGE)), (empty, 0)):
        assert exact.exact_groups(docs).count() == n
        assert langid.language(docs).count() == n
        assert decontaminate.contamination(docs, bench).count() == n
        assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
        assert pii.pseudonymise(docs, b"k").count() == n
        assert sharding.place(docs).count() == n
        assert toxicity.toxicity(docs, no).where("score between 0 and 1").count() == n
        assert quality.quality(docs, no).where("score between 0 and 1").count() == n
        assert substring_dedup.remove_repeats(docs).count() == n
        assert pieces.tokenize(docs, path).count() == n
        assert ngram_join.ngram_components(docs).count() == n
        for kept in (exact.drop_copies(docs), ngram_join.drop_near_copies(docs), decontaminate.drop_contaminated(docs, bench), decontaminate.cut_spans(docs, bench)):
            assert kept.columns == docs.columns and kept.count() <= n


def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# --- exact dedup -----------------------------------------------------------------------------------------


def test_exact_groups_ties_and_nulls(edge):
    got = collections.Counter(tuple(r)[:4] for r in exact.exact_groups(edge).collect())
    by = {k: v for k, v in got.items() if k[1] == 4}
    assert by == {(4, 4, 4, True): 1, (5, 4, 4, False): 2, (None, 4, 4, False): 1}
    assert got[(3, 3, 1, True)] == 1  # white space alone is one space, not empty


def test_exact_null_text_equals_empty(edge):
    rows = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(edge).collect() if r.text_sha256 == hashlib.sha256(b"").hexdigest()}
    assert rows == {(1, 1, 3, True), (2, 1, 3, False), (None, 1, 3, False)}


def test_one_of_tied_rows_stays(edge):
    kept = exact.drop_copies(edge).select("doc_id", "text").collect()
    texts = [re.sub("[ \t\n]+", " ", r.text or "") for r in kept]
    assert len(texts) == len(set(texts)) == len({re.sub("[ \t\n]+", " ", t or "") for _, t in EDGE})


def test_small_filter_gives_same_groups(spark):
    keys = spark.range(5000).select((F.col("id") % 3000).alias("k"))
    tight = bloom.repeat_filter(keys.select(F.xxhash64("k")), cells_per_row=1, max_cells=1 << 16)
    missed = keys.where(~tight(F.xxhash64("k"))).groupBy("k").count().where("count > 1")
    assert missed.count() == 0 and keys.where("k >= 2000").distinct().where(~tight(F.xxhash64("k"))).count() > 0


def test_member_filter_has_no_false_negative(spark):
    keys = spark.range(0, 20000, 7)
    test = bloom.member_filter(keys)
    found = spark.range(20000).where(test("id"))
    assert keys.join(found, "id", "left_anti").count() == 0 and found.count() < 20000 // 7 * 1.2


# --- components ------------------------------------------------------------------------------------------


def test_components_against_union_find(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)]
    parent = list(range(600))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


# --- decontamination -------------------------------------------------------------------------------------


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(docs, items, width):
    wins = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - width + 1, 1) if w else 0):
            wins[tuple(w[i : i + width])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in own if x is not None}
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_contamination_brute_force(spark, tmp_path, block):
    draw = random.Random(4)
    text = lambda n: " ".join(draw.choice("ab cd ef gh A-b é9 zz".split()) for _ in range(n))
    items = [(i if i else None, text(draw.choice([0, 1, 2, 4, 6, 7]))) for i in range(40)]
    rows = [(i, text(draw.randrange(60))) for i in range(80)] + [(90, None), (91, "x " + text(3000))]
    docs = frame(spark, tmp_path, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(docs, bench, 4, block).collect()), key=repr)
    assert got == brute_contamination(rows, items, 4)


def test_fm_index_counts_and_locates():
    draw = np.random.default_rng(3)
    runs = draw.integers(0, 4, 3000)
    runs[-1] = 0
    starts = np.concatenate([[0], np.flatnonzero(runs == 0)[:-1] + 1])
    index = decontaminate.FmIndex.build(runs, starts, 3)
    text = "".join(map(str, runs))
    for _ in range(60):
        n = int(draw.integers(1, 7))
        phrase = draw.integers(1, 4, n)
        lo, hi = index.search(phrase[None, :], np.array([n]))
        want = [m.start() for m in re.finditer(f"(?={''.join(map(str, phrase))})", text)]
        assert sorted(index.locate(np.arange(lo[0], hi[0]))) == want


def test_cut_spans(spark, tmp_path):
    docs = frame(spark, tmp_path, [(1, "é One two THREE four, rest"), (2, None), (3, "clean")])
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.cut_spans(docs, bench).collect()}
    assert got == {1: "é , rest", 2: None, 3: "clean"}


# --- n-gram join -----------------------------------------------------------------------------------------


def brute_components(rows, percent, n=3):
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[doc] = frozenset(zip(*(w[i:] for i in range(n)))) if len(w) >= n else frozenset([tuple(w)] if w else [])
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("percent", [90, 80])
def test_ngram_components_brute_force(spark, tmp_path, percent):
    draw = random.Random(9)
    rows = []
    for family in range(14):  # families of drifting copies, so components are chains rather than stars
        size = draw.choice([9, 10, 11, 12, 20, 31, 60, 150])
        base = [f"w{family}x{i}" for i in range(size)]
        for _ in range(10):
            rows.append((len(rows), " ".join(base)))
            k = draw.randrange(3)
            for _ in range(k):
                if draw.random() < 0.5:
                    base[draw.choice([0, -1])] = f"new{draw.randrange(10**6)}"
                else:
                    base.append(f"tail{draw.randrange(10**6)}")
    rows += [(500, "one two"), (501, "One  TWO"), (502, "one two three"), (503, None), (504, ""), (505, " \n")]
    draw.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(frame(spark, tmp_path, rows), percent=percent).collect()}
    assert got == brute_components(rows, percent)


def test_one_large_family_of_scattered_edits(spark, tmp_path):
    """Members are near some others only, so the hub alone links few and the turns and the last pass decide."""
    draw = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(draw.randrange(6)):
            own[draw.randrange(150)] = f"e{draw.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(frame(spark, tmp_path, rows)).collect()}
    assert got == brute_components(rows, 90) and 1 < len({c for _, c in got.values()}) < 150


def test_near_copies_keep_smallest(spark, tmp_path):
    base = [f"w{i}" for i in range(100)]
    rows = [(5, " ".join(base)), (3, " ".join(base + ["x"])), (9, " ".join(["y"] + base)), (None, " ".join(base)), (4, "other text is here"), (8, None), (2, "")]
    kept = ngram_join.drop_near_copies(frame(spark, tmp_path, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 8]


def test_empty_block_rows_are_paired():
    classes = ngram_join.SizeClasses(90)
    draw = np.random.default_rng(1)
    for _ in range(300):
        n = int(draw.integers(9, 60))
        a = draw.integers(0, 1 << 63, n).astype(np.uint64)
        b = a.copy()
        for _ in range(int(draw.integers(0, n * 10 // 100 + 1))):
            b = np.delete(b, draw.integers(0, len(b))) if draw.random() < 0.5 else np.append(b, draw.integers(0, 1 << 63, 1).astype(np.uint64))
        a, b = np.unique(a), np.unique(b)
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 90 * (len(a) + len(b) - shared) and len(a) + len(b) != 2 * shared:
            assert ngram_join.overlaps(a, b, 90)
            assert len(np.intersect1d(ngram_join.block_rows(a, classes), ngram_join.block_rows(b, classes)))


# --- repeated substrings ---------------------------------------------------------------------------------


def brute_repeats(rows, length):
    count = collections.Counter()
    raws = [(d, (t or "").encode()) for d, t in rows]
    for _, raw in raws:
        count.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for d, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if count[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group_max", [512, 1, 0])
def test_repeats_brute_force(spark, tmp_path, group_max):
    draw = random.Random(6)
    text = lambda n: "".join(draw.choice("abcdé ") for _ in range(n))
    passages = [text(draw.choice([30, 41, 45, 60, 120])) for _ in range(6)]
    rows = [(i, text(draw.randrange(50)) + draw.choice(passages)[draw.randrange(12) :] + text(draw.randrange(40)) + draw.choice([*passages, ""])) for i in range(60)]
    rows += [(70, "ab" * 100), (71, "x" * 90), (72, None), (73, ""), (74, rows[3][1]), (75, rows[3][1])]
    got = substring_dedup.remove_repeats(frame(spark, tmp_path, rows), 40, group_max)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()), key=repr) == brute_repeats(rows, 40)


def test_index_family_over_many_batches():
    draw = random.Random(8)
    base = bytes(draw.randrange(97, 100) for _ in range(300))
    runs = []
    for _ in range(200):
        at = draw.randrange(200)
        n = draw.randrange(1, 30)
        own = bytearray(base[at : at + n - 1 + 24])
        if draw.random() < 0.7:
            own[draw.randrange(len(own))] = draw.randrange(97, 123)
        runs.append((bytes(own), n))
    count = collections.Counter(t[i : i + 24] for t, n in runs for i in range(n))
    got = substring_dedup.family_matches(runs, 24, batch_windows=40)
    assert [g.tolist() for g in got] == [[i for i in range(n) if count[t[i : i + 24]] > 1] for t, n in runs]


def test_levels_grow_geometrically():
    draw = random.Random(9)
    family, added = substring_dedup.IndexFamily(24), 0
    for _ in range(130):
        text = np.frombuffer(bytes(draw.randrange(97, 123) for _ in range(63)), np.uint8)
        family.add(text, np.arange(40))
        added += 1
        sizes = [len(level.starts) for level in family.levels]
        assert sum(sizes) == 40 * added and len(sizes) <= added.bit_length()
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
    assert not len(family.matched())


@pytest.mark.parametrize("sizes", [(0, 5), (5, 0), (1, 300), (300, 300)])
def test_merge_scan_against_sorted_lists(sizes):
    draw = random.Random(sum(sizes))
    level = []
    for n in sizes:
        text = np.frombuffer(bytes(draw.choice(b"ab\x00") for _ in range(n + 27)), np.uint8)
        level.append(substring_dedup.sorted_level(text, np.arange(n), 28))
    own = [[lv.text[p : p + 28].tobytes() for p in lv.starts] for lv in level]
    assert [sorted(o) for o in own] == own
    place, in_a, in_b = substring_dedup.merge_scan(*level, 28)
    assert place.tolist() == [sum(x < y for x in own[0]) for y in own[1]]
    assert in_a.tolist() == [y in own[0] for y in own[1]] and in_b.tolist() == [x in own[1] for x in own[0]]


def test_nothing_is_removed_without_the_family(spark, tmp_path, monkeypatch):
    rows = [(i, "abcdefghij" * 9) for i in range(4)] + [(9, "zabcdefghij" * 9)]
    docs = frame(spark, tmp_path, rows)
    assert substring_dedup.remove_repeats(docs, 40).where("n_removed > 0").count() == 5
    monkeypatch.setattr(substring_dedup, "_by_family", lambda texts, length: spark.createDataFrame([], substring_dedup._FOUND))
    for group_max in (512, 1):
        assert substring_dedup.remove_repeats(docs, 40, group_max).where("n_removed > 0").count() == 0


def test_hot_gram_is_split(spark, tmp_path):
    """One passage just short of the length, with other bytes around it in every document, and one pair that matches."""
    draw = random.Random(12)
    text = lambda n: "".join(draw.choice("abcd") for _ in range(n))
    core = text(37)
    rows = [(i, text(30) + core + text(30)) for i in range(120)]
    rows.append((200, rows[7][1][20:75]))
    got = substring_dedup.remove_repeats(frame(spark, tmp_path, rows), 40, 8)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()), key=repr) == brute_repeats(rows, 40)


# --- tokens ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("as_text", [True, False])
def test_tokens_equal_the_library(spark, tmp_path, as_text):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    draw = random.Random(7)
    known = [lib.id_to_piece(i).replace("▁", " ") for i in range(300, 32000, 7)]
    odd = list("abc \n\t\r\x00\x01  ▁éßñжи中文😀𝔘.,!?|#$$012") + ["\n\n", "   ", " \n", "|", "xyzxyz" * 60]
    rows = [(i, "".join(draw.choice(known) if draw.random() < 0.7 else draw.choice(odd) for _ in range(draw.randrange(30)))) for i in range(1500)]
    rows += [(9001, None), (9002, ""), (9003, " "), (9004, "\n"), (9005, "▁"), (9006, "a" * 5000)]
    got = pieces.tokenize(frame(spark, tmp_path, rows), model_path(), as_text)
    seen = {r.doc_id: (r.n_tokens, r.ids if not as_text else [int(i) for i in r.ids.split(" ")], r.decoded) for r in got.collect()}
    for doc, text in rows:
        ids = [*lib.encode(text or ""), lib.eos_id()]
        assert seen[doc] == (len(ids), ids, lib.decode(ids)), repr(text)


# --- personal data ---------------------------------------------------------------------------------------


def test_feistel_is_a_permutation():
    f = pii.Feistel(b"k")
    for size in (2, 7, 100, 361):
        image = [f.permute("t", x, size) for x in range(size)]
        assert sorted(image) == list(range(size))
        assert [f.permute("t", y, size, back=True) for y in image] == list(range(size))
    even = [x for x in range(100) if x % 2 == 0]
    assert sorted(f.permute("e", x, 100, lambda v: v % 2 == 0) for x in even) == even


TEXT = (
    "card 4117640103996265 and 4117-6401-0399-6265, bad 4117640103996266; +1 (547) 555-0128; 547-555-0128; "
    "ip 37.140.120.103 not 300.1.2.3 or 1.2.3.4.5; ssn 123-45-6789 not 000-12-3456; 2024-02-29 not 2023-02-29; "
    "29.02.2024; 31/12/1999 and 12/31/1999; DE89 3704 0044 0532 0130 00 bad DE88370400440532013000; x.y9@mail0.example.com, v1.2.3"
)


def test_pseudonyms_keep_format_link_and_invert():
    new, found = pii.Pseudonyms(b"secret").replace(TEXT)
    assert [k for k, _, _ in found] == ["card", "card", "phone", "phone", "ipv4", "ssn", "date", "date", "date", "date", "iban", "email"]
    parts = [new[a:b] for _, a, b in found]
    for bad in ("4117640103996266", "300.1.2.3", "1.2.3.4.5", "000-12-3456", "2023-02-29", "DE88370400440532013000", "v1.2.3"):
        assert bad in new
    for old in ("4117640103996265", "547", "37.140.120.103", "123-45-6789", "2024-02-29", "0532 0130", "x.y9@"):
        assert not any(old in p for p in parts)
    assert parts[0] == parts[1].replace("-", "") and pii.luhn_digit(parts[0][:-1]) == parts[0][-1]
    assert re.sub(r"\D", "", parts[2])[1:] == re.sub(r"\D", "", parts[3]) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", parts[2])
    y, m, d = parts[6].split("-")
    assert parts[7] == f"{d}.{m}.{y}"
    assert pii.Pseudonyms(b"secret", back=True).replace(new)[0] == TEXT
    assert pii.Pseudonyms(b"other").replace(TEXT)[0] != new


def test_phone_of_any_area_code():
    olds = ["+1 (017) 555-7713", "+1 (132) 555-1352", "(136) 555-7479", "+1 (547) 055-0128", "+1-017-555-7713", "+10175557713"]
    text = "; ".join([*olds, "017-555-7713"])  # the last has no mark of a phone number
    new, found = pii.Pseudonyms(b"secret").replace(text)
    parts = [new[a:b] for _, a, b in found]
    assert [k for k, _, _ in found] == ["phone"] * len(olds) and not any(old in new for old in olds[:4])
    assert [re.sub("[0-9]", "9", p) for p in parts] == [re.sub("[0-9]", "9", o) for o in olds] and new.endswith("; 017-555-7713")
    assert len({re.sub(r"\D", "", parts[i])[1:] for i in (0, 4, 5)}) == 1
    assert pii.Pseudonyms(b"secret", back=True).replace(new)[0] == text


def test_pseudonymise_frame(spark, tmp_path):
    docs = frame(spark, tmp_path, [(1, TEXT), (2, None), (3, "nothing here"), (4, "again 4117640103996265")])
    out = {r.doc_id: r for r in pii.pseudonymise(docs, b"secret").collect()}
    assert out[2].text is None and out[2].found_ == [] and out[3].text == "nothing here"
    span = out[4].found_[0]
    assert out[4].text[span.start : span.end] in out[1].text and out[4].found == "f"


# --- sharding --------------------------------------------------------------------------------------------


def test_table_is_filled_by_turns():
    names, size = sharding.shard_names(5), 101
    prefs = []
    for name in names:
        offset, step = sharding._number(name, "offset") % size, sharding._number(name, "step") % (size - 1) + 1
        prefs.append([(offset + j * step) % size for j in range(size)])
        assert sorted(prefs[-1]) == list(range(size))
    want = [-1] * size
    turn = 0
    while -1 in want:
        slot = next(s for s in prefs[turn % 5] if want[s] < 0)
        want[slot] = turn % 5
        turn += 1
    assert sharding.fill_table(names, size) == want
    with pytest.raises(ValueError):
        sharding.fill_table(names, 100)


def test_shares_and_disruption():
    a = sharding.fill_table(sharding.shard_names(64))
    share = np.bincount(a)
    assert share.max() - share.min() <= 1
    b = sharding.fill_table(sharding.shard_names(63))
    assert np.mean(np.array(a) != np.array(b)) < 0.12


def test_place_against_table(spark, edge, tmp_path):
    table = sharding.fill_table(sharding.shard_names(64))
    placed = sharding.place(edge.select("doc_id", "slot"))
    assert placed.columns == ["doc_id", "slot", "slot_", "shard", "shard_name"]
    for r in placed.withColumn("h", F.xxhash64("doc_id")).collect():
        assert r.slot_ == r.h % 65537 and r.shard == table[r.slot_] and r.shard_name == f"shard-{r.shard:05d}"
    sharding.write_shards(edge, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(EDGE)


# --- learnt operators ------------------------------------------------------------------------------------


def crc(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


BIG = "/root/testdata/sf0.1"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    rows = langid.language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    sure = [r for r in held if r.accepted]
    assert np.mean([r.lang_pred == r.lang for r in sure]) > 0.98 and len(sure) > 0.5 * len(held)


def test_language_und(spark, edge):
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.language(edge).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[6][0] == "en"


def test_toxicity_held_out_and_located(spark):
    docs, lab = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    rows = toxicity.toxicity(docs, lab).join(lab.where("toxic is not null"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted for r in held if r.toxic == 1]) > 0.75
    assert np.mean([r.predicted for r in held if r.toxic == 0]) < 0.02
    model = toxicity.train([("good morning. you are a foul thing", 1), ("good morning. you are kind", 0)] * 40)
    spans = toxicity.offending(spark.createDataFrame([(1, "Good morning. You are a foul thing!"), (2, None)], "doc_id long, text string"), model).collect()
    assert [(r.doc_id, r.start, r.end) for r in spans] == [(1, 14, 34)]


def test_quality_held_out(spark):
    docs, lab = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    rows = quality.quality(docs, lab).join(lab.where("quality is not null"), "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_quality_learns_from_all_labelled_rows(spark):
    """One text of 140,000 characters and more rows than a group has: mean and cut are those of all of them."""
    texts = ["A plain line of words, number %d." % i if i % 3 else "BUY NOW!!! $$$ %d" % i for i in range(240)] + ["Long and plain. " * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(len(texts))], "doc_id long, quality int")
    table = quality.measured(docs)
    model = quality.train_on(table, lab, 40)
    used = [t for i, t in enumerate(texts) if crc(i, 5) != 0]
    x = np.concatenate([quality.features(c) for c in chunks(pa.array(used, pa.large_string()))])
    assert any(len(t) > 65_536 for t in used) and np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.maximum(x.std(axis=0), 1e-3))
    right = quality.quality(docs.where("doc_id < 240"), lab, 40).join(lab, "doc_id").where("predicted = quality").count()
    assert right > 235
    worth = np.sort(model.worth(x))
    bad = sum(i % 3 == 0 for i in range(len(texts)) if crc(i, 5) != 0)
    assert worth[bad - 1] <= model.cut <= worth[bad]


def test_scores_do_not_use_other_columns(spark, tmp_path):
    docs, lab = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train_on(docs, lab)
    a = toxicity.with_score(docs.select("doc_id", "text"), model, "s")
    b = toxicity.with_score(docs.select("doc_id", "text", F.lit("zz").alias("lang")), model, "s")
    assert {tuple(r) for r in a.select("doc_id", "s").collect()} == {tuple(r) for r in b.select("doc_id", "s").collect()}


def test_mil_is_noisy_or():
    model = toxicity.train([("bad word here. fine", 1), ("fine. all fine", 0)] * 40)
    from ledgerflow.llm.common import chunks

    one = [model.score(c) for c in chunks(pa.array(["bad word here", "bad word here. bad word here", "", "!!!"], pa.large_string()))][0]
    assert one[1] == pytest.approx(1 - (1 - one[0]) ** 2) and one[2] == one[3] == 0


def test_length_alone_is_not_toxic():
    model = toxicity.train([("bad word here. fine", 1), ("fine. all fine", 0)] * 40)
    from ledgerflow.llm.common import chunks

    clean = "Fine. All fine. Other words! " * 3334
    clean_score, hidden = [model.score(c)[0] for t in (clean, clean + "Bad word here.") for c in chunks(pa.array([t], pa.large_string()))]
    assert clean_score < toxicity.THRESHOLD <= hidden
    constant = toxicity.train([("bad", 1), ("fine", 1)])
    assert constant.score(next(chunks(pa.array(["any text"], pa.large_string()))))[0] >= toxicity.THRESHOLD


@pytest.mark.parametrize("percent", [80, 90])
def test_parity_never_discards_a_near_pair(percent):
    rng = np.random.default_rng(percent)
    kept = 0
    for n in (1, 2, 9, 60, 511, 513, 1500, 5000):
        for _ in range(20):
            base = rng.integers(0, 2**64, n, dtype=np.uint64)
            other = np.unique(np.concatenate([base[rng.random(n) < rng.uniform(0.7, 1)], rng.integers(0, 2**64, int(n * rng.uniform(0, 0.2)), dtype=np.uint64)]))
            base = np.unique(base)
            allows = ngram_join.parity_allows(ngram_join.parity(base), len(base), ngram_join.parity(other), len(other), percent)
            near = ngram_join.overlaps(base, other, percent)
            assert allows or not near
            kept += near
        far = rng.integers(0, 2**64, n, dtype=np.uint64)
        if n >= 60:  # sets with nothing in common are told apart, however many n-grams they have
            assert not ngram_join.parity_allows(ngram_join.parity(base), len(base), ngram_join.parity(np.unique(far)), n, percent)
    assert kept > 10

"""Operator 9: n-gram Jaccard join as a blocked sparse matrix product.

Documents are the rows and distinct word n-grams the columns of a 0/1 matrix A; the join wants the
entries of A A' that reach the similarity. The product is never formed whole:

* *Row blocks* are size classes; only neighbouring classes can hold a qualifying pair.
* *Column blocks* are hash ranges of the n-grams. Two sets of similarity s or more, the smaller of size
  n, differ in at most ``H = n (1 - s) / s`` n-grams, so over ``H + 1`` column blocks at least one block
  row is the same in both. A pair enters the product only where one block row agrees; every other pair
  is below the size-derived bound and is discarded unseen. Equal block rows are met by their digest;
  an empty block row (rare) is paired with all one-deletion variants of the next block, which keeps the
  bound exact without a bucket of unrelated documents.
* Each set also has a parity vector: one bit per hash value modulo ``PARITY_BITS``, flipped by each n-gram.
  Two vectors differ in at most as many bits as the sets differ in n-grams, so a pair whose vectors differ
  in more bits than its sizes allow is discarded before its rows are fetched. A vector this short fills up with
  long texts, so pairs that pass are held against vectors of at least as many bits as the set has n-grams.
* For a surviving pair overlap counts accumulate column block by column block; the pair is discarded as
  soon as the n-grams missed exceed what its two sizes allow.

Equal sets are one row from the start. Block rows that few documents share are paired in one pass, parity vectors
travel on with larger ones only. Documents are tried with few others of a shared block row first;
once components are known, only pairs across components are tried, so a large group of copies costs a
few links each, and no link between different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.bloom import member_filter, numbered, remove_rows, take_rows
from ledgerflow.llm.common import Chunk, byte_class, chunks, discard, lean, mix64, ship, stored, text_column, words_of
from ledgerflow.llm.components import components

NGRAM = 3
PERCENT = 90
VERIFY_BLOCKS = 8
PARITY_BITS = 512
#: shared block rows are found in so many turns, one hash range each: a turn's shuffle files go before the next one's come
TURNS = 4
#: of a block row with so many sets at most, all pairs are known from the first pass over it
SMALL = 6

_WORD = ~byte_class((9, 13), (32, 32))


def ngram_sets(chunk: Chunk, n: int = NGRAM) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes per document; fewer words are one n-gram, no words none."""
    words = words_of(chunk, _WORD)
    h, out = words.hash, []
    gram = np.zeros(len(h), np.uint64)
    size = max(len(h) - n + 1, 0)
    with np.errstate(over="ignore"):
        key = np.full(size, n, np.uint64)
        for i in range(n):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + h[i : i + size])
        gram[:size] = key
        for d in range(chunk.n):
            a, b = int(words.first[d]), int(words.first[d + 1])
            if b - a >= n:
                out.append(np.unique(gram[a : b - n + 1]))
            elif b > a:
                short = np.full(1, b - a, np.uint64)
                for i in range(a, b):
                    short = mix64(short * np.uint64(0x9E3779B97F4A7C15) + h[i : i + 1])
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


class SizeClasses:
    """Size classes so narrow that a qualifying pair lies in one class or two neighbouring ones."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lower = [1]

    def _grow(self, n: int) -> None:
        while self.lower[-1] <= n:
            low = self.lower[-1]
            self.lower.append(max(low + 1, low * 100 // self.percent))

    def of(self, n: int) -> int:
        self._grow(n)
        return int(np.searchsorted(self.lower, n, side="right")) - 1

    def blocks(self, k: int) -> int:
        """Column blocks of class ``k``: one more than the n-grams two of its sets may differ in."""
        self._grow(self.lower[k])
        largest = self.lower[k + 1] - 1
        return largest * (100 - self.percent) // self.percent + 1


def block_rows(grams: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """Digests of a set's block rows, in its own size class and the next smaller one."""
    n, out = len(grams), []
    if not n:
        return np.zeros(0, np.int64)
    mixed = mix64(grams ^ np.uint64(0xA0761D6478BD642F))
    own = classes.of(n)
    with np.errstate(over="ignore"):
        for k in (own, own - 1):
            if k < 0:
                continue
            parts = classes.blocks(k)
            if parts == 1:
                continue  # only equal sets qualify, and those are one row already
            part = ((grams >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            edge = np.searchsorted(part, np.arange(parts + 1))  # grams are sorted, so blocks are ranges
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
            sums, size = total[edge[1:]] - total[edge[:-1]], np.diff(edge)
            label = mix64(np.arange(parts, dtype=np.uint64) + np.uint64(k << 32))
            full = size > 0
            out.append(mix64(sums[full] + label[full]) ^ label[full])
            for p in np.flatnonzero(~full):
                q = (p + 1) % parts
                variants = np.append(sums[q] - mixed[edge[q] : edge[q + 1]], sums[q])
                out.append(mix64(variants + label[p] * np.uint64(3)) ^ label[q])
    return np.unique(np.concatenate(out)).view(np.int64) if out else np.zeros(0, np.int64)


def parity(grams: np.ndarray) -> np.ndarray:
    """Bit vector of the n-grams' count modulo 2 per hash value modulo a power of two that is no less than their
    number (nor than ``PARITY_BITS``), as bytes."""
    bits = max(PARITY_BITS, 1 << max(len(grams) - 1, 0).bit_length())
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def folded(vector: np.ndarray, size: int) -> np.ndarray:
    """The parity vector over ``size`` bytes, from one over a multiple of them."""
    return np.bitwise_xor.reduce(vector.reshape(-1, size), axis=0)


def parity_allows(a: np.ndarray, size_a: int, b: np.ndarray, size_b: int, percent: int) -> bool:
    """False only if two sets surely differ in more n-grams than their sizes allow (parity vectors of any widths)."""
    short = min(len(a), len(b))
    differ = int(np.bitwise_count(folded(a, short) ^ folded(b, short)).sum())
    return differ <= (size_a + size_b) * (100 - percent) // (100 + percent)


def _near_enough(size_a: str, parity_a: str, size_b: str, parity_b: str, percent: int) -> Column:
    """False only if two sets surely differ in more n-grams than their sizes allow."""
    bits = [f"bit_count({parity_a}[{k}] ^ {parity_b}[{k}])" for k in range(PARITY_BITS // 64)]
    return F.expr(f"{' + '.join(bits)} <= ({size_a} + {size_b}) * {100 - percent} div {100 + percent}")


def _sketch(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """rid, doc_id, n_shingles, k1, k2 (128-bit digest of the set), parity (folded to ``PARITY_BITS``), wide (whole), rows0, rows1, ... (block row digests by hash range)."""
    rows = numbered(docs).select("rid", F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("parity", pa.list_(pa.int64())), ("wide", pa.binary()), *((f"rows{k}", pa.list_(pa.int64())) for k in range(TURNS))])
    ranges = np.linspace(0, 2.0**64, TURNS + 1)[1:-1].astype(np.uint64)

    def by_range(found: list[np.ndarray]) -> Iterator[pa.Array]:
        cuts = [np.concatenate([[0], np.searchsorted(r.view(np.uint64), ranges), [len(r)]]) for r in found]
        for k in range(TURNS):
            part = [r[c[k] : c[k + 1]] for r, c in zip(found, cuts, strict=True)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(part)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(percent)
        for batch in batches:
            for c in chunks(text_column(batch, "text")):
                sets = ngram_sets(c, n)
                with np.errstate(over="ignore"):
                    k1 = [mix64(s).sum(dtype=np.uint64) for s in sets]
                    k2 = [mix64(s + np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64) for s in sets]
                rows_ = [block_rows(s, classes) for s in sets]
                wide = [parity(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(c.first, c.n),
                        batch.column(1).slice(c.first, c.n),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array(k1, np.uint64).view(np.int64)),
                        pa.array(np.array(k2, np.uint64).view(np.int64)),
                        pa.array([folded(v, PARITY_BITS // 8).view(np.int64) for v in wide], pa.list_(pa.int64())),
                        pa.array([v.tobytes() for v in wide], pa.binary()),
                        *by_range(rows_),
                    ],
                    schema=schema,
                )

    turns = ", ".join(f"rows{k} array<long>" for k in range(TURNS))
    return rows.mapInArrow(lean(run), f"rid long, doc_id long, n_shingles long, k1 long, k2 long, parity array<long>, wide binary, {turns}")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(node, grams): sorted distinct n-gram hashes of the rows in ``wanted`` (column node) and of few others, which a
    join with the wanted rows leaves out; texts of all other rows are not cut into n-grams."""
    rows = numbered(docs).select(F.col("rid").alias("node"), "text")
    maybe = member_filter(wanted).plain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(maybe(batch.column(0).to_numpy().view(np.uint64))))
            for c in chunks(text_column(batch, "text")):
                grams = [s.view(np.int64) for s in ngram_sets(c, n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(c.first, c.n), pa.array(grams, pa.list_(pa.int64()))], names=["node", "grams"]
                )

    return rows.mapInArrow(lean(run), "node long, grams array<long>")


def overlaps(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity: accumulate the overlap block by block, stop when
    the n-grams missed so far exceed ``(|a| + |b|) (100 - percent) / (100 + percent)``."""
    allowed = (len(a) + len(b)) * (100 - percent) // (100 + percent)
    edges = np.linspace(0, 2.0**64, VERIFY_BLOCKS + 1)[1:-1].astype(np.uint64)
    cut_a = np.concatenate([[0], np.searchsorted(a, edges), [len(a)]])
    cut_b = np.concatenate([[0], np.searchsorted(b, edges), [len(b)]])
    shared = missed = 0
    for k in range(VERIFY_BLOCKS):
        x, y = a[cut_a[k] : cut_a[k + 1]], b[cut_b[k] : cut_b[k + 1]]
        both = len(np.intersect1d(x, y, assume_unique=True))
        shared += both
        missed += len(x) + len(y) - 2 * both
        if missed > allowed:
            return False
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _close(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole parity vectors (``wide``: node, size, wide) leave them near enough."""
    a = wide.select(F.col("node").alias("u"), F.col("size").alias("nu"), F.col("wide").alias("wu"))
    b = wide.select(F.col("node").alias("v"), F.col("size").alias("nv"), F.col("wide").alias("wv"))
    both = pairs.join(a, "u").join(b, "v").select("u", "v", "nu", "nv", "wu", "wv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_u, size_v = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            wide_u, wide_v = ([np.frombuffer(x.as_buffer(), np.uint8) for x in batch.column(k)] for k in (4, 5))
            keep = [parity_allows(*x, percent) for x in zip(wide_u, size_u, wide_v, size_v, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(lean(run), "u long, v long")


def _verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (u, v; a stored table) whose sets reach the similarity, stored. Only the sets of pairs are made, and
    they are gone again when the pairs are decided."""
    tried = stored(pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct(), "ngram-tried")
    sets = stored(_sets(docs, tried, n), "ngram-sets")
    a = sets.select(F.col("node").alias("u"), F.col("grams").alias("gu"))
    b = sets.select(F.col("node").alias("v"), F.col("grams").alias("gv"))
    both = pairs.join(a, "u").join(b, "v").select("u", "v", "gu", "gv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = [
                overlaps(left[i].values.to_numpy().view(np.uint64), right[i].values.to_numpy().view(np.uint64), percent)
                for i in range(batch.num_rows)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    links = stored(both.mapInArrow(lean(run), "u long, v long"), "ngram-links")
    discard(tried, sets)
    return links


def _opened(held: DataFrame, roots: DataFrame) -> tuple[DataFrame, int, int]:
    """The shared block rows that still hold several components (columns of ``held`` and root), how many entries
    they have and how many pairs across components they stand for."""
    placed = stored(held.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "ngram-placed")
    parts = placed.groupBy("row", "root").agg(F.count(F.lit(1)).alias("c"))
    rows = parts.groupBy("row").agg(F.count(F.lit(1)).alias("parts"), F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("cc"))
    rows = stored(rows.where("parts > 1").select("row", "c", ((F.col("c") * F.col("c") - F.col("cc")) / 2).cast("long").alias("across")), "ngram-open")
    entries, across = rows.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("across"), F.lit(0))).first()
    opened = stored(placed.join(rows.select("row"), "row", "left_semi"), "ngram-opened")
    discard(placed, rows)
    return opened, entries, across


def _small_pairs(few: DataFrame, percent: int) -> DataFrame:
    """(u, v): every pair near enough of the block rows in ``few`` (row, node, size, parity; at most ``SMALL`` nodes a row)."""
    in_row = Window.partitionBy("row").orderBy("node")
    entry = F.struct("node", "size", "parity")
    before = few.select("node", "size", "parity", *(F.lag(entry, k).over(in_row).alias(f"b{k}") for k in range(1, SMALL)))
    each = before.select("node", "size", "parity", F.explode(F.array_compact(F.array(*(f"b{k}" for k in range(1, SMALL))))).alias("other"))
    near = each.where(_near_enough("size", "parity", "other.size", "other.parity", percent))
    return near.select(F.col("node").alias("u"), F.col("other.node").alias("v")).distinct()


def _hub_pairs(held: DataFrame, percent: int) -> DataFrame:
    """(u, v): each node with the smallest of the smallest nodes of its block rows that is near enough."""
    hubs = held.groupBy("row").agg(F.min(F.struct("node", "size", "parity")).alias("hub"))
    near = held.join(hubs, "row").where("hub.node < node").where(_near_enough("size", "parity", "hub.size", "hub.parity", percent))
    return near.groupBy("node").agg(F.min("hub.node").alias("v")).select(F.col("node").alias("u"), "v")


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v) that no component holds both of."""
    a = roots.select(F.col("node").alias("u"), F.col("root").alias("ru"))
    b = roots.select(F.col("node").alias("v"), F.col("root").alias("rv"))
    both = pairs.join(a, "u", "left").join(b, "v", "left")
    return both.where(F.coalesce("ru", "u") != F.coalesce("rv", "v")).select("u", "v")


def _some_pairs(opened: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each node with the first one of a small pseudo-random part of its block row, another one each turn."""
    part = F.pmod(F.xxhash64("node", F.lit(turn)), F.greatest((F.col("n") / 4).cast("long"), F.lit(1)))
    cut = opened.withColumn("part", part)
    first = stored(cut.groupBy("row", "part").agg(F.min(F.struct("node", "root", "size", "parity")).alias("lead")), "ngram-hubs")
    pairs = cut.join(first, ["row", "part"]).where("node != lead.node and root != lead.root")
    pairs = pairs.where(_near_enough("size", "parity", "lead.size", "lead.parity", percent))
    return pairs.select(F.greatest("node", "lead.node").alias("u"), F.least("node", "lead.node").alias("v")).distinct()


def _all_pairs(opened: DataFrame, percent: int) -> DataFrame:
    """Every pair of nodes that share a block row, are not in one component and may be near enough."""
    other = opened.select("row", *(F.col(c).alias(f"o_{c}") for c in ("root", "size", "parity")), F.col("node").alias("v"))
    near = _near_enough("size", "parity", "o_size", "o_parity", percent)
    pairs = opened.join(other, "row").where(F.expr("v < node and root != o_root") & near)
    return pairs.select(F.col("node").alias("u"), "v").distinct()


def _linked(held: DataFrame, small: DataFrame, wide: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, root) of all nodes with links, from the pairs (u, v) of the small block rows and the larger
    rows ``held`` (row, node, size, parity, n).

    Each node is tried with the smallest one of its pairs or rows first. Then, while the pairs of the larger rows
    left across components outnumber the entries and keep falling, each node is tried with one other
    node per shared row and turn, so families whose members are close to some others only grow
    together at a cost linear in their size. Last, every pair that is left is tried, those of the small
    rows too: the result never depends on the turns.
    """
    pairs = small.unionByName(_hub_pairs(held, percent)).groupBy("u").agg(F.min("v").alias("v"))
    links, turn, last, table = None, 0, None, held
    while True:
        tried = stored(pairs, "ngram-pairs")
        close = stored(_close(tried, wide, percent), "ngram-close")
        more = _verified(close, docs, n, percent)
        discard(tried, close)
        links = more if links is None else links.unionByName(more)
        roots = stored(components(links), "ngram-roots")
        if turn < 0:
            return roots
        before, (opened, entries, across) = table, _opened(held, roots)
        table = opened
        discard(before)
        falling = last is None or across < last * 7 // 10
        held = opened.drop("root")  # rows without a pair across components stay so
        if across > entries and falling:
            turn, last = turn + 1, across
            pairs = _some_pairs(opened, turn, percent)
        else:
            turn = -1
            pairs = _across(small, roots)
            if across:
                pairs = pairs.unionByName(_all_pairs(opened, percent)).distinct()


def ngram_components(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """rid, doc_id, n_shingles, component_id (smallest doc_id linked, itself included) per row of ``docs``.

    Rows without words are linked with nothing (component_id is their own doc_id). Rows with equal
    sets are linked. A null doc_id never names a component that holds another id. Empty tables give
    no rows; other columns are ignored. ``docs`` must be a stored table.
    """
    ship(docs.sparkSession)
    rows = stored(_sketch(docs, n, percent), "ngram-sketch")
    # one node per distinct set; empty sets stay apart
    key = ["n_shingles", "k1", "k2"]
    slim = stored(rows.select("rid", "doc_id", *key), "ngram-ids")
    members = slim.where("n_shingles > 0")
    nodes = stored(members.groupBy(*key).agg(F.min("rid").alias("node"), F.min("doc_id").alias("least")), "ngram-nodes")

    shared = [
        stored(rows.select(F.explode(f"rows{k}").alias("row")).groupBy("row").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("row"), "ngram-shared")
        for k in range(TURNS)
    ]
    every = shared[0]
    for part in shared[1:]:
        every = every.unionByName(part)
    blocks = rows.select(F.col("rid").alias("node"), F.col("n_shingles").alias("size"), "parity", F.explode(F.concat(*(f"rows{k}" for k in range(TURNS)))).alias("row"))
    # rows with a set that an earlier row has are few, or their block rows do not matter: only these are looked up
    again = stored(members.select(F.col("rid").alias("node")).join(nodes.select("node"), "node", "left_anti"), "ngram-again")
    blocks = blocks.where(member_filter(every)("row"))
    if not again.isEmpty():
        maybe = stored(blocks.withColumn("maybe", member_filter(again)("node")), "ngram-maybe")
        sure = maybe.where("not maybe").drop("maybe")
        blocks = sure.unionByName(maybe.where("maybe").drop("maybe").join(again, "node", "left_anti"))
    loose = stored(blocks, "ngram-loose")

    wide = stored(rows.where("n_shingles > 0").select(F.col("rid").alias("node"), F.col("n_shingles").alias("size"), "wide"), "ngram-wide")
    discard(*shared, rows)
    times = stored(loose.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "ngram-times")
    small = stored(_small_pairs(loose.join(times.where(F.col("n") <= SMALL).select("row"), "row"), percent), "ngram-small")
    held = stored(take_rows(loose, "row", times.where(F.col("n") > SMALL)), "ngram-held")
    discard(loose, times)
    roots = _linked(held, small, wide, docs, n, percent)
    discard(wide)

    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(named.join(ids, "root").select(*key, "root", "component_id"), "ngram-named")
    linked = members.join(named, key).select("rid", "doc_id", "n_shingles", "root", "component_id")
    alone = slim.where("n_shingles = 0").select(
        "rid", "doc_id", "n_shingles", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone)


def drop_near_copies(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """One row per component of ``docs`` (a stored table), with its columns: the smallest doc_id stays
    (nulls last, one of ties); rows without words all stay."""
    found = stored(ngram_components(docs, n, percent), "ngram-components").where("root is not null")
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rid")
    best = found.groupBy("root").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    dropped = found.join(best, "root").where(F.col("rid") != F.col("best.rid")).select("rid")
    return remove_rows(docs, stored(dropped, "ngram-dropped"))

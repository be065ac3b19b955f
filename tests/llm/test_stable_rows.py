"""Row numbers do not move when the cluster splits a scan otherwise: results stay equal."""

import pytest

from ledgerflow.llm import bloom, decontaminate, exact, ngram_join, substring_dedup

SF = "/root/testdata/sf0.01"
SPLIT = "spark.sql.files.minPartitionNum"


@pytest.fixture()
def docs(spark, tmp_path):
    """The whole table in five files of several row groups each, so that a scan can be split in many ways."""
    path = str(tmp_path / "docs")
    spark.read.parquet(f"{SF}/documents.parquet").repartition(5, "doc_id").write.option("parquet.block.size", 1 << 16).parquet(path)
    yield spark.read.parquet(path)
    spark.conf.unset(SPLIT)


class Moving:
    """Changes the number of splits before every other use of ``stored``."""

    def __init__(self, spark, plain):
        self.spark, self.plain, self.turn = spark, plain, 0

    def __call__(self, df, name):
        out = self.plain(df, name)
        self.turn += 1
        self.spark.conf.set(SPLIT, str((2, 37, 11)[self.turn % 3]))
        return out


def test_numbers_do_not_move(spark, docs):
    seen = []
    for n in (1, 4, 40):
        spark.conf.set(SPLIT, str(n))
        seen.append({r.doc_id: r.rid for r in bloom.numbered(docs).collect()})
    assert seen[0] == seen[1] == seen[2] and len(set(seen[0].values())) == len(seen[0]) == docs.count()


@pytest.mark.parametrize("name", ["exact", "near", "contaminated", "repeats"])
def test_results_do_not_move(spark, docs, monkeypatch, name):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    module, run = {
        "exact": (exact, lambda: exact.drop_copies(docs).select("doc_id")),
        "near": (ngram_join, lambda: ngram_join.drop_near_copies(docs).select("doc_id")),
        "contaminated": (decontaminate, lambda: decontaminate.drop_contaminated(docs, bench).select("doc_id")),
        "repeats": (substring_dedup, lambda: substring_dedup.remove_repeats(docs).select("doc_id", "n_removed", "n_spans")),
    }[name]
    spark.conf.set(SPLIT, "3")
    steady = sorted(map(tuple, run().collect()))
    monkeypatch.setattr(module, "stored", Moving(spark, module.stored))
    lazy = run()
    spark.conf.set(SPLIT, "29")
    assert sorted(map(tuple, lazy.collect())) == steady
    assert 0 < len(steady) and (len(steady) < docs.count() or name == "repeats" and any(r[1] for r in steady))

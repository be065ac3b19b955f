"""The corpus pipeline against a brute-force version, and the registered queries."""

import re

import public_tokenizers
import pytest

import __spark_entry__ as E
import corpus_pipeline
from ledgerflow.llm import toxicity
from test_llm_operators import brute_components, brute_contamination

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_pipeline_brute_force(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train_on(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.s for r in toxicity.with_score(docs.select("doc_id", "text"), model, "s").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] < 0.3)
    first = {}
    for d, t in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), (d, t))
    rows = sorted(first.values())
    near = brute_components(rows, 80, 5)
    rows = [(d, t) for d, t in rows if near[d][1] == d]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d for d, _, n, _ in brute_contamination(rows, items, 10) if n == 0}
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {d: [*lib.encode(t), lib.eos_id()] for d, t in rows if d in clean}
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < docs.count()

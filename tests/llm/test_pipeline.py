from collections import Counter

import corpus_pipeline
import public_tokenizers
from labelsieve.llm import bpe

from .helpers import documents, odd_texts, prose
from .test_superminhash import expected

SF = "/root/testdata/sf0.001"


def test_stages_return_documents_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "tokens":
            assert docs.columns == columns
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        seen[name] = rows
        counts.append(len(rows))
    assert counts[1] < counts[0] and counts[2] < counts[1]
    texts = [r.text for r in seen["exact_dedup"]]
    assert len(set(texts)) == len(texts) and set(texts) == {r.text for r in seen["quality"]}
    want = expected([r.doc_id for r in seen["exact_dedup"]], texts, 5, 80)
    assert sorted(r.doc_id for r in seen["near_dedup"]) == [i for i, _, _, kept in want if kept]
    enc = bpe.encoder(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)[0]
    mixed = Counter(r.doc_id for r in seen["mixture"])
    assert mixed == Counter(r.doc_id for r in seen["tokens"]) and max(mixed.values()) <= 3
    text = {r.doc_id: r.text for r in seen["mixture"]}
    assert all(enc.decode(r.ids) == text[r.doc_id] and r.n_tokens == len(r.ids) for r in seen["tokens"])


def test_odd_rows_pass_through(spark):
    texts = [*odd_texts(), prose(40, 1), prose(40, 1)]
    docs = documents(spark, texts, ["s"] * len(texts)).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() >= 1


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []

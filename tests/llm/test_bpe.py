import public_tokenizers
from labelsieve.llm import bpe
from labelsieve.llm.common import F

from .helpers import documents, odd_texts, prose, sha

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
ENC = bpe.encoder(RANKS, PATTERN)[0]
TEXTS = [*odd_texts(), "don't we'll I'M 123abc456 <|endoftext|> 😀é́   \x85 x", " " * 3000 + "a" + "\n\n \t " * 50,
         prose(4000, 3).replace("w1", " '1ll's") * 3, "日本語" * 500, "!?" * 2000, "ab12" * 3000]


def test_digests_are_those_of_the_library(spark, monkeypatch):
    got = {r.doc_id: r for r in bpe.digests(documents(spark, TEXTS), RANKS, PATTERN).collect()}
    for i, t in enumerate(TEXTS):
        ids = ENC.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == \
            (len(ids), sha(" ".join(map(str, ids))), sha(t or ""))


def test_pieces_never_change_the_ids():
    for t in TEXTS[1:]:
        for size in (1, 7, 64, 1000):
            assert "".join(bpe.pieces(t, size)) == t
            assert bpe.encode_text(ENC, t, size) == ENC.encode_ordinary(t)
    assert len(list(bpe.pieces(prose(4000), 500))) > 20


def test_round_trip_keeps_columns(spark):
    docs = documents(spark, TEXTS)
    ids = bpe.encode(docs, RANKS, PATTERN)
    assert ids.columns == [c for c in docs.columns if c != "text"] + ["ids"]
    back = bpe.decode(ids, RANKS, PATTERN)
    assert {r.doc_id: bytes(r.bytes) for r in back.collect()} == {i: (t or "").encode() for i, t in enumerate(TEXTS)}


def test_empty_table_and_missing_ids(spark):
    assert bpe.digests(documents(spark, []), RANKS, PATTERN).collect() == []
    none = spark.range(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert bytes(bpe.decode(none, RANKS, PATTERN).first().bytes) == b""

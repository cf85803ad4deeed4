import random
import struct
import zlib

import numpy as np
import pytest
import xxhash
from labelsieve.llm import queries, zstd_quality as zq
from labelsieve.llm.common import docs_of

from .helpers import documents, odd_texts, prose

SF = "/root/testdata/sf0.01"


def labelled(spark, good=30, bad=30):
    texts = [prose(60, i) + "." for i in range(good)] + [" ".join(w + "!!%" for w in prose(60, 100 + i).upper().split())
                                                         for i in range(bad)]
    labels = spark.createDataFrame([(i, int(i < good)) for i in range(good + bad)], "doc_id long, label int")
    return documents(spark, texts), labels


def test_separates_and_scores_odd_texts(spark):
    docs, labels = labelled(spark)
    model = zq.fit(docs_of(docs), labels)
    scores = {r.doc_id: r.score for r in zq.score(docs, model).collect()}
    assert min(scores[i] for i in range(30)) > max(scores[i] for i in range(30, 60))
    odd = zq.score(documents(spark, odd_texts()), model).collect()
    assert len(odd) == len(odd_texts()) and all(0 <= r.score <= 1 for r in odd)
    assert zq.score(documents(spark, []), model).collect() == []


def test_keep_good_keeps_rows_whole(spark):
    docs, labels = labelled(spark)
    model = zq.fit(docs_of(docs), labels)
    out = zq.keep_good(docs, model, 0.5)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == list(range(30))


def test_labels_that_do_not_count(spark):
    docs, _ = labelled(spark)
    odd = spark.createDataFrame([(0, 1), (0, 0), (1, None), (2, 7), (None, 1), (99, 1)], "doc_id long, label int")
    model = zq.fit(docs_of(docs), odd)  # nothing usable
    assert {round(r.score, 6) for r in zq.score(docs, model).collect()} == {0.5}
    only = spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, label int")
    assert {round(r.score, 6) for r in zq.score(docs, zq.fit(docs_of(docs), only)).collect()} == {0.9}


def test_held_out_fold_is_not_learned_from(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ids = {r.doc_id for r in zq.training_labels(labels, 5).collect()}
    assert ids and all(zlib.crc32(str(i).encode()) % 5 for i in ids)


def test_held_out_accuracy(spark):
    got = queries.op2_compression_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = [r for r in got.collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97
    assert sum(bad) / len(bad) < 0.3


def test_too_little_text_for_a_trained_dictionary(spark):
    docs = documents(spark, ["aa", "bb!!", "", ""])
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, label int")
    scores = [r.score for r in zq.score(docs, zq.fit(docs_of(docs), labels)).collect()]
    assert all(0 <= s <= 1 for s in scores) and scores[2] == pytest.approx(scores[3])


def plain_model(texts, labels, per_class=zq.SAMPLE_PER_CLASS, most=zq.MAX_CHARS):
    """The fit in one process: the first rows of each class by Spark's hash of the id."""
    def h(i, *more):
        x = xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42)
        for v in more:
            x = xxhash.xxh64_intdigest(struct.pack("<i", v), seed=x)
        return x - (1 << 64) if x >> 63 else x
    by = {}
    for c in (0, 1):
        ids = sorted((h(i), i) for i, y in labels.items() if y == c)[:per_class]
        by[c] = []
        for _, i in ids:
            t = texts[i]
            at = h(i, 1) % (max(len(t) - most, 0) + 1) if len(t) > most else 0
            by[c].append(t[at:at + most].encode())
    half = {c: (len(v) + 1) // 2 for c, v in by.items()}
    good, bad = (zq._train_dictionary(by[c][:half[c]]) for c in (1, 0))
    held = {c: v[half[c]:] or v for c, v in by.items()}
    x = zq.features(zq.sizes(held[0] + held[1], zq._compressor(good), zq._compressor(bad)))
    return zq.Model(good, bad, zq.calibrate(x, np.repeat([0.0, 1.0], [len(held[0]), len(held[1])])))


def test_long_labelled_texts_are_learned_from(spark):
    """Every labelled text is above the bound: a run of each, from a place chosen by the hash, is used."""
    rng = random.Random(3)
    texts = [prose(rng.randrange(12_000, 16_000), i) if i % 2 else " ".join(
        w + "!!%" for w in prose(rng.randrange(9_000, 12_000), 100 + i).upper().split()) for i in range(20)]
    assert min(map(len, texts)) > zq.MAX_CHARS
    labels = {i: i % 2 for i in range(20)}
    frame = spark.createDataFrame(list(labels.items()), "doc_id long, label int")
    docs = documents(spark, texts)
    model = zq.fit(docs_of(docs), frame)
    assert model == plain_model(texts, labels)
    scores = {r.doc_id: r.score for r in zq.score(docs, model).collect()}
    assert min(scores[i] for i in labels if i % 2) > max(scores[i] for i in labels if not i % 2)
    small = zq.fit(docs_of(docs), frame, sample_bytes=1)  # a text of each class at least
    assert small.good and small.bad and small != model


def test_scores_against_one_process(spark):
    docs, labels = labelled(spark)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    model = plain_model(texts, {r.doc_id: r.label for r in labels.collect()}, per_class=20)
    assert zq.fit(docs_of(docs), labels, sample_per_class=20) == model
    every = texts + [t or "" for t in odd_texts()] + texts[:3]
    good, bad = zq._compressor(model.good), zq._compressor(model.bad)
    want = zq.probability(zq.features(zq.sizes([t.encode() for t in every], good, bad)), model.weights)
    rows = zq.score(documents(spark, texts + odd_texts() + texts[:3]), model).collect()  # repeated rows are scored each
    assert {r.doc_id: r.score for r in rows} == dict(enumerate(want.tolist()))

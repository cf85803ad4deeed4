import math
import random
from collections import Counter

import duckdb
import numpy as np
from labelsieve.llm import best_position, queries
from labelsieve.llm.oracle import ORACLE

from .helpers import documents, odd_texts, prose

SF = "/root/testdata/sf0.001"


def plain(texts, ids, items, k):
    docs = [(i, Counter(best_position.terms_of(t))) for i, t in zip(ids, texts, strict=True)]
    docs = [(i, c) for i, c in docs if c]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(best_position.terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in docs:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, texts, ids, items, k=10, **limits):
    table = spark.createDataFrame([(*i, "en", 1) for i in items], "item_id long, text string, lang string, score long")
    got = best_position.rank(documents(spark, texts, ids=ids).repartition(3), table, k, **limits)
    return sorted(map(tuple, got.collect()), key=str)


def corpus():
    rng = random.Random(5)
    texts = odd_texts() + [prose(rng.randrange(1, 80), s, 60) for s in range(160)] + [prose(40, 7, 60)] * 12
    texts += ["Straße ÉCOLE naïve 東京 w1", "w1,w1;W1-w2_w3", "x" * 70_000 + " w5", "a" * 600 + " w6"]
    ids = list(range(len(texts)))
    ids[20] = ids[21] = ids[30] = None
    ids[40] = ids[41] = 7  # repeated id
    ids[42] = -3
    return texts, ids


ITEMS = [(0, "w1 w2 w3 w4 W5"), (1, None), (2, "nowhere"), (3, "... ,"), (4, "Straße naïve 東京 école ÉCOLE"), (5, prose(60, 7, 60)),
         (5, "w59 w58"), (None, "w6 w7"), (6, "a" * 600), (7, "same tab vt ff rcr one two words")]


def test_against_brute_force(spark):
    texts, ids = corpus()
    want = plain(texts, ids, ITEMS, 10)
    assert run(spark, texts, ids, ITEMS) == want
    assert run(spark, texts, ids, ITEMS, postings=50, vocabulary=3) == want  # many blocks of documents and of queries


def test_fewer_and_no_rows(spark):
    assert run(spark, [], [], ITEMS) == []
    assert run(spark, ["w1"], [1], []) == []
    assert run(spark, [None, "..."], [1, 2], ITEMS) == []
    assert run(spark, ["w1 w2"], [4], ITEMS, k=3) == plain(["w1 w2"], [4], ITEMS, 3)


def test_stops_early_and_strictly_below_the_kth_score():
    rng = np.random.default_rng(1)
    n_docs, n_terms = 20_000, 6
    doc = np.repeat(np.arange(n_docs), n_terms)
    term = np.tile(np.arange(n_terms), n_docs)
    strength = rng.pareto(1.5, n_docs)  # a document is good in all lists or in none
    impact = (1000 * np.repeat(strength, n_terms) * rng.uniform(0.8, 1.2, len(doc))).astype(np.int64)
    lists = best_position.Lists(doc, term, impact, n_docs, n_terms)
    best, ids = best_position.Best(10), np.arange(n_docs)
    scored = lists.search(np.arange(n_terms), np.ones(n_terms, bool), best, np.zeros(n_docs, bool), ids)
    whole = impact.reshape(n_docs, n_terms).sum(1)
    order = np.lexsort((ids, -whole))[:10]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == whole[order].tolist()
    assert scored < n_docs // 20
    assert not lists.seen.any() and not lists.met.any()
    # Equal scores: all documents tie, so none may be left out before the smallest ids are known.
    flat = best_position.Lists(doc, term, np.ones(len(doc), np.int64), n_docs, n_terms)
    tied = best_position.Best(10)
    assert flat.search(np.arange(n_terms), np.ones(n_terms, bool), tied, np.zeros(n_docs, bool), ids[::-1].copy()) == n_docs
    assert tied.ids.tolist() == list(range(10))


def test_hash_matches_are_confirmed_by_bytes():
    known = best_position.Vocabulary(["alpha", "beta"])
    raw = np.frombuffer(b"ALPHA beta gamma", np.uint8)
    start, end = np.array([0, 6, 11]), np.array([5, 10, 16])
    hashes = np.array([known.hash[0]] * 3, np.uint64)  # one hash for all words
    at, number = known.find(hashes, raw, start, end)
    assert at.tolist() == [int(known.number[0])] and number.tolist() == [int(known.number[0])]


def test_query_against_sql(spark):
    got = queries.op13_best_position(spark, SF)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(f"select {', '.join(got.columns)} from ({ORACLE['op13_best_position']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)

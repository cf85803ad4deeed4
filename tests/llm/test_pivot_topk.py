import math

import duckdb
import numpy as np
import pytest
from labelsieve.llm import pivot_topk, queries
from labelsieve.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, score string, v string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "s", "v") for i, v in rows], SCHEMA)


def plain(rows, k, every):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in sorted(good):
        if qi % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), i) for i, v in good if i != qi)
            out += [(qi, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


def run(spark, rows, k=5, every=10, **options):
    v = pivot_topk.quantised(table(spark, rows), "vec_id", "embedding", 256)
    got = pivot_topk.top_k(v, v.filter(f"vec_id % {every} = 0"), k, **options)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


def test_ties_odd_vectors_and_blocks(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(9)]  # equal scores
    rows += [(300, None), (310, [1.0, None]), (320, [float("nan")] * 8), (330, [float("inf")] * 8), (340, []),
             (None, rows[0][1]), (350, [0.0] * 8), (360, [0.5, 0.25])]
    want = plain(rows, 5, 10)
    assert run(spark, rows) == want
    assert run(spark, rows, n_pivots=3, query_block=4) == want
    assert run(spark, rows, k=500) == plain(rows, 500, 10)


def test_bounds_hold_and_stop_early():
    rng = np.random.default_rng(1)
    rows = rng.integers(-300, 300, (3000, 24)).astype(float)
    rows[:100] *= 3
    basis = pivot_topk.basis_of(rows[::10], 18)
    assert basis.shape == (18, 24) and np.allclose(basis @ basis.T, np.eye(18), atol=1e-12)
    q = rows[5:6]
    at, off, size = pivot_topk.coordinates(rows, basis)
    bound = pivot_topk.bounds(at, off, size, *pivot_topk.coordinates(q, basis))[0]
    assert (bound >= rows @ q[0]).all()
    best = pivot_topk.Best(5)
    evaluated = pivot_topk.search_block(best, q[0], float(size[5]), -1, bound, rows, size, np.arange(3000))
    assert evaluated < 1500
    assert best.scores.tolist() == sorted((rows @ q[0]).astype(int).tolist(), reverse=True)[:5]


def test_most_pairs_are_eliminated(spark):
    """On the given vectors (64 dimensions) under one half of the pairs is evaluated."""
    sf = SF.replace("0.001", "0.1")
    v = pivot_topk.quantised(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id", "embedding", 256)
    tally = spark.sparkContext.accumulator(0)
    asked = v.filter("vec_id % 50 = 0")
    pivot_topk.top_k(v, asked, 5, tally=tally).collect()
    assert 0 < tally.value < v.count() * asked.count() // 2


def test_components_of_any_size(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(40)]
    rows += [(41, [1e8, 0.0, 0.0, 0.0]), (42, [0.0, 0.0, 3e18, 0.0]), (50, [1e-3, 2e6, 0.0, 0.0]), (60, [0.0, 1e7, 0.0, 1.0]),
             (70, [2.0**-8, 0.0, 0.0, 0.0]), (71, [2.0**53, 1.0, 0.0, 0.0]), (72, [-(2.0**53), 1.0, 0.0, 0.0])]
    doubles = spark.createDataFrame(rows, "vec_id long, v array<double>")
    asked = (50, 60, 70)
    v = pivot_topk.quantised(doubles, "vec_id", "v", 256)

    def whole(x):
        return math.floor(256 * x)
    want = []
    for qi, q in rows:
        if qi in asked:
            scored = sorted((-sum(whole(a) * whole(b) for a, b in zip(q, x, strict=True)), i) for i, x in rows if i != qi)
            want += [(qi, r, i, -s) for r, (s, i) in enumerate(scored[:5], 1)]
    got = pivot_topk.top_k(v, v.filter(v.vec_id.isin(*asked)), 5)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want
    # The largest doubles take part as well; only a score beyond 64 bits raises.
    huge = spark.createDataFrame([(0, [0.0, 1.0]), (1, [1e300, 1.0]), (2, [7e305, 2.0])], "vec_id long, v array<double>")
    v = pivot_topk.quantised(huge, "vec_id", "v", 256)
    got = pivot_topk.top_k(v, v.filter("vec_id = 0"), 5).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 2 * 65536), (1, 65536)]
    with pytest.raises(Exception, match="64 bits"):
        pivot_topk.top_k(v, v.filter("vec_id = 1"), 5).collect()
    with pytest.raises(Exception, match="too large"):
        pivot_topk.quantised(spark.createDataFrame([(0, [1.7e308])], "vec_id long, v array<double>"), "vec_id", "v", 256).collect()


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, [(0, [1.0])]) == []


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = queries.op9_pivot_topk(spark, SF).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == \
        sorted(con.sql(ORACLE["op9_pivot_topk"]).fetchall())

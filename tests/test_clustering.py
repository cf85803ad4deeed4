import hashlib
import math
import random

import numpy as np
import pytest

from labelsieve.operators import clustering, extensions

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, d double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1.0) for i, v in rows], SCHEMA)


def plain(rows, k, rounds, seed=42):
    """Sequential k-means with exact sums of multiples of 2**-30."""
    items = sorted((i, [float(np.float32(x)) for x in v]) for i, v in rows)

    def square(a, b):
        total = 0.0
        for x, y in zip(a, b, strict=True):
            total += (x - y) * (x - y)
        return total
    first = min(items, key=lambda r: (hashlib.md5(f"{seed}:centre:{r[0]}".encode()).hexdigest(), r[0]))
    centres = [first[1]]
    while len(centres) < k:
        far = max(items, key=lambda r: (min(square(r[1], c) for c in centres), -r[0]))
        if not min(square(far[1], c) for c in centres):
            break
        centres.append(far[1])
    for _ in range(rounds):
        at = {i: min(range(len(centres)), key=lambda c: (square(v, centres[c]), c)) for i, v in items}
        for c in range(len(centres)):
            mine = [v for i, v in items if at[i] == c]
            if mine:
                centres[c] = [float(sum(int(np.rint(v[j] * 2**30)) for v in mine)) / 2**30 / len(mine) for j in range(len(mine[0]))]
    return {i: min((square(v, c), n) for n, c in enumerate(centres)) for i, v in items}


def points(n, dim=5, seed=1):
    rng = random.Random(seed)
    hubs = [[rng.uniform(-3, 3) for _ in range(dim)] for _ in range(4)]
    return [(i, [h + rng.gauss(0, 0.4) for h in rng.choice(hubs)]) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 50])
def test_same_groups_on_any_partitioning(spark, parts):
    rows = points(300) + [(1000 + i, [0.25] * 5) for i in range(60)]  # repeated vectors
    got = clustering.kmeans(table(spark, rows).repartition(parts), 6, 4).collect()
    want = plain(rows, 6, 4)
    assert {r.item_id: r.cluster for r in got} == {i: c for i, (_, c) in want.items()}
    assert all(r.distance == math.sqrt(want[r.item_id][0]) for r in got)


def test_vectors_that_take_no_part(spark):
    rows = points(20) + [(50, None), (51, [None] * 5), (52, [float("nan")] * 5), (53, [float("inf")] * 5), (54, [1.0, 2.0]), (None, [1.0] * 5)]
    items = table(spark, rows)
    got = {r.item_id: r.cluster for r in clustering.kmeans(items, 3).collect()}
    assert set(got) == set(range(20)) | {54}
    padded = [r for r in rows if r[0] is not None and r[0] < 50] + [(54, [1.0, 2.0, 0.0, 0.0, 0.0])]
    assert got == {i: c for i, (_, c) in plain(padded, 3, 5).items()}
    grouped = extensions.kmeans_groups(items, k=3, out="found")
    assert {r.vec_id: r.found for r in grouped.collect() if r.vec_id in got} == got
    assert grouped.count() == len(rows) and grouped.filter("found is null").count() == 5


def test_few_different_vectors_and_empty_table(spark):
    same = table(spark, [(i, [1.0, 2.0]) for i in range(9)])
    assert {r.cluster for r in clustering.kmeans(same, 4).collect()} == {0}
    assert clustering.kmeans(table(spark, []), 4).collect() == []
    with pytest.raises(ValueError, match="scale them"):
        clustering.kmeans(table(spark, [(1, [1e30])]), 2)
    with pytest.raises(ValueError):
        clustering.kmeans(same, 0)

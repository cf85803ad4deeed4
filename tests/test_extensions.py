import random

from pyspark.sql import functions as F

from labelsieve.operators import extensions
from labelsieve.params import Params


def _brute_spaced(rows, budget, cap, gap):
    """Sequential walk: global score order, per-video cap and minimum time gap."""
    out, acc = [], {}
    for f, s, t in sorted(rows, key=lambda r: (-r[1], r[0])):
        v = f.split("-")[0]
        taken = acc.setdefault(v, [])
        if len(taken) >= cap or any(abs(t - u) < gap for u in taken):
            continue
        taken.append(t)
        out.append(f)
        if len(out) >= budget:
            break
    return out


def test_spaced_select_equals_sequential(spark):
    rng = random.Random(11)
    rows = [(f"v{rng.randint(0, 6)}-{i:04d}", rng.choice([.1, .3, .5, .8, rng.random()]), float(rng.randint(0, 100)))
            for i in range(250)]
    scores = spark.createDataFrame([(f, s) for f, s, _ in rows], "frame_id string, combined double")
    times = spark.createDataFrame([(f, t) for f, _, t in rows], "frame_id string, t double")
    for budget, cap, gap in [(15, 3, 10.0), (100, 5, 25.0), (7, 2, 0.0)]:
        got = [r.frame_id for r in extensions.spaced_select(scores, times, budget, cap, gap).orderBy("pick").collect()]
        assert got == _brute_spaced(rows, budget, cap, gap)


def test_scene_split_keeps_videos_whole(spark):
    inv = spark.createDataFrame([(f"v{i % 37:02d}-{i:05d}",) for i in range(2000)], "frame_id string")
    s = extensions.scene_split(inv, Params(seed_fraction=0.05, unlabeled_fraction=0.75, val_fraction=0.20))
    per_video = s.groupBy("video_id").agg(F.countDistinct("split").alias("k")).collect()
    assert all(r.k == 1 for r in per_video) and s.count() == 2000
    assert {r.split for r in s.select("split").distinct().collect()} <= {"seed", "unlabeled", "val"}


def test_budget_curve_prefixes(spark):
    sel = spark.createDataFrame([(i + 1, f"v{i % 4}-{i}", f"v{i % 4}", float(10 - i)) for i in range(10)],
                                "pick long, frame_id string, video_id string, score double")
    got = {r.budget: (r.n_frames, r.n_videos) for r in extensions.budget_curve(sel, (2, 5, 50)).collect()}
    assert got == {2: (2, 2), 5: (5, 4), 50: (10, 4)}


def test_signal_ablation_variants(spark):
    sc = spark.createDataFrame([(f"v{i}-{i}", (i % 5) / 5, 1 - (i % 5) / 5) for i in range(30)],
                               "frame_id string, uncertainty_norm double, rare_class_norm double")
    got = extensions.signal_ablation(sc, budget=3, cap=1)
    tops = {r.variant: r.frame_id for r in got.filter("pick = 1").collect()}
    # ties on the score go to the lower frame_id (string order)
    assert tops["uncertainty"] == "v14-14" and tops["rare_class"] == "v0-0"
    assert got.groupBy("variant").count().count() == 3


def test_spaced_select_ends(spark):
    scores = spark.createDataFrame([("a-1", 0.5), ("a-2", 0.4)], "frame_id string, combined double")
    times = spark.createDataFrame([("a-1", 0.0), ("a-2", 1.0)], "frame_id string, t double")
    none = extensions.spaced_select(scores, times, 0, 3, 10.0)
    assert none.columns == ["pick", "frame_id", "video_id", "score", "t"] and none.collect() == []
    assert [r.frame_id for r in extensions.spaced_select(scores, times, 9, 100, 10.0).collect()] == ["a-1"]


def test_cluster_diverse_by_plain_centres(spark):
    rng = random.Random(4)
    rows = [(i, [rng.random() for _ in range(4)], i % 3) for i in range(60)]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = [(r.item_id, r.cluster) for r in extensions.cluster_diverse(items, 7, 3).orderBy("pick").collect()]
    plain = {r.vec_id: (r.embedding, r.label) for r in items.collect()}
    centre = {c: [sum(v[j] for v, k in plain.values() if k == c) / 20 for j in range(4)] for c in range(3)}
    far = sorted(((-sum((a - b) ** 2 for a, b in zip(v, centre[c])) ** 0.5, i, c) for i, (v, c) in plain.items()))
    want, taken = [], {}
    for _, i, c in far:
        if taken.get(c, 0) < 3 and len(want) < 7:
            taken[c] = taken.get(c, 0) + 1
            want.append((i, str(c)))
    assert got == want
    assert extensions.kmeans_groups(items, k=2).select("label").distinct().count() == 2


def test_cluster_diverse_keeps_items_without_a_label(spark):
    rows = [(1, [0.0, 0.0], 5), (2, [2.0, 0.0], 5), (3, [0.0, 0.0], None), (4, [0.0, 6.0], None), (5, [0.0, 3.0], None)]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = extensions.cluster_diverse(items, 9, 2).orderBy("pick").collect()
    assert [(r.item_id, r.cluster, r.score) for r in got] == [(3, None, 3.0), (4, None, 3.0), (1, "5", 1.0), (2, "5", 1.0)]

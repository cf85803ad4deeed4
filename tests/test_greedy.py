import random

import pyarrow as pa
import pytest

from labelsieve.operators import evaluation
from labelsieve.params import IOU_THRESHOLDS

DET = "image_id long, class_id int, det_id string, confidence double, x_center double, y_center double, width double, height double"
GT = "image_id long, class_id int, gt_id long, x_center double, y_center double, width double, height double"


def _iou(a, b):
    ix = max(0.0, min(a[0] + a[2] / 2, b[0] + b[2] / 2) - max(a[0] - a[2] / 2, b[0] - b[2] / 2))
    iy = max(0.0, min(a[1] + a[3] / 2, b[1] + b[3] / 2) - max(a[1] - a[3] / 2, b[1] - b[3] / 2))
    union = a[2] * a[3] + b[2] * b[3] - ix * iy
    return ix * iy / union if union > 0 else 0.0


def plain(det, gt, thresholds):
    """One detection after the other, each with its best free box."""
    won = {}
    for ti, t in enumerate(thresholds):
        taken = set()
        for image, cls, det_id, conf, *box in sorted(det, key=lambda d: (-d[3], d[2])):
            free = [(_iou(box, g[3:]), -g[2]) for g in gt if g[:2] == (image, cls) and (image, cls, g[2]) not in taken]
            free = [f for f in free if f[0] >= t]
            if free:
                taken.add((image, cls, -max(free)[1]))
                won.setdefault((image, cls, det_id), set()).add(ti)
    return won


def crowd(rng, images, n):
    def box():
        return rng.choice([.2, .25, .3, .5, rng.random()]), rng.choice([.2, .22, rng.random()]), rng.choice([.1, .12, .2]), rng.choice([.1, .15])
    gt = [(i, c, g, *box()) for i in range(images) for c in range(2) for g in range(n)]
    det = [(i, c, f"d{k:03d}", rng.choice([.3, .5, .9, rng.random()]), *box()) for i in range(images) for c in range(3) for k in range(n)]
    # Ladders: each box half a step further, so that every detection waits for the one before.
    gt += [(99, 0, g, .1 + .01 * g, .5, .1, .1) for g in range(9)]
    det += [(99, 0, f"l{k:03d}", .95 - .01 * k, .1 + .01 * k + .004, .5, .1, .1) for k in range(9)]
    return det, gt


@pytest.mark.parametrize("walked", [evaluation.WALKED_PAIRS, 12])
def test_crowded_images_by_brute_force(spark, walked):
    """Walked through in tasks, and (images of over 12 pairs) settled by rounds."""
    det, gt = crowd(random.Random(1), 4, 14)
    det.append((7, 0, "alone", .9, .5, .5, .1, .1))
    gt.append((8, 0, 0, .5, .5, 0.0, .1))
    got = evaluation.greedy_matches(spark.createDataFrame(det, DET), spark.createDataFrame(gt, GT), walked_pairs=walked).collect()
    want = plain(det, gt, IOU_THRESHOLDS)
    assert len(got) == len(det)
    for r in got:
        flags = {i for i in range(len(IOU_THRESHOLDS)) if r[f"tp_{i}"]}
        assert flags == want.get((r.image_id, r.class_id, r.det_id), set()), r


def test_a_detection_takes_its_next_box(spark):
    gt = [(1, 0, 0, .50, .5, .2, .2), (1, 0, 1, .54, .5, .2, .2)]
    det = [(1, 0, "a", .9, .50, .5, .2, .2), (1, 0, "b", .8, .51, .5, .2, .2), (1, 0, "c", .7, .5, .5, .2, .2)]
    d, g = spark.createDataFrame(det, DET), spark.createDataFrame(gt, GT)
    greedy = {r.det_id: r.tp_0 for r in evaluation.greedy_matches(d, g, (0.5,)).collect()}
    claims = {r.det_id: r.tp_0 for r in evaluation.detection_matches(d, g, (0.5,)).collect()}
    assert greedy == {"a": 1, "b": 1, "c": 0} and claims == {"a": 1, "b": 0, "c": 0}
    ap = evaluation.per_class_ap(evaluation.ap_by_threshold(d, g, (0.5,), matching=evaluation.greedy_matches)).first()
    assert ap.ap50 == 1.0


def test_nothing_to_match(spark):
    none = evaluation.greedy_matches(spark.createDataFrame([(1, 0, "a", .9, .5, .5, .2, .2)], DET), spark.createDataFrame([], GT))
    assert [r.tp_9 for r in none.collect()] == [0]
    assert evaluation.greedy_matches(spark.createDataFrame([], DET), spark.createDataFrame([], GT)).collect() == []


@pytest.mark.parametrize("kind", [pa.int64(), pa.string()])
def test_the_walk_takes_its_columns_as_arrays(monkeypatch, kind):
    """Boxes of any kind of id, keys beyond 2^53 and rows without a box; no value is made one by one."""
    ids = [str(1 << 60), str((1 << 60) + 1), None, str(1 << 60)]
    batch = pa.RecordBatch.from_pydict({
        "image_id": [1, 1, 1, 1], "class_id": [0, 0, 0, 0], "det_id": ["a", "a", "b", "c"], "__k": [1, 1, 2, 3], "__r": [1, 1, 2, 3],
        "gt_id": pa.array(ids).cast(kind), "__mask": pa.array([1, 3, 0, 3], pa.int32())})
    monkeypatch.setattr(evaluation, "_values", spy := Spy(evaluation._values))
    got = pa.Table.from_batches(evaluation._walk_all(iter([batch]), 2)).to_pylist()
    assert [(r["det_id"], r["__mask"]) for r in got] == [("a", 3), ("b", 0), ("c", 2)] and spy.calls == 2


class Spy:
    def __init__(self, f):
        self.f, self.calls = f, 0

    def __call__(self, column):
        self.calls += 1
        return self.f(column)

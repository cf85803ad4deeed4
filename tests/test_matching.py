import random

import pytest
from pyspark.sql import functions as F

from labelsieve.operators import evaluation
from labelsieve.params import IOU_THRESHOLDS
from labelsieve.session import materialize
from labelsieve.sources import testdata as td

from test_greedy import DET, GT, crowd

MATCHINGS = [evaluation.detection_matches, evaluation.greedy_matches]


def tables(spark):
    det, gt = crowd(random.Random(5), 4, 14)
    det += [(5, 0, "same", .8, .5, .5, .2, .2)] * 2 + [(5, 0, "other", .7, .5, .5, .2, .2), (None, 0, "lost", .7, .5, .5, .2, .2)]
    gt += [(5, 0, g, .5, .5, .2, .2) for g in range(2)]
    return (spark.createDataFrame(det, DET).repartition(3), spark.createDataFrame(gt, GT).repartition(3))


def rows(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("matching", MATCHINGS)
def test_ordinary_groups_are_shuffled_by_image_and_class_only(spark, matching):
    """Each table once; detections are neither copied for the cells they may meet a box in, nor for each threshold."""
    det, gt = tables(spark)
    plan = matching(det, gt)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") <= 2, plan


@pytest.mark.parametrize("matching", MATCHINGS)
@pytest.mark.parametrize("limit", ["COMPARED_BOXES", "TASK_DETECTIONS"])
def test_large_groups_beside_ordinary_ones(spark, monkeypatch, matching, limit):
    """Whichever way a group is settled: the same flags, a row per detection, and the same AP."""
    det, gt = tables(spark)
    det = det.crossJoin(spark.createDataFrame([("a",), ("b",)], "arm string")).filter("arm = 'a' or det_id < 'd007'")
    want, ap = rows(matching(det, gt, keys=("arm",))), rows(evaluation.ap_by_threshold(det, gt, keys=("arm",), matching=matching))
    assert len(want) == det.count() and sum(r.tp_0 for r in want) > 10
    monkeypatch.setattr(evaluation, limit, 12)
    assert rows(matching(det, gt, keys=("arm",))) == want
    assert rows(evaluation.ap_by_threshold(det, gt, keys=("arm",), matching=matching)) == ap


@pytest.mark.parametrize("batch", ["1", "7"])
def test_the_walk_goes_on_across_batches(spark, batch):
    det, gt = tables(spark)
    want = rows(evaluation.greedy_matches(det, gt))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert rows(evaluation.greedy_matches(det, gt)) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_flags_are_packed_for_the_ranks(spark):
    det, gt = tables(spark)
    packed = evaluation.detection_matches(det, gt, packed=True)
    bits = [F.sum(F.getbit("__mask", F.lit(i)).cast("int")) for i in range(len(IOU_THRESHOLDS))]
    flags = evaluation.detection_matches(det, gt)
    assert list(packed.agg(*bits).first()) == list(flags.agg(*[F.sum(f"tp_{i}") for i in range(len(IOU_THRESHOLDS))]).first())


def test_boxes_numbered_by_image_and_class_are_not_dealt_again(spark):
    """The view's own shuffle is the one that the join needs."""
    lines = materialize(td.lines_v(spark, "/root/testdata/sf0.001"), "lines")
    for det, gt in ((td.detections_v, td.ground_truth_v), (td.crowded_detections_v, td.crowded_ground_truth_v)):
        plan = evaluation.detection_matches(det(spark, "", lines=lines).hint("merge"), gt(spark, "", lines=lines))
        assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_groups_are_counted_by_class_in_crowded_images_only(spark, monkeypatch):
    det, gt = tables(spark)
    counted = []
    broadcast = evaluation.checked_broadcast
    monkeypatch.setattr(evaluation, "checked_broadcast", lambda df: counted.append(df.columns) or broadcast(df))
    want = rows(evaluation.detection_matches(det, gt))
    assert counted == [["image_id"]]
    monkeypatch.setattr(evaluation, "COMPARED_BOXES", 14)  # 28 boxes in an image, 14 of a class; another image holds fewer
    assert rows(evaluation.detection_matches(det, gt)) == want
    assert counted == [["image_id"], ["image_id"], ["image_id", "class_id"]]


@pytest.mark.parametrize("matching", MATCHINGS)
@pytest.mark.parametrize("boxes", [evaluation.COMPARED_BOXES, 12])
def test_a_detection_of_several_sets_is_dealt_once(spark, monkeypatch, matching, boxes):
    det, gt = tables(spark)
    sets = F.when(F.col("det_id") < "d007", F.array(F.lit("a"), F.lit("b"))).when(
        F.col("det_id") < "d009", F.array(F.lit("b"))).when(F.col("det_id") < "d010", F.array().cast("array<string>"))
    folded = det.withColumn("arm", F.coalesce(sets, F.array(F.lit("a"))))
    plain = folded.withColumn("arm", F.explode("arm"))
    monkeypatch.setattr(evaluation, "COMPARED_BOXES", boxes)
    assert rows(matching(folded, gt, keys=("arm",))) == rows(matching(plain, gt, keys=("arm",)))
    ap = [rows(evaluation.ap_by_threshold(d, gt, keys=("arm",), matching=matching)) for d in (folded, plain)]
    assert ap[0] == ap[1]


def test_arms_share_their_detections(spark):
    sf = "/root/testdata/sf0.001"
    got = td.arm_detections_v(spark, sf, {"mined": 11, "random": 7}).withColumn("arm", F.explode("arm"))
    for arm, mod in (("mined", 11), ("random", 7)):
        assert rows(got.filter(F.col("arm") == arm).drop("arm")) == rows(td.detections_v(spark, sf, mod))

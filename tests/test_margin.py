import math
import os

import pytest
from pyspark.sql import functions as F

from labelsieve.functions.columns import top_two_gap
from labelsieve.operators import mining, scoring
from labelsieve.schemas import DETECTION, PREDICTION
from labelsieve.sources import files

NAN = float("nan")


def test_gap_of_the_two_best(spark):
    cases = [([0.5, 0.2, 0.4], 0.5 - 0.4), ([0.7, 0.7, 0.1], 0.0), ([0.3], 0.3), ([], None), (None, None), ([None, 0.6], 0.6),
             ([None, NAN], None), ([0.1, NAN, 0.4, None], 0.4 - 0.1), ([-1.0, -2.0], 1.0), ([0.9, 0.8, 0.9], 0.0)]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, s array<double>")
    got = {r.i: r.gap for r in df.select("i", top_two_gap("s").alias("gap")).collect()}
    assert got == {i: g for i, (_, g) in enumerate(cases)}


def test_margin_of_a_frame(spark):
    rows = [("a", [0.9, 0.1]), ("a", [0.5, 0.5]), ("a", None), ("b", None), ("c", [0.2]), ("c", [0.25, 0.125, 0.25])]
    pred = spark.createDataFrame(rows * 3, "frame_id string, class_scores array<double>")
    got = {r.frame_id: (r.n_margins, r.margin) for r in mining.frame_margins(pred).collect()}
    assert got["b"] == (0, None)
    assert got["a"][0] == 6 and math.isclose(got["a"][1], 0.4, rel_tol=1e-9)
    assert got["c"][0] == 6 and math.isclose(got["c"][1], 0.1, rel_tol=1e-9)
    for parts in (1, 7):  # the mean does not depend on the order of the rows
        again = {r.frame_id: (r.n_margins, r.margin) for r in mining.frame_margins(pred.repartition(parts)).collect()}
        assert again == got


def test_confused_frames_rank_above_sure_ones_and_above_frames_without_scores(spark):
    rows = [(f"v{i}-1", 1, 0.9, [0.9, 0.1 * i]) for i in range(9)] + [("w-1", 1, 0.9, None), ("x-1", -1, 0.0, None)]
    pred = spark.createDataFrame(rows, "frame_id string, class_id int, confidence double, class_scores array<double>")
    scores = mining.frame_scores(pred, {"confusion": 1.0})
    ranks = {r.frame_id: r.combined for r in scores.collect()}
    order = sorted(ranks, key=ranks.get, reverse=True)
    assert order[:9] == [f"v{i}-1" for i in range(8, -1, -1)] and ranks["w-1"] == ranks["x-1"] < ranks["v0-1"]
    both = mining.frame_scores(pred, {"uncertainty": 1.0, "confusion": 3.0})
    assert both.columns == ["frame_id", "uncertainty", "rare_class", "confusion", "uncertainty_norm", "rare_class_norm",
                            "confusion_norm", "combined"]
    with pytest.raises(ValueError, match="unknown signals"):
        mining.frame_scores(pred, {"entropy": 1.0})


def _factory():
    def model():  # nested, so that it is shipped by value
        def predict(paths):
            return [[(1, 0.9, .1, .1, .1, .1, [0.9, 0.2, None])] if p.endswith("1.jpg") else [(1, 0.8, .1, .1, .1, .1)]
                    for p in paths]
        return predict
    return model


def test_scores_are_written_and_older_shards_are_read(spark, tmp_path):
    m = spark.createDataFrame([(f"c-{i}", i) for i in range(4)], "frame_id string, pos long")
    out = str(tmp_path / "o")
    scoring.infer_to_table(spark, m, _factory(), out, shard_size=2, image_dir="/pool")
    # A shard of a release that knew no class scores.
    old = spark.createDataFrame([("c-9", 3, 0.5, .1, .1, .1, .1)], DETECTION).withColumn("shard_id", F.lit(7).cast("long"))
    old.write.mode("append").partitionBy("shard_id").parquet(os.path.join(out, "predictions"))
    pred = files.read_predictions(spark, os.path.join(out, "predictions"))
    assert set(pred.columns) == set(PREDICTION.fieldNames())
    got = {r.frame_id: r.class_scores for r in pred.collect()}
    assert got == {"c-0": None, "c-1": [0.9, 0.2, None], "c-2": None, "c-3": None, "c-9": None}
    margins = {r.frame_id: r.margin for r in mining.frame_margins(pred).collect()}
    assert math.isclose(margins["c-1"], 0.7, rel_tol=1e-9) and margins["c-9"] is None

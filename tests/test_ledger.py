import json
import os

import pytest

from labelsieve.operators import ingest, mining, scoring
from labelsieve.params import CATEGORY_IDS, Params
from labelsieve.plans import ledger, stages
from labelsieve.sources import testdata as td

SF = "/root/testdata/sf0.001"
ALL = ["ingest", "infer", "mine", "prepare", "test", "evaluate"]


def _world(spark, tmp_path):
    def model():  # nested: shipped to the workers by value
        return lambda paths: [[(2, 0.3 + int(p[-5]) / 20, 0.5, 0.25, 0.25, 0.125)] * (int(p[-5]) % 3) for p in paths]
    box = {"x1": 480, "y1": 135, "x2": 800, "y2": 225}
    pool, test = [f"c{v}-{i}" for v in range(4) for i in range(6)], [f"t-{i}" for i in range(3)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"videoName": f, "name": f + ".jpg", "labels": [{"category": "car", "box2d": box}]}
                                for f in pool + test]))

    def images(names):
        return spark.createDataFrame([(n, f"/img/{n}.jpg", "x") for n in names], "frame_id string, path string, source_set string")
    return dict(annotation_paths=[str(path)], categories=spark.createDataFrame(
        [(i, n) for n, i in CATEGORY_IDS.items()], "class_id int, class_name string"), train_images=images(pool),
        test_images=images(test), model_factory=model, model_id="m1", image_dir="/img",
        arm_models={"mined": model, "random": model}, arm_model_ids={"mined": "a", "random": "b"}, test_image_dir="/img",
        params=Params(seed_fraction=0.2, unlabeled_fraction=0.6, val_fraction=0.2, label_budget=6, max_per_scene=3), shard_size=8)


def test_a_changed_parameter_runs_the_stages_behind_it(spark, tmp_path):
    world, root = _world(spark, tmp_path), str(tmp_path / "root")
    first, ran = stages.resume_pipeline(spark, root, **world)
    assert ran == ALL and first.count() == 1
    again, ran = stages.resume_pipeline(spark, root, **world)
    assert ran == [] and again.collect() == first.collect()
    p = world["params"]
    world["params"] = Params(**{**p.__dict__, "label_budget": 4})
    with pytest.raises(ValueError, match="stage mine was run with other params"):
        stages.resume_pipeline(spark, root, **world, on_change="refuse")
    assert stages.resume_pipeline(spark, root, **world)[1] == ["mine", "prepare"]
    world["model_id"], world["arm_model_ids"] = "m2", {"mined": "a2", "random": "b"}
    assert stages.resume_pipeline(spark, root, **world)[1] == ["infer", "mine", "prepare", "test", "evaluate"]


def test_a_stage_that_fails_leaves_no_record(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path))

    def fails():
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        book.run("x", {}, ["out"], {"a": 1}, fails)
    assert book.record("x") is None and book.ran == []
    assert book.run("x", {}, ["out"], {"a": 1}, lambda: {"n": 3}) == {"n": 3}
    assert book.run("x", {}, ["out"], {"a": 1}, fails) == {"n": 3}
    # A table that somebody took away is made again.
    def makes():
        spark.range(3).write.mode("error").parquet(str(tmp_path / "made"))
    for _ in range(2):
        book.run("y", {}, ["made"], {}, makes)
    os.rename(tmp_path / "made", tmp_path / "gone")
    book.run("y", {}, ["made"], {}, makes)
    assert book.ran == ["x", "y", "y"]
    with pytest.raises(ValueError):
        ledger.Ledger(spark, str(tmp_path), "ask")


def test_fingerprints_follow_rows_not_their_order(spark):
    rows = [(i, f"t{i % 5}", None) for i in range(50)]
    a = spark.createDataFrame(rows, "i long, t string, n int")
    assert ledger.fingerprint(spark, a) == ledger.fingerprint(spark, a.repartition(7))
    assert ledger.fingerprint(spark, a) != ledger.fingerprint(spark, a.limit(49))
    assert ledger.fingerprint(spark, a) != ledger.fingerprint(spark, a.unionByName(a.limit(1)))
    assert ledger.fingerprint(spark, "/nowhere/at/all") == "none"


def test_counters_come_with_the_write(spark, tmp_path):
    from pyspark.sql import Observation
    ann, seen = td.annotations_v(spark, SF), Observation("x")
    ann.observe(seen, *ingest.convert_metrics()).write.parquet(str(tmp_path / "ann"))
    assert seen.get == ingest.convert_counters(ann).first().asDict()
    scores, seen = mining.frame_scores(td.predictions_v(spark, SF)), Observation("y")
    scores.observe(seen, *mining.summary_metrics()).write.parquet(str(tmp_path / "scores"))
    stored = spark.read.parquet(str(tmp_path / "scores"))
    assert mining.score_summary(stored, seen=seen.get).collect() == mining.score_summary(stored).collect()


def test_a_model_is_built_once_per_worker(spark, tmp_path):
    built = str(tmp_path / "built")

    def factory():
        with open(built, "a") as f:  # a line per build
            f.write(f"{os.getpid()}\n")
        return lambda paths: [[] for _ in paths]
    m = spark.createDataFrame([(f"c-{i:04d}", i) for i in range(64)], "frame_id string, pos long")
    scoring.infer_to_table(spark, m, factory, str(tmp_path / "o"), 16, image_dir="/p", shards_per_wave=1)
    pids = open(built).read().split()
    assert len(pids) == len(set(pids))  # four waves of tasks


def test_models_kept_by_a_worker_are_few(monkeypatch):
    monkeypatch.setattr(scoring, "_MODELS", {})
    made = []

    def factory(name):
        return lambda: made.append(name) or (lambda paths: name)
    for name in "abacb":
        assert scoring.cached_model(name, factory(name))([]) == name
    assert made == ["a", "b", "c", "b"] and len(scoring._MODELS) == scoring.MODELS_KEPT
    assert scoring.model_key(len) == scoring.model_key(len) != scoring.model_key(max)

import json
import os

from pyspark.sql import functions as F

from labelsieve.operators import evaluation, ingest
from labelsieve.params import CATEGORY_IDS, Params
from labelsieve.plans import stages
from labelsieve.sources import files


def _images(folder, names):
    folder.mkdir()
    for n in names:
        (folder / f"{n}.jpg").write_bytes(b"\0")


def test_pipeline_evaluates_from_its_own_tables(spark, tmp_path):
    def miner():  # nested: shipped to the workers by value
        return lambda paths: [[(int(p[-5]) % 5, 0.3 + int(p[-5]) / 20, 0.4, 0.4, 0.1, 0.1)] * (int(p[-5]) % 3)
                              for p in paths]

    def exact():  # finds every box of the test set, and one too many on t-1
        return lambda paths: [[(2, 0.9, 0.5, 0.25, 0.25, 0.125)]
                              + ([(2, 0.4, 0.9, 0.9, 0.05, 0.05)] if "t-1" in p else []) for p in paths]

    def half():  # misses the even frames
        return lambda paths: [[(2, 0.8, 0.5, 0.25, 0.25, 0.125)] if int(p[-5]) % 2 else [] for p in paths]

    pool = [f"c{v}-{v * 9 + i:03d}" for v in range(7) for i in range(9)]
    test = [f"t-{i}" for i in range(4)]
    _images(tmp_path / "pool", pool)
    _images(tmp_path / "held", test)
    box = {"x1": 480, "y1": 135, "x2": 800, "y2": 225}  # centre (.5, .25), size (.25, .125)
    sources = []
    for name, frames in (("first", pool), ("second", test)):
        (tmp_path / f"{name}.json").write_text(json.dumps(
            [{"videoName": f, "name": f + ".jpg", "labels": [{"category": "car", "box2d": box}]} for f in frames]))
        sources.append(str(tmp_path / f"{name}.json"))
    (tmp_path / "names.json").write_text(json.dumps(CATEGORY_IDS))
    params = Params(seed_fraction=0.2, unlabeled_fraction=0.6, val_fraction=0.2, label_budget=8, max_per_scene=3)
    root = str(tmp_path / "root")
    summary = stages.run_pipeline(
        spark, root, annotation_paths=sources, categories=files.read_categories(spark, str(tmp_path / "names.json")),
        train_images=ingest.image_inventory(spark, str(tmp_path / "pool"), "train"),
        test_images=ingest.image_inventory(spark, str(tmp_path / "held"), "val"), model_factory=miner,
        image_dir=str(tmp_path / "pool"), arm_models={"mined": exact, "random": half},
        test_image_dir=str(tmp_path / "held"), params=params, shard_size=16).first()
    assert (summary.verdict, summary.mined_map50) == ("mined", 1.0)
    assert 0.4 < summary.random_map50 < 0.6
    sizes = {r.split: r["count"] for r in files.read_manifest(spark, os.path.join(root, "splits"))
             .groupBy("split").count().collect()}
    assert sizes == {"seed": 12, "unlabeled": 37, "val": 14, "test": 4}
    picked = files.read_selections(spark, os.path.join(root, "selections"))
    assert picked.filter("arm = 'mined'").count() == 8
    assert picked.groupBy("arm", "video_id").count().agg(F.max("count")).first()[0] <= 3
    arm_rows = spark.read.parquet(os.path.join(root, "arms"))
    assert arm_rows.filter("arm = 'random' and subset = 'train'").count() == 20
    texts = spark.read.parquet(os.path.join(root, "labels", "text"))
    assert texts.count() == 67 and texts.first().text == "2 0.500000 0.250000 0.250000 0.125000"
    comparison = spark.read.parquet(os.path.join(root, "report", "comparison")).collect()
    assert [(r.class_id, r.class_name, r.mined_ap) for r in comparison] == [(2, "car", 1.0)]


def test_detection_ids_are_stable(spark):
    pred = spark.createDataFrame([("f", 1, 0.5, .1, .2, .3, .4), ("f", 0, 0.5, .1, .2, .3, .4), ("f", 2, 0.9, .1, .2, .3, .4),
                                  ("f", -1, 0.0, 0., 0., 0., 0.), ("g", 2, 0.9, .1, .2, .3, .4)],
                                 "frame_id string, class_id int, confidence double, x_center double, y_center double, "
                                 "width double, height double")
    only = spark.createDataFrame([("f",)], "frame_id string")
    for p in (pred, pred.repartition(4)):
        assert sorted((r.det_id, r.class_id) for r in evaluation.detections_of(only, p).collect()) == [(1, 2), (2, 0), (3, 1)]

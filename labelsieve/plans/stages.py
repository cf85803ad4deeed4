"""The pipeline's stages as functions over a data root.

Each stage reads the previous stage's tables and writes its own; every step
inside is a DataFrame plan.  Layout under ``root``::

    splits/        (frame_id, split, pos)       partitioned by split
    annotations    records in source order
    labels/boxes   (frame_id, box_pos, class_id, box)
    labels/lines   (frame_id, box_pos, line)
    labels/text    (frame_id, text)
    labels/frames  (frame_id, n_boxes)
    infer/         predictions/ shards_done/ meta/
    signals/       scores
    selections/    (arm, pick, frame_id, video_id, score)  partitioned by arm
    arms/          (arm, subset, frame_id, image_path, has_image, has_label)
    test/<arm>/    predictions/ shards_done/ meta/
    report/        per_class/ comparison/ summary/
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import arms, evaluation, ingest, mining, scoring
from ..params import Params
from ..sources import files
from .ledger import Ledger


# Frames of a shard, the unit of commit and resume; apart from the model's batch.
SHARD_SIZE = 4096


def _p(root: str, *parts: str) -> str:
    return os.path.join(root, *parts)


def ingest_stage(spark: SparkSession, root: str, annotation_paths: list[str], categories: DataFrame,
                 train_images: DataFrame, test_images: DataFrame | None = None,
                 params: Params = Params()) -> dict:
    """Label boxes from annotation files, then exact splits of the image inventory."""
    params.check_fractions()
    # The JSON arrays are parsed once, then everything reads Parquet.
    # The counters are gathered while the records go by.
    seen = Observation("annotations")
    read = files.read_annotations(spark, annotation_paths).observe(seen, *ingest.convert_metrics())
    read.write.mode("overwrite").parquet(_p(root, "annotations"))
    counters = seen.get
    ann = spark.read.parquet(_p(root, "annotations"))
    boxes = ingest.label_boxes(ann, categories, params.image_width, params.image_height)
    boxes.write.mode("overwrite").parquet(_p(root, "labels", "boxes"))
    lines = ingest.yolo_lines(spark.read.parquet(_p(root, "labels", "boxes")))
    files.write_label_lines(lines, _p(root, "labels", "lines"))
    files.write_label_texts(ingest.yolo_text(spark.read.parquet(_p(root, "labels", "lines")),
                                             ingest.labeled_frames(ann)), _p(root, "labels", "text"))
    ingest.labeled_frames(ann).write.mode("overwrite").parquet(_p(root, "labels", "frames"))
    manifest = ingest.split_frames(train_images, params, test_images)
    files.write_manifest(manifest, _p(root, "splits"))
    return counters


def infer_stage(spark: SparkSession, root: str, model_factory, image_dir: str,
                params: Params = Params(), shard_size: int = SHARD_SIZE) -> dict:
    """Resumable inference over the unlabeled split, committed by shards of thousands of frames."""
    unl = files.read_manifest(spark, _p(root, "splits"), "unlabeled")
    return scoring.infer_to_table(spark, unl.select("frame_id", "pos"), model_factory, _p(root, "infer"),
                                  shard_size, params.batch, params.conf_threshold,
                                  image_dir=image_dir)


def mine_stage(spark: SparkSession, root: str, params: Params = Params()) -> DataFrame:
    """J3 + J4: scores, then both selections."""
    pred = files.read_predictions(spark, _p(root, "infer", "predictions"),
                                  spark.read.parquet(_p(root, "infer", "shards_done")))
    seen = Observation("scores")
    scores = mining.frame_scores(pred, params.weights, params.band_low, params.band_high)
    files.write_scores(scores.observe(seen, *mining.summary_metrics()), _p(root, "signals", "scores"))
    scores = spark.read.parquet(_p(root, "signals", "scores"))
    sel = mining.selections(scores, params.label_budget, params.max_per_scene, params.seed)
    files.write_selections(sel, _p(root, "selections"))
    return mining.score_summary(scores, seen=seen.get)


def prepare_stage(spark: SparkSession, root: str, inventory: DataFrame) -> DataFrame:
    """Arm manifests (train = seed + selection, shared val)."""
    splits = files.read_manifest(spark, _p(root, "splits"))
    sel = files.read_selections(spark, _p(root, "selections"))
    labeled = spark.read.parquet(_p(root, "labels", "frames"))
    manifest = arms.arm_manifest(splits, sel, inventory, labeled)
    files.write_arms(manifest, _p(root, "arms"))
    return arms.arm_summary(spark.read.parquet(_p(root, "arms")))


def predict_test(spark: SparkSession, root: str, arm_models: dict, image_dir: str,
                     params: Params = Params(), shard_size: int = SHARD_SIZE) -> DataFrame:
    """Each arm's model over the test split, resumable like J2: ``(arm, prediction columns)``."""
    test = files.read_manifest(spark, _p(root, "splits"), "test").select("frame_id", "pos")
    for arm, model_factory in arm_models.items():
        scoring.infer_to_table(spark, test, model_factory, _p(root, "test", arm), shard_size, params.batch,
                               params.conf_threshold, image_dir=image_dir)
    return stored_test_predictions(spark, root, arm_models)


def evaluate_stage(spark: SparkSession, root: str, predictions: DataFrame, categories: DataFrame) -> DataFrame:
    """J6 + J7: per-class AP of each arm on the test split, and the comparison.

    Ground truth are the stored label boxes of the test split's frames;
    ``predictions`` carry an ``arm``, and all arms are evaluated in one pass.
    """
    test = files.read_manifest(spark, _p(root, "splits"), "test").select("frame_id")
    gt = evaluation.ground_truth_of(test, spark.read.parquet(_p(root, "labels", "boxes")))
    det = evaluation.detections_of(test, predictions, keys=("arm",))
    ap = evaluation.ap_by_threshold(det, gt, keys=("arm",))
    evaluation.per_class_ap(ap, categories).write.mode("overwrite").parquet(_p(root, "report", "per_class"))
    per = spark.read.parquet(_p(root, "report", "per_class"))
    (evaluation.compare_arms(per.filter("arm = 'mined'"), per.filter("arm = 'random'"))
     .write.mode("overwrite").parquet(_p(root, "report", "comparison")))
    summary = evaluation.compare_summary(evaluation.map_summary(per))
    files.write_summary_json(summary, _p(root, "report", "summary"))
    return summary


def run_pipeline(spark: SparkSession, root: str, *, annotation_paths, categories, train_images,
                 test_images, model_factory, image_dir, arm_models: dict, test_image_dir,
                 params: Params = Params(), shard_size: int = SHARD_SIZE) -> DataFrame:
    """Every stage in order; returns the comparison summary.

    ``arm_models`` (arm -> model factory) are the detectors trained on the arms.
    """
    ingest_stage(spark, root, annotation_paths, categories, train_images, test_images, params)
    infer_stage(spark, root, model_factory, image_dir, params, shard_size)
    mine_stage(spark, root, params)
    prepare_stage(spark, root, train_images)
    predictions = predict_test(spark, root, arm_models, test_image_dir, params, shard_size)
    return evaluate_stage(spark, root, predictions, categories)


def resume_pipeline(spark: SparkSession, root: str, *, annotation_paths, categories, train_images, test_images,
                    model_factory, model_id: str, image_dir, arm_models: dict, arm_model_ids: dict, test_image_dir,
                    params: Params = Params(), shard_size: int = SHARD_SIZE,
                    on_change: str = "rerun") -> tuple[DataFrame, list[str]]:
    """J8 with a ledger: only stages whose inputs, parameters or tables changed run.

    ``model_id`` and ``arm_model_ids`` (arm -> id) name the models, whose code and weights
    cannot be looked into.  Returns the comparison summary and the stages that ran.
    """
    ledger = Ledger(spark, root, on_change)
    p = params

    def counted(work):
        def run():
            out = work()
            return out if isinstance(out, dict) else None
        return run
    ledger.run("ingest", {"annotations": list(annotation_paths), "categories": categories, "train": train_images,
                          **({"test": test_images} if test_images is not None else {})},
               ["annotations", "labels", "splits"],
               {"fractions": [p.seed_fraction, p.unlabeled_fraction, p.val_fraction], "seed": p.seed,
                "size": [p.image_width, p.image_height]},
               counted(lambda: ingest_stage(spark, root, annotation_paths, categories, train_images, test_images, p)))
    scoring_params = {"batch": p.batch, "conf": p.conf_threshold, "shard_size": shard_size}
    ledger.run("infer", {"splits": _p(root, "splits", "split=unlabeled")}, ["infer"],
               {**scoring_params, "model": model_id, "images": image_dir},
               counted(lambda: infer_stage(spark, root, model_factory, image_dir, p, shard_size)))
    ledger.run("mine", {"predictions": [_p(root, "infer", "predictions"), _p(root, "infer", "shards_done")]},
               ["signals", "selections"],
               {"weights": p.weights, "band": [p.band_low, p.band_high], "budget": p.label_budget, "cap": p.max_per_scene,
                "seed": p.seed}, counted(lambda: mine_stage(spark, root, p)))
    ledger.run("prepare", {"splits": _p(root, "splits"), "selections": _p(root, "selections"), "train": train_images,
                           "labels": _p(root, "labels", "frames")}, ["arms"], {},
               counted(lambda: prepare_stage(spark, root, train_images)))
    ledger.run("test", {"splits": _p(root, "splits", "split=test")}, ["test"],
               {**scoring_params, "models": arm_model_ids, "images": test_image_dir},
               counted(lambda: predict_test(spark, root, arm_models, test_image_dir, p, shard_size)))
    ledger.run("evaluate", {"predictions": _p(root, "test"), "labels": _p(root, "labels", "boxes"),
                            "splits": _p(root, "splits", "split=test"), "categories": categories}, ["report"], {},
               counted(lambda: evaluate_stage(spark, root, stored_test_predictions(spark, root, arm_models), categories)))
    return spark.read.json(_p(root, "report", "summary")), ledger.ran


def stored_test_predictions(spark: SparkSession, root: str, arms_: dict) -> DataFrame:
    """The committed test predictions of every arm: ``(arm, prediction columns)``."""
    out = None
    for arm in sorted(arms_):
        folder = _p(root, "test", arm)
        pred = files.read_predictions(spark, _p(folder, "predictions"), spark.read.parquet(_p(folder, "shards_done")))
        pred = pred.select(F.lit(arm).alias("arm"), *pred.columns)
        out = pred if out is None else out.unionByName(pred)
    return out

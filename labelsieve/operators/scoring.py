"""Inference over the unlabeled pool: shards, resume, model scoring, sentinels.

The model runs inside ``mapInPandas`` tasks (Arrow batches in, Arrow out); it
is built once per worker process by a user factory.  Work is committed by shard, in
waves: each wave is one partitioned write followed by an append of its shard
ids to ``shards_done``; only shards listed there count as complete, so a crash
loses at most the wave in flight and re-running it overwrites its partitions.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import SENTINEL_CLASS
from ..schemas import PREDICTION
from ..session import checked_broadcast, scratch_path, ship_package

# A model factory returns ``predict(paths) -> list of detections per path``, each detection
# ``(class_id, confidence, x_center, y_center, width, height[, class_scores])``.
Predict = Callable[[list[str]], list[list[tuple]]]
ModelFactory = Callable[[], Predict]

# Frames that one task scores, unless that leaves cores idle.
FRAMES_PER_TASK = 4096
_DET_COLS = ["class_id", "confidence", "x_center", "y_center", "width", "height"]


def assign_shards(manifest: DataFrame, shard_size: int, pos_col: str = "pos") -> DataFrame:
    """``shard_id = pos div shard_size`` (the unit of commit and resume)."""
    if shard_size <= 0:
        raise ValueError("shard_size must be positive")
    return manifest.withColumn("shard_id", F.floor(F.col(pos_col) / F.lit(shard_size)).cast("long"))


def pending_shards(assigned: DataFrame, done: DataFrame) -> DataFrame:
    """Frames of shards not listed in ``done`` (a whole shard is skipped
    when listed, whatever it holds).  ``done`` is broadcast after a count."""
    done_ids, _ = checked_broadcast(done.select("shard_id").distinct())
    return assigned.join(done_ids, "shard_id", "left_anti")


# Models of this worker process by the key of their factory, the last ones used.
_MODELS: dict[str, Predict] = {}
MODELS_KEPT = 2


def cached_model(key: str, model_factory: ModelFactory) -> Predict:
    """The model of a factory, built once per worker process: tasks of later waves find it there."""
    model = _MODELS.pop(key, None)
    if model is None:
        while len(_MODELS) >= MODELS_KEPT:
            _MODELS.pop(next(iter(_MODELS)))
        model = model_factory()
    _MODELS[key] = model
    return model


def model_key(model_factory: ModelFactory) -> str:
    """Equal factories (code and what it holds) have equal keys."""
    return hashlib.sha256(cloudpickle.dumps(model_factory)).hexdigest()


def _score_batches(model_factory: ModelFactory, batch: int, conf_threshold: float,
                   path_col: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    key = model_key(model_factory)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = cached_model(key, model_factory)
        for pdf in frames:
            rows = []  # one output batch per input Arrow batch
            for start in range(0, len(pdf), batch):
                chunk = pdf.iloc[start:start + batch]
                results = predict(chunk[path_col].tolist())  # one model call per `batch` frames
                if len(results) != len(chunk):
                    raise ValueError("predict returned a different number of results than paths")
                for fid, sid, dets in zip(chunk["frame_id"], chunk["shard_id"], results):
                    kept = [d for d in dets if float(d[1]) >= conf_threshold]  # H2
                    if not kept:  # H3: keep a row so the frame counts as processed
                        rows.append((fid, SENTINEL_CLASS, 0.0, 0.0, 0.0, 0.0, 0.0, None, sid))
                    for d in kept:  # H4: k boxes -> k rows
                        rows.append((fid, int(d[0]), *[float(x) for x in d[1:6]], _scores(d), sid))
            yield pd.DataFrame(rows, columns=["frame_id", *_DET_COLS, "class_scores", "shard_id"])
    return run


def _scores(detection: tuple) -> list[float] | None:
    """The class scores of a detection, if the model gives any."""
    given = detection[6] if len(detection) > 6 else None
    return None if given is None else [None if x is None else float(x) for x in given]


def score_frames(frames: DataFrame, model_factory: ModelFactory, batch: int = 16,
                 conf_threshold: float = 0.25, path_col: str = "path", tasks: int | None = None,
                 resources: ResourceProfile | None = None) -> DataFrame:
    """H1-H4: run the model over ``(frame_id, shard_id, path)`` rows.

    A model is built once per worker process and must not keep state between calls.
    ``resources`` is the profile of the scoring stage alone (GPUs or memory a task), where
    the cluster manager has stage-level scheduling.

    Rows are dealt by hash to ``tasks`` partitions, a number that follows the
    frame count (a few bytes of path a row would make adaptive execution merge
    all of them into one task otherwise).
    """
    ship_package(frames.sparkSession)
    tasks = tasks or scoring_tasks(frames.sparkSession, frames.count())
    shards = (frames.select("frame_id", "shard_id", path_col).repartition(tasks, "frame_id")
                    .sortWithinPartitions("shard_id", path_col))
    return shards.mapInPandas(_score_batches(model_factory, batch, conf_threshold, path_col), PREDICTION, profile=resources)


def scoring_tasks(spark: SparkSession, n_frames: int) -> int:
    """At least one task a core, and no task with much over FRAMES_PER_TASK frames."""
    return max(spark.sparkContext.defaultParallelism, -(-n_frames // FRAMES_PER_TASK))


def with_sentinels(manifest: DataFrame, detections: DataFrame) -> DataFrame:
    """H3 as a join: frames without any detection get one sentinel row."""
    det = detections.select("frame_id", *_DET_COLS)
    joined = manifest.select("frame_id").join(det, "frame_id", "left")
    miss = F.col("class_id").isNull()
    return joined.select(
        "frame_id",
        F.when(miss, F.lit(SENTINEL_CLASS)).otherwise(F.col("class_id")).cast("int").alias("class_id"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in _DET_COLS[1:]],
    )


def manifest_fingerprint(manifest: DataFrame) -> DataFrame:
    """Fingerprint of a manifest: row count and two sums of 64-bit hashes of (frame, position)."""
    def total(*seed) -> Column:
        return F.sum(F.xxhash64("frame_id", "pos", *seed).cast("decimal(38,0)")).cast("string")
    return manifest.agg(F.count(F.lit(1)).alias("n_frames"), F.concat_ws(":", total(), total(F.lit(1))).alias("id_hash"))


META = "n_frames long, id_hash string, shard_size long, conf_threshold double"


def open_run(spark: SparkSession, manifest: DataFrame, out_dir: str, shard_size: int, conf_threshold: float) -> None:
    """Note what the predictions in ``out_dir`` are made for, or refuse to go on with others.

    With another manifest, positions, shard size or confidence floor, shard numbers or contents
    would silently change meaning.
    """
    meta_dir = os.path.join(out_dir, "meta")
    fp = manifest_fingerprint(manifest).first()
    meta = {"n_frames": fp["n_frames"], "id_hash": fp["id_hash"], "shard_size": shard_size,
            "conf_threshold": float(conf_threshold)}
    if path_exists(spark, meta_dir):
        old = spark.read.parquet(meta_dir).first().asDict()
        if old != meta:
            raise ValueError(f"predictions in {out_dir} were made for another manifest/shard size: {old}")
    else:
        spark.createDataFrame([meta], META).coalesce(1).write.mode("overwrite").parquet(meta_dir)


def infer_to_table(spark: SparkSession, manifest: DataFrame, model_factory: ModelFactory,
                   out_dir: str, shard_size: int, batch: int = 16, conf_threshold: float = 0.25,
                   shards_per_wave: int | None = None, image_dir: str | None = None,
                   resources: ResourceProfile | None = None) -> dict:
    """Resumable inference of ``manifest`` (``frame_id, pos[, path]``) into
    ``out_dir/predictions`` (partitioned by ``shard_id``).

    A wave gives every core several tasks; the pending frames are written once,
    partitioned by wave, so a wave reads its own frames only.  Refuses to resume
    when the manifest, its positions, ``shard_size`` or ``conf_threshold``
    changed, because shard numbers or contents would silently change meaning.
    Returns counters (D9).
    """
    from ..functions.columns import image_path
    done_dir = os.path.join(out_dir, "shards_done")
    pred_dir = os.path.join(out_dir, "predictions")
    open_run(spark, manifest, out_dir, shard_size, conf_threshold)
    if shards_per_wave is None:
        # Several tasks a core.
        frames_per_wave = 4 * spark.sparkContext.defaultParallelism * FRAMES_PER_TASK
        shards_per_wave = max(1, frames_per_wave // shard_size)
    frames = manifest
    if "path" not in manifest.columns:
        if image_dir is None:
            raise ValueError("manifest has no path column and no image_dir was given")
        frames = manifest.withColumn("path", image_path(image_dir, "frame_id"))
    assigned = assign_shards(frames, shard_size).withColumn(
        "wave", F.floor(F.col("shard_id") / F.lit(shards_per_wave)).cast("long"))
    done = (spark.read.parquet(done_dir) if path_exists(spark, done_dir)
            else spark.createDataFrame([], "shard_id long"))
    pending = pending_shards(assigned, done)
    # A row per wave: gaps that an earlier run left open cost no job.
    waves = pending.groupBy("wave").agg(F.countDistinct("shard_id").alias("n")).orderBy("wave").collect()
    n_total = assigned.agg(F.countDistinct("shard_id")).first()[0]
    if waves:
        todo = scratch_path(spark, "waves")
        pending.select("frame_id", "shard_id", "path", "wave").write.partitionBy("wave").parquet(todo)
        tasks = scoring_tasks(spark, shards_per_wave * shard_size)
        for w in waves:
            wave = spark.read.parquet(todo).filter(F.col("wave") == w["wave"]).drop("wave")
            scored = score_frames(wave, model_factory, batch, conf_threshold, tasks=tasks,
                                  resources=resources).repartition("shard_id")
            (scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                   .partitionBy("shard_id").parquet(pred_dir))
            wave.select("shard_id").distinct().write.mode("append").parquet(done_dir)
    processed = sum(w["n"] for w in waves)  # a wave holds whole shards
    return {"shards_total": n_total, "shards_processed": processed,
            "shards_skipped": n_total - processed}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``; a store that cannot be reached raises."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)

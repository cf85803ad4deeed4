"""Streaming inference that commits shards: the stream's result is that of the batch job.

Frames of a manifest arrive in files, in any order; the frames of a shard may come in
several micro-batches.  Keyed state (a bitmap of the positions that came, per shard)
drops frames that come twice and closes a shard when its last frame is there.  A
micro-batch then

1. scores its new frames,
2. keeps the rows of shards that are still open under ``staged/shard_id=S/batch=N``,
3. writes the whole shard of every closed one to ``predictions/shard_id=S``,
4. appends the closed shards to ``shards_done``, the commit log of ``infer_to_table``.

A replayed micro-batch comes from the same files and the same state, overwrites the
same folders and logs the same shards again (the log is read as a set), so each
frame counts once whatever fails in between.  Readers, mining and a batch job that takes up
where the stream ended (``infer_to_table`` on the same folder) see committed shards only.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import image_path
from ..operators.scoring import ModelFactory, assign_shards, open_run, path_exists, score_frames
from ..schemas import PREDICTION
from ..session import materialize, ship_package

ARRIVALS = "frame_id string, pos long"
_STATE = T.StructType([T.StructField("seen", T.BinaryType())])
_CAME = "frame_id string, shard_id long, closed boolean"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ShardProgress(StatefulProcessor):
    """Per shard the positions that came; new frames go on, and one row with ``closed`` when all are there."""

    def __init__(self, shard_size: int):
        self.shard_size = shard_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seen", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = self.state.get() if self.state.exists() else None
        seen = np.zeros(self.shard_size, dtype=bool)
        if old is not None:
            seen = np.unpackbits(np.frombuffer(old[0], np.uint8), count=self.shard_size).astype(bool)
        was, expected = int(seen.sum()), 0
        for part in rows:
            part = part.drop_duplicates("pos")
            at = part["pos"].to_numpy() % self.shard_size
            part, fresh = part[~seen[at]], at[~seen[at]]
            expected = int(part["expected"].iloc[0]) if len(part) else expected
            seen[fresh] = True
            if len(part):
                yield pd.DataFrame({"frame_id": part["frame_id"], "shard_id": key[0], "closed": False})
        now = int(seen.sum())
        if now == was:
            return
        self.state.update((np.packbits(seen).tobytes(),))
        if now == expected:
            yield pd.DataFrame({"frame_id": [None], "shard_id": [key[0]], "closed": [True]})

    def close(self) -> None:
        pass


def stream_inference(spark: SparkSession, manifest: DataFrame, arrivals_dir: str, out_dir: str, checkpoint: str,
                     model_factory: ModelFactory, image_dir: str, shard_size: int, batch: int = 16,
                     conf_threshold: float = 0.25, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``.

    ``manifest`` (frame_id, pos) is the whole manifest; the files in ``arrivals_dir`` hold rows
    of it.  Refuses, like the batch job, a folder made for another manifest, shard size or
    confidence floor.  A frame of a shard that the manifest does not have fails the stream.
    """
    ship_package(spark)
    open_run(spark, manifest, out_dir, shard_size, conf_threshold)
    sizes = materialize(assign_shards(manifest.select("pos").distinct(), shard_size)
                        .groupBy("shard_id").agg(F.count(F.lit(1)).alias("expected")), "shard-sizes")
    unknown = F.raise_error(F.concat(F.lit("not in the manifest: shard "), F.col("shard_id").cast("string")))
    came = (assign_shards(spark.readStream.schema(ARRIVALS).parquet(arrivals_dir), shard_size)
            .join(sizes, "shard_id", "left")
            .select("frame_id", "pos", "shard_id",
                    F.when(F.col("expected").isNull(), unknown.cast("long")).otherwise(F.col("expected")).alias("expected")))
    # Typed state lives in RocksDB.
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        progress = came.groupBy("shard_id").transformWithStateInPandas(
            ShardProgress(shard_size), outputStructType=_CAME, outputMode="Append", timeMode="None")

        def write_batch(rows: DataFrame, batch_id: int) -> None:
            commit_batch(rows, batch_id, out_dir, model_factory, image_dir, batch, conf_threshold)
        writer = progress.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def commit_batch(rows: DataFrame, batch_id: int, out_dir: str, model_factory: ModelFactory, image_dir: str,
                 batch: int, conf_threshold: float) -> None:
    """Score a micro-batch ``(frame_id, shard_id, closed)`` and commit the shards it closes; may run again."""
    spark = rows.sparkSession
    staged_dir, pred_dir, done_dir = (os.path.join(out_dir, x) for x in ("staged", "predictions", "shards_done"))
    rows = materialize(rows, "arrivals")  # the state is asked once
    frames = rows.filter("not closed").select("frame_id", "shard_id", image_path(image_dir, "frame_id").alias("path"))
    closed = rows.filter("closed").select("shard_id")
    if frames.isEmpty():
        return
    scored = materialize(score_frames(frames, model_factory, batch, conf_threshold), "scored")

    def write(df: DataFrame, path: str, *by: str) -> None:
        (df.repartition("shard_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(path))
    write(scored.join(closed, "shard_id", "left_anti").withColumn("batch", F.lit(batch_id).cast("long")),
          staged_dir, "shard_id", "batch")
    if closed.isEmpty():
        return
    whole = scored
    if path_exists(spark, staged_dir):
        schema = T.StructType([*PREDICTION.fields, T.StructField("batch", T.LongType())])
        earlier = spark.read.schema(schema).parquet(staged_dir).filter(F.col("batch") < batch_id).drop("batch")
        whole = scored.unionByName(earlier)
    write(whole.join(closed, "shard_id", "left_semi"), pred_dir, "shard_id")
    closed.write.mode("append").parquet(done_dir)

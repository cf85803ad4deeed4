"""Structured Streaming form of the inference stage.

New manifest files dropped into a folder are scored as they arrive: a file
stream source, ``foreachBatch`` running the same ``score_frames`` plan, and a
checkpoint that records which files were consumed.  Each micro-batch has a folder
of its own, which a replay of that batch overwrites: exactly once, also when frames
of one shard arrive in several batches.  ``trigger(availableNow=True)`` processes
everything present and stops, which makes it a resumable batch job too.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import image_path
from ..operators.scoring import ModelFactory, score_frames

_MANIFEST_SCHEMA = "frame_id string, shard_id long"


def stream_scores(spark: SparkSession, manifest_dir: str, out_dir: str, checkpoint: str,
                  model_factory: ModelFactory, image_dir: str, batch: int = 16,
                  conf_threshold: float = 0.25, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``.

    Manifest files carry ``(frame_id, shard_id)``; predictions go to
    ``out_dir/batch=<id>``, so reading ``out_dir`` gives all of them with the
    batch as a partition column.
    """
    frames = (spark.readStream.schema(_MANIFEST_SCHEMA).parquet(manifest_dir)
              .withColumn("path", image_path(image_dir, "frame_id")))

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        scored = score_frames(batch_df, model_factory, batch, conf_threshold)
        scored.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))

    writer = frames.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()

"""Readers and writers of the pipeline's files.

Missing inputs raise (Spark's PATH_NOT_FOUND, or ``ValueError`` for an empty
inventory) instead of logging and returning: a deliberate change, so a stage
never silently writes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ANNOTATION, CATEGORY, MANIFEST, PREDICTION, SCORES, SELECTION
from .json_array import RANGE_BYTES, read_json_array


def read_annotations(spark: SparkSession, paths: str | list[str], multiline: bool = True,
                     sequence: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A1: annotation records with ``seq`` = (rank of the source, position in it), compared in that order.

    ``paths`` are sources in the order that counts: a record of a later source is
    later than any of an earlier one, whatever their sizes and positions.  A JSON array file
    (``multiline``, one file per source) is read by a task per ``range_bytes``, and the
    position is the record's byte offset.  JSON Lines are split over tasks by Spark, so
    their records must carry their own position in a column ``sequence``.
    """
    if not multiline and sequence is None:
        raise ValueError("JSON Lines need a sequence column")
    schema = ANNOTATION if sequence is None else T.StructType([*ANNOTATION.fields, T.StructField(sequence, T.LongType())])
    out = None
    for rank, path in enumerate([paths] if isinstance(paths, str) else paths):
        if multiline:
            df, position = read_json_array(spark, path, schema, range_bytes), F.col("position")
        else:
            df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        if sequence is not None:
            position = F.col(sequence)
        df = df.withColumn("seq", F.struct(F.lit(rank).alias("source"), position.alias("position")))
        df = df.select(*ANNOTATION.fieldNames(), "seq")
        out = df if out is None else out.unionByName(df)
    return out


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """A2: the ``name -> id`` JSON object as a ``(class_id, class_name)`` table.

    The file is a small configuration object, parsed on the driver.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    mapping = json.loads(text)
    return spark.createDataFrame([(int(i), str(n)) for n, i in mapping.items()], CATEGORY)


def read_manifest(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A4: split manifest (partition pruning on ``split``)."""
    df = spark.read.schema(MANIFEST).parquet(path)
    return df.filter(F.col("split") == split) if split else df


def read_predictions(spark: SparkSession, path: str, done: DataFrame | None = None) -> DataFrame:
    """A5: prediction shards (the ``shard_id`` partition folders).

    With ``done`` (shard_id) only committed shards count: a crash may leave
    folders of a wave that was never finished.  Shards written before detections
    carried ``class_scores`` are read with null there.
    """
    pred = spark.read.schema(PREDICTION).parquet(path)
    return pred if done is None else pred.join(done.select("shard_id").distinct(), "shard_id", "left_semi")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """A6."""
    return spark.read.schema(SCORES).parquet(path)


def read_selections(spark: SparkSession, path: str, arm: str | None = None) -> DataFrame:
    df = spark.read.schema(SELECTION).parquet(path)
    return df.filter(F.col("arm") == arm) if arm else df


def write_manifest(df: DataFrame, path: str) -> None:
    """One table partitioned by ``split``; replaces every split of an earlier run."""
    _replace(df.select("frame_id", "split", "pos"), path, "split")


def write_scores(df: DataFrame, path: str) -> None:
    """A9."""
    df.write.mode("overwrite").parquet(path)


def write_selections(df: DataFrame, path: str) -> None:
    """A10: both arms, partitioned by ``arm``; replaces every arm of an earlier run."""
    _replace(df, path, "arm")


def write_arms(df: DataFrame, path: str) -> None:
    """Arm manifests, partitioned by ``arm``; replaces every arm of an earlier run."""
    _replace(df, path, "arm")


def _replace(df: DataFrame, path: str, partition: str) -> None:
    # Static overwrite whatever the session says: partitions that are not written again go.
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition).parquet(path)


def write_label_lines(lines: DataFrame, path: str) -> None:
    """Label lines as a table ``(frame_id, box_pos, line)``, clustered by frame."""
    lines.repartition("frame_id").sortWithinPartitions("frame_id", "box_pos") \
        .write.mode("overwrite").parquet(path)


def write_label_texts(texts: DataFrame, path: str) -> None:
    """One row ``(frame_id, text)`` per label file."""
    texts.write.mode("overwrite").parquet(path)


def write_summary_json(df: DataFrame, path: str) -> None:
    """A one-row summary as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)

"""Declared schemas of every table the pipeline reads or writes."""

from pyspark.sql import types as T

BOX2D = T.StructType([
    T.StructField("x1", T.DoubleType()),
    T.StructField("y1", T.DoubleType()),
    T.StructField("x2", T.DoubleType()),
    T.StructField("y2", T.DoubleType()),
])

LABEL = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("box2d", BOX2D),
    T.StructField("attributes", T.StructType([
        T.StructField("occluded", T.BooleanType()),
        T.StructField("truncated", T.BooleanType()),
    ])),
])

ANNOTATION = T.StructType([
    T.StructField("videoName", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("labels", T.ArrayType(LABEL)),
    T.StructField("attributes", T.StructType([
        T.StructField("weather", T.StringType()),
        T.StructField("timeofday", T.StringType()),
        T.StructField("scene", T.StringType()),
    ])),
])

CATEGORY = T.StructType([
    T.StructField("class_id", T.IntegerType(), False),
    T.StructField("class_name", T.StringType(), False),
])

MANIFEST = T.StructType([
    T.StructField("frame_id", T.StringType()),
    T.StructField("split", T.StringType()),
    T.StructField("pos", T.LongType()),
])

DETECTION = T.StructType([
    T.StructField("frame_id", T.StringType()),
    T.StructField("class_id", T.IntegerType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("x_center", T.DoubleType()),
    T.StructField("y_center", T.DoubleType()),
    T.StructField("width", T.DoubleType()),
    T.StructField("height", T.DoubleType()),
])

# The score of every class for a detection, where the model gives them (S7); older shards have none.
CLASS_SCORES = T.StructField("class_scores", T.ArrayType(T.DoubleType()))

PREDICTION = T.StructType(DETECTION.fields + [CLASS_SCORES, T.StructField("shard_id", T.LongType())])

SCORES = T.StructType([
    T.StructField("frame_id", T.StringType()),
    T.StructField("uncertainty", T.LongType()),
    T.StructField("rare_class", T.DoubleType()),
    T.StructField("uncertainty_norm", T.DoubleType()),
    T.StructField("rare_class_norm", T.DoubleType()),
    T.StructField("combined", T.DoubleType()),
])

SELECTION = T.StructType([
    T.StructField("arm", T.StringType()),
    T.StructField("pick", T.LongType()),
    T.StructField("frame_id", T.StringType()),
    T.StructField("video_id", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

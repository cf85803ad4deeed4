"""Adapter views that shape the driver's TPC-H-like tables as pipeline inputs.

Mapping: order = frame, customer = video (group), line item = detection,
``p_size % 13`` = class, quantity = confidence.  The same views are written as
SQL in ``plans.oracle`` so DuckDB can check every query.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import TASK_ROWS

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
# The orders that number the boxes of an order, and of a supplier.
LINE_KEY = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
CROWD_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def frame_key(custkey: Column, orderkey: Column) -> Column:
    """``cccccccc-oooooooo``: the video (customer) prefix makes ``video_key`` work."""
    def padded(key: Column) -> Column:  # longer keys stay whole
        text = key.cast("string")
        return F.lpad(text, F.greatest(F.lit(8), F.length(text)), F.lit("0"))
    return F.concat(padded(custkey), F.lit("-"), padded(orderkey))


def class_of(p_size: Column) -> Column:
    return (p_size % 13).cast("int")


def confidence_of(quantity: Column) -> Column:
    return F.lit(0.25) + F.lit(0.015) * (quantity - 1)


def line_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for a step that sorts line items: by the rows, whatever bytes they are packed in."""
    return 1 + table(spark, sf_dir, "lineitem").count() // TASK_ROWS


def inventory_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame inventory: one frame per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(frame_key(F.col("o_custkey"), F.col("o_orderkey")).alias("frame_id"))


def predictions_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction table, with one sentinel row for every order without lines."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    lp = l.join(p, l.l_partkey == p.p_partkey)
    n = line_tasks(spark, sf_dir)
    j = o.repartition(n, "o_orderkey").join(lp.repartition(n, "l_orderkey"), o.o_orderkey == lp.l_orderkey, "left")
    miss = F.col("l_orderkey").isNull()
    zero = F.lit(0.0)
    box = _raw_box(F.col("l_quantity"), F.col("l_partkey"), F.col("l_suppkey"))
    return j.select(
        frame_key(F.col("o_custkey"), F.col("o_orderkey")).alias("frame_id"),
        F.when(miss, F.lit(-1)).otherwise(class_of(F.col("p_size"))).alias("class_id"),
        F.when(miss, zero).otherwise(confidence_of(F.col("l_quantity"))).alias("confidence"),
        *[F.when(miss, zero).otherwise(expr).alias(name)
          for name, expr in zip(("x_center", "y_center", "width", "height"), box)],
    )


def class_scores_of(confidence: Column, class_id: Column, partkey: Column, suppkey: Column) -> Column:
    """Scores of the 13 classes: the detection's own class first, the others a share of it that may reach it.

    Some detections come from an older shard (no scores), some from a model of one class.
    """
    others = F.transform(F.sequence(F.lit(0), F.lit(12)), lambda c: F.when(c == class_id, confidence).otherwise(
        confidence * (((partkey * 7 + suppkey * 3 + c * 11) % 21) / F.lit(20.0))))
    return F.when(suppkey % 9 == 0, F.lit(None)).when(partkey % 8 == 0, F.array(confidence)).otherwise(others)


def scored_predictions_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``predictions_v`` with ``class_scores`` (null for sentinel rows)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    lp = l.join(p, l.l_partkey == p.p_partkey)
    n = line_tasks(spark, sf_dir)
    j = o.repartition(n, "o_orderkey").join(lp.repartition(n, "l_orderkey"), o.o_orderkey == lp.l_orderkey, "left")
    miss = F.col("l_orderkey").isNull()
    cls, conf = class_of(F.col("p_size")), confidence_of(F.col("l_quantity"))
    return j.select(
        frame_key(F.col("o_custkey"), F.col("o_orderkey")).alias("frame_id"),
        F.when(miss, F.lit(-1)).otherwise(cls).alias("class_id"),
        F.when(miss, F.lit(0.0)).otherwise(conf).alias("confidence"),
        F.when(~miss, class_scores_of(conf, cls, F.col("l_partkey"), F.col("l_suppkey"))).alias("class_scores"))


def _raw_box(quantity: Column, partkey: Column, suppkey: Column, jitter: bool = False) -> list[Column]:
    x = (partkey % 40) / F.lit(50.0) + F.lit(0.05)
    y = (suppkey % 40) / F.lit(50.0) + F.lit(0.05)
    if jitter:
        x = x + ((suppkey % 7) - 3) * F.lit(0.01)
        y = y + ((partkey % 5) - 2) * F.lit(0.01)
    size = F.lit(0.1) + quantity / F.lit(500.0)
    return [x, y, size, size]


def lines_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items' columns that boxes are made of, with the class of their part."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    p = table(spark, sf_dir, "part").select("p_partkey", class_of(F.col("p_size")).alias("class_id"))
    return l.join(p, l.l_partkey == p.p_partkey).drop("p_partkey")


def ground_truth_v(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Ground-truth boxes: every line item whose part key is not a multiple of 10.

    ``lines`` is a stored ``lines_v``, for views that share it.
    """
    return _boxes(spark, sf_dir, lines, "l_orderkey", LINE_KEY)


def _boxes(spark: SparkSession, sf_dir: str, lines: DataFrame | None, image: str, order) -> DataFrame:
    from pyspark.sql import Window
    j = (lines_v(spark, sf_dir) if lines is None else lines).filter(F.col("l_partkey") % 10 != 0)
    # Named first and numbered then: whoever joins by image and class finds the rows dealt so.  Boxes are made last, as they
    # take more room than what they are made of.
    j = j.withColumnRenamed(image, "image_id")
    supp = F.col("image_id" if image == "l_suppkey" else "l_suppkey")
    w = Window.partitionBy("image_id", "class_id").orderBy(*order)
    j = j.withColumn("gt_id", F.row_number().over(w).cast("long"))
    x, y, wd, ht = _raw_box(F.col("l_quantity"), F.col("l_partkey"), supp)
    return j.select("image_id", "class_id", "gt_id",
                    x.alias("x_center"), y.alias("y_center"), wd.alias("width"), ht.alias("height"))


def detection_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
                       F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"),
                       F.col("l_quantity").cast("int").cast("string"),
                       F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"))


def detections_v(spark: SparkSession, sf_dir: str, drop_mod: int = 11, lines: DataFrame | None = None) -> DataFrame:
    """Detections: line items whose supplier key is not a multiple of ``drop_mod``,
    with jittered centres."""
    return _jittered(spark, sf_dir, lines, "l_orderkey", F.col("l_suppkey") % drop_mod != 0)


def arm_detections_v(spark: SparkSession, sf_dir: str, drops: dict[str, int], lines: DataFrame | None = None) -> DataFrame:
    """``detections_v`` of several arms (and the ``drop_mod`` of each), a detection once with the ``arm`` array of those that hold it."""
    held = F.array_compact(F.array(*[F.when(F.col("l_suppkey") % mod != 0, F.lit(arm)) for arm, mod in drops.items()]))
    return _jittered(spark, sf_dir, lines, "l_orderkey", F.size(held) > 0, held.alias("arm"))


def _jittered(spark: SparkSession, sf_dir: str, lines: DataFrame | None, image: str, kept: Column, *more: Column) -> DataFrame:
    j = (lines_v(spark, sf_dir) if lines is None else lines).filter(kept)
    x, y, wd, ht = _raw_box(F.col("l_quantity"), F.col("l_partkey"), F.col("l_suppkey"), jitter=True)
    return j.select(F.col(image).alias("image_id"), "class_id",
                    detection_id().alias("det_id"), confidence_of(F.col("l_quantity")).alias("confidence"),
                    x.alias("x_center"), y.alias("y_center"), wd.alias("width"), ht.alias("height"), *more)


def crowded_ground_truth_v(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """``ground_truth_v`` with a supplier as the image: some hundred boxes each, many of them overlapping."""
    return _boxes(spark, sf_dir, lines, "l_suppkey", CROWD_KEY)


def crowded_detections_v(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Detections on the suppliers' images: all line items but those of every 11th order."""
    return _jittered(spark, sf_dir, lines, "l_suppkey", F.col("l_orderkey") % 11 != 0)


def categories_df(spark: SparkSession) -> DataFrame:
    """A2: the 13-row category dimension."""
    from ..params import CATEGORY_IDS
    from ..schemas import CATEGORY
    return spark.createDataFrame([(i, n) for n, i in CATEGORY_IDS.items()], CATEGORY)


def annotations_v(spark: SparkSession, sf_dir: str, width: int = 1280, height: int = 720) -> DataFrame:
    """Nested annotation records, one per order (the shape of the raw label JSON).

    ``labels`` is null for an order without lines; a returned line ('R') has a
    null ``box2d``.  Boxes are pixel corners of the adapter's normalised boxes.
    ``seq`` stands for the position of the record in the file.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", *LINE_ORDER)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    cats = categories_df(spark)
    xc, yc, w, h = _raw_box(F.col("l_quantity"), F.col("l_partkey"), F.col("l_suppkey"))
    box = F.struct(((xc - w / F.lit(2.0)) * F.lit(float(width))).alias("x1"),
                   ((yc - h / F.lit(2.0)) * F.lit(float(height))).alias("y1"),
                   ((xc + w / F.lit(2.0)) * F.lit(float(width))).alias("x2"),
                   ((yc + h / F.lit(2.0)) * F.lit(float(height))).alias("y2"))
    label = F.struct(F.col("class_name").alias("category"),
                     F.when(F.col("l_returnflag") != "R", box).alias("box2d"),
                     F.lit(None).cast("struct<occluded:boolean,truncated:boolean>").alias("attributes"))
    lines = (l.join(p, F.col("l_partkey") == F.col("p_partkey"))
              .join(F.broadcast(cats), class_of(F.col("p_size")) == F.col("class_id"))
              .select("l_orderkey", F.struct(*[F.col(c) for c in LINE_ORDER], label.alias("label")).alias("e")))
    # One image's labels: the record's array, ordered by line.
    per_order = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("e")).alias("es"))
    rec = o.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key = frame_key(F.col("o_custkey"), F.col("o_orderkey"))
    return rec.select(
        key.alias("videoName"), F.concat(key, F.lit(".jpg")).alias("name"),
        F.transform("es", lambda e: e["label"]).alias("labels"),
        F.lit(None).cast("struct<weather:string,timeofday:string,scene:string>").alias("attributes"),
        F.col("o_orderkey").alias("seq"),
    )


# Every so many orders a frame's record comes again, and again without labels.
REPEATED, EMPTIED = 5, 7


def repeated_annotations_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``annotations_v`` with later records: some keep the first label only, some have none."""
    ann = annotations_v(spark, sf_dir)
    again = (ann.filter(F.col("seq") % REPEATED == 0).withColumn("labels", F.slice("labels", 1, 1))
             .withColumn("seq", F.col("seq") + (1 << 40)))
    emptied = (ann.filter(F.col("seq") % EMPTIED == 0)
               .withColumn("labels", F.when(F.lit(False), F.col("labels"))).withColumn("seq", F.col("seq") + (2 << 40)))
    return ann.unionByName(again).unionByName(emptied)


def toy_model_factory():
    """A deterministic stand-in detector for tests and registered queries.

    It reads the order key from the image file name and returns
    ``order_key % 4`` boxes; the same rule is written in SQL for the oracle.
    """
    def predict(paths: list[str]) -> list[list[tuple]]:
        out = []
        for path in paths:
            stem = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
            okey = int(stem.split("-")[1])
            out.append([((okey + j) % 13, ((okey * 7 + j * 13) % 100) / 100.0,
                         ((okey + j) % 50) / 50.0 + 0.01, ((okey * 3 + j) % 50) / 50.0 + 0.01, 0.1, 0.1)
                        for j in range(okey % 4)])
        return out
    return predict

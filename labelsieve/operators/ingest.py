"""Ingest: annotation records -> normalised label boxes; inventory -> exact splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_order_key, normalised_box
from ..params import IMAGE_HEIGHT, IMAGE_WIDTH, Params
from .positions import ordered_position


def latest_entries(ann: DataFrame, key: str = "videoName", seq: str = "seq") -> DataFrame:
    """Entries with labels, keeping the last one per ``key`` by ``seq``.

    A later entry with null labels does not replace an earlier one (it is
    skipped before it could overwrite).  One pass: ``max_by`` is a partial
    aggregate, so a key repeated many times never gathers in one task.
    """
    return (ann.filter(F.col("labels").isNotNull()).groupBy(key)
            .agg(F.max_by("labels", seq).alias("labels"), F.max(seq).alias(seq)))


def labeled_frames(ann: DataFrame, key: str = "videoName", seq: str = "seq") -> DataFrame:
    """Frames that get a label file (possibly empty), with their box count."""
    latest = latest_entries(ann, key, seq)
    n_boxes = F.size(F.filter("labels", lambda l: l["box2d"].isNotNull()))
    return latest.select(F.col(key).alias("frame_id"), n_boxes.cast("long").alias("n_boxes"))


def label_boxes(ann: DataFrame, categories: DataFrame, width: int = IMAGE_WIDTH,
                height: int = IMAGE_HEIGHT, key: str = "videoName", seq: str = "seq",
                strict: bool = True) -> DataFrame:
    """One row per non-null box of the latest labelled entry of each frame.

    ``categories`` is the 13-row ``(class_id, class_name)`` dimension (fixed
    size, broadcast).  An unknown category fails the job when ``strict``,
    else the box is kept with a null ``class_id`` (see ``label_rejects``).
    """
    latest = latest_entries(ann, key, seq)
    boxes = (latest.select(F.col(key).alias("frame_id"), F.posexplode("labels").alias("box_pos", "l"))
                   .filter(F.col("l.box2d").isNotNull()))
    joined = boxes.join(F.broadcast(categories),
                        F.col("l.category") == F.col("class_name"), "left")
    class_id = F.col("class_id")
    if strict:
        class_id = F.when(class_id.isNull(),
                          F.raise_error(F.concat(F.lit("unknown category: "), F.col("l.category"))))\
                    .otherwise(class_id)
    return joined.select(
        "frame_id", F.col("box_pos").cast("int").alias("box_pos"), class_id.cast("int").alias("class_id"),
        *normalised_box("l.box2d.x1", "l.box2d.y1", "l.box2d.x2", "l.box2d.y2", width, height),
    )


def label_rejects(ann: DataFrame, categories: DataFrame, key: str = "videoName",
                  seq: str = "seq") -> DataFrame:
    """Boxes whose category is not in the dimension."""
    latest = latest_entries(ann, key, seq)
    boxes = (latest.select(F.col(key).alias("frame_id"), F.posexplode("labels").alias("box_pos", "l"))
                   .filter(F.col("l.box2d").isNotNull()))
    return (boxes.join(F.broadcast(categories), F.col("l.category") == F.col("class_name"), "left_anti")
                 .select("frame_id", "box_pos", F.col("l.category").alias("category")))


def convert_metrics() -> list[Column]:
    """D7 as aggregates, for ``convert_counters`` or for ``observe`` on a write of the records."""
    return [F.count_if(F.col("labels").isNotNull()).cast("long").alias("converted"),
            F.count_if(F.col("labels").isNull()).cast("long").alias("skipped")]


def convert_counters(ann: DataFrame) -> DataFrame:
    """Entries converted (labels present, ``[]`` included) and skipped (null)."""
    return ann.agg(*convert_metrics())


def yolo_lines(boxes: DataFrame) -> DataFrame:
    """``class x_center y_center width height`` per box, fixed 6 decimals."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f", "class_id", "x_center", "y_center", "width", "height")
    return boxes.select("frame_id", "box_pos", line.alias("line"))


def yolo_text(lines: DataFrame, frames: DataFrame) -> DataFrame:
    """One text per labelled frame (empty text for a frame without boxes).

    Gathers the lines of one image, i.e. one label file's content.
    """
    per_frame = (lines.groupBy("frame_id")
                 .agg(F.sort_array(F.collect_list(F.struct("box_pos", "line"))).alias("__l")))
    return (frames.select("frame_id").join(per_frame, "frame_id", "left")
            .select("frame_id", F.coalesce(F.concat_ws("\n", F.col("__l.line")), F.lit("")).alias("text")))


# ---------------------------------------------------------------------------
# Splits

def cut_points(n: int, params: Params) -> tuple[int, int]:
    """``seed_end = int(n*s)``, ``unlabeled_end = seed_end + int(n*u)``."""
    params.check_fractions()
    seed_end = int(n * params.seed_fraction)
    return seed_end, seed_end + int(n * params.unlabeled_fraction)


def split_frames(inventory: DataFrame, params: Params = Params(), test_inventory: DataFrame | None = None,
                 id_col: str = "frame_id") -> DataFrame:
    """J1 split: exact seed / unlabeled / val sizes over a repeatable md5 order.

    Output ``(frame_id, split, pos)``; ``pos`` numbers frames inside their
    split (the shuffled order for train splits, sorted ids for test).
    """
    params.check_fractions()  # B15: fail before any job runs
    frames = (inventory.select(F.col(id_col).alias("frame_id")).distinct()
              .withColumn("__h", hash_order_key(params.seed, "split", "frame_id")))
    positioned = ordered_position(frames, [F.col("__h").asc(), F.col("frame_id").asc()], name="__g")
    n = positioned.count()
    if n == 0:
        raise ValueError("empty frame inventory")
    seed_end, unl_end = cut_points(n, params)
    g = F.col("__g")
    split = F.when(g < seed_end, "seed").when(g < unl_end, "unlabeled").otherwise("val")
    start = F.when(g < seed_end, 0).when(g < unl_end, seed_end).otherwise(unl_end)
    out = positioned.select("frame_id", split.alias("split"), (g - start).cast("long").alias("pos"))
    if test_inventory is not None:
        test = ordered_position(test_inventory.select(F.col(id_col).alias("frame_id")).distinct(),
                                [F.col("frame_id").asc()], name="pos")
        out = out.unionByName(test.select("frame_id", F.lit("test").alias("split"), "pos"))
    return out


def split_sizes(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("split").agg(F.count(F.lit(1)).alias("n_frames"))


def split_invariants(manifest: DataFrame, inventory: DataFrame, id_col: str = "frame_id") -> DataFrame:
    """G3 as data: frames assigned, frames in two splits, inventory frames not
    assigned -- one full outer join and one aggregation."""
    train = manifest.filter(F.col("split") != "test")
    per_frame = train.groupBy("frame_id").agg(F.count(F.lit(1)).alias("__k"))
    inv = inventory.select(F.col(id_col).alias("frame_id")).distinct().withColumn("__inv", F.lit(True))
    j = inv.join(per_frame, "frame_id", "full")
    return j.agg(F.count_if(F.col("__k").isNotNull()).cast("long").alias("n_assigned"),
                 F.count_if(F.col("__k") > 1).cast("long").alias("n_overlapping"),
                 F.count_if(F.col("__k").isNull()).cast("long").alias("n_missing"))


def image_inventory(spark, directory: str, source_set: str, extension: str = "jpg", prefixes=()) -> DataFrame:
    """A3: ``(frame_id, path, source_set)`` of the ``*.jpg`` of a directory (non-recursive), listed by tasks.

    ``prefixes`` of names spread a large folder over a task each; files that start with none of them are
    listed too.  A missing folder raises, an empty one gives no rows.
    """
    from ..sources.listing import image_files
    return image_files(spark, directory, source_set, extension, prefixes)


__all__ = [
    "latest_entries", "labeled_frames", "label_boxes", "label_rejects", "convert_metrics", "convert_counters",
    "yolo_lines", "yolo_text", "cut_points", "split_frames", "split_sizes", "split_invariants",
    "image_inventory",
]

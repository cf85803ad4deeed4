"""Training arms: seed + selected frames (train) and the shared val split.

Replaces directories of symlinks with manifests: each row says which arm and
subset a frame belongs to, its image path, and whether the image and the label
exist (a missing source is kept and flagged, not dropped silently).  Labels are
revealed only for frames in a manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checked_broadcast

ARMS = ("mined", "random")


def arm_manifest(splits: DataFrame, selections: DataFrame, inventory: DataFrame,
                 labeled: DataFrame, arms=ARMS) -> DataFrame:
    """J5 (G2 + C4): ``(arm, subset, frame_id, image_path, has_image, has_label)``.

    ``splits``: frame_id, split.  ``selections``: arm, frame_id.
    ``inventory``: frame_id, path.  ``labeled``: frame_id (frames with a label).
    Every arm's train subset is seed + its selection (a frame in both counts
    once); val is the same for every arm.
    """
    each_arm = F.explode(F.array(*[F.lit(a) for a in arms])).alias("arm")
    seed = splits.filter(F.col("split") == "seed").select(each_arm, F.lit("train").alias("subset"), "frame_id")
    picked = selections.filter(F.col("arm").isin(*arms)).select("arm", F.lit("train").alias("subset"), "frame_id")
    val = splits.filter(F.col("split") == "val").select(each_arm, F.lit("val").alias("subset"), "frame_id")
    members = seed.unionByName(picked).dropDuplicates(["arm", "subset", "frame_id"]).unionByName(val)
    # Only the members' images and labels are looked at; the rest of the corpus never shuffles for them.
    ids, _ = checked_broadcast(members.select("frame_id").distinct())
    images = (inventory.select("frame_id", F.col("path").alias("image_path")).join(ids, "frame_id", "left_semi")
              .dropDuplicates(["frame_id"]))
    labels = (labeled.select("frame_id").join(ids, "frame_id", "left_semi").distinct()
              .withColumn("has_label", F.lit(True)))
    out = members.join(images, "frame_id", "left").join(labels, "frame_id", "left")
    return out.select("arm", "subset", "frame_id", "image_path",
                      F.col("image_path").isNotNull().alias("has_image"),
                      F.coalesce(F.col("has_label"), F.lit(False)).alias("has_label"))


def arm_summary(manifest: DataFrame) -> DataFrame:
    """Frames, images found and labels revealed per arm and subset."""
    return manifest.groupBy("arm", "subset").agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.count_if("has_image").cast("long").alias("n_images"),
        F.count_if("has_label").cast("long").alias("n_labels"))


def reveal_boxes(manifest: DataFrame, boxes: DataFrame) -> DataFrame:
    """C4: label boxes of the frames in each arm (boxes of other frames stay hidden).

    The manifest (seed + budget + val, small next to the label table) is
    broadcast after a count, so the box table is not shuffled.
    """
    keys, _ = checked_broadcast(manifest.filter("has_label").select("arm", "subset", "frame_id"))
    return boxes.join(keys, "frame_id").select("arm", "subset", *boxes.columns)


def class_distribution(selected_boxes: DataFrame, corpus_boxes: DataFrame,
                       group: str = "arm", groups=ARMS) -> DataFrame:
    """S3: class shares of each selection vs the corpus, and their ratio.

    A row per class of the corpus for every group that occurs and for the given
    ``groups``; a class that a selection lacks is reported with 0, and a group
    without any box has null shares.  Both sides are first reduced to one row per
    class (partial aggregates); the share denominators are windows over those few rows.
    """
    corpus = corpus_boxes.groupBy("class_id").agg(F.count(F.lit(1)).alias("corpus_n"))
    total = F.sum("corpus_n").over(Window.partitionBy())
    corpus = corpus.withColumn("corpus_share", F.try_divide("corpus_n", total))
    sel = selected_boxes.groupBy(group, "class_id").agg(F.count(F.lit(1)).alias("selected_n"))
    kind = selected_boxes.schema[group].dataType
    given = selected_boxes.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(g).cast(kind) for g in groups]).cast(f"array<{kind.simpleString()}>")).alias(group))
    every = sel.select(group).unionByName(given).distinct().withColumn("__j", F.lit(1))
    # A row per class with a row per group: both are few.
    grid = corpus.withColumn("__j", F.lit(1)).join(F.broadcast(every), "__j").drop("__j")
    sel = sel.select(F.col(group).alias("__g"), F.col("class_id").alias("__c"), "selected_n")
    j = grid.join(sel, grid[group].eqNullSafe(sel["__g"]) & grid["class_id"].eqNullSafe(sel["__c"]), "left")
    j = j.withColumn("selected_n", F.coalesce("selected_n", F.lit(0)))
    own = F.sum("selected_n").over(Window.partitionBy(group))
    j = j.withColumn("selected_share", F.try_divide("selected_n", own))
    return j.select(group, "class_id", "selected_n", "corpus_n", "selected_share", "corpus_share",
                    F.try_divide("selected_share", "corpus_share").alias("share_ratio"))

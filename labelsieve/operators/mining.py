"""Frame scoring from predictions alone, and budgeted capped selection.

Plan shape of ``frame_scores`` (one pass over the detections):

    detections --partial agg--> class counts (<= #classes rows, checked broadcast)
    detections ⋈ counts (broadcast hash join, no shuffle of detections)
      --partial agg / shuffle on frame_id--> per-frame signals
    per-frame signals --checkpoint--> average ranks (tie-collapsed, see positions)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import exact_sum, hash_order_key, hash_rank, in_band, top_two_gap, video_key
from ..params import AMBIGUOUS_HIGH, AMBIGUOUS_LOW, SEED
from ..session import checked_broadcast, materialize
from .positions import TASK_ROWS, average_ranks, first_rows, median

def class_counts(pred: DataFrame, class_col: str = "class_id") -> DataFrame:
    """Detections per class, sentinel class included."""
    return pred.groupBy(class_col).agg(F.count(F.lit(1)).alias("class_count"))


def frame_signals(pred: DataFrame, frame_col: str = "frame_id", class_col: str = "class_id",
                  conf_col: str = "confidence", low: float = AMBIGUOUS_LOW,
                  high: float = AMBIGUOUS_HIGH) -> DataFrame:
    """D2 + D3 + C1-C3 + G1 + B11 behind one shuffle on the frame.

    ``uncertainty`` = detections with ``low <= confidence <= high``;
    ``rare_class`` = sum of 1/class_count over non-sentinel detections, added as
    ``k / class_count`` per class in class order: a double sum that depends on
    neither row order nor the size of the counts.  Every frame that has any row
    (sentinel-only frames too) gets a row.
    """
    counts, _ = checked_broadcast(class_counts(pred.select(class_col), class_col))
    # A task holds the groups of its frames in memory, so there are tasks by the rows, not by the bytes they are packed in.
    rows = counts.agg(F.sum("class_count")).first()[0] or 0
    per_class = (pred.select(frame_col, class_col, conf_col).repartition(1 + rows // TASK_ROWS, frame_col)
                 .groupBy(frame_col, class_col)
                 .agg(F.count(F.lit(1)).alias("__k"), F.count_if(in_band(conf_col, low, high)).alias("__u")))
    return rare_mass(per_class.join(counts, class_col), frame_col, class_col)


def rare_mass(per_class: DataFrame, frame_col: str, class_col: str) -> DataFrame:
    """D3 + D2 from ``(frame, class, __k, __u, class_count)``, one row per frame and class."""
    terms = F.array_sort(F.collect_list(F.when(F.col(class_col) >= 0, F.struct(
        F.col(class_col).alias("c"), (F.col("__k") / F.col("class_count")).alias("x")))))
    return per_class.groupBy(frame_col).agg(
        F.sum("__u").cast("long").alias("uncertainty"),
        F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t["x"]).alias("rare_class"),
    )


def frame_margins(pred: DataFrame, frame_col: str = "frame_id", scores_col: str = "class_scores") -> DataFrame:
    """``(frame_id, n_margins, margin)``, the mean top-two gap of a frame's detections.

    A detection without class scores has no gap and does not count; a frame
    without any gap has a null margin (sentinel-only frames and older shards).
    Small margins mean confusion between classes.  The mean is a sum of whole
    multiples of 2**-40, so it does not depend on the order of the rows.
    """
    gaps = pred.select(frame_col, top_two_gap(scores_col).alias("__gap"))
    return gaps.groupBy(frame_col).agg(
        F.count("__gap").alias("n_margins"), F.try_divide(exact_sum("__gap"), F.count("__gap")).alias("margin"))


def percentile_norm(df: DataFrame, columns: list[str], suffix: str = "_norm") -> DataFrame:
    """``average rank / N`` for each column (range (0, 1], ties averaged)."""
    return average_ranks(df, columns, suffix=suffix, normalise=True)


def combine(df: DataFrame, weights: dict[str, float], out: str = "combined",
            suffix: str = "_norm") -> DataFrame:
    """Weighted mean of the normalised signals (weights rescaled to sum 1)."""
    total = float(sum(weights.values()))
    if total <= 0:
        raise ValueError("signal weights must have a positive sum")
    expr = None
    for name, w in weights.items():
        term = F.lit(float(w) / total) * F.col(name + suffix)
        expr = term if expr is None else expr + term
    return df.withColumn(out, expr)


def frame_scores(pred: DataFrame, weights: dict[str, float] | None = None,
                 low: float = AMBIGUOUS_LOW, high: float = AMBIGUOUS_HIGH,
                 frame_col: str = "frame_id") -> DataFrame:
    """The score table ``(frame_id, <signal>..., <signal>_norm..., combined)``.

    ``weights`` names the signals: ``uncertainty`` and ``rare_class`` (both, equally,
    by default), and ``confusion`` (S7), one minus the frame's margin; a frame without a
    margin ranks below all others in it.
    """
    weights = weights or {"uncertainty": 1.0, "rare_class": 1.0}
    unknown = set(weights) - {"uncertainty", "rare_class", "confusion"}
    if unknown:
        raise ValueError(f"unknown signals: {sorted(unknown)}")
    signals = frame_signals(pred, frame_col=frame_col, low=low, high=high)
    if "confusion" in weights:
        margins = frame_margins(pred, frame_col).select(frame_col, (F.lit(1.0) - F.col("margin")).alias("confusion"))
        signals = signals.join(margins, frame_col, "left")
    names = [n for n in ("uncertainty", "rare_class", "confusion") if n in signals.columns]
    scored = combine(percentile_norm(materialize(signals), names), weights)
    return scored.select(frame_col, *names, *[n + "_norm" for n in names], "combined")


def summary_metrics(score_col: str = "combined") -> list[Column]:
    """D4, D6 as aggregates, for ``score_summary`` or for ``observe`` on a write of the scores."""
    return [F.count(F.lit(1)).alias("n_frames"), F.max(score_col).alias("max_combined")]


def score_summary(scores: DataFrame, score_col: str = "combined", seen: dict | None = None) -> DataFrame:
    """Frame count, max and exact median of the combined score.

    ``seen`` are the ``summary_metrics`` observed while the scores were written, which
    spares a pass over them.

    The median comes from the counts of distinct values (``positions.median``),
    not from an aggregate that holds every value in one buffer.
    """
    middle = median(scores, score_col).withColumnRenamed("median", "median_combined")
    if seen is not None:
        known = {"n_frames": "long", "max_combined": "double"}
        return middle.select(*[F.lit(seen[c]).cast(t).alias(c) for c, t in known.items()], "median_combined")
    whole = scores.agg(*summary_metrics(score_col))
    one = F.lit(1).alias("__one")
    return (whole.select("*", one).join(F.broadcast(middle.select("*", one)), "__one")
            .select("n_frames", "max_combined", "median_combined"))


def capped(df: DataFrame, order: list[Column], group: Column, cap: int, keys=()) -> DataFrame:
    """Keep the first ``cap`` rows of each group (and ``keys``) in ``order``.

    ``row_number() <= cap`` lets Spark add a partial ``WindowGroupLimit`` before
    the shuffle, so a hot group sends at most ``cap`` rows per map task.
    """
    w = Window.partitionBy(*keys, "video_id").orderBy(*order)
    return (df.withColumn("video_id", group)
              .withColumn("__vr", F.row_number().over(w))
              .filter(F.col("__vr") <= cap)
              .drop("__vr"))


def select_capped(scores: DataFrame, budget: int, cap: int, score_col: str = "combined",
                  id_col: str = "frame_id", group: Column | None = None,
                  arm: str = "mined") -> DataFrame:
    """J4 mined arm: highest scores first, at most ``cap`` per group, ``budget`` rows.

    Equal to the reference's greedy walk under the total order
    ``(score desc, id asc)``.  Output ``(arm, pick, frame_id, video_id, score)``.
    """
    group = group if group is not None else video_key(id_col)
    order = [F.col(score_col).desc(), F.col(id_col).asc()]
    base = scores.select(F.col(id_col), F.col(score_col))
    picked = first_rows(capped(base, order, group, cap), [], -F.col(score_col).cast("double"), order, budget)
    return picked.select(F.lit(arm).alias("arm"), "pick", F.col(id_col).alias("frame_id"),
                         "video_id", F.col(score_col).alias("score"))


def random_capped(scores: DataFrame, budget: int, cap: int, seed: int = SEED,
                  score_col: str = "combined", id_col: str = "frame_id",
                  group: Column | None = None, arm: str = "random") -> DataFrame:
    """J4 random arm: md5-seeded order over all scored frames, same cap and budget."""
    group = group if group is not None else video_key(id_col)
    order = [F.col("__h").asc(), F.col(id_col).asc()]
    base = scores.select(F.col(id_col), F.col(score_col), hash_order_key(seed, "random", id_col).alias("__h"))
    picked = first_rows(capped(base, order, group, cap), [], hash_rank("__h"), order, budget)
    return picked.select(F.lit(arm).alias("arm"), "pick", F.col(id_col).alias("frame_id"),
                         "video_id", F.col(score_col).alias("score"))


def selections(scores: DataFrame, budget: int, cap: int, seed: int = SEED) -> DataFrame:
    """Both arms in one table, partitionable by ``arm``: ``select_capped`` and ``random_capped`` in one pass."""
    score, h = F.col("combined").cast("double"), hash_order_key(seed, "random", "frame_id")

    def arm(name: str, rank: Column, first: Column, second: Column) -> Column:
        return F.struct(F.lit(name).alias("arm"), rank.alias("rank"), first.alias("first"), second.alias("second"))
    both = F.array(arm("mined", -score, -score, F.lit("")), arm("random", hash_rank(h), F.lit(0.0), h))
    rows = scores.select("frame_id", "combined", F.explode(both).alias("__a")).select("frame_id", "combined", "__a.*")
    order = [F.col("first").asc_nulls_last(), F.col("second").asc(), F.col("frame_id").asc()]
    few = capped(rows, order, video_key("frame_id"), cap, ["arm"])
    return first_rows(few, ["arm"], F.col("rank"), order, budget).select(
        "arm", "pick", "frame_id", "video_id", F.col("combined").alias("score"))


__all__ = [
    "class_counts", "frame_signals", "frame_margins", "percentile_norm", "combine", "frame_scores",
    "score_summary", "select_capped", "random_capped", "selections",
]

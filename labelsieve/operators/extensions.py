"""Selection studies described alongside the pipeline.

All are compositions of the core operators: fixed-size replication by a short
parameter list (variants, seeds, budgets) via ``explode``, capped windows with
partial ``WindowGroupLimit``, and the scale-safe running sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import exact_sum, hash_order_key, hash_rank, video_key
from ..params import SEED, Params
from ..session import checked_broadcast, materialize
from .clustering import kmeans
from .ingest import cut_points
from .mining import capped
from .positions import first_rows, running

ABLATION = {
    "both": {"uncertainty": 1.0, "rare_class": 1.0},
    "uncertainty": {"uncertainty": 1.0, "rare_class": 0.0},
    "rare_class": {"uncertainty": 0.0, "rare_class": 1.0},
}


def signal_ablation(scores: DataFrame, budget: int, cap: int, variants: dict | None = None) -> DataFrame:
    """The mined selection under several signal weightings, in one job.

    Output ``(variant, pick, frame_id, video_id, score)``.
    """
    variants = variants or ABLATION
    rows = []
    for name, weights in variants.items():
        total = float(sum(weights.values()))
        expr = None
        for sig, w in weights.items():
            term = F.lit(float(w) / total) * F.col(sig + "_norm")
            expr = term if expr is None else expr + term
        rows.append(F.struct(F.lit(name).alias("variant"), expr.alias("score")))
    exploded = scores.select("frame_id", F.explode(F.array(*rows)).alias("__v")).select("frame_id", "__v.*")
    order = [F.col("score").desc(), F.col("frame_id").asc()]
    few = capped(exploded, order, video_key("frame_id"), cap, ["variant"])
    return first_rows(few, ["variant"], -F.col("score"), order, budget) \
        .select("variant", "pick", "frame_id", "video_id", "score")


def seed_spread(scores: DataFrame, budget: int, cap: int, seeds=(42, 43, 44, 45, 46),
                score_col: str = "combined") -> DataFrame:
    """Random baselines under several seeds; per seed the selected count and
    exact mean score, plus the mean and spread of that mean across seeds."""
    s = scores.select("frame_id", F.col(score_col).alias("score"),
                      F.explode(F.array(*[F.lit(int(x)) for x in seeds])).alias("seed"))
    s = s.withColumn("__h", F.md5(F.concat(F.col("seed").cast("string"), F.lit(":random:"), F.col("frame_id"))))
    order = [F.col("__h").asc(), F.col("frame_id").asc()]
    picked = first_rows(capped(s, order, video_key("frame_id"), cap, ["seed"]), ["seed"], hash_rank("__h"), order, budget)
    per_seed = picked.groupBy("seed").agg(F.count(F.lit(1)).alias("n_selected"),
                                          (exact_sum("score") / F.count(F.lit(1))).alias("mean_score"))
    all_seeds = Window.partitionBy()  # over one row per seed
    return per_seed.select(
        "seed", "n_selected", "mean_score",
        F.round(F.avg("mean_score").over(all_seeds), 10).alias("seeds_mean"),
        F.round(F.stddev_samp("mean_score").over(all_seeds), 10).alias("seeds_stddev"))


def budget_curve(selection: DataFrame, budgets=(250, 500, 1000, 2000)) -> DataFrame:
    """Composition of the first ``b`` picks for each budget ``b``.

    ``selection`` carries ``pick`` (1-based) from one run at the largest budget;
    the greedy walk makes every smaller budget a prefix of it.
    """
    b = selection.select("*", F.explode(F.array(*[F.lit(int(x)) for x in budgets])).alias("budget"))
    return (b.filter(F.col("pick") <= F.col("budget")).groupBy("budget")
             .agg(F.count(F.lit(1)).alias("n_frames"), F.countDistinct("video_id").alias("n_videos"),
                  (exact_sum("score") / F.count(F.lit(1))).alias("mean_score")))


def scene_split(inventory: DataFrame, params: Params = Params(), id_col: str = "frame_id") -> DataFrame:
    """Splits where no video spans two splits.

    Videos are shuffled by md5 and laid end to end; a video goes to the split
    where its first frame's position falls (cut points as in ``split_frames``).
    The running frame count over videos is the skew-safe ``running``.
    """
    params.check_fractions()
    frames = inventory.select(F.col(id_col).alias("frame_id")).distinct().withColumn("video_id", video_key("frame_id"))
    videos = (frames.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("__h", hash_order_key(params.seed, "scene", "video_id"))
                    .withColumn("__all", F.lit(0)))
    cum = running(videos, ["__all"], [F.col("__h").asc(), F.col("video_id").asc()], sums={"__c": "n"})
    total = cum.agg(F.sum("n")).first()[0] or 0
    if total == 0:
        raise ValueError("empty frame inventory")
    seed_end, unl_end = cut_points(total, params)
    start = F.col("__c") - F.col("n")
    split = F.when(start < seed_end, "seed").when(start < unl_end, "unlabeled").otherwise("val")
    return frames.join(cum.select("video_id", split.alias("split")), "video_id").select("frame_id", "video_id", "split")


def spaced_select(scores: DataFrame, times: DataFrame, budget: int, cap: int, min_gap: float,
                  score_col: str = "combined", time_col: str = "t") -> DataFrame:
    """Capped selection where two picks of one video are >= ``min_gap`` apart.

    Exact greedy in at most ``cap`` rounds: a round accepts the best remaining
    frame of every video (``min_by``, summed up before the shuffle) and keeps the
    frames far enough from it (a join with one row per video).  Only frames that
    are still eligible are written again, and the rounds end when none is left.
    Then the budget takes the first accepted frames in the global order, as
    the sequential walk would.  Output ``(pick, frame_id, video_id, score, t)``.
    """
    cand = (scores.select("frame_id", F.col(score_col).alias("score"))
                  .join(times.select("frame_id", F.col(time_col).cast("double").alias("t")), "frame_id")
                  .withColumn("video_id", video_key("frame_id")))
    order = [F.col("score").desc(), F.col("frame_id").asc()]
    accepted = cand.limit(0)
    for _ in range(cap if budget > 0 else 0):
        cand = materialize(cand, "spaced_cand")
        if cand.isEmpty():
            break
        best = F.struct((-F.col("score")).alias("__ns"), F.col("frame_id").alias("__f"))
        top = cand.groupBy("video_id").agg(F.min_by(F.struct("frame_id", "score", "t"), best).alias("b"))
        top = top.select("b.frame_id", "b.score", "b.t", "video_id")
        accepted = accepted.unionByName(top)
        block = top.select("video_id", F.col("t").alias("__t"), F.col("frame_id").alias("__f"))
        cand = (cand.join(block, "video_id")
                    .filter((F.col("frame_id") != F.col("__f")) & (F.abs(F.col("t") - F.col("__t")) >= min_gap))
                    .drop("__f", "__t"))
    return first_rows(accepted, [], -F.col("score"), order, budget) \
        .select("pick", "frame_id", "video_id", "score", "t")


def cluster_diverse(items: DataFrame, budget: int, cap: int, group_col: str = "label",
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Cluster labels as the diversity group; score = distance to the cluster's centre.

    Centres are plain averages per cluster and component (a partial aggregate
    over exploded components, one row per cluster and component), so the result is
    repeatable on any partitioning; ``kmeans_groups`` makes labels where there are
    none, repeatably too; items without a label are a cluster of their own.  Picks the items farthest from their centre, at most ``cap`` per cluster.
    """
    rows = items.select(F.col(id_col).alias("item_id"), F.col(vec_col).cast("array<double>").alias("emb"),
                        F.col(group_col).cast("string").alias("cluster"))
    parts = rows.select("item_id", "cluster", F.posexplode("emb").alias("i", "x"))
    # Sums of integers (2**-40 units) do not depend on the order of rows.
    mean = F.sum(F.round(F.col("x") * F.lit(float(1 << 40))).cast("decimal(38,0)")).cast("double")
    centres = (parts.groupBy("cluster", "i").agg((mean / F.lit(float(1 << 40)) / F.count(F.lit(1))).alias("c"))
               .groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda e: e["c"])
                                       .alias("centre")))
    centres, _ = checked_broadcast(centres.withColumnRenamed("cluster", "__of"))
    dist = F.sqrt(F.aggregate(F.zip_with("emb", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                              lambda acc, x: acc + x))
    scored = rows.join(centres, F.col("cluster").eqNullSafe(F.col("__of"))).select("item_id", "cluster", dist.alias("score"))
    order = [F.col("score").desc(), F.col("item_id").asc()]
    few = capped(scored, order, F.col("cluster"), cap)
    return first_rows(few, [], -F.col("score"), order, budget).select("pick", "item_id", "cluster", "score")


def kmeans_groups(items: DataFrame, k: int = 8, seed: int = SEED, vec_col: str = "embedding",
                  out: str = "label", id_col: str = "vec_id", rounds: int = 5) -> DataFrame:
    """``items`` with a cluster number in ``out`` (null where the vector takes no part), for ``cluster_diverse``."""
    groups = kmeans(items, k, rounds, seed, id_col, vec_col).select(F.col("item_id").alias("__id"), F.col("cluster").alias(out))
    groups = groups.dropDuplicates(["__id"])
    return items.drop(out).join(groups, F.col(id_col) == F.col("__id"), "left").drop("__id")


__all__ = ["ABLATION", "signal_ablation", "seed_spread", "budget_curve", "scene_split",
           "spaced_select", "cluster_diverse", "kmeans_groups"]

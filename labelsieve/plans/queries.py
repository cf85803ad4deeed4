"""Registered queries over the driver tables, each paired with DuckDB SQL.

Every query reads the whole tables (through the adapter views) so its work
grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import arms, clustering, evaluation, extensions, ingest, mining, scoring
from ..functions.columns import image_path
from ..params import Params
from ..sources import testdata as td
from ..session import materialize
from . import oracle as O

P = Params()
# Budget and cap used by the registered selection queries: with 1-25 orders per
# customer both bite at sf0.01.
BUDGET = P.label_budget
CAP = P.max_per_scene

Query = Callable[[SparkSession, str], DataFrame]


# What scores are made of; the boxes need not be joined and written for them.
SCORED = ("frame_id", "class_id", "confidence")


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    # The prediction table is written by the inference stage; write the view once.
    return materialize(td.predictions_v(spark, sf).select(*SCORED), "predictions")


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return mining.frame_scores(_predictions(spark, sf))


def q_class_counts(spark, sf):
    return mining.class_counts(td.predictions_v(spark, sf))


def q_uncertainty(spark, sf):
    return mining.frame_signals(td.predictions_v(spark, sf)).select("frame_id", "uncertainty")


def q_rare_class(spark, sf):
    return mining.frame_signals(td.predictions_v(spark, sf)).select("frame_id", "rare_class")


def q_frame_scores(spark, sf):
    return _scores(spark, sf)


def _scored_predictions(spark, sf):
    return materialize(td.scored_predictions_v(spark, sf), "scored_predictions")


def q_margin(spark, sf):
    """The mean gap between the two best class scores per frame."""
    return mining.frame_margins(td.scored_predictions_v(spark, sf))


MARGIN_WEIGHTS = {"uncertainty": 2.0, "rare_class": 1.0, "confusion": 1.0}


def q_margin_scores(spark, sf):
    """J3 with the margin as a third signal."""
    return mining.frame_scores(_scored_predictions(spark, sf), MARGIN_WEIGHTS)


def q_margin_select(spark, sf):
    """J4 over three signals."""
    return mining.select_capped(q_margin_scores(spark, sf), BUDGET, CAP)


def q_score_summary(spark, sf):
    return mining.score_summary(_scores(spark, sf))


def q_select_mined(spark, sf):
    return mining.select_capped(_scores(spark, sf), BUDGET, CAP)


def q_select_random(spark, sf):
    return mining.random_capped(_scores(spark, sf), BUDGET, CAP)


def _label_boxes(spark, sf):
    return ingest.label_boxes(td.annotations_v(spark, sf), td.categories_df(spark))


def q_label_boxes(spark, sf):
    return _label_boxes(spark, sf)


def q_convert_counters(spark, sf):
    return ingest.convert_counters(td.annotations_v(spark, sf))


def q_yolo_lines(spark, sf):
    return ingest.yolo_lines(_label_boxes(spark, sf))


def _split(spark, sf):
    return ingest.split_frames(td.inventory_v(spark, sf), P)


def q_split_manifest(spark, sf):
    return _split(spark, sf)


def q_split_sizes(spark, sf):
    return ingest.split_sizes(_split(spark, sf))


def q_split_invariants(spark, sf):
    return ingest.split_invariants(_split(spark, sf), td.inventory_v(spark, sf))


def _unlabeled_shards(spark, sf):
    unl = _split(spark, sf).filter(F.col("split") == "unlabeled")
    return scoring.assign_shards(unl.select("frame_id", "pos"), P.batch)


def q_shard_assignment(spark, sf):
    return _unlabeled_shards(spark, sf)


def q_pending_shards(spark, sf):
    """Resume after a run that committed the first half of the shards."""
    assigned = _unlabeled_shards(spark, sf)
    half = assigned.agg(F.max("shard_id")).first()[0] // 2
    done = assigned.filter(F.col("shard_id") <= half).select("shard_id").distinct()
    return scoring.pending_shards(assigned, done).select("frame_id", "shard_id")


def q_predictions_with_sentinels(spark, sf):
    unl = _split(spark, sf).filter(F.col("split") == "unlabeled")
    dets = td.predictions_v(spark, sf).filter(F.col("class_id") >= 0)
    return scoring.with_sentinels(unl, dets)


def q_score_frames(spark, sf):
    frames = _unlabeled_shards(spark, sf).withColumn("path", image_path("/images/train", "frame_id"))
    scored = scoring.score_frames(frames, td.toy_model_factory, batch=P.batch, conf_threshold=P.conf_threshold)
    return scored.drop("class_scores")  # the toy model gives none


# Two detectors of the fixture: the "mined" arm misses the boxes of every 11th
# supplier, the "random" arm those of every 7th.
MINED_DROP, RANDOM_DROP = 11, 7


def _lines(spark, sf):
    # Boxes and detections are both made of the line items with their class: joined and written once.
    return materialize(td.lines_v(spark, sf), "lines")


def _gt(spark, sf, lines):
    return td.ground_truth_v(spark, sf, lines)


def _det(spark, sf, lines, drop=MINED_DROP):
    return td.detections_v(spark, sf, drop, lines)


def _per_class(spark, sf, drop=MINED_DROP, arm=None):
    lines = _lines(spark, sf)
    ap = evaluation.ap_by_threshold(_det(spark, sf, lines, drop), _gt(spark, sf, lines))
    return evaluation.per_class_ap(ap, td.categories_df(spark), arm=arm)


def q_detection_matches(spark, sf):
    lines = _lines(spark, sf)
    return evaluation.detection_matches(_det(spark, sf, lines), _gt(spark, sf, lines))


def q_per_class_ap(spark, sf):
    return _per_class(spark, sf)


def q_map_summary(spark, sf):
    return evaluation.map_summary(_per_class(spark, sf))


def _both_arms(spark, sf):
    """Per-class AP of both arms, evaluated in one pass with the arm as a key."""
    lines = _lines(spark, sf)
    det = td.arm_detections_v(spark, sf, {"mined": MINED_DROP, "random": RANDOM_DROP}, lines)
    ap = evaluation.ap_by_threshold(det, _gt(spark, sf, lines), keys=("arm",))
    return materialize(evaluation.per_class_ap(ap, td.categories_df(spark)), "per_class")


def q_compare_arms(spark, sf):
    per = _both_arms(spark, sf)
    return evaluation.compare_arms(per.filter("arm = 'mined'"), per.filter("arm = 'random'"))


def q_compare_summary(spark, sf):
    return evaluation.compare_summary(evaluation.map_summary(_both_arms(spark, sf)))


def _annotations(spark, sf):
    # The label records are a stored file in the pipeline: for queries that read them again, write the view once.
    return materialize(td.annotations_v(spark, sf), "annotations")


def _arm_manifest(spark, sf, ann):
    split = _split(spark, sf)
    unl = split.filter(F.col("split") == "unlabeled").select("frame_id").repartition(td.line_tasks(spark, sf), "frame_id")
    pred = materialize(td.predictions_v(spark, sf).select(*SCORED).join(unl, "frame_id", "left_semi"), "predictions")
    sel = mining.selections(materialize(mining.frame_scores(pred), "scores"), BUDGET, CAP, P.seed)
    inventory = td.inventory_v(spark, sf).withColumn("path", image_path("/images/train", "frame_id"))
    return arms.arm_manifest(split, sel, inventory, ingest.labeled_frames(ann))


def q_arm_manifest(spark, sf):
    return _arm_manifest(spark, sf, td.annotations_v(spark, sf))


def q_arm_summary(spark, sf):
    return arms.arm_summary(_arm_manifest(spark, sf, td.annotations_v(spark, sf)))


def q_revealed_boxes(spark, sf):
    ann = _annotations(spark, sf)
    return arms.reveal_boxes(_arm_manifest(spark, sf, ann), ingest.label_boxes(ann, td.categories_df(spark)))


def q_class_distribution(spark, sf):
    ann = _annotations(spark, sf)
    boxes = materialize(ingest.label_boxes(ann, td.categories_df(spark)).select("frame_id", "class_id"), "boxes")
    revealed = arms.reveal_boxes(_arm_manifest(spark, sf, ann), boxes)
    return arms.class_distribution(revealed.filter(F.col("subset") == "train"), boxes)


BUDGETS = (250, 500, 1000, 2000)
SEEDS = (42, 43, 44, 45, 46)
MIN_GAP_DAYS = 60.0


def q_signal_ablation(spark, sf):
    return extensions.signal_ablation(_scores(spark, sf), BUDGET, CAP)


def q_seed_spread(spark, sf):
    return extensions.seed_spread(_scores(spark, sf), BUDGET, CAP, SEEDS)


def q_budget_curve(spark, sf):
    return extensions.budget_curve(q_select_mined(spark, sf), BUDGETS)


def q_scene_split(spark, sf):
    return extensions.scene_split(td.inventory_v(spark, sf), P)


def q_spaced_select(spark, sf):
    """S2 with the order date as the frame time (days)."""
    o = td.table(spark, sf, "orders")
    times = o.select(td.frame_key(F.col("o_custkey"), F.col("o_orderkey")).alias("frame_id"),
                     F.datediff(F.col("o_orderdate"), F.lit("1970-01-01")).alias("t"))
    return extensions.spaced_select(_scores(spark, sf), times, BUDGET, CAP, MIN_GAP_DAYS)


CLUSTER_BUDGET, CLUSTER_CAP = 30, 4


def q_cluster_diverse(spark, sf):
    """S5 with the table's own labels as clusters."""
    return extensions.cluster_diverse(td.table(spark, sf, "embeddings"), CLUSTER_BUDGET, CLUSTER_CAP)


KMEANS_K, KMEANS_ROUNDS = 6, 4


def q_kmeans_clusters(spark, sf):
    """S5 without given labels: repeatable k-means."""
    return clustering.kmeans(td.table(spark, sf, "embeddings"), KMEANS_K, KMEANS_ROUNDS, P.seed)


def q_kmeans_diverse(spark, sf):
    """The selection over clusters that were found."""
    items = extensions.kmeans_groups(td.table(spark, sf, "embeddings"), KMEANS_K, P.seed, out="found", rounds=KMEANS_ROUNDS)
    return extensions.cluster_diverse(materialize(items, "clusters"), CLUSTER_BUDGET, CLUSTER_CAP, group_col="found")


def q_greedy_matches(spark, sf):
    """C8 with the greedy assignment, on crowded images."""
    return evaluation.greedy_matches(*_crowded(spark, sf))


def q_greedy_ap(spark, sf):
    """D11 with the greedy assignment, on crowded images."""
    ap = evaluation.ap_by_threshold(*_crowded(spark, sf), matching=evaluation.greedy_matches)
    return evaluation.per_class_ap(ap, td.categories_df(spark))


def _crowded(spark, sf):
    lines = _lines(spark, sf)
    return td.crowded_detections_v(spark, sf, lines), td.crowded_ground_truth_v(spark, sf, lines)


def q_latest_labels(spark, sf):
    """Label boxes where some frames come twice, and some a third time without labels."""
    return ingest.label_boxes(td.repeated_annotations_v(spark, sf), td.categories_df(spark)) \
        .select("frame_id", "box_pos", "class_id")


def q_label_text(spark, sf):
    """The text of every label file."""
    ann = materialize(td.annotations_v(spark, sf), "annotations")
    lines = ingest.yolo_lines(ingest.label_boxes(ann, td.categories_df(spark)))
    return ingest.yolo_text(lines, ingest.labeled_frames(ann))


def q_evaluate_test(spark, sf):
    """The held-out frames' stored boxes against the predictions for the same frames."""
    test = _split(spark, sf).filter(F.col("split") == "val").select("frame_id")
    gt = materialize(evaluation.ground_truth_of(test, _label_boxes(spark, sf)), "test_gt")
    det = materialize(evaluation.detections_of(test, td.predictions_v(spark, sf)), "test_det")
    return evaluation.per_class_ap(evaluation.ap_by_threshold(det, gt), td.categories_df(spark))


DOC_BUDGET, DOC_CAP = 200, 11


def q_document_reveal(spark, sf):
    """The selection on another mapping: documents as items, source as the group, length as the
    score; labels are revealed for the picks only, and not all of them have one."""
    docs = td.table(spark, sf, "documents")
    scores = docs.select(F.concat("source", F.lit("-"), F.col("doc_id").cast("string")).alias("frame_id"),
                         F.col("n_chars").cast("double").alias("combined"))
    picks = mining.select_capped(scores, DOC_BUDGET, DOC_CAP)
    labels = td.table(spark, sf, "labels").select(F.col("doc_id").alias("__d"), "quality", "toxic")
    number = F.substring_index("frame_id", "-", -1).cast("long")
    return (picks.withColumn("doc_id", number).join(labels, F.col("doc_id") == F.col("__d"), "left")
            .select("pick", "doc_id", F.col("video_id").alias("source"), "score",
                    F.col("__d").isNotNull().alias("has_label"),
                    *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("quality", "toxic")]))


QUERIES: dict[str, Query] = {
    "class_counts": q_class_counts,
    "uncertainty": q_uncertainty,
    "rare_class": q_rare_class,
    "frame_scores": q_frame_scores,
    "score_summary": q_score_summary,
    "select_mined": q_select_mined,
    "select_random": q_select_random,
    "label_boxes": q_label_boxes,
    "convert_counters": q_convert_counters,
    "yolo_lines": q_yolo_lines,
    "split_manifest": q_split_manifest,
    "split_sizes": q_split_sizes,
    "split_invariants": q_split_invariants,
    "shard_assignment": q_shard_assignment,
    "pending_shards": q_pending_shards,
    "predictions_with_sentinels": q_predictions_with_sentinels,
    "score_frames": q_score_frames,
    "detection_matches": q_detection_matches,
    "per_class_ap": q_per_class_ap,
    "map_summary": q_map_summary,
    "compare_arms": q_compare_arms,
    "compare_summary": q_compare_summary,
    "arm_manifest": q_arm_manifest,
    "arm_summary": q_arm_summary,
    "revealed_boxes": q_revealed_boxes,
    "class_distribution": q_class_distribution,
    "signal_ablation": q_signal_ablation,
    "seed_spread": q_seed_spread,
    "budget_curve": q_budget_curve,
    "scene_split": q_scene_split,
    "spaced_select": q_spaced_select,
    "cluster_diverse": q_cluster_diverse,
    "latest_labels": q_latest_labels,
    "label_text": q_label_text,
    "evaluate_test": q_evaluate_test,
    "document_reveal": q_document_reveal,
    "margin": q_margin,
    "margin_scores": q_margin_scores,
    "margin_select": q_margin_select,
    "kmeans_clusters": q_kmeans_clusters,
    "kmeans_diverse": q_kmeans_diverse,
    "greedy_matches": q_greedy_matches,
    "greedy_ap": q_greedy_ap,
}

_SPLIT = O.split_manifest(P.seed_fraction, P.unlabeled_fraction, P.seed)
_UNL = O.unlabeled_shards(P.batch)
_ARMS = O.arms_ctes(BUDGET, CAP, P.seed_fraction, P.unlabeled_fraction, P.seed)
_EVAL = O.with_(O.categories_cte(), O.GROUND_TRUTH_V, O.detections_v("det_m", MINED_DROP),
                O.detections_v("det_r", RANDOM_DROP), O.detection_ap("det_m", "m"), O.detection_ap("det_r", "r"))
_CROWD = O.with_recursive(O.categories_cte(), O.CROWDED_GROUND_TRUTH_V, O.crowded_detections_v("det_g"),
                          O.detection_ap("det_g", "g", greedy=True))

ORACLE: dict[str, str] = {
    "class_counts": O.with_(O.PREDICTIONS_V, O.CLASS_COUNTS) + "select class_id, class_count from class_counts",
    "uncertainty": O.with_(O.PREDICTIONS_V, O.CLASS_COUNTS, O.SIGNALS) + "select frame_id, uncertainty from signals",
    "rare_class": O.with_(O.PREDICTIONS_V, O.CLASS_COUNTS, O.SIGNALS) + "select frame_id, rare_class from signals",
    "frame_scores": O.SCORED + "select * from scored",
    "score_summary": O.SCORED + ("select count(*) as n_frames, max(combined) as max_combined, "
                                 "median(combined) as median_combined from scored"),
    "select_mined": O.SCORED + "," + O.selected(BUDGET, CAP, "mined") + "select * from picked_mined",
    "select_random": O.SCORED + "," + O.selected(BUDGET, CAP, "random") + "select * from picked_random",
    "label_boxes": O.with_(O.LABEL_BOXES) + "select * from label_boxes",
    "convert_counters": O.CONVERT_COUNTERS,
    "yolo_lines": O.with_(O.LABEL_BOXES) + ("select frame_id, box_pos, printf('%d %.6f %.6f %.6f %.6f', class_id, "
                                            "x_center, y_center, width, height) as line from label_boxes"),
    "split_manifest": O.with_(O.INVENTORY_V, _SPLIT) + "select * from split_manifest",
    "split_sizes": O.with_(O.INVENTORY_V, _SPLIT) + ("select split, count(*) as n_frames "
                                                    "from split_manifest group by split"),
    "split_invariants": O.with_(O.INVENTORY_V, _SPLIT) + (
        "select (select count(distinct frame_id) from split_manifest) as n_assigned, "
        "(select count(*) from (select frame_id from split_manifest group by frame_id having count(*) > 1)) "
        "as n_overlapping, "
        "(select count(*) from (select distinct frame_id from inventory_v) i "
        "where i.frame_id not in (select frame_id from split_manifest)) as n_missing"),
    "shard_assignment": O.with_(O.INVENTORY_V, _SPLIT, _UNL) + "select frame_id, pos, shard_id from unl",
    "pending_shards": O.with_(O.INVENTORY_V, _SPLIT, _UNL) + (
        "select frame_id, shard_id from unl where shard_id > (select max(shard_id) // 2 from unl)"),
    "predictions_with_sentinels": O.with_(O.PREDICTIONS_V, O.INVENTORY_V, _SPLIT) + (
        "select m.frame_id, coalesce(d.class_id, -1) as class_id, coalesce(d.confidence, 0e0) as confidence, "
        "coalesce(d.x_center, 0e0) as x_center, coalesce(d.y_center, 0e0) as y_center, "
        "coalesce(d.width, 0e0) as width, coalesce(d.height, 0e0) as height "
        "from split_manifest m left join (select * from predictions_v where class_id >= 0) d "
        "on m.frame_id = d.frame_id where m.split = 'unlabeled'"),
    "score_frames": O.with_(O.INVENTORY_V, _SPLIT, _UNL, O.TOY_SCORED) + "select * from toy_scored",
    "detection_matches": _EVAL + "select * from m_flags",
    "per_class_ap": _EVAL + "select * from m_per_class",
    "map_summary": _EVAL + "select * from m_map",
    "compare_arms": _EVAL + ("select m.class_id, coalesce(m.class_name, r.class_name) as class_name, "
                             "m.ap50_95 as mined_ap, r.ap50_95 as random_ap, m.ap50_95 - r.ap50_95 as delta_ap "
                             "from m_per_class m full join r_per_class r on m.class_id = r.class_id"),
    "compare_summary": _EVAL + (
        "select m.map50 as mined_map50, r.map50 as random_map50, m.map50_95 as mined_map50_95, "
        "r.map50_95 as random_map50_95, m.map50 - r.map50 as delta_map50, "
        "m.map50_95 - r.map50_95 as delta_map50_95, "
        "case when m.map50 > r.map50 then 'mined' when m.map50 < r.map50 then 'random' else 'tie' end as verdict "
        "from m_map m, r_map r"),
    "arm_manifest": _ARMS + "select * from arm_manifest",
    "arm_summary": _ARMS + ("select arm, subset, count(*) as n_frames, count(*) filter (where has_image) as n_images, "
                            "count(*) filter (where has_label) as n_labels from arm_manifest group by arm, subset"),
    "revealed_boxes": _ARMS + "," + O.LABEL_BOXES + (
        " select m.arm, m.subset, b.* from label_boxes b join arm_manifest m on b.frame_id = m.frame_id "
        "where m.has_label"),
    "class_distribution": _ARMS + "," + O.LABEL_BOXES + """,
revealed as (select m.arm, b.class_id from label_boxes b join arm_manifest m on b.frame_id = m.frame_id
             where m.has_label and m.subset = 'train'),
corpus as (select class_id, count(*) as corpus_n from label_boxes group by class_id),
corpus_s as (select class_id, corpus_n, corpus_n / sum(corpus_n) over () as corpus_share from corpus),
sel as (select a.arm, c.class_id, count(r.arm) as selected_n
        from (select distinct arm from revealed) a cross join corpus c
        left join revealed r on r.arm = a.arm and r.class_id = c.class_id group by a.arm, c.class_id),
sel_s as (select *, selected_n / sum(selected_n) over (partition by arm) as selected_share from sel)
select s.arm, s.class_id, s.selected_n, c.corpus_n, s.selected_share, c.corpus_share,
       s.selected_share / c.corpus_share as share_ratio
from sel_s s join corpus_s c on s.class_id = c.class_id""",
    "signal_ablation": O.SCORED + "," + O.signal_ablation(BUDGET, CAP) + "select * from abl_picked",
    "seed_spread": O.SCORED + "," + O.seed_spread(BUDGET, CAP, SEEDS) + (
        "select seed, n_selected, mean_score, round(avg(mean_score) over (), 10) as seeds_mean, "
        "round(stddev_samp(mean_score) over (), 10) as seeds_stddev from ss_per"),
    "budget_curve": O.SCORED + "," + O.selected(BUDGET, CAP, "mined") + (
        ", b as (select unnest([" + ", ".join(str(x) for x in BUDGETS) + "]) as budget) "
        "select budget, count(*) as n_frames, count(distinct video_id) as n_videos, "
        "cast(sum(cast(round((score) * 1099511627776e0) as hugeint)) as double) / 1099511627776e0 / count(*) as mean_score "
        "from picked_mined join b on pick <= budget group by budget"),
    "scene_split": O.with_(O.INVENTORY_V, O.scene_split(P.seed_fraction, P.unlabeled_fraction, P.seed)) + (
        "select f.frame_id, f.video_id, a.split from sc_frames f join sc_assign a on f.video_id = a.video_id"),
    "spaced_select": O.SCORED + "," + O.spaced_select(BUDGET, CAP, MIN_GAP_DAYS) + "select * from sp_picked",
    "cluster_diverse": O.cluster_diverse(CLUSTER_BUDGET, CLUSTER_CAP),
    "latest_labels": O.with_(O.LABEL_BOXES) + (
        "select frame_id, box_pos, class_id from label_boxes "
        f"where box_pos = 0 or cast(split_part(frame_id, '-', 2) as bigint) % {td.REPEATED} <> 0"),
    "label_text": O.with_(O.LABEL_BOXES) + (
        "select f.frame_id, coalesce(string_agg(printf('%d %.6f %.6f %.6f %.6f', class_id, x_center, y_center, "
        "width, height), chr(10) order by box_pos), '') as text "
        "from (select distinct frame_id from label_lines) f left join label_boxes b on f.frame_id = b.frame_id "
        "group by f.frame_id"),
    "evaluate_test": O.with_(O.categories_cte(), O.INVENTORY_V, _SPLIT, O.LABEL_BOXES, O.PREDICTIONS_V,
                             O.TEST_TABLES, O.detection_ap("test_det", "t")) + "select * from t_per_class",
    "document_reveal": f"""
with d as (
  select doc_id, source, cast(n_chars as double) as score, concat(source, '-', cast(doc_id as varchar)) as id,
         row_number() over (partition by source order by n_chars desc, concat(source, '-', cast(doc_id as varchar))) as r
  from documents
),
p as (select *, row_number() over (order by score desc, id) as pick from d where r <= {DOC_CAP})
select cast(pick as bigint) as pick, p.doc_id, source, score, l.doc_id is not null as has_label,
       coalesce(quality, -1) as quality, coalesce(toxic, -1) as toxic
from p left join labels l on p.doc_id = l.doc_id where pick <= {DOC_BUDGET}""",
    "margin": O.with_(O.SCORED_PREDICTIONS_V, O.MARGINS) + "select frame_id, n_margins, margin from margins",
    "margin_scores": O.MARGIN_SCORED + "select * from scored",
    "kmeans_clusters": "with " + O.kmeans(KMEANS_K, KMEANS_ROUNDS, P.seed) + "\nselect * from clusters",
    "kmeans_diverse": O.cluster_diverse(CLUSTER_BUDGET, CLUSTER_CAP, O.kmeans(KMEANS_K, KMEANS_ROUNDS, P.seed)),
    "greedy_matches": _CROWD + "select * from g_flags",
    "greedy_ap": _CROWD + "select * from g_per_class",
    "margin_select": O.MARGIN_SCORED + "," + O.selected(BUDGET, CAP, "mined") + "select * from picked_mined",
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Score every frame and pick the capped, budgeted mined arm."""
    return q_select_mined(spark, sf)

"""DuckDB SQL for every registered query (the correctness oracle).

The adapter views of ``sources.testdata`` are repeated here as CTE text.
Doubles are written as ``e0`` literals so DuckDB and Spark do the same IEEE
operations; counts are cast to ``bigint``.
"""

from __future__ import annotations

from ..params import AMBIGUOUS_HIGH, AMBIGUOUS_LOW, SEED

def _padded(key: str) -> str:
    return f"lpad(cast({key} as varchar), greatest(8, length(cast({key} as varchar)))::int, '0')"


FRAME_KEY = f"concat({_padded('o_custkey')}, '-', {_padded('o_orderkey')})"

PREDICTIONS_V = f"""
predictions_v as (
  select {FRAME_KEY} as frame_id,
         case when l_orderkey is null then -1 else cast(p_size % 13 as int) end as class_id,
         case when l_orderkey is null then 0e0 else 0.25e0 + 0.015e0 * (l_quantity - 1) end as confidence,
         case when l_orderkey is null then 0e0 else (l_partkey % 40) / 50e0 + 0.05e0 end as x_center,
         case when l_orderkey is null then 0e0 else (l_suppkey % 40) / 50e0 + 0.05e0 end as y_center,
         case when l_orderkey is null then 0e0 else 0.1e0 + l_quantity / 500e0 end as width,
         case when l_orderkey is null then 0e0 else 0.1e0 + l_quantity / 500e0 end as height
  from orders left join (lineitem join part on l_partkey = p_partkey) on o_orderkey = l_orderkey
)"""

INVENTORY_V = f"""
inventory_v as (select {FRAME_KEY} as frame_id from orders)"""

GROUND_TRUTH_V = """
ground_truth_v as (
  select l_orderkey as image_id, cast(p_size % 13 as int) as class_id,
         cast(row_number() over (partition by l_orderkey, cast(p_size % 13 as int)
           order by l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) as bigint) as gt_id,
         (l_partkey % 40) / 50e0 + 0.05e0 as x_center, (l_suppkey % 40) / 50e0 + 0.05e0 as y_center,
         0.1e0 + l_quantity / 500e0 as width, 0.1e0 + l_quantity / 500e0 as height
  from lineitem join part on l_partkey = p_partkey
  where l_partkey % 10 <> 0
)"""


def detections_v(name: str = "detections_v", drop_mod: int = 11) -> str:
    return f"""
{name} as (
  select l_orderkey as image_id, cast(p_size % 13 as int) as class_id,
         concat_ws('-', cast(l_orderkey as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar),
                   cast(l_linenumber as varchar), cast(cast(l_quantity as int) as varchar),
                   cast(cast(round(l_extendedprice * 100) as bigint) as varchar)) as det_id,
         0.25e0 + 0.015e0 * (l_quantity - 1) as confidence,
         (l_partkey % 40) / 50e0 + 0.05e0 + ((l_suppkey % 7) - 3) * 0.01e0 as x_center,
         (l_suppkey % 40) / 50e0 + 0.05e0 + ((l_partkey % 5) - 2) * 0.01e0 as y_center,
         0.1e0 + l_quantity / 500e0 as width, 0.1e0 + l_quantity / 500e0 as height
  from lineitem join part on l_partkey = p_partkey
  where l_suppkey % {drop_mod} <> 0
)"""


def _num(x: float) -> str:
    return repr(float(x)) + "e0" if "e" not in repr(float(x)) else repr(float(x))


CLASS_COUNTS = f"""
class_counts as (select class_id, count(*) as class_count from predictions_v group by class_id)"""

SIGNALS = f"""
signals as (
  select frame_id, cast(sum(u) as bigint) as uncertainty,
         coalesce(list_reduce(list(k / cast(class_count as double) order by f.class_id) filter (where f.class_id >= 0),
                              lambda a, b: a + b), 0e0) as rare_class
  from (select frame_id, class_id, count(*) as k,
               count(*) filter (where confidence between {_num(AMBIGUOUS_LOW)} and {_num(AMBIGUOUS_HIGH)}) as u
        from predictions_v group by frame_id, class_id) f
  join class_counts c on f.class_id = c.class_id
  group by frame_id
)"""

SCORES = """
scores as (
  select frame_id, uncertainty, rare_class,
         ((rank() over (order by uncertainty) - 1) + (count(*) over (partition by uncertainty) + 1) / 2e0)
           / count(*) over () as uncertainty_norm,
         ((rank() over (order by rare_class) - 1) + (count(*) over (partition by rare_class) + 1) / 2e0)
           / count(*) over () as rare_class_norm
  from signals
),
scored as (
  select frame_id, uncertainty, rare_class, uncertainty_norm, rare_class_norm,
         0.5e0 * uncertainty_norm + 0.5e0 * rare_class_norm as combined
  from scores
)"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


def with_recursive(*ctes: str) -> str:
    return "with recursive " + ",".join(ctes) + "\n"


SCORED = with_(PREDICTIONS_V, CLASS_COUNTS, SIGNALS, SCORES)


SCORED_PREDICTIONS_V = f"""
scored_predictions_v as (
  select {FRAME_KEY} as frame_id, case when l_orderkey is null then -1 else cast(p_size % 13 as int) end as class_id,
         case when l_orderkey is null then 0e0 else conf end as confidence,
         case when l_orderkey is null or l_suppkey % 9 = 0 then null when l_partkey % 8 = 0 then [conf]
              else list_transform(range(13), lambda c: case when c = p_size % 13 then conf
                   else conf * (((l_partkey * 7 + l_suppkey * 3 + c * 11) % 21) / 20e0) end) end as class_scores
  from orders left join (select *, 0.25e0 + 0.015e0 * (l_quantity - 1) as conf
                         from lineitem join part on l_partkey = p_partkey) on o_orderkey = l_orderkey
)"""

MARGINS = """
gaps as (
  select frame_id, case len(class_scores) when 1 then class_scores[1]
                   else list_reverse_sort(class_scores)[1] - list_reverse_sort(class_scores)[2] end as gap
  from scored_predictions_v
),
margins as (
  select frame_id, count(gap) as n_margins,
         case when count(gap) > 0
              then cast(sum(cast(round(gap * 1099511627776e0) as hugeint)) as double) / 1099511627776e0 / count(gap) end as margin
  from gaps group by frame_id
)"""

MARGIN_SCORED = with_(SCORED_PREDICTIONS_V, "predictions_v as (select * from scored_predictions_v)", CLASS_COUNTS, SIGNALS,
                      MARGINS) + """,
three as (select s.frame_id, uncertainty, rare_class, 1e0 - margin as confusion
          from signals s join margins m on s.frame_id = m.frame_id),
normed as (
  select *,
         ((rank() over (order by uncertainty) - 1) + (count(*) over (partition by uncertainty) + 1) / 2e0)
           / count(*) over () as uncertainty_norm,
         ((rank() over (order by rare_class) - 1) + (count(*) over (partition by rare_class) + 1) / 2e0)
           / count(*) over () as rare_class_norm,
         ((rank() over (order by confusion nulls first) - 1) + (count(*) over (partition by confusion) + 1) / 2e0)
           / count(*) over () as confusion_norm
  from three
),
scored as (select *, 0.5e0 * uncertainty_norm + 0.25e0 * rare_class_norm + 0.25e0 * confusion_norm as combined from normed)"""


def selected(budget: int, cap: int, arm: str = "mined", seed: int = SEED) -> str:
    """Capped top-``budget`` selection over ``scored`` (mined) or md5 order (random)."""
    if arm == "mined":
        order = "combined desc, frame_id"
    else:
        order = f"md5(concat('{seed}:random:', frame_id)), frame_id"
    return f"""
capped_{arm} as (
  select frame_id, split_part(frame_id, '-', 1) as video_id, combined,
         row_number() over (partition by split_part(frame_id, '-', 1) order by {order}) as vr
  from scored
),
picked_{arm} as (
  select '{arm}' as arm, cast(row_number() over (order by {order}) as bigint) as pick,
         frame_id, video_id, combined as score
  from capped_{arm} where vr <= {cap}
  qualify pick <= {budget}
)"""


LABEL_BOXES = f"""
label_lines as (
  select {FRAME_KEY} as frame_id, l_returnflag,
         cast(row_number() over (partition by l_orderkey
           order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 as int) as box_pos,
         cast(p_size % 13 as int) as class_id,
         (l_partkey % 40) / 50e0 + 0.05e0 as xc, (l_suppkey % 40) / 50e0 + 0.05e0 as yc,
         0.1e0 + l_quantity / 500e0 as w, 0.1e0 + l_quantity / 500e0 as h
  from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey
),
label_px as (
  select frame_id, box_pos, class_id, l_returnflag,
         (xc - w / 2e0) * 1280e0 as x1, (yc - h / 2e0) * 720e0 as y1,
         (xc + w / 2e0) * 1280e0 as x2, (yc + h / 2e0) * 720e0 as y2
  from label_lines
),
label_boxes as (
  select frame_id, box_pos, class_id,
         (x1 + x2) / 2e0 / 1280e0 as x_center, (y1 + y2) / 2e0 / 720e0 as y_center,
         (x2 - x1) / 1280e0 as width, (y2 - y1) / 720e0 as height
  from label_px where l_returnflag <> 'R'
)"""

CONVERT_COUNTERS = """
select cast(count(*) filter (where has_lines) as bigint) as converted,
       cast(count(*) filter (where not has_lines) as bigint) as skipped
from (select o_orderkey, exists (select 1 from lineitem where l_orderkey = o_orderkey) as has_lines from orders)
"""


def split_manifest(seed_fraction: float, unlabeled_fraction: float, seed: int = SEED) -> str:
    return f"""
inv as (select distinct frame_id from inventory_v),
numbered as (
  select frame_id, cast(row_number() over (order by md5(concat('{seed}:split:', frame_id)), frame_id) - 1 as bigint) as g,
         count(*) over () as n
  from inv
),
cuts as (
  select frame_id, g, cast(floor(n * {seed_fraction!r}e0) as bigint) as seed_end,
         cast(floor(n * {seed_fraction!r}e0) as bigint) + cast(floor(n * {unlabeled_fraction!r}e0) as bigint) as unl_end
  from numbered
),
split_manifest as (
  select frame_id,
         case when g < seed_end then 'seed' when g < unl_end then 'unlabeled' else 'val' end as split,
         cast(g - case when g < seed_end then 0 when g < unl_end then seed_end else unl_end end as bigint) as pos
  from cuts
)"""


def unlabeled_shards(shard_size: int) -> str:
    return f"""
unl as (
  select frame_id, pos, cast(pos // {shard_size} as bigint) as shard_id,
         cast(split_part(frame_id, '-', 2) as bigint) as okey
  from split_manifest where split = 'unlabeled'
)"""


TOY_SCORED = """
toy_raw as (
  select frame_id, shard_id, okey, unnest(range(okey % 4)) as j from unl
),
toy_kept as (
  select frame_id, cast((okey + j) % 13 as int) as class_id, ((okey * 7 + j * 13) % 100) / 100e0 as confidence,
         ((okey + j) % 50) / 50e0 + 0.01e0 as x_center, ((okey * 3 + j) % 50) / 50e0 + 0.01e0 as y_center,
         0.1e0 as width, 0.1e0 as height, shard_id
  from toy_raw where ((okey * 7 + j * 13) % 100) / 100e0 >= 0.25e0
),
toy_scored as (
  select * from toy_kept
  union all
  select frame_id, -1, 0e0, 0e0, 0e0, 0e0, 0e0, shard_id from unl
  where frame_id not in (select frame_id from toy_kept)
)"""


THRESHOLDS_SQL = "[0.5e0, 0.55e0, 0.6e0, 0.65e0, 0.7e0, 0.75e0, 0.8e0, 0.85e0, 0.9e0, 0.95e0]"

_IOU = """greatest(0e0, least(d.x_center + d.width / 2e0, g.x_center + g.width / 2e0)
               - greatest(d.x_center - d.width / 2e0, g.x_center - g.width / 2e0))
     * greatest(0e0, least(d.y_center + d.height / 2e0, g.y_center + g.height / 2e0)
               - greatest(d.y_center - d.height / 2e0, g.y_center - g.height / 2e0))"""


CROWDED_GROUND_TRUTH_V = """
ground_truth_v as (
  select l_suppkey as image_id, cast(p_size % 13 as int) as class_id,
         cast(row_number() over (partition by l_suppkey, cast(p_size % 13 as int)
           order by l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) as bigint) as gt_id,
         (l_partkey % 40) / 50e0 + 0.05e0 as x_center, (l_suppkey % 40) / 50e0 + 0.05e0 as y_center,
         0.1e0 + l_quantity / 500e0 as width, 0.1e0 + l_quantity / 500e0 as height
  from lineitem join part on l_partkey = p_partkey
  where l_partkey % 10 <> 0
)"""


def crowded_detections_v(name: str) -> str:
    return (detections_v(name, 11).replace("select l_orderkey as image_id", "select l_suppkey as image_id")
            .replace("where l_suppkey % 11", "where l_orderkey % 11"))


def _greedy(p: str) -> str:
    """Detections one after the other, each with the list of boxes taken before it."""
    return f"""
{p}_cand as materialized (
  select ti, image_id, class_id, det_id, list(gt_id order by iou desc, gt_id) as boxes,
         row_number() over (partition by ti, image_id, class_id order by confidence desc, det_id) as rn
  from {p}_pairs join {p}_thr on iou >= t group by ti, image_id, class_id, det_id, confidence
),
{p}_walk as (
  select distinct ti, image_id, class_id, 0::bigint as rn, []::bigint[] as used, null::bigint as pick, null::varchar as det_id
  from {p}_cand
  union all
  select ti, image_id, class_id, rn, case when pick is null then used else list_append(used, pick) end, pick, det_id
  from (select c.*, w.used, list_filter(c.boxes, lambda b: not list_contains(w.used, b))[1] as pick
        from {p}_walk w join {p}_cand c
          on c.ti = w.ti and c.image_id = w.image_id and c.class_id = w.class_id and c.rn = w.rn + 1)
),
{p}_win as (select image_id, class_id, det_id, ti from {p}_walk where pick is not null),"""


def _voc(p: str) -> str:
    """Each detection claims its best box; the most confident claim wins."""
    return f"""
{p}_top as (
  select * from {p}_pairs where iou >= 0.5e0
  qualify row_number() over (partition by image_id, class_id, det_id order by iou desc, gt_id) = 1
),
{p}_claims as (select b.*, ti, t from {p}_top b join {p}_thr on b.iou >= t),
{p}_win as (
  select image_id, class_id, det_id, ti from {p}_claims
  qualify row_number() over (partition by ti, image_id, class_id, gt_id order by confidence desc, det_id) = 1
),"""


def detection_ap(det: str, prefix: str, greedy: bool = False) -> str:
    """CTEs ``{prefix}_flags`` (per detection TP flags) and ``{prefix}_ap``
    (class_id, t, ap) for detections in CTE ``det`` against ``ground_truth_v``.
    ``greedy``: a detection that loses its best box takes its next free one (needs ``with recursive``)."""
    p = prefix
    flags = ", ".join(f"max(case when ti = {i} then 1 else 0 end) as tp_{i}" for i in range(10))
    return f"""
{p}_inter as (
  select d.image_id, d.class_id, d.det_id, d.confidence, g.gt_id,
         {_IOU} as inter,
         d.width * d.height + g.width * g.height as area_sum
  from {det} d join ground_truth_v g on d.image_id = g.image_id and d.class_id = g.class_id
  where d.width > 0 and d.height > 0 and g.width > 0 and g.height > 0
),
{p}_pairs as (
  select *, case when area_sum - inter > 0 then inter / (area_sum - inter) else 0e0 end as iou from {p}_inter
),
{p}_thr as (select unnest(range(10)) as ti, unnest({THRESHOLDS_SQL}) as t),{_greedy(p) if greedy else _voc(p)}
{p}_flags as (
  select d.image_id, d.class_id, d.det_id, d.confidence, {flags}
  from {det} d left join {p}_win w on d.det_id = w.det_id and d.image_id = w.image_id and d.class_id = w.class_id
  group by d.image_id, d.class_id, d.det_id, d.confidence
),
{p}_ranked as (
  select f.*, t.ti, t.t,
         case {" ".join(f"when t.ti = {i} then tp_{i}" for i in range(10))} end as tp,
         row_number() over (partition by f.class_id, t.ti order by f.confidence desc, f.image_id, f.det_id) as rnk
  from {p}_flags f, {p}_thr t
),
{p}_cum as (
  select class_id, t, rnk, tp, sum(tp) over (partition by class_id, t order by rnk) as ctp from {p}_ranked
),
{p}_ngt as (select class_id, count(*) as n_gt from ground_truth_v group by class_id),
{p}_best as (
  select c.class_id, t, (100 * ctp) // n_gt as bucket, max(ctp / rnk) as prec
  from {p}_cum c join {p}_ngt n on c.class_id = n.class_id where tp = 1
  group by c.class_id, t, bucket
),
{p}_env as (
  select class_id, t, max(prec) over (partition by class_id, t order by bucket desc) as env,
         bucket - coalesce(lag(bucket) over (partition by class_id, t order by bucket), -1) as levels
  from {p}_best
),
{p}_apt as (
  select class_id, t, cast(sum(cast(round((env * levels) * 1099511627776e0) as hugeint)) as double) / 1099511627776e0 / 101e0 as ap
  from {p}_env group by class_id, t
),
{p}_ap as (
  select n.class_id, t.t, coalesce(a.ap, 0e0) as ap
  from {p}_ngt n cross join {p}_thr t left join {p}_apt a on a.class_id = n.class_id and a.t = t.t
),
{p}_per_class as (
  select a.class_id, coalesce(c.class_name, 'class_' || cast(a.class_id as varchar)) as class_name,
         max(case when t = 0.5e0 then ap end) as ap50,
         cast(sum(cast(round((ap) * 1099511627776e0) as hugeint)) as double) / 1099511627776e0 / count(*) as ap50_95
  from {p}_ap a left join categories c on a.class_id = c.class_id
  group by a.class_id, c.class_name
),
{p}_map as (
  select cast(sum(cast(round((ap50) * 1099511627776e0) as hugeint)) as double) / 1099511627776e0 / count(*) as map50,
         cast(sum(cast(round((ap50_95) * 1099511627776e0) as hugeint)) as double) / 1099511627776e0 / count(*) as map50_95
  from {p}_per_class
)"""


def categories_cte() -> str:
    from ..params import CATEGORY_IDS
    rows = ", ".join(f"({i}, '{n}')" for n, i in CATEGORY_IDS.items())
    return f"""
categories as (select * from (values {rows}) v(class_id, class_name))"""


def arms_ctes(budget: int, cap: int, seed_fraction: float, unlabeled_fraction: float, seed: int = SEED) -> str:
    """Split, scores over the unlabeled pool, both selections, and the arm manifest."""
    pred_all = PREDICTIONS_V.replace("predictions_v as (", "predictions_all as (", 1)
    pred_unl = """
predictions_v as (
  select * from predictions_all
  where frame_id in (select frame_id from split_manifest where split = 'unlabeled')
)"""
    manifest = f"""
labeled as (
  select distinct {FRAME_KEY} as frame_id from orders join lineitem on o_orderkey = l_orderkey
),
members as (
  select arm, 'train' as subset, frame_id from split_manifest, (values ('mined'), ('random')) a(arm)
  where split = 'seed'
  union
  select arm, 'train' as subset, frame_id from picked_mined
  union
  select arm, 'train' as subset, frame_id from picked_random
  union all
  select arm, 'val' as subset, frame_id from split_manifest, (values ('mined'), ('random')) a(arm)
  where split = 'val'
),
arm_manifest as (
  select m.arm, m.subset, m.frame_id, '/images/train/' || m.frame_id || '.jpg' as image_path,
         true as has_image, l.frame_id is not null as has_label
  from members m left join labeled l on m.frame_id = l.frame_id
)"""
    return (with_(INVENTORY_V, split_manifest(seed_fraction, unlabeled_fraction, seed), pred_all, pred_unl,
                  CLASS_COUNTS, SIGNALS, SCORES)
            + "," + selected(budget, cap, "mined", seed) + "," + selected(budget, cap, "random", seed)
            + "," + manifest)


def signal_ablation(budget: int, cap: int) -> str:
    variants = {"both": "0.5e0 * uncertainty_norm + 0.5e0 * rare_class_norm",
                "uncertainty": "1.0e0 * uncertainty_norm + 0.0e0 * rare_class_norm",
                "rare_class": "0.0e0 * uncertainty_norm + 1.0e0 * rare_class_norm"}
    union = " union all ".join(f"select '{k}' as variant, frame_id, {v} as score from scored"
                               for k, v in variants.items())
    return f"""
abl as ({union}),
abl_capped as (
  select *, split_part(frame_id, '-', 1) as video_id,
         row_number() over (partition by variant, split_part(frame_id, '-', 1) order by score desc, frame_id) as vr
  from abl
),
abl_picked as (
  select variant, cast(row_number() over (partition by variant order by score desc, frame_id) as bigint) as pick,
         frame_id, video_id, score
  from abl_capped where vr <= {cap}
  qualify pick <= {budget}
)"""


def seed_spread(budget: int, cap: int, seeds=(42, 43, 44, 45, 46)) -> str:
    vals = ", ".join(f"({x})" for x in seeds)
    return f"""
ss as (
  select s.seed, frame_id, combined as score, md5(concat(cast(s.seed as varchar), ':random:', frame_id)) as h
  from scored, (values {vals}) s(seed)
),
ss_capped as (
  select *, row_number() over (partition by seed, split_part(frame_id, '-', 1) order by h, frame_id) as vr from ss
),
ss_picked as (
  select seed, score, row_number() over (partition by seed order by h, frame_id) as pick
  from ss_capped where vr <= {cap}
  qualify pick <= {budget}
),
ss_per as (
  select seed, count(*) as n_selected,
         cast(sum(cast(round((score) * 1099511627776e0) as hugeint)) as double) / 1099511627776e0 / count(*) as mean_score
  from ss_picked group by seed
)"""


def scene_split(seed_fraction: float, unlabeled_fraction: float, seed: int = SEED) -> str:
    return f"""
sc_frames as (select distinct frame_id, split_part(frame_id, '-', 1) as video_id from inventory_v),
sc_videos as (
  select video_id, count(*) as n, md5(concat('{seed}:scene:', video_id)) as h from sc_frames group by video_id
),
sc_cum as (
  select video_id, n, sum(n) over (order by h, video_id rows between unbounded preceding and current row) as c,
         sum(n) over () as total
  from sc_videos
),
sc_assign as (
  select video_id,
         case when c - n < cast(floor(total * {seed_fraction!r}e0) as bigint) then 'seed'
              when c - n < cast(floor(total * {seed_fraction!r}e0) as bigint)
                           + cast(floor(total * {unlabeled_fraction!r}e0) as bigint) then 'unlabeled'
              else 'val' end as split
  from sc_cum
)"""


TEST_TABLES = """
ground_truth_v as (
  select frame_id as image_id, class_id, cast(box_pos as bigint) as gt_id, x_center, y_center, width, height
  from label_boxes where frame_id in (select frame_id from split_manifest where split = 'val')
),
test_det as (
  select frame_id as image_id, class_id, confidence, x_center, y_center, width, height,
         row_number() over (partition by frame_id
           order by confidence desc, class_id, x_center, y_center, width, height) as det_id
  from predictions_v
  where class_id >= 0 and frame_id in (select frame_id from split_manifest where split = 'val')
)"""


def spaced_select(budget: int, cap: int, min_gap: float) -> str:
    """The greedy rounds one after the other: best frame of each video, then the frames far enough from it."""
    rounds = ""
    for r in range(cap):
        rounds += f"""
sp_top{r} as materialized (
  select * from sp_cand{r} qualify row_number() over (partition by video_id order by score desc, frame_id) = 1
),
sp_cand{r + 1} as materialized (
  select c.* from sp_cand{r} c join sp_top{r} p on c.video_id = p.video_id
  where c.frame_id <> p.frame_id and abs(c.t - p.t) >= {_num(min_gap)}
),"""
    union = " union all ".join(f"select * from sp_top{r}" for r in range(cap))
    return f"""
sp_cand0 as materialized (
  select s.frame_id, split_part(s.frame_id, '-', 1) as video_id, combined as score,
         cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as double) as t
  from scored s join (select {FRAME_KEY} as frame_id, o_orderdate from orders) o on s.frame_id = o.frame_id
),{rounds}
sp_picked as (
  select cast(row_number() over (order by score desc, frame_id) as bigint) as pick, frame_id, video_id, score, t
  from ({union}) qualify pick <= {budget}
)"""


def _square_distance(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(range(1, 1 + len({a})), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])), "
            "lambda x, y: x + y)")


def kmeans(k: int, rounds: int, seed: int = SEED) -> str:
    """CTEs up to ``clusters`` (item_id, cluster, distance): farthest-first seeding, then ``rounds`` of Lloyd's algorithm."""
    unit = _num(float(1 << 30))
    parts = [f"""
vecs as materialized (select vec_id as item_id, cast(embedding as double[]) as v from embeddings),
seed_0 as materialized (select v from vecs order by md5(concat('{seed}:centre:', cast(item_id as varchar))), item_id limit 1),
far_0 as materialized (select item_id, vecs.v, {_square_distance('vecs.v', 's.v')} as d from vecs, seed_0 s)"""]
    for i in range(1, k):
        parts.append(f"""
seed_{i} as materialized (select v from far_{i - 1} where d > 0 order by d desc, item_id limit 1),
far_{i} as materialized (select item_id, f.v, least(d, {_square_distance('f.v', 's.v')}) as d from far_{i - 1} f, seed_{i} s)""")
    centres = " union all ".join(f"select {i} as c, v from seed_{i}" for i in range(k))
    parts.append(f"\ncentre_0 as materialized ({centres})")
    for r in range(rounds + 1):
        parts.append(f"""
near_{r} as materialized (
  select item_id, x.v, c, {_square_distance('x.v', 'm.v')} as d from vecs x, centre_{r} m
  qualify row_number() over (partition by item_id order by d, c) = 1)""")
        if r < rounds:
            parts.append(f"""
mean_{r} as (
  select c, list(m order by j) as v from (
    select c, j, cast(sum(cast(round_even(x * {unit}, 0) as hugeint)) as double) / {unit} / count(*) as m
    from (select c, generate_subscripts(v, 1) as j, unnest(v) as x from near_{r}) group by c, j) group by c),
centre_{r + 1} as materialized (
  select o.c, coalesce(m.v, o.v) as v from centre_{r} o left join mean_{r} m on o.c = m.c)""")
    parts.append(f"\nclusters as (select item_id, cast(c as int) as cluster, sqrt(d) as distance from near_{rounds})")
    return ",".join(parts)


def cluster_diverse(budget: int, cap: int, labels: str = "") -> str:
    """Farthest items of each cluster; ``labels``: CTEs with ``clusters`` to use in place of the table's own labels."""
    source = ("select vec_id as item_id, cast(label as varchar) as cluster, cast(embedding as double[]) as e from embeddings"
              if not labels else "select vec_id as item_id, cast(cluster as varchar) as cluster, cast(embedding as double[]) as e "
              "from embeddings join clusters on vec_id = item_id")
    unit = _num(float(1 << 40))
    return f"""
with {labels + "," if labels else ""} v as ({source}),
x as (select cluster, generate_subscripts(e, 1) as i, unnest(e) as x from v),
m as (select cluster, i, cast(sum(cast(round(x * {unit}) as hugeint)) as double) / {unit} / count(*) as c
      from x group by cluster, i),
k as (select cluster, list(c order by i) as c from m group by cluster),
s as (
  select item_id, v.cluster, sqrt(list_reduce(list_prepend(0e0, list_transform(range(1, 1 + len(e)),
           lambda i: (e[i] - c[i]) * (e[i] - c[i]))), lambda a, b: a + b)) as score
  from v join k on v.cluster = k.cluster
),
r as (select *, row_number() over (partition by cluster order by score desc, item_id) as n from s),
p as (select *, row_number() over (order by score desc, item_id) as pick from r where n <= {cap})
select cast(pick as bigint) as pick, item_id, cluster, score from p where pick <= {budget}"""

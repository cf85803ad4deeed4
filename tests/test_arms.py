import pytest

from labelsieve.operators import arms

START = [f"s-{i}" for i in range(7)]
HOLD = [f"h-{i}" for i in range(6)]
POOL = [f"p-{i}" for i in range(12)]
PICKS = {"mined": POOL[:4] + START[:2], "random": POOL[3:8]}  # some picks stand in the seed, one in both arms


def _manifest(spark, no_image=(), no_label=()):
    splits = [(f, s) for frames, s in ((START, "seed"), (HOLD, "val"), (POOL, "unlabeled")) for f in frames]
    every = START + HOLD + POOL
    return arms.arm_manifest(
        spark.createDataFrame(splits, "frame_id string, split string"),
        spark.createDataFrame([(a, f) for a, fs in PICKS.items() for f in fs], "arm string, frame_id string"),
        spark.createDataFrame([(f, f"/pool/{f}.png") for f in every if f not in no_image] * 2,
                              "frame_id string, path string"),
        spark.createDataFrame([(f,) for f in every if f not in no_label] * 2, "frame_id string"))


def test_members_of_each_arm(spark):
    rows = _manifest(spark).collect()
    for arm, picks in PICKS.items():
        train = [r.frame_id for r in rows if (r.arm, r.subset) == (arm, "train")]
        assert sorted(train) == sorted({*START, *picks})
        assert sorted(r.frame_id for r in rows if (r.arm, r.subset) == (arm, "val")) == HOLD
    assert {r.image_path for r in rows} == {f"/pool/{r.frame_id}.png" for r in rows}


def test_missing_images_and_labels_are_flagged(spark):
    m = _manifest(spark, no_image={"h-1", "p-0"}, no_label={"s-3", "p-7"})
    got = {(r.arm, r.subset): (r.n_frames, r.n_images, r.n_labels) for r in arms.arm_summary(m).collect()}
    assert got == {("mined", "train"): (11, 10, 10), ("mined", "val"): (6, 5, 6),
                   ("random", "train"): (12, 12, 10), ("random", "val"): (6, 5, 6)}


BOX = "frame_id string, box_pos int, class_id int, x_center double, y_center double, width double, height double"


def _boxes(spark, rows):
    return spark.createDataFrame([(f, 0, c, .3, .3, .1, .1) for f, c in rows], BOX)


def test_only_members_labels_are_revealed(spark):
    boxes = _boxes(spark, [(f, 5) for f in START + HOLD + POOL + ["q-9"]])
    got = {(r.arm, r.frame_id) for r in arms.reveal_boxes(_manifest(spark, no_label={"p-3"}), boxes).collect()}
    assert got == {(a, f) for a, fs in PICKS.items() for f in [*START, *HOLD, *fs] if f != "p-3"}


def test_a_class_that_an_arm_lacks_counts_zero(spark):
    corpus = _boxes(spark, [(f, i % 3) for i, f in enumerate(START + HOLD)])
    chosen = _boxes(spark, [("a", 0), ("b", 0), ("c", 1), ("d", 2)]).withColumn("arm", arms.F.when(
        arms.F.col("frame_id").isin("a", "b"), "mined").otherwise("random"))
    got = {(r.arm, r.class_id): r for r in arms.class_distribution(chosen, corpus).collect()}
    assert len(got) == 6
    assert [got["mined", c].selected_n for c in range(3)] == [2, 0, 0]
    assert (got["mined", 1].selected_share, got["mined", 1].share_ratio) == (0.0, 0.0)
    assert got["random", 1].selected_share == pytest.approx(0.5)
    assert got["random", 0].corpus_share == pytest.approx(5 / 13)

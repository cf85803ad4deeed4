import os

import pytest
from pyspark.sql import functions as F

from labelsieve.operators import scoring
from labelsieve.schemas import DETECTION
from labelsieve.sources import files


def _manifest(spark, n=11):
    return spark.createDataFrame([(f"clip{i % 3}-{i:06d}", i) for i in range(n)], "frame_id string, pos long")


def _paths(df, shard=0):
    return df.withColumn("shard_id", F.lit(shard).cast("long")) \
        .withColumn("path", F.concat(F.lit("/pool/"), "frame_id", F.lit(".jpg")))


def _by_number(rule):
    """A model whose boxes depend on the number in the file name."""
    def factory():
        def predict(paths):
            return [rule(int(p.rsplit("-", 1)[1].split(".")[0])) for p in paths]
        return predict
    return factory


def _rule():
    def rule(i):  # nested, so that it is shipped to the workers by value
        return [(i % 4, 0.31 + 0.01 * j, 0.2, 0.6, 0.05, 0.07) for j in range(i % 3)]
    return rule


_some = _rule()


def test_every_shard_is_written_and_committed(spark, tmp_path):
    out = str(tmp_path / "o")
    c = scoring.infer_to_table(spark, _manifest(spark), _by_number(_some), out, shard_size=4, batch=3, image_dir="/pool")
    assert c == {"shards_total": 3, "shards_processed": 3, "shards_skipped": 0}
    pred = files.read_predictions(spark, os.path.join(out, "predictions"),
                                  spark.read.parquet(os.path.join(out, "shards_done")))
    assert set(pred.columns) == {*DETECTION.fieldNames(), "class_scores", "shard_id"}
    rows = pred.collect()
    # A row per box, one sentinel for a frame without any.
    assert len(rows) == sum(max(1, i % 3) for i in range(11))
    assert {r.frame_id for r in rows if r.class_id == -1} == {f"clip{i % 3}-{i:06d}" for i in range(11) if i % 3 == 0}
    assert all(r.shard_id == int(r.frame_id[-6:]) // 4 for r in rows)


def test_low_confidence_boxes_go_and_leave_a_sentinel(spark):
    boxes = {0: [(5, 0.249, .1, .1, .1, .1)], 1: [(5, 0.25, .1, .1, .1, .1), (6, 0.2, .1, .1, .1, .1)], 2: []}
    frames = _paths(_manifest(spark, 3))
    got = sorted((r.frame_id[-1], r.class_id, r.confidence) for r in
                 scoring.score_frames(frames, _by_number(lambda i: boxes[i]), batch=2, tasks=2).collect())
    assert got == [("0", -1, 0.0), ("1", 5, 0.25), ("2", -1, 0.0)]


def test_the_model_runs_in_a_task_per_core_at_least(spark):
    frames = _paths(_manifest(spark, 5000))
    scored = scoring.score_frames(frames, _by_number(_some))
    tasks = scored.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= spark.sparkContext.defaultParallelism
    assert scoring.scoring_tasks(spark, 10**9) >= 10**9 // scoring.FRAMES_PER_TASK


def test_resume_takes_up_what_is_not_committed(spark, tmp_path):
    out, m = str(tmp_path / "o"), _manifest(spark)
    run = dict(shard_size=4, batch=3, image_dir="/pool", shards_per_wave=1)
    calls = {"n": 0}
    real = scoring.score_frames

    def crash(*a, **k):
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("lost")
        return real(*a, **k)
    scoring.score_frames = crash
    try:
        with pytest.raises(RuntimeError):
            scoring.infer_to_table(spark, m, _by_number(_some), out, **run)
    finally:
        scoring.score_frames = real
    # A folder of a wave that was never committed does not count.
    real(_paths(m.limit(1), 9), _by_number(_some)).write.mode("append").partitionBy("shard_id") \
        .parquet(os.path.join(out, "predictions"))
    done = spark.read.parquet(os.path.join(out, "shards_done"))
    assert [r.shard_id for r in done.collect()] == [0]
    assert {r.shard_id for r in files.read_predictions(spark, os.path.join(out, "predictions"), done).collect()} == {0}
    c = scoring.infer_to_table(spark, m, _by_number(_some), out, **run)
    assert c == {"shards_total": 3, "shards_processed": 2, "shards_skipped": 1}
    assert scoring.infer_to_table(spark, m, _by_number(_some), out, **run)["shards_processed"] == 0
    whole = files.read_predictions(spark, os.path.join(out, "predictions"),
                                   spark.read.parquet(os.path.join(out, "shards_done")))
    assert {r.shard_id for r in whole.collect()} == {0, 1, 2}


@pytest.mark.parametrize("change", ["shard_size", "conf_threshold", "positions", "frames"])
def test_resume_refuses_what_would_change_meaning(spark, tmp_path, change):
    out, m = str(tmp_path / "o"), _manifest(spark)
    run = dict(shard_size=4, batch=3, image_dir="/pool", conf_threshold=0.25)
    scoring.infer_to_table(spark, m, _by_number(_some), out, **run)
    if change == "shard_size":
        run["shard_size"] = 5
    elif change == "conf_threshold":
        run["conf_threshold"] = 0.5
    elif change == "positions":  # the same ids, elsewhere
        m = m.withColumn("pos", 10 - F.col("pos"))
    else:
        m = m.limit(10)
    with pytest.raises(ValueError, match="another manifest"):
        scoring.infer_to_table(spark, m, _by_number(_some), out, **run)


def test_an_unreadable_commit_table_is_not_taken_for_absent(spark, tmp_path):
    out = tmp_path / "o"
    (out / "shards_done").mkdir(parents=True)
    (out / "shards_done" / "part-0.parquet").write_bytes(b"broken")
    with pytest.raises(Exception, match="(?i)parquet|footer|corrupt|schema"):
        scoring.infer_to_table(spark, _manifest(spark), _by_number(_some), str(out), shard_size=4, image_dir="/pool")


def test_sentinels_by_join(spark):
    det = spark.createDataFrame([("clip1-000001", 8, 0.77, .2, .2, .1, .1)] * 2, DETECTION)
    got = sorted((r.frame_id, r.class_id, r.confidence) for r in scoring.with_sentinels(_manifest(spark, 2), det).collect())
    assert got == [("clip0-000000", -1, 0.0), ("clip1-000001", 8, 0.77), ("clip1-000001", 8, 0.77)]


def test_stream_keeps_frames_of_one_shard_that_come_in_two_batches(spark, tmp_path):
    from labelsieve.streaming.incremental import stream_scores
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    part = _manifest(spark, 6).withColumn("shard_id", F.lit(0).cast("long"))
    for k in range(2):
        part.filter(F.col("pos") % 2 == k).select("frame_id", "shard_id").write.mode("append").parquet(src)
        stream_scores(spark, src, out, ckpt, _by_number(lambda i: [(1, 0.9, .1, .1, .1, .1)]), "/pool",
                      batch=2).awaitTermination(120)
    assert spark.read.parquet(out).select("frame_id").distinct().count() == 6

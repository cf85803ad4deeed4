import os

import pytest
from pyspark.sql import functions as F

from labelsieve.operators import scoring
from labelsieve.params import Params
from labelsieve.plans import stages
from labelsieve.sources import files
from labelsieve.streaming import commit


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _factory():
    def model():  # nested, so that it is shipped by value
        def predict(paths):
            n = [int(p.rsplit("-", 1)[1].split(".")[0]) for p in paths]
            return [[(i % 4, 0.4 + 0.01 * j, .2, .6, .05, .07, [0.4, 0.3]) for j in range(i % 3)] for i in n]
        return predict
    return model


def _manifest(spark, n=22):
    return spark.createDataFrame([(f"clip{i % 3}-{i:06d}", i) for i in range(n)], "frame_id string, pos long")


def _run(spark, m, tmp, **options):
    q = commit.stream_inference(spark, m, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ckpt", _factory(), "/pool",
                                **{"shard_size": 5, "batch": 3, **options})
    q.awaitTermination(180)
    assert q.exception() is None
    return q


def _arrive(m, tmp, where):
    m.filter(where).coalesce(1).write.mode("append").parquet(f"{tmp}/in")


def _done(spark, tmp):
    path = f"{tmp}/out/shards_done"
    return {r.shard_id for r in spark.read.parquet(path).collect()} if os.path.exists(path) else set()


def _rows(spark, tmp):
    pred = files.read_predictions(spark, f"{tmp}/out/predictions", spark.read.parquet(f"{tmp}/out/shards_done"))
    return sorted((r.frame_id, r.class_id, r.confidence, r.shard_id) for r in pred.collect())


def _batch_rows(spark, m, tmp):
    scoring.infer_to_table(spark, m, _factory(), f"{tmp}/batch", 5, batch=3, image_dir="/pool")
    pred = files.read_predictions(spark, f"{tmp}/batch/predictions")
    return sorted((r.frame_id, r.class_id, r.confidence, r.shard_id) for r in pred.collect())


def test_shards_close_with_their_last_frame(spark, tmp_path):
    m, tmp = _manifest(spark), str(tmp_path)
    _arrive(m, tmp, "pos < 7 or pos = 21")  # shard 0 whole, parts of 1 and 4
    _run(spark, m, tmp)
    assert _done(spark, tmp) == {0}
    _arrive(m, tmp, "pos in (5, 6, 7, 8)")  # some come again
    _run(spark, m, tmp)
    assert _done(spark, tmp) == {0}
    _arrive(m, tmp, "pos = 9 or pos >= 10")
    _run(spark, m, tmp)
    assert _done(spark, tmp) == {0, 1, 2, 3, 4}
    assert _rows(spark, tmp) == _batch_rows(spark, m, tmp)
    # All frames again: nothing is scored or logged twice.
    _arrive(m, tmp, "pos >= 0")
    _run(spark, m, tmp)
    assert _rows(spark, tmp) == _batch_rows(spark, m, tmp)


def test_replay_after_a_crash_in_every_place(spark, tmp_path, monkeypatch):
    m, tmp = _manifest(spark, 10), str(tmp_path)
    _arrive(m, tmp, "pos < 8")
    real = commit.commit_batch
    crashes = []

    def crash_behind(rows, batch_id, *rest):
        real(rows, batch_id, *rest)  # all is written and logged, but the batch is not marked as done
        if not crashes:
            crashes.append(batch_id)
            raise RuntimeError("lost")
    monkeypatch.setattr(commit, "commit_batch", crash_behind)
    with pytest.raises(Exception, match="lost"):
        _run(spark, m, tmp)
    assert _done(spark, tmp) == {0}
    _run(spark, m, tmp)  # the same batch again
    _arrive(m, tmp, "pos >= 8")
    scored = commit.score_frames

    def crash_before(*a, **k):
        if len(crashes) == 1:
            crashes.append("score")
            raise RuntimeError("lost")
        return scored(*a, **k)
    monkeypatch.setattr(commit, "score_frames", crash_before)
    with pytest.raises(Exception, match="lost"):
        _run(spark, m, tmp)
    assert _done(spark, tmp) == {0}
    _run(spark, m, tmp)
    assert _done(spark, tmp) == {0, 1} and len(crashes) == 2
    assert _rows(spark, tmp) == _batch_rows(spark, m, tmp)


def test_batch_job_takes_up_and_mining_reads(spark, tmp_path):
    m, tmp = _manifest(spark), str(tmp_path)
    _arrive(m, tmp, "pos < 13")
    commit.stream_inference(spark, m, f"{tmp}/in", f"{tmp}/infer", f"{tmp}/ckpt", _factory(), "/pool", 5, 3).awaitTermination(180)
    counters = scoring.infer_to_table(spark, m, _factory(), f"{tmp}/infer", 5, batch=3, image_dir="/pool")
    assert counters == {"shards_total": 5, "shards_processed": 3, "shards_skipped": 2}
    pred = files.read_predictions(spark, f"{tmp}/infer/predictions", spark.read.parquet(f"{tmp}/infer/shards_done"))
    assert sorted((r.frame_id, r.class_id, r.confidence, r.shard_id) for r in pred.collect()) == _batch_rows(spark, m, tmp)
    assert stages.mine_stage(spark, tmp, Params(label_budget=5)).first().n_frames == 22


def test_refuses_another_manifest_and_unknown_shards(spark, tmp_path):
    m, tmp = _manifest(spark, 10), str(tmp_path)
    _arrive(m, tmp, "pos < 5")
    _run(spark, m, tmp)
    with pytest.raises(ValueError, match="another manifest"):
        _run(spark, m, tmp, shard_size=4)
    _arrive(m.withColumn("pos", F.col("pos") + 50), tmp, "pos >= 0")
    with pytest.raises(Exception, match="not in the manifest"):
        _run(spark, m, tmp)

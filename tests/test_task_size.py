"""What one task holds, and what is built once."""

import pytest
from pyspark.sql import functions as F

from labelsieve.operators import mining
from labelsieve.plans import queries as q

SF = "/root/testdata/sf0.001"


def test_frames_are_dealt_by_rows(spark, monkeypatch):
    """The groups of a task are held in memory: tasks by the rows, whatever bytes they are packed in."""
    pred = spark.range(1000).select(F.concat(F.col("id") % 90, F.lit("-x")).alias("frame_id"),
                                    (F.col("id") % 7).cast("int").alias("class_id"), F.lit(0.5).alias("confidence"))
    want = sorted(mining.frame_signals(pred).collect())
    monkeypatch.setattr(mining, "TASK_ROWS", 50, raising=False)
    got = mining.frame_signals(pred)
    assert ", 21), REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(got.collect()) == want and len(want) == 90


@pytest.mark.parametrize("query", ["revealed_boxes", "class_distribution"])
def test_label_records_are_built_once(spark, monkeypatch, query):
    built, written = [], []
    make, write = q.td.annotations_v, q.materialize
    monkeypatch.setattr(q.td, "annotations_v", lambda *a, **k: built.append(1) or make(*a, **k))
    monkeypatch.setattr(q, "materialize", lambda df, name="t": written.append(name) or write(df, name))
    q.QUERIES[query](spark, SF)
    assert len(built) == 1 and "annotations" in written and "predictions" in written

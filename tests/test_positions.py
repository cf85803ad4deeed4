import random

import pandas as pd
from pyspark.sql import functions as F

from labelsieve.operators import positions


def _df(spark, n=500, seed=1):
    rng = random.Random(seed)
    # a hot value holding a third of the rows
    rows = [(f"id{i:05d}", 7.0 if i % 3 == 0 else float(rng.randint(0, 40)), rng.choice("abc")) for i in range(n)]
    return spark.createDataFrame(rows, "id string, v double, g string")


def test_ordered_position_equals_row_number(spark):
    df = _df(spark)
    got = positions.ordered_position(df, [F.col("v").desc(), F.col("id").asc()], partitions=6).toPandas()
    want = df.toPandas().sort_values(["v", "id"], ascending=[False, True]).reset_index(drop=True)
    want["pos"] = range(len(want))
    m = got.merge(want, on="id", suffixes=("", "_w"))
    assert (m["pos"] == m["pos_w"]).all() and len(m) == len(want)


def test_average_rank_paths_agree(spark):
    df = _df(spark)
    want = df.toPandas()
    want["r"] = want["v"].rank(method="average") / len(want)
    small = positions.average_ranks(df, ["v"]).toPandas().merge(want, on="id")
    big = positions.average_rank(df, "v", "v_norm", broadcast_bytes=0).toPandas().merge(want, on="id")
    assert (small["v_norm"] - small["r"]).abs().max() < 1e-12
    assert (big["v_norm"] - big["r"]).abs().max() < 1e-12


def test_running_splits_hot_group(spark):
    df = _df(spark, 800).withColumn("one", F.lit(1))
    got = positions.running(df, ["g"], [F.col("v").asc(), F.col("id").asc()],
                            sums={"rank": "one", "cv": "v"}, maxes={"mx": "v"}, partitions=7).toPandas()
    p = df.toPandas().sort_values(["g", "v", "id"])
    p["rank_w"] = p.groupby("g").cumcount() + 1
    p["cv_w"] = p.groupby("g")["v"].cumsum()
    p["mx_w"] = p.groupby("g")["v"].cummax()
    m = got.merge(p[["id", "rank_w", "cv_w", "mx_w"]], on="id")
    assert len(m) == 800
    assert (m["rank"] == m["rank_w"]).all() and (m["cv"] == m["cv_w"]).all() and (m["mx"] == m["mx_w"]).all()


def test_first_rows_puts_null_ranks_last(spark):
    rows = [(f"id{i:02d}", None if i % 4 == 0 else float(i)) for i in range(20)] + [("z", None)]
    df = spark.createDataFrame(rows, "id string, v double")
    order = [F.col("v").desc(), F.col("id").asc()]
    scored = [i for i, v in sorted(rows, key=lambda r: (-(r[1] or 0), r[0])) if v is not None]
    lost = sorted(i for i, v in rows if v is None)
    for budget in (3, 15, 18, 100):
        got = positions.first_rows(df, [], -F.col("v"), order, budget).orderBy("pick").collect()
        assert [r.id for r in got] == (scored + lost)[:budget]
    got = positions.first_rows(df.filter("v is null"), [], -F.col("v"), order, 3).orderBy("pick").collect()
    assert [r.id for r in got] == lost[:3]


def test_running_by_rank_with_hot_parts_and_null_ranks(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aab"), rng.choice([None, .5, .5, .5, .25, rng.random()]), i, rng.randrange(5)) for i in range(600)]
    rows += [("c", None, 900, 1), ("d", .5, 901, 2)]
    df = spark.createDataFrame(rows, "g string, c double, i long, x long").repartition(5)
    order = [F.col("c").desc_nulls_last(), F.col("i").asc()]
    want = {}
    for g in "abcd":
        total = 0
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2])):
            total += r[3]
            want[r[2]] = total
    for task_rows in (positions.TASK_ROWS, 20):  # the parts of .5 and of null are hot
        got = positions.running_by_rank(df, ["g"], -F.col("c"), order, {"s": "x"}, task_rows=task_rows)
        assert got.columns == ["g", "c", "i", "x", "s"]
        assert {r.i: r.s for r in got.collect()} == want


def test_first_rows_by_window_or_by_ranges(spark):
    rows = [(i % 3, float(i % 40), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, v double, i long")
    order = [F.col("v").desc(), F.col("i").asc()]
    want = sorted((k, n, i) for k in range(3) for n, (_, i) in enumerate(sorted((-v, i) for kk, v, i in rows if kk == k)[:70], 1))
    for task_rows in (10_000, 5):
        got = positions.first_rows(df, ["k"], -F.col("v"), order, 70, task_rows=task_rows).collect()
        assert sorted((r.k, r.pick, r.i) for r in got) == want


def test_broadcast_bound_is_on_rows_in_memory(spark):
    from labelsieve.session import checked_broadcast
    same = spark.range(400_000).select((F.col("id") % 2).alias("k"), F.lit("x" * 200).alias("s"))  # some KB as a file
    table, small = checked_broadcast(same)
    assert not small and table.count() == 400_000
    few, small = checked_broadcast(same.limit(1000).select("k", F.array("s").alias("a"), F.struct("k").alias("st"),
                                                          F.create_map("s", "k").alias("m"), F.lit(None).cast("string").alias("n")))
    assert small and few.count() == 1000
    assert checked_broadcast(same.limit(0))[1]

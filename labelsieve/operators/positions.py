"""Scale-safe global positions and average ranks.

A window with ``orderBy`` and no ``partitionBy`` runs in one task.  These two
primitives give the same numbers with every row-level step partitioned:

* ``ordered_position`` range-partitions on the *whole* ordering (so a hot value
  of the first key is split by the later keys), numbers rows inside each
  partition with ``monotonically_increasing_id`` after a per-partition sort, and
  adds the row count of all earlier partitions.  The only global step is a
  prefix sum over one row per partition.
* ``average_rank`` first collapses ties with ``groupBy(value).count()`` (a hot
  value becomes one row), then computes prefix sums of the counts the same way,
  and joins the rank back on the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checked_broadcast, default_parallelism, materialize

_MID = "__mid"
_PID = "__pid"
_CNT = "__cnt"
_OFF = "__off"

def _partition_offsets(counts: DataFrame) -> DataFrame:
    """``(pid, cnt)`` -> ``(pid, off)`` with ``off`` = rows in earlier partitions.

    One row per partition, so the unpartitioned window is bounded by the
    partition count, not by the data.
    """
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(_PID, (F.sum(_CNT).over(w) - F.col(_CNT)).alias(_OFF))


def ordered_position(df: DataFrame, order: list[Column], name: str = "pos",
                     partitions: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of each row in the total ``order``.

    ``order`` must be a total order (end it with a unique key) for the
    positions to be repeatable.
    """
    n = partitions or default_parallelism(df.sparkSession)
    ranged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn(_MID, F.monotonically_increasing_id()))
    # Pin the physical numbering: later reads must see the same ids.
    ranged = materialize(ranged, "positions").withColumn(_PID, F.shiftright(F.col(_MID), 33))
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    offsets = F.broadcast(_partition_offsets(counts))  # <= n rows
    return (ranged.join(offsets, _PID)
            .withColumn(name, (F.col(_OFF) + F.col(_MID) - F.shiftleft(F.col(_PID), 33)).cast("long"))
            .drop(_MID, _PID, _OFF))


def running(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, str | Column] | None = None,
            maxes: dict[str, str] | None = None, partitions: int | None = None,
            few_groups: bool = True) -> DataFrame:
    """Inclusive running sums / maxima per ``group`` in ``order``, skew-safe.

    ``sums`` / ``maxes`` map output name -> input column or expression.  Rows are range
    partitioned on ``group + order``, so one group may span many partitions
    (a hot group is split).  Each partition computes local running values;
    a small table of per-(partition, group) totals gives the carry-in from
    earlier partitions of the same group.  It is broadcast where the groups are
    few (signals, classes, variants: a fixed list); pass ``few_groups=False`` for
    groups that grow with the data, and it is joined by a shuffle.
    """
    sums, maxes = sums or {}, maxes or {}
    n = partitions or default_parallelism(df.sparkSession)
    keys = [F.col(g).asc_nulls_first() for g in group] + list(order)
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn(_MID, F.monotonically_increasing_id()))
    ranged = materialize(ranged, "running").withColumn(_PID, F.shiftright(F.col(_MID), 33))
    local_w = (Window.partitionBy(_PID, *group).orderBy(_MID)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(c).over(local_w).alias(f"__ls_{o}") for o, c in sums.items()],
                          *[F.max(c).over(local_w).alias(f"__lm_{o}") for o, c in maxes.items()])
    totals = ranged.groupBy(_PID, *group).agg(*[F.sum(c).alias(f"__ts_{o}") for o, c in sums.items()],
                                              *[F.max(c).alias(f"__tm_{o}") for o, c in maxes.items()])
    before = Window.partitionBy(*group).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(_PID, *group,
                          *[F.coalesce(F.sum(f"__ts_{o}").over(before), F.lit(0)).alias(f"__cs_{o}")
                            for o in sums],
                          *[F.max(f"__tm_{o}").over(before).alias(f"__cm_{o}") for o in maxes])
    # One row per (partition, group) pair.
    joined = local.join(F.broadcast(carry) if few_groups else carry, [_PID, *group], "left")
    out = joined.select(
        *[c for c in df.columns],
        *[(F.col(f"__cs_{o}") + F.col(f"__ls_{o}")).alias(o) for o in sums],
        *[F.greatest(F.col(f"__cm_{o}"), F.col(f"__lm_{o}")).alias(o) for o in maxes],
    )
    return out


BUCKETS = 1024
# Rows that one task numbers.
TASK_ROWS = 200_000


def first_rows(df: DataFrame, keys: list[str], rank: Column, order: list[Column], budget: int,
               name: str = "pick", partitions: int | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """The first ``budget`` rows per ``keys`` in ``order`` with their 1-based ``name``.

    ``rank`` is a double that never falls along ``order``; rows without one come last.  Its range per key
    is cut into ``BUCKETS`` equal parts; the counts per part (a partial
    aggregate, ``BUCKETS`` rows per key at most) give the part in which the budget
    is reached, and all rows behind it are filtered out.  The rest is numbered by a window where
    it has up to ``task_rows`` rows per key (the counts tell), else range partitioned, so no task sees
    more than its share of rows at any budget.  ``keys`` are few (variants, seeds): their bounds are broadcast.
    """
    key = keys or ["__all"]
    rows = materialize((df if keys else df.withColumn("__all", F.lit(0))).withColumn("__rank", rank), "ranked")
    bounds = F.broadcast(rows.groupBy(*key).agg(F.min("__rank").alias("__lo"), F.max("__rank").alias("__hi")))
    span = F.col("__hi") - F.col("__lo")
    # No rank: a part behind all others.
    part = F.when(F.col("__rank").isNull(), BUCKETS + 1).when(span > 0, F.floor((F.col("__rank") - F.col("__lo")) / span * BUCKETS)).otherwise(0)
    placed = rows.join(bounds, key).withColumn("__part", part.cast("int")).drop("__lo", "__hi")
    counts = placed.groupBy(*key, "__part").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(*key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    wanted = materialize(counts.withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0)))
                         .filter(F.col("__before") < budget).groupBy(*key)
                         .agg(F.max("__part").alias("__last"), F.sum("__n").alias("__n")), "wanted")
    most = wanted.agg(F.max("__n")).first()[0] or 0
    near = (placed.join(F.broadcast(wanted.drop("__n")), key).filter(F.col("__part") <= F.col("__last"))
            .drop("__last", "__part", "__rank"))
    if most <= task_rows:
        out = near.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    else:
        out = running(near.withColumn("__one", F.lit(1)), key, order, sums={name: "__one"}, partitions=partitions)
    return out.filter(F.col(name) <= budget).withColumn(name, F.col(name).cast("long")).drop("__one", "__all")


def running_by_rank(df: DataFrame, group: list[str], rank: Column, order: list[Column], sums: dict[str, str | Column],
                    task_rows: int = TASK_ROWS) -> DataFrame:
    """``running`` sums for groups that are few, without a range partition of all rows.

    ``rank`` is a double that never falls along ``order`` (nulls last).  Its range per group is cut into
    ``BUCKETS`` equal parts; sums per part (a partial aggregate, ``BUCKETS`` rows per group at
    most, broadcast) give what stands before a part, and rows are added up inside their part only.  A part
    of more than ``task_rows`` rows (many equal ranks) is added up by ``running``, over many tasks.
    """
    rows = materialize(df.withColumn("__rank", rank), "ranked")
    bounds = F.broadcast(rows.groupBy(*group).agg(F.min("__rank").alias("__lo"), F.max("__rank").alias("__hi")))
    span = F.col("__hi") - F.col("__lo")
    part = F.when(F.col("__rank").isNull(), BUCKETS + 1).when(
        span > 0, F.floor((F.col("__rank") - F.col("__lo")) / span * BUCKETS)).otherwise(0)
    placed = rows.join(bounds, group).withColumn("__part", part.cast("int")).drop("__lo", "__hi", "__rank")
    totals = placed.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__n"),
                                                  *[F.sum(c).alias(f"__t_{o}") for o, c in sums.items()])
    upto = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(totals.select(*group, "__part", "__n", *[
        F.coalesce(F.sum(f"__t_{o}").over(upto), F.lit(0)).alias(f"__o_{o}") for o in sums]), "offsets")
    keys = [*group, "__part"]

    def added(left: DataFrame) -> DataFrame:
        return left.join(F.broadcast(offsets.drop("__n")), keys).select(
            *df.columns, *[(F.col(f"__o_{o}") + F.col(f"__l_{o}")).alias(o) for o in sums])
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hot = offsets.filter(F.col("__n") > task_rows).select(*keys)
    local = {f"__l_{o}": c for o, c in sums.items()}
    if hot.isEmpty():
        return added(placed.select("*", *[F.sum(c).over(inside).alias(o) for o, c in local.items()]))
    few = placed.join(F.broadcast(hot), keys, "left_anti")
    many = running(placed.join(F.broadcast(hot), keys, "left_semi"), keys, order, sums=local)
    return added(few.select("*", *[F.sum(c).over(inside).alias(o) for o, c in local.items()])).unionByName(added(many))


def median(df: DataFrame, value: str, partitions: int | None = None) -> DataFrame:
    """One row ``(median)``: exact, from the distinct values and the rows before each."""
    ranks = value_ranks(df.filter(F.col(value).isNotNull()), value, partitions)
    low, high = F.expr("(total - 1) div 2"), F.expr("total div 2")

    def at(pos):
        return F.max(F.when((F.col("before") <= pos) & (pos < F.col("before") + F.col("cnt")), F.col(value)))
    return ranks.agg(at(low).alias("lo"), at(high).alias("hi")).select(
        (F.col("lo") + (F.col("hi") - F.col("lo")) * 0.5).alias("median"))


def value_ranks(df: DataFrame, value: str, partitions: int | None = None) -> DataFrame:
    """One row per distinct ``value``: ``(value, cnt, before, total)``.

    ``before`` = number of rows with a smaller value; ``total`` = all rows.
    Nulls sort first, as in an ascending SQL order.
    """
    spark = df.sparkSession
    n = partitions or default_parallelism(spark)
    freq = df.groupBy(value).agg(F.count(F.lit(1)).alias(_CNT))
    ranged = (freq.repartitionByRange(n, F.col(value).asc_nulls_first())
                  .withColumn(_PID, F.spark_partition_id()))
    ranged = materialize(ranged, "ranks")
    per_part = ranged.groupBy(_PID).agg(F.sum(_CNT).alias(_CNT))
    offsets = F.broadcast(_partition_offsets(per_part).join(per_part, _PID)
                          .select(_PID, _OFF, F.sum(_CNT).over(Window.partitionBy()).alias("__total")))
    w = (Window.partitionBy(_PID).orderBy(F.col(value).asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.join(offsets, _PID)
            .select(value, F.col(_CNT).alias("cnt"),
                    (F.col(_OFF) + F.sum(_CNT).over(w) - F.col(_CNT)).alias("before"),
                    F.col("__total").alias("total")))


def _avg_rank_expr(before: str, cnt: str, total: str, normalise: bool) -> Column:
    expr = F.col(before) + (F.col(cnt) + F.lit(1)) / F.lit(2.0)
    return expr / F.col(total) if normalise else expr


def average_ranks(df: DataFrame, columns: list[str], suffix: str = "_norm", normalise: bool = True) -> DataFrame:
    """Average rank of several columns at once (``col + suffix`` for each).

    All columns are stacked into one ``(signal, value)`` frequency table (one
    aggregation, ties collapsed, hot values become one row).  Its running counts
    are range partitioned, and the ranks are joined back on the value: broadcast
    where the rank table's bytes allow, else by a shuffle.
    """
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("__sig"), F.col(c).cast("double").alias("__v")) for c in columns
    ])).alias("__s")).select("__s.*")
    freq = stacked.groupBy("__sig", "__v").agg(F.count(F.lit(1)).alias(_CNT))
    counted = running(freq, ["__sig"], [F.col("__v").asc_nulls_first()], sums={"__upto": _CNT})
    counted = (counted.withColumn("__before", F.col("__upto") - F.col(_CNT))
               .withColumn("__total", F.lit(df.count())))
    ranks, small = checked_broadcast(counted.select(
        "__sig", "__v", _avg_rank_expr("__before", _CNT, "__total", normalise).alias("__rank")))
    out = df
    for c in columns:
        r = ranks.filter(F.col("__sig") == c).select(F.col("__v").alias(f"__v_{c}"), F.col("__rank").alias(c + suffix))
        out = (out.join(F.broadcast(r) if small else r, F.col(c).cast("double").eqNullSafe(F.col(f"__v_{c}")), "left")
                  .drop(f"__v_{c}"))
    return out


def average_rank(df: DataFrame, value: str, out: str, normalise: bool = True,
                 partitions: int | None = None,
                 broadcast_bytes: int | None = None) -> DataFrame:
    """Add ``out`` = average rank of ``value`` (ties get the mean of their ranks).

    With ``normalise`` the rank is divided by the row count, giving (0, 1].
    The rank table has one row per distinct value; it is broadcast when the
    count check allows, otherwise joined with a shuffle (AQE splits the side
    that holds a hot value).
    """
    ranks = value_ranks(df, value, partitions)
    ranks = ranks.select(value, _avg_rank_expr("before", "cnt", "total", normalise).alias(out))
    kwargs = {} if broadcast_bytes is None else {"max_bytes": broadcast_bytes}
    ranks, _ = checked_broadcast(ranks, **kwargs)
    return df.join(ranks, on=df[value].eqNullSafe(ranks[value]), how="left").drop(ranks[value])

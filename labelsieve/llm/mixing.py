"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key.  Inside its source the keys are cut into
ranges (the key is uniform, so equal ranges hold about equally many rows and a hot
source is spread over as many ranges as its rows need); each range is sorted and
summed, the range sums are added up per source, and range offset plus sum inside
the range gives every document the words before it.  A source's budget is its
target in whole words: as many whole epochs as fit, and of the next epoch the words
before the cut, so the cut document is taken in part and the budget is met exactly.

Targets: source ``i`` in code point order (null last) has weight ``weights[i mod n]``
and gets that share of all words; a target stops at ``max_epochs`` times the size of
its source and the excess is shared again by weight until none is above.

Defined results: a null text has size 0; a source without words has target 0; rows
that repeat an id are separate rows with the same key, and which of two equal rows
is cut is of no consequence; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.positions import ordered_position
from .common import HEAVY, materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"
# Rows of a range at least; a large source has about as many ranges as rows in each.
ROWS_PER_RANGE = 1_000
# The first 8 hex digits of a key choose its range.
KEY_SPACE = 1 << 32


def words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def mix_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")))


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (src, source, source_size, n_rows), one row per source, with ``target`` added."""
    placed = ordered_position(sizes, [F.col("source").isNull(), F.col("source")], "pos")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    placed = materialize(placed.withColumn("weight", weight.cast("long")), "mix-sources")
    limit = F.col("source_size") * max_epochs
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    rate = -1.0  # words per unit of weight; only grows as sources reach their limit
    while True:
        above = F.lit(rate) * F.col("weight") > limit
        used, free = placed.agg(F.sum(F.when(above, limit).otherwise(0)),
                                F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        new = (total - (used or 0)) / free if free else rate
        if new <= rate or not free:
            break
        rate = new
    return placed.withColumn("target", F.least(limit.cast("double"), F.lit(max(rate, 0.0)) * F.col("weight")))


def by_source(rows: DataFrame, sources: DataFrame, total: int) -> DataFrame:
    """Join on ``src``: sources with at least 1/HEAVY of all rows (HEAVY at most) by broadcast, the others by a shuffle."""
    cut = max(2, -(-total // HEAVY))
    hot = F.broadcast(sources.filter(F.col("n_rows") >= cut))
    cold = sources.filter(F.col("n_rows") < cut)
    return (rows.join(hot, "src").unionByName(rows.join(F.broadcast(hot.select("src")), "src", "left_anti")
                                              .join(cold, "src")))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``(doc_id, source, mix_key, size, source_size, target, start, budget, taken)`` per row of ``docs``.

    ``docs`` has doc_id, source and text.  ``start`` is the words before the document in
    its source's order, ``taken`` the words the mix takes of it, epochs counted.
    """
    rows = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        _source_key(F.col("source").cast("string")).alias("src"), words(F.col("text")).alias("size"),
        mix_key(F.col("doc_id"), seed).alias("mix_key")), "mix-rows")
    sizes = materialize(rows.groupBy("src", "source").agg(F.sum("size").alias("source_size"),
                                                          F.count(F.lit(1)).alias("n_rows")), "mix-sizes")
    total = sizes.agg(F.sum("n_rows")).first()[0] or 0
    sources = (targets(sizes, weights, max_epochs).select("src", "source_size", "target", "n_rows")
               .withColumn("ranges", F.ceil(
                   F.col("n_rows") / F.greatest(F.lit(float(rows_per_range)), F.sqrt("n_rows"))).cast("long"))
               .withColumn("budget", F.round("target").cast("long")))
    sources = materialize(sources, "mix-targets")
    number = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long")
    placed = by_source(rows, sources, total).withColumn(
        "range", F.floor(number * F.col("ranges") / KEY_SPACE).cast("long"))
    # Words of each range, then of the ranges before it.
    sums = placed.groupBy("src", "range").agg(F.sum("size").alias("range_size"), F.count(F.lit(1)).alias("range_rows"))
    before = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("src", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy("src", "range").orderBy("mix_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    ordered = (placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
               .join(offsets, ["src", "range"]).withColumn("start", F.col("offset") + F.col("inside")))
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    rest = F.col("budget") - epochs * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("start"), F.lit(0)), F.col("size"))
    return ordered.select("doc_id", "source", "mix_key", "size", "source_size", "target", "start", "budget",
                          (epochs * F.col("size") + part).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` (all its columns), each as often as the mix takes it.

    Whole rows only: the document at a source's cut is taken once more when at least
    half of it lies before the cut.  Rows never shuffle with their texts: each source
    hands out its epochs and the key of its last document.
    """
    plan = mix(docs, weights, max_epochs, seed)
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    extra = F.col("taken") - whole * F.col("size")
    taken = (F.col("size") > 0) & (extra * 2 >= F.col("size"))
    cuts = plan.select(_source_key(F.col("source")).alias("src"), "mix_key", whole.alias("epochs"),
                       taken.alias("more")).groupBy("src").agg(
        F.first("epochs").alias("__epochs"), F.max(F.when(F.col("more"), F.col("mix_key"))).alias("__last"),
        F.count(F.lit(1)).alias("n_rows"))
    cuts = materialize(cuts, "mix-cuts")
    total = cuts.agg(F.sum("n_rows")).first()[0] or 0
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("row"), _source_key(F.col("source").cast("string")).alias("src"),
                        mix_key(F.col("doc_id"), seed).alias("__key"))
    times = F.col("__epochs") + F.coalesce((F.col("__key") <= F.col("__last")).cast("int"), F.lit(0))
    return (by_source(keyed, cuts, total).withColumn("__times", times.cast("int")).filter("__times > 0")
            .select("row", F.explode(F.expr("sequence(1, __times)")).alias("__copy")).select("row.*"))

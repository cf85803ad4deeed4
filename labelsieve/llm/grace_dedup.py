"""Exact dedup by Grace hashing.

1. ``combine``: each input task collapses the equal texts it reads in an
   open-addressing table of bounded size and writes one row per document; only the
   first row of a text in the table carries the text.  A text that a third of all
   rows share thus leaves each task once.
2. ``partition``: the rows with a text go to buckets by a hash of the content.  A
   bucket over ``bucket_bytes`` is divided again, by another hash and into as many
   children as its own size asks for, until each fits or holds a single hash value (copies of
   one text: one table entry).  A bucket's name is its path, so every level divides
   inside its parents.  Sizes come from a narrow column; texts move once, from the
   table to the tasks of their last bucket.  Spark's shuffle files are the spill files: they
   are spread over the cluster, and a lost one is made again.
3. ``match``: each bucket goes through an open-addressing table that compares the
   complete content and names the group of each of its rows.  A task takes its buckets one after
   the other, so it holds one at a time.
4. Group totals are sums over at most one row per task and text; every document
   gets its answer by a join on the key of step 1, of which no value has more rows
   than one input task.

Defined results: a null text is empty, and all empty texts are one group; rows that
repeat a ``doc_id`` count as rows and share ``keep_id``; a null ``doc_id`` is only kept
where a text has no other.  An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast
from .common import arrow_map, docs_of, materialize

COMBINE_BYTES = 64 << 20
BUCKET_BYTES = 32 << 20
# Children of a bucket, and tasks of a level, at most.
MAX_FAN = 4096
MAX_LEVELS = 8
# Bytes that a table entry costs besides its content.
ENTRY_BYTES = 64


class Table:
    """Open addressing with linear probing; equality is that of the complete content."""

    def __init__(self, size: int = 1024):
        self.slots = np.full(size, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def entry(self, content: bytes, h: int) -> tuple[int, bool]:
        """Index of the entry with this content, and whether it is new."""
        if 2 * len(self.contents) >= len(self.slots):
            self._grow()
        mask = len(self.slots) - 1
        at = h & mask
        while (i := int(self.slots[at])) >= 0:
            if self.hashes[i] == h and self.contents[i] == content:
                return i, False
            at = (at + 1) & mask
        self.slots[at] = i = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + ENTRY_BYTES
        return i, True

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        mask = len(self.slots) - 1
        for i, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def _combine(limit: int):
    schema = pa.schema([("doc_id", pa.int64()), ("rep", pa.int64()), ("hash", pa.int64()),
                        ("sha", pa.string()), ("weight", pa.int64()), ("text", pa.string())])

    def run(batches):
        # Row numbers inside a task make the keys; the table they are written to fixes them.
        base = TaskContext.get().partitionId() << 33
        table, keys, row = Table(), [], 0
        for b in batches:
            texts, hashes = b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_numpy()
            reps = np.empty(len(texts), dtype=np.int64)
            fresh = np.zeros(len(texts), dtype=bool)
            for i, (t, h) in enumerate(zip(texts, hashes.tolist(), strict=True)):
                e, new = table.entry(t, h)
                if new:
                    keys.append(base + row + i)
                    fresh[i] = True
                reps[i] = keys[e]
                if table.bytes > limit:  # only a combiner: start again when full
                    table, keys = Table(), []
            row += len(texts)
            kept = pa.compute.if_else(pa.array(fresh), b.column(1), pa.scalar(None, b.column(1).type))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(reps), b.column(2), b.column(3),
                 pa.array([len(t) + ENTRY_BYTES for t in texts], pa.int64()), kept.cast(pa.string())], schema=schema)
    return run


def _match(batches):
    """Rows ``(rep, hash, text, bucket)``, bucket by bucket -> ``(rep, grp)``: the least ``rep`` with the same content."""
    now, table, least, reps, entries = None, Table(), [], [], []

    def named():
        return pa.RecordBatch.from_arrays(
            [pa.array(reps, pa.int64()), pa.array(least, pa.int64()).take(pa.array(entries, pa.int64()))], names=["rep", "grp"])
    for b in batches:
        for rep, h, t, bucket in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                     b.column(2).cast(pa.binary()).to_pylist(), b.column(3).to_pylist(), strict=True):
            if bucket != now:
                if reps:
                    yield named()
                now, table, least, reps, entries = bucket, Table(), [], [], []
            e, new = table.entry(t, h)
            if new:
                least.append(rep)
            else:
                least[e] = min(least[e], rep)
            reps.append(rep)
            entries.append(e)
    if reps:
        yield named()


def buckets(rows: DataFrame, bucket_bytes: int = BUCKET_BYTES, max_fan: int = MAX_FAN):
    """``rows`` (rep, hash, weight, text) level by level with ``bucket``, the path of a bucket that needs no division.

    Yields ``(rows, tasks)``: with at most ``max_fan`` buckets there is a task for each, else ``max_fan`` tasks.
    A level's divided buckets are a table of their own (path and number of children).
    """
    total = rows.agg(F.sum("weight")).first()[0] or 0

    def children(weight: Column) -> Column:
        return F.least(F.lit(max_fan), F.greatest(F.lit(1), F.ceil(2 * weight / bucket_bytes))).cast("int")
    left = rows.withColumn("bucket", F.lit("")).withColumn("fan", children(F.lit(total)))
    tasks = min(max_fan, max(1, -(-2 * total // bucket_bytes)))
    for level in range(MAX_LEVELS):
        child = F.pmod(F.xxhash64("hash", F.lit(level)), F.col("fan"))
        dealt = left.withColumn("bucket", F.concat(F.col("bucket"), F.lit("/"), child.cast("string"))).drop("fan")
        sizes = dealt.groupBy("bucket").agg(F.sum("weight").alias("b"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        over, _ = checked_broadcast(sizes.filter((F.col("b") > bucket_bytes) & (F.col("lo") < F.col("hi")))
                                    .select("bucket", children(F.col("b")).alias("fan"), "b"))
        rest = over.agg(F.sum("b"), F.sum("fan")).first()
        if not rest[0] or level == MAX_LEVELS - 1:
            yield dealt, tasks
            return
        yield dealt.join(over.select("bucket"), "bucket", "left_anti"), tasks
        left = dealt.join(over.select("bucket", "fan"), "bucket")
        tasks = min(max_fan, int(rest[1]))


def exact_groups(docs: DataFrame, combine_bytes: int = COMBINE_BYTES, bucket_bytes: int = BUCKET_BYTES,
                 max_fan: int = MAX_FAN, content_hash=None) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs`` (doc_id, text).

    ``content_hash`` (text column -> long column) is the hash that chooses table
    slots and buckets; a weak one costs time, never a right answer.
    """
    content_hash = content_hash or (lambda c: F.xxhash64(c))
    rows = docs_of(docs).select("doc_id", "text", content_hash(F.col("text")).alias("hash"),
                                F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    stored = materialize(arrow_map(rows, _combine(combine_bytes),
                                   "doc_id long, rep long, hash long, sha string, weight long, text string"),
                         "grace")
    rows = stored.filter(F.col("text").isNotNull()).select("rep", "hash", "weight", "text")
    found = None
    for level, tasks in buckets(rows, bucket_bytes, max_fan):
        # On the first level a task is a bucket; deeper, a task has several and sorts them.
        place = F.substring("bucket", 2, 20).cast("int") if found is None else F.pmod(F.xxhash64("bucket"), F.lit(tasks)).cast("int")
        dealt = level.select("rep", "hash", "text", "bucket").repartitionById(tasks, place)
        part = arrow_map(dealt if found is None else dealt.sortWithinPartitions("bucket"), _match, "rep long, grp long")
        found = part if found is None else found.unionByName(part)
    found = materialize(found, "grace-groups")
    totals = stored.groupBy("rep").agg(F.max("doc_id").alias("max_id"), F.count(F.lit(1)).alias("n"))
    groups = (totals.join(found, "rep").groupBy("grp")
              .agg(F.max("max_id").alias("keep_id"), F.sum("n").alias("group_size")))
    answers = found.join(groups, "grp").select("rep", "keep_id", "group_size")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return (stored.select("doc_id", "rep", "sha").join(answers, "rep")
            .select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256")))


def keep_one(df: DataFrame, **limits) -> DataFrame:
    """The rows of ``df`` (doc_id, text, any others) that stay; rows equal in both go down to one."""
    def key():
        return (F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
                F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("sha"))
    stay = exact_groups(df, **limits).filter("kept").select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.col("text_sha256").alias("sha")).distinct()
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *key())
    return rows.join(stay, ["id", "sha"], "left_semi").dropDuplicates(["id", "sha"]).select("row.*")

"""Shared pieces of the ``llm`` operators: null-safe inputs, numpy tokenising, skew-safe joins."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import default_parallelism, materialize, scratch_path, ship_package

__all__ = ["HEAVY", "Tokens", "arrow_map", "default_parallelism", "docs_of", "hash_sample", "heavy_join", "materialize", "mix",
           "scratch_path", "ship_package", "slices", "tokenize", "within"]

# Bytes of text handled by one numpy step; bounds the temporary arrays of a worker.
SLICE_BYTES = 4 << 20
# A key with at least 1/HEAVY of all rows is heavy; at most HEAVY keys can be, whatever the data.
HEAVY = 1000
LOWER_A = 65  # "A"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def docs_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text string)`` of any table: a null text is empty, other columns are left out."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def arrow_map(df: DataFrame, fn, schema: str, **kwargs) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema, **kwargs)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that ``column`` holds about ``limit`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = string_buffers(batch.column(batch.schema.get_field_index(column)))
        at, n = 0, batch.num_rows
        while at < n:
            to = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
            to = min(n, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls and its n+1 offsets (starting at 0)."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Longer words (in bytes) are hashed one by one.
LONG_WORD = 512
# Keeps the first n bytes of a little-endian 8-byte load.
KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


class Tokens:
    """Words of a batch of texts: ``hash`` per word, ``first`` (n_docs+1) word offsets, byte ``start``/``end``."""

    __slots__ = ("end", "first", "hash", "raw", "start")

    def __init__(self, raw, start, end, hashes, first):
        self.raw, self.start, self.end, self.hash, self.first = raw, start, end, hashes, first

    @property
    def doc(self) -> np.ndarray:
        """Index of each word's document."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def tokenize(col: pa.Array, lower: bool, seed: int = 0) -> Tokens:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text with a 64-bit hash of their bytes.

    ``lower`` maps A-Z to a-z first (other letters stay).  Works on the Arrow
    buffer of the whole column: a word also ends where its text ends.
    """
    raw, offsets = string_buffers(col)
    size = len(raw)
    # Word bytes: all but 0x20 and 0x09-0x0D (uint8 arithmetic wraps below 9).
    word = (raw != 0x20) & ((raw - np.uint8(9)) > np.uint8(4))
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    # Text borders: a word at the start of a text begins there, one at its end stops there.
    inner = offsets[:-1][offsets[:-1] < size]
    begins[inner] = word[inner]
    last = offsets[1:][offsets[1:] > 0] - 1
    stops[last] = word[last]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(stops) + 1
    first = np.searchsorted(start, offsets)
    padded = np.zeros(size + 8, dtype=np.uint8)
    padded[:size] = raw
    if lower:
        padded += ((padded - np.uint8(65)) < np.uint8(26)).view(np.uint8) << np.uint8(5)
    # An 8-byte load at every byte position.
    loads = np.ndarray((size + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = end - start
    with np.errstate(over="ignore"):
        hashes = mix((loads[start] & KEEP[np.minimum(length, 8)]) + length.astype(np.uint64) * GOLDEN
                     + np.uint64(0x632BE59BD9B4E019 * (seed + 1) & 0xFFFFFFFFFFFFFFFF))
        for i in np.flatnonzero(length > LONG_WORD):  # each in one pass, not 8 bytes a step
            body = padded[start[i]:end[i]].tobytes()
            hashes[i] = int.from_bytes(hashlib.blake2b(body, digest_size=8, salt=bytes([seed])).digest(), "little")
        at, done = np.flatnonzero((length > 8) & (length <= LONG_WORD)), 8
        while len(at):
            left = length[at] - done
            hashes[at] = mix(hashes[at] * GOLDEN + (loads[start[at] + done] & KEEP[np.minimum(left, 8)]))
            done += 8
            at = at[left > 8]
    return Tokens(raw, start, end, hashes, first)


def within(first: np.ndarray) -> np.ndarray:
    """Position of each word inside its document."""
    counts = np.diff(first)
    return np.arange(int(first[-1] - first[0])) - np.repeat(first[:-1] - first[0], counts)


def heavy_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join on ``key`` where ``right`` has one row per key and ``weight`` says how many ``left`` rows it has.

    Keys with at least ``total / HEAVY`` rows are at most ``HEAVY`` (their weights
    sum to ``total``), so that part of ``right`` is broadcast whatever the input's
    size; every other key has under ``total / HEAVY`` rows and is joined by a shuffle.
    """
    cut = max(2, -(-total // HEAVY))
    heavy = F.broadcast(right.filter(F.col(weight) >= cut))
    rest = right.filter(F.col(weight) < cut)
    hot = left.join(heavy, key, "inner")
    cold = left.join(F.broadcast(right.filter(F.col(weight) >= cut).select(key)), key, "left_anti")
    return hot.unionByName(cold.join(rest, key, "inner"))


def hash_sample(df: DataFrame, id_col: str, total: int, want: int) -> DataFrame:
    """The first ``want`` rows of ``df`` (``total`` rows) by a hash of the id; the same on any partitioning.

    Rows far behind are filtered out first, so about ``8 * want`` rows in all, not
    ``want`` from each partition, meet in the task that takes the first ones.
    """
    share = min(1.0, 8 * want / max(total, 1))
    rows = df if share == 1.0 else df.filter(F.xxhash64(id_col) <= F.lit(int((share - 0.5) * (1 << 64))))
    return rows.orderBy(F.xxhash64(id_col), F.col(id_col)).limit(want)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

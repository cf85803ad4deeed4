"""Interpolated modified Kneser-Ney bigram model, counted in Spark, memory-mapped by workers.

Tokens are words and one end per text; the first token's context is a begin mark.

1. ``vocabulary``: tasks count word hashes, shards of the hash range are summed up and
   written as sorted hash arrays.  A word's id is its position in the whole order.
2. ``bigrams``: tasks count ``context id << 32 | word id``; shards by a hash of that key
   (a hot context is spread over all of them) are summed up and written as sorted
   arrays with counts.
3. ``contexts``: per id, the total and the number of successors seen once, twice, more
   often (as a context), and the number of predecessors (as a word); written as
   dense arrays by ranges of ids.
4. Scoring: every task maps the arrays it touches from the shared folder; pages are
   shared by the workers of a machine and no model passes through the driver.

Between the steps Spark shuffles packed blocks (sorted keys as differences, zstd), so
a block costs 4-5 bytes a distinct bigram.  The files are written under a temporary
name and renamed: a task that is run again writes the same file again.

p(w|h) = max(c(hw) - D(c), 0) / c(h) + g(h) p1(w), with g(h) = (D1 N1 + D2 N2 + D3 N3+) / c(h);
p1(w) is the same on the numbers of predecessors, and ends in the uniform 1 / (V + 1).
The three discounts come from the counts of counts of each order.  An unknown context
leaves p1; an unknown word gets the uniform share, so each context's probabilities
and the unknown word's add up to 1.

The folder must be one that every worker can open (the folder of spark.checkpoint.dir on
a mounted file system).  An array that is missing, or shorter than when it was written, raises.
Defined results: a null or empty text has one token, its end; rows that repeat count and are
scored each; without training texts every probability is 1; an empty table gives an empty table.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, replace
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, docs_of, materialize, mix, scratch_path, slices, tokenize

# Hash of the end mark (no word hashes to it but by chance of 2**-64).
END = np.uint64(0x5D8A1F3B9C27E641)
FLUSH_TOKENS = 3_000_000
MIN_SHARDS, MAX_SHARDS = 8, 1 << 14
BLOCK = "shard int, a binary, b binary"
# Arrays that a worker keeps mapped; each holds a file descriptor.
MAX_MAPPED = 400
_FILES: dict[str, np.ndarray] = {}


def mounted(uri: str) -> str:
    """The path of a folder on a mounted file system."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the model's folder must be on a mounted file system, not {uri}")
    return parts.path


def save(folder: str, name: str, array: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    temporary = os.path.join(folder, f".{name}-{uuid.uuid4().hex}.npy")
    np.save(temporary, array)
    os.replace(temporary, os.path.join(folder, f"{name}.npy"))


def mapped(folder: str, name: str, size: int | None = None) -> np.ndarray:
    """An array of the model.  ``size`` is the length it must have: a shard without rows needs no file.

    A file that is missing or has another length raises, as its n-grams would count as
    unseen.  The last ``MAX_MAPPED`` arrays stay mapped, so the number of open files is bounded.
    """
    if size == 0:
        return np.empty(0, np.uint64)
    path = os.path.join(folder, f"{name}.npy")
    array = _FILES.pop(path, None)
    if array is None:
        if not os.path.exists(path):
            raise FileNotFoundError(f"the model lacks {path}")
        while len(_FILES) >= MAX_MAPPED:
            _FILES.pop(next(iter(_FILES)))  # the one not used for longest
        array = np.load(path, mmap_mode="r" if os.path.getsize(path) > 256 else None)
    if size is not None and len(array) != size:
        raise ValueError(f"{path} has {len(array)} entries, not {size}")
    _FILES[path] = array
    return array


def pack(array: np.ndarray, ascending: bool = False) -> bytes:
    """An integer array as zstd of its byte planes (of the differences, if ascending)."""
    if ascending:
        array = np.diff(array, prepend=array.dtype.type(0))
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes, dtype, ascending: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    out = np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()
    return np.cumsum(out, dtype=dtype) if ascending else out


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct sorted keys and the sums of each value."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[at], *[np.add.reduceat(v[order], at) for v in values])


def blocks(shard: np.ndarray, pack_row) -> pa.RecordBatch:
    """A row per shard that occurs: ``pack_row(selection)`` gives its two blobs."""
    order = np.argsort(shard, kind="stable")
    present, starts = np.unique(shard[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    rows = [pack_row(order[s:e]) for s, e in zip(starts, ends, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(present.astype(np.int32)), pa.array([r[0] for r in rows], pa.binary()),
         pa.array([r[1] for r in rows], pa.binary())], names=["shard", "a", "b"])


@dataclass(frozen=True)
class Model:
    folder: str
    bits: int  # log2 of the number of shards of words and of bigrams
    bases: tuple[int, ...]  # first word id of each vocabulary shard
    vocabulary: int
    tokens: int
    id_shard: int  # ids per file of the dense arrays
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]
    pairs: int  # distinct bigrams
    low_mass: float = 1.0  # what the discounts of p1 take
    pair_sizes: tuple[int, ...] = ()  # distinct bigrams of each shard

    def word_size(self, shard: int) -> int:
        ends = (*self.bases[1:], self.vocabulary)
        return ends[shard] - self.bases[shard]

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Id of each word hash, -1 if it was not seen in training."""
        distinct, back = np.unique(hashes, return_inverse=True)
        ids = np.full(len(distinct), -1, dtype=np.int64)
        for shard, s, e in ranges(distinct >> np.uint64(64 - self.bits)):
            keys = mapped(self.folder, f"words-{shard}", self.word_size(shard))
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, distinct[s:e]), len(keys) - 1)
            ids[s:e] = np.where(keys[at] == distinct[s:e], at + self.bases[shard], -1)
        return ids[back]

    def word_counts(self, ids: np.ndarray) -> np.ndarray:
        """Training count of each known id (ids sorted)."""
        out = np.zeros(len(ids), dtype=np.float64)
        shard = np.searchsorted(np.asarray(self.bases), ids, side="right") - 1
        for k, s, e in ranges(shard):
            out[s:e] = mapped(self.folder, f"counts-{k}", self.word_size(k))[ids[s:e] - self.bases[k]]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Training count of each distinct sorted bigram key."""
        shard = (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        out = np.zeros(len(keys), dtype=np.float64)
        for k, s, e in ranges(shard[order]):
            size = self.pair_sizes[k] if self.pair_sizes else 0  # no text was counted
            have, part = mapped(self.folder, f"pairs-{k}", size), order[s:e]
            if not len(have):
                continue
            at = np.minimum(np.searchsorted(have, keys[part]), len(have) - 1)
            hit = have[at] == keys[part]
            out[part[hit]] = mapped(self.folder, f"paircounts-{k}", size)[at[hit]]
        return out

    def dense(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of a dense array at sorted ids."""
        out = np.zeros(len(ids), dtype=np.float64)
        for k, s, e in ranges(ids // self.id_shard):
            out[s:e] = mapped(self.folder, f"{name}-{k}", self.id_shard)[ids[s:e] - k * self.id_shard]
        return out


def ranges(sorted_values: np.ndarray):
    """``(value, start, end)`` of the runs of a sorted array."""
    if len(sorted_values):
        at = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
        for s, e in zip(at.tolist(), [*at[1:].tolist(), len(sorted_values)], strict=True):
            yield int(sorted_values[s]), s, e


def token_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts (each text's end included) and the token offsets."""
    t = tokenize(col, lower=True)
    first = t.first + np.arange(len(t.first))
    out = np.full(int(first[-1]), END, dtype=np.uint64)
    at = np.arange(len(t.hash)) + t.doc
    out[at] = t.hash
    return out, first


def _count_words(bits: int):
    def run(batches):
        held, n = [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return blocks((keys >> np.uint64(64 - bits)).astype(np.int64),
                          pack_row=lambda i: (pack(keys[i], True), pack(counts[i])))
        for b in slices(batches, "text"):
            held.append(token_hashes(b.column(0))[0])
            n += len(held[-1])
            if n >= FLUSH_TOKENS:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()
    return run


def merged(batches, dtypes, limit: int = 1 << 22) -> tuple[np.ndarray, ...]:
    """Sums of a shard's blocks: the keys of ``a`` and as many value columns as ``b`` holds."""
    parts, n = [], 0
    for b in batches:
        for a, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            keys = unpack(a, np.uint64, True)
            values = unpack(v, np.int64).reshape(dtypes, -1) if len(keys) else np.zeros((dtypes, 0), np.int64)
            parts.append((keys, *values))
            n += len(keys)
            if n > limit and len(parts) > 1:
                parts = [summed(*map(np.concatenate, zip(*parts, strict=True)))]
                n, limit = len(parts[0][0]), max(limit, 2 * len(parts[0][0]))
    if not parts:
        return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * dtypes)
    return summed(*map(np.concatenate, zip(*parts, strict=True)))


def _shard() -> int:
    """The shard that this task's partition holds."""
    return TaskContext.get().partitionId()


def narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint32) if not len(counts) or counts.max() < 1 << 32 else counts.astype(np.uint64)


def _write_words(folder: str):
    def run(batches):
        shard = _shard()
        keys, counts = merged(batches, 1)
        save(folder, f"words-{shard}", keys)
        save(folder, f"counts-{shard}", narrow(counts))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(keys)], pa.int64()),
                                          pa.array([int(counts.sum())], pa.int64())], names=["shard", "n", "total"])
    return run


def pair_keys(model: Model, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids, context ids (-1: unknown, V: begin mark) and bigram keys of all tokens."""
    ids = model.word_ids(hashes)
    context = np.empty(len(ids), dtype=np.int64)
    context[1:] = ids[:-1]
    context[first[:-1]] = model.vocabulary
    return ids, context, (context.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)


def _count_pairs(model: Model):
    def run(batches):
        held, n = [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return blocks((mix(keys) >> np.uint64(64 - model.bits)).astype(np.int64),
                          pack_row=lambda i: (pack(keys[i], True), pack(counts[i])))
        for b in slices(batches, "text"):
            held.append(pair_keys(model, *token_hashes(b.column(0)))[2])
            n += len(held[-1])
            if n >= FLUSH_TOKENS:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()
    return run


def _write_pairs(model: Model):
    """Write a shard's arrays; emit its counts of counts (shard -1) and per-id sums by ranges of ids."""
    def run(batches):
        shard = _shard()
        keys, counts = merged(batches, 1)
        save(model.folder, f"pairs-{shard}", keys)
        save(model.folder, f"paircounts-{shard}", narrow(counts))
        of = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([np.append(of, len(keys)).astype(np.int64).tobytes()], pa.binary()),
             pa.array([np.int64(shard).tobytes()], pa.binary())], names=["shard", "a", "b"])
        if not len(keys):
            return
        one = np.ones(len(keys), np.int64)
        for role, ids, values in (
                (0, keys >> np.uint64(32), (counts, (counts == 1) * one, (counts == 2) * one, (counts > 2) * one)),
                (1, keys & np.uint64(0xFFFFFFFF), (one,))):
            ids, *values = summed(ids, *values)
            part = blocks((ids // np.uint64(model.id_shard)).astype(np.int64) * 2 + role,
                          pack_row=lambda i, ids=ids, values=values: (
                              pack(ids[i], True), pack(np.concatenate([v[i] for v in values]))))
            yield part
    return run


def _write_ids(model: Model):
    """Dense arrays of a range of ids; emits the counts of counts of the predecessors."""
    size = model.id_shard

    def run(batches):
        shard = _shard()
        tables = list(batches)
        roles = [[b.filter(pa.array(b.column(0).to_numpy() % 2 == role)) for b in tables] for role in (0, 1)]
        ids, total, *numbers = merged(roles[0], 4)
        at = ids.astype(np.int64) - shard * size
        totals, gamma = np.zeros(size), np.zeros(size)
        totals[at] = total
        if len(at):
            gamma[at] = sum(d * n for d, n in zip(model.discounts, numbers, strict=True)) / total
        save(model.folder, f"totals-{shard}", totals)
        save(model.folder, f"gamma-{shard}", gamma)
        ids, before = merged(roles[1], 1)
        predecessors = np.zeros(size, np.uint32)
        predecessors[ids.astype(np.int64) - shard * size] = before
        save(model.folder, f"before-{shard}", predecessors)
        of = [*np.bincount(np.minimum(before, 5), minlength=6)[1:5], len(before)]
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in of],
                                         names=["t1", "t2", "t3", "t4", "types"])
    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3+ from the counts of counts; 0.5, 1, 1.5 where one is missing."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(float(min(max(d, 0.0), k + 1)) for k, d in enumerate(raw))


def _all_shards(df: DataFrame, n: int) -> DataFrame:
    """One partition per shard."""
    return df.repartitionById(n, F.expr("int(shard)"))


def train(texts: DataFrame) -> Model:
    """A model of ``texts`` (text string, no nulls)."""
    spark = texts.sparkSession
    texts = texts.select("text")
    folder = mounted(scratch_path(spark, "kneser-ney"))
    parts = max(1, texts.rdd.getNumPartitions())
    bits = int(min(MAX_SHARDS, max(MIN_SHARDS, parts)) - 1).bit_length()
    n = 1 << bits
    words = arrow_map(_all_shards(arrow_map(texts, _count_words(bits), BLOCK), n), _write_words(folder),
                      "shard int, n long, total long")
    rows = materialize(words, "kn-words").collect()  # one row per shard
    by_shard = {r["shard"]: r["n"] for r in rows}
    sizes = [by_shard.get(i, 0) for i in range(n)]
    bases = tuple(int(x) for x in np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    vocabulary, tokens = sum(sizes), sum(r["total"] for r in rows)
    if not tokens:
        return Model(folder, bits, bases, 0, 0, 1, (0.5, 1.0, 1.5), (0.5, 1.0, 1.5), 0)
    if vocabulary >= (1 << 32) - 1:
        raise ValueError("word ids need more than 32 bits")
    id_shard = max(1, -(-(vocabulary + 1) // n))
    model = Model(folder, bits, bases, vocabulary, tokens, id_shard, (0.0,) * 3, (0.0,) * 3, 0)
    pairs = arrow_map(_all_shards(arrow_map(texts, _count_pairs(model), BLOCK), n), _write_pairs(model), BLOCK)
    pairs = materialize(pairs, "kn-pairs")
    # One row per shard.
    rows = [(np.frombuffer(r["b"], np.int64)[0], np.frombuffer(r["a"], np.int64)) for r in
            pairs.filter("shard = -1").select("a", "b").collect()]
    stats, by_shard = np.sum([r[1] for r in rows], axis=0), {int(r[0]): int(r[1][4]) for r in rows}
    model = replace(model, discounts=discounts(*map(int, stats[:4])), pairs=int(stats[4]),
                    pair_sizes=tuple(by_shard.get(i, 0) for i in range(n)))
    id_shards = -(-(vocabulary + 1) // id_shard)
    by_id = pairs.filter("shard >= 0").repartitionById(id_shards, F.expr("shard div 2").cast("int"))
    low = arrow_map(by_id, _write_ids(model), "t1 long, t2 long, t3 long, t4 long, types long")
    sums = materialize(low, "kn-ids").agg(*[F.sum(x) for x in ("t1", "t2", "t3", "t4", "types")]).first()
    t1, t2, t3, t4, types = (int(x or 0) for x in sums)
    d = discounts(t1, t2, t3, t4)
    mass = (d[0] * t1 + d[1] * t2 + d[2] * (types - t1 - t2)) / model.pairs if model.pairs else 1.0
    return replace(model, low_discounts=d, low_mass=mass)


def _score(model: Model):
    def run(batches):
        for b in slices(batches, "text"):
            hashes, first = token_hashes(b.column(1))
            ids, context, keys = pair_keys(model, hashes, first)
            words, back = np.unique(ids, return_inverse=True)
            seen = words >= 0
            counts, before = np.zeros(len(words)), np.zeros(len(words))
            counts[seen], before[seen] = model.word_counts(words[seen]), model.dense("before", words[seen])
            low = (before - discount(before, model.low_discounts)) / max(model.pairs, 1)
            low = (low + model.low_mass / (model.vocabulary + 1))[back]
            base = np.log10((counts + 1) / (model.tokens + model.vocabulary + 1))[back]
            places, at = np.unique(context, return_inverse=True)
            usable = (places >= 0) & (model.tokens > 0)
            totals, gamma = np.zeros(len(places)), np.zeros(len(places))
            totals[usable], gamma[usable] = (model.dense(x, places[usable]) for x in ("totals", "gamma"))
            totals, gamma = totals[at], gamma[at]
            both = (ids >= 0) & (context >= 0)
            pairs, where = np.unique(keys[both], return_inverse=True)
            count = np.zeros(len(ids))
            count[both] = model.pair_counts(pairs)[where]
            high = (count - discount(count, model.discounts)) / np.maximum(totals, 1)
            score = np.log10(np.where(totals > 0, high + gamma * low, low))
            starts = first[:-1]  # every text has a token
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(first)), pa.array(np.add.reduceat((counts > 0)[back].astype(np.int64), starts)),
                 pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(score, starts))],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


def discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.select([counts == 0, counts == 1, counts == 2], [0.0, d[0], d[1]], d[2])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)`` of every row of ``docs`` (doc_id, text).

    ``base_score`` is the add-one unigram's log10 probability, ``score`` the model's.
    """
    return arrow_map(docs_of(docs), _score(model),
                     "doc_id long, n_tokens long, n_known long, base_score double, score double")

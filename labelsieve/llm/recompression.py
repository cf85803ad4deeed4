"""Substring dedup by recompression of word sequences.

Recompression replaces, level by level, pairs of a left-class and a following
right-class symbol by a new symbol, and before the first level maximal runs of one
word.  Runs are not joined again at higher levels: the step makes every symbol rest upon
both neighbours, which widens the deciding words and leaves lower, more numerous anchors
(sf0.01: 0.25 a word with the step at every level, 0.14 so).  Names are 64-bit
fingerprints of what a symbol stands for, so every task gives equal runs and pairs
the same name without asking another.  Equal substrings get equal symbols in
their interior: with each symbol go the words ``[lo, hi)`` that alone decided it
(itself, and the neighbours that might have merged with it), and wherever these
words stand again the same symbol stands there too.

The anchor of a window of ``window`` words is the leftmost symbol of the highest level
whose deciding words lie inside the window.  It depends on the window's words only:
equal windows have anchors of equal name.  Hence, in Spark rounds,

1. one pass names each text's symbols and keeps its distinct anchors, a digest of its
   word sequence and the digest of its words;
2. texts with the same word sequence form a class; only one of them goes on, and a
   class of several texts is repeated as a whole;
3. anchors are grouped by name over all classes; one that stands in a single place
   cannot belong to a repeat;
4. the windows of the remaining anchors are grouped by 96 bits of window hash and anchor
   name: those with a second place are repeats, and the words they cover are removed.

A key that is repeated inside one task is settled there, and one row per task goes
into the shuffle for it, so a passage that a third of all texts hold makes no large
group.  Windows are judged on the input, not on what is left.

Defined results: a null or empty text has no words; texts shorter than the window lose
nothing; rows that repeat an id are texts of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, Tokens, arrow_map, default_parallelism, docs_of, heavy_join, materialize, mix, slices, tokenize

WINDOW = 35
# Levels with a step for runs, and the number of levels; fixed, so that all tasks agree.
RUN_LEVELS = (0,)
MAX_LEVELS = 11
FLUSH_ROWS = 1_000_000
ROWS = "key long, id long, a long, b int"
# Values of b: an occurrence, one of a key that is repeated in its own task, a settled result.
ONCE, AGAIN, SETTLED = 0, 1, 2
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def neighbours(lo, hi, doc, first, at, stop):
    """What the symbols before ``at`` and from ``stop`` on rest upon; at a border, one word outside the text."""
    n, own = len(doc), doc[at]
    p, q = np.maximum(at - 1, 0), np.minimum(stop, n - 1)
    before = np.where((at > 0) & (doc[p] == own), lo[p], first[own] - 1)
    after = np.where((stop < n) & (doc[q] == own), hi[q], first[own + 1] + 1)
    return before, after


def compress_runs(name, start, lo, hi, doc, first, level):
    """Maximal runs of equal neighbours become one symbol each; a symbol alone rests upon both neighbours."""
    n = len(name)
    same = (name[1:] == name[:-1]) & (doc[1:] == doc[:-1])
    at = np.flatnonzero(np.concatenate([[True], ~same]))
    stop = np.append(at[1:], n)
    length = (stop - at).astype(np.uint64)
    new = np.where(length > 1, mix(name[at] * GOLDEN + length + np.uint64(level << 32)), name[at])
    before, after = neighbours(lo, hi, doc, first, at, stop)
    return new, start[at], np.minimum(before, lo[at]), np.maximum(after, hi[stop - 1]), doc[at]


def compress_pairs(name, start, lo, hi, doc, first, level):
    """A symbol of the left class and a following one of the right class become one symbol."""
    n = len(name)
    right = (mix(name + np.uint64(2 * level + 1) * GOLDEN) & np.uint64(1)).astype(bool)
    pair = np.zeros(n, dtype=bool)
    pair[:-1] = ~right[:-1] & right[1:] & (doc[1:] == doc[:-1])
    second = np.zeros(n, dtype=bool)
    second[1:] = pair[:-1]
    at = np.flatnonzero(~second)
    merged, of_right = pair[at], right[at]
    last = at + merged
    new = np.where(merged, mix(mix(name[at] + GOLDEN) * GOLDEN + name[last]), name[at])
    before, after = neighbours(lo, hi, doc, first, at, last + 1)
    # A left symbol that stays alone rests upon its successor, a right one upon its predecessor.
    low = np.where(~merged & of_right, np.minimum(before, lo[at]), lo[at])
    high = np.where(~merged & ~of_right, np.maximum(after, hi[last]), hi[last])
    return new, start[at], low, high, doc[at]


def levels(tokens: Tokens, window: int) -> list[tuple]:
    """The symbols of each level: name, first word, and the words [lo, hi) that decided them."""
    pos = np.arange(len(tokens.hash), dtype=np.int64)
    state = (tokens.hash, pos, pos, pos + 1, tokens.doc)
    out = [state[:4]]
    with np.errstate(over="ignore"):
        for level in range(MAX_LEVELS):
            if level in RUN_LEVELS:
                state = compress_runs(*state, tokens.first, level)
            state = compress_pairs(*state, tokens.first, level)
            out.append(state[:4])
    return out


def anchors(tokens: Tokens, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: its first word, the name of its anchor and the anchor's first word."""
    n_win = np.maximum(np.diff(tokens.first) - window + 1, 0)
    total = int(n_win.sum())
    begin = np.repeat(tokens.first[:-1], n_win) + np.arange(total) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    name, place = np.zeros(total, np.uint64), np.zeros(total, np.int64)
    left = np.arange(total)
    if not total:
        return begin, name, place
    for names, start, lo, hi in reversed(levels(tokens, window)):
        if not len(left):
            break
        # For each word, the first symbol with lo at or after it (lo never falls).
        following = np.cumsum(np.bincount(lo + 2, minlength=len(tokens.hash) + 3))
        at = begin[left]
        j = np.minimum(following[at + 1], len(lo) - 1)
        ok = (lo[j] >= at) & (hi[j] <= at + window)
        name[left[ok]], place[left[ok]] = names[j[ok]], start[j[ok]]
        left = left[~ok]
    return begin, name, place


MULTIPLIER = 0xD1342543DE82EF95
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def window_hashes(words: np.ndarray, begin: np.ndarray, window: int) -> np.ndarray:
    """Polynomial hash (modulo 2**64) of the ``window`` words from each ``begin``."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(MULTIPLIER, len(words)), dtype=np.uint64)])
        return mix((sums[begin + window] - sums[begin]) * _powers(INVERSE, len(words) + 1)[begin])


def sequence_digests(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's word sequence."""
    counts = np.diff(tokens.first)
    pos = (np.arange(len(tokens.hash)) - np.repeat(tokens.first[:-1], counts)).astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for seed in (1, 2):
            terms = mix(tokens.hash * np.uint64(2 * seed + 1) + mix(pos * GOLDEN + np.uint64(seed)))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
            out.append(mix(sums[tokens.first[1:]] - sums[tokens.first[:-1]] + counts.astype(np.uint64) * GOLDEN)
                       .view(np.int64))
    return tuple(out)


def _texts(col: pa.Array) -> list[bytes]:
    return col.cast(pa.binary()).to_pylist()


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                                    pa.array(values))


def _name_texts(window: int):
    """One row per text: digests, digest of its words, anchors that stand once in it and those that stand again."""
    def run(batches):
        for b in slices(batches, "text"):
            t = tokenize(b.column(1), lower=False)
            n = len(t.first) - 1
            begin, name, place = anchors(t, window)
            doc = np.searchsorted(t.first, begin, side="right") - 1
            # Distinct places first (neighbouring windows share theirs), then names.
            order = np.lexsort((place, name, doc))
            d, m, p = doc[order], name[order], place[order]
            new = np.ones(len(d), dtype=bool)
            new[1:] = (d[1:] != d[:-1]) | (m[1:] != m[:-1]) | (p[1:] != p[:-1])
            d, m = d[new], m[new]
            head = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (m[1:] != m[:-1])])) if len(d) else d
            many = np.diff(np.append(head, len(d))) > 1
            d, m = d[head], m[head].view(np.int64)
            d1, d2 = sequence_digests(t)
            shas = [hashlib.sha256(b" ".join(x.split())).hexdigest() for x in _texts(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(np.diff(t.first)), pa.array(d1), pa.array(d2), pa.array(shas),
                 _lists(m[~many], np.bincount(d[~many], minlength=n)), _lists(m[many], np.bincount(d[many], minlength=n))],
                names=["doc_id", "id", "n", "d1", "d2", "sha", "once", "again"])
    return run


def _equal(key: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Which rows have the key of their predecessor: ``key`` and the upper half of ``a``."""
    return (key[1:] == key[:-1]) & ((a[1:] >> 32) == (a[:-1] >> 32))


def settle(key: np.ndarray, ids: np.ndarray, a: np.ndarray, again: np.ndarray) -> pa.RecordBatch:
    """Rows for the shuffle: keys that stand alone in this task, one row of every other, and the settled results."""
    order = np.lexsort((a >> 32, key))
    key, ids, a, again = key[order], ids[order], a[order], again[order]
    head = np.flatnonzero(np.concatenate([[True], ~_equal(key, a)])) if len(key) else np.empty(0, np.int64)
    size = np.diff(np.append(head, len(key)))
    repeated = (size > 1) | (np.add.reduceat(again.astype(np.int64), head) > 0) if len(head) else head.astype(bool)
    done = np.repeat(repeated, size)
    spread = mix(ids[done].view(np.uint64) + GOLDEN).view(np.int64)  # settled rows go anywhere
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([key[head].view(np.int64), spread])),
         pa.array(np.concatenate([ids[head], ids[done]])), pa.array(np.concatenate([a[head], a[done]])),
         pa.array(np.concatenate([repeated.astype(np.int32), np.full(int(done.sum()), SETTLED, np.int32)]))],
        names=["key", "id", "a", "b"])


def _flushed(parts_of_batches):
    """Rows of ``settle`` for every FLUSH_ROWS keys."""
    held, n = [], 0
    for part in parts_of_batches:
        held.append(part)
        n += len(part[0])
        if n >= FLUSH_ROWS:
            yield settle(*map(np.concatenate, zip(*held, strict=True)))
            held, n = [], 0
    if n:
        yield settle(*map(np.concatenate, zip(*held, strict=True)))


def _name_rows(batches):
    """``(id, once, again)`` -> rows for the shuffle, the anchor's name as key and result."""
    def parts():
        for b in batches:
            for at, again in ((1, False), (2, True)):
                col = b.column(at)
                names = col.flatten().to_numpy(zero_copy_only=False)
                counts = np.diff(col.offsets.to_numpy())
                yield (names.view(np.uint64), np.repeat(b.column(0).to_numpy(), counts), names,
                       np.full(len(names), again))
    yield from _flushed(parts())


def _window_rows(window: int):
    """``(id, text, names)`` -> rows for the shuffle for each window whose anchor is one of ``names``."""
    def parts(batches):
        for b in slices(batches, "text"):
            t = tokenize(b.column(1), lower=False)
            begin, name, _ = anchors(t, window)
            doc = np.searchsorted(t.first, begin, side="right") - 1
            col = b.column(2)
            wanted = mix(col.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                         + GOLDEN * np.repeat(np.arange(b.num_rows), np.diff(col.offsets.to_numpy())).astype(np.uint64))
            keep = np.isin(mix(name + GOLDEN * doc.astype(np.uint64)), wanted)
            begin, name, doc = begin[keep], name[keep], doc[keep]
            # 96 bits of the window's words: the key, and the upper half of the position.
            text = window_hashes(t.hash, begin, window)
            key, more = mix(text + mix(name + np.uint64(1))), mix(text * GOLDEN ^ name)
            at = ((more >> np.uint64(32)) << np.uint64(32)).view(np.int64) | (begin - t.first[doc])
            yield key, b.column(0).to_numpy()[doc], at, np.zeros(len(begin), dtype=bool)

    def run(batches):
        with np.errstate(over="ignore"):
            yield from _flushed(parts(batches))
    return run


def _repeated(batches):
    """Rows sorted by key -> ``(id, a)`` of the settled ones and of those whose key stands twice or is repeated."""
    last = None  # the row whose successor is not known yet: key, id, a, b, whether its key came before
    for b in batches:
        if not b.num_rows:
            continue
        key, ids, a, kind = (b.column(i).to_numpy() for i in range(4))
        yield _pairs(ids[kind == SETTLED], a[kind == SETTLED])
        key, ids, a, kind = (x[kind != SETTLED] for x in (key, ids, a, kind))
        if not len(key):
            continue
        before = np.zeros(len(key), dtype=bool)
        before[1:] = _equal(key, a)
        if last is not None:
            before[0] = key[0] == last[0] and a[0] >> 32 == last[2] >> 32
            if (before[0] or last[4]) and last[3] == ONCE:
                yield _pairs(np.array([last[1]]), np.array([last[2]]))
        found = before.copy()
        found[:-1] |= before[1:]
        found &= kind == ONCE
        yield _pairs(ids[:-1][found[:-1]], a[:-1][found[:-1]])
        last = key[-1], ids[-1], a[-1], kind[-1], before[-1]
    if last is not None and last[4] and last[3] == ONCE:
        yield _pairs(np.array([last[1]]), np.array([last[2]]))


def _pairs(ids, a) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a, pa.int64())], names=["id", "a"])


def repeated(rows: DataFrame, partitions: int) -> DataFrame:
    """Group the rows of ``settle`` by key: one shuffle, sorted and read in passing."""
    dealt = rows.repartition(partitions, "key").sortWithinPartitions("key", "a")
    return arrow_map(dealt, _repeated, "id long, a long")


def _strip(window: int):
    """``(id, text, starts)`` -> what is left of each text when the windows at ``starts`` are taken out."""
    def run(batches):
        for b in slices(batches, "text"):
            removed, shas = [], []
            for text, starts in zip(_texts(b.column(1)), b.column(2).to_pylist(), strict=True):
                words = text.split()
                at = np.unique(np.asarray(starts, dtype=np.int64) & 0xFFFFFFFF)
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                cover[at] += 1
                cover[at + window] -= 1
                gone = np.cumsum(cover[:-1]) > 0
                removed.append(int(gone.sum()))
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
                shas.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(removed, pa.int64()), pa.array(shas)],
                                             names=["id", "n_removed", "kept_sha256"])
    return run


def strip_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, one row per row of ``docs`` (doc_id, text)."""
    n = default_parallelism(docs.sparkSession)
    # Tells rows that repeat a doc_id with another text apart; equal rows share it, and their answer.
    texts = docs_of(docs).withColumn("id", F.xxhash64("doc_id", "text"))
    named = materialize(arrow_map(texts.select("doc_id", "text", "id"), _name_texts(window),
                                  "doc_id long, id long, n long, d1 long, d2 long, sha string, "
                                  "once array<bigint>, again array<bigint>"), "named")
    keyed = named.withColumn("sequence", F.struct("d1", "d2"))
    classes = materialize(keyed.groupBy("sequence").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("texts")),
                          "sequences")
    total = named.count()
    placed = heavy_join(keyed, classes, "sequence", "texts", total)
    chosen = placed.filter((F.col("id") == F.col("least")) & (F.col("n") >= window)).select("id", "once", "again")
    names = repeated(arrow_map(chosen, _name_rows, ROWS), n)
    names = materialize(names.groupBy("id").agg(F.collect_set("a").alias("names")), "names")
    # Both uses of the texts below read one shuffle.
    dealt = texts.select("id", "text").repartition(n, "id")
    windows = arrow_map(dealt.join(names, "id").select("id", "text", "names"), _window_rows(window), ROWS)
    starts = repeated(windows, n).groupBy("id").agg(F.collect_list("a").alias("starts"))
    stripped = (arrow_map(dealt.join(starts, "id").select("id", "text", "starts"), _strip(window),
                          "id long, n_removed long, kept_sha256 string").dropDuplicates(["id"]))
    whole = (F.col("texts") > 1) & (F.col("n") >= window)
    rows = heavy_join(keyed.drop("once", "again"), classes, "sequence", "texts", total)
    return rows.join(stripped, "id", "left").select(
        "doc_id", F.col("n").alias("n_words"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))

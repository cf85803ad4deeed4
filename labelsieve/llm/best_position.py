"""Exact ranked retrieval by the Best Position Algorithm.

A query's terms each have an impact list: the documents that hold the term, in
descending order of what it adds to their score.  Documents are read from the heads of
a query's lists; each is scored at once by direct access to its places in the other
lists.  In every list the best position is the end of the contiguous run of places
seen, by reading or by direct access.  A document not seen yet stands behind the best
position of each list, so the impacts there add up to a threshold that no such document
passes; it is at most the threshold of the last places read.  The search of a query
stops when the threshold is strictly below its k-th best score, so ties are kept.

In Spark: (1) one pass over the whole texts notes for every document its length and
its occurrences of the queries' terms (Parquet table; queries in blocks of at most
``VOCABULARY`` distinct terms); (2) aggregates give the number of documents, of terms, and
of documents per term; (3) every task makes impact lists of the documents it reads, at most
``POSTINGS`` entries at a time, and searches them for every query, each block against
the k-th best score of the blocks before; (4) the k best rows of each task and query are
ranked.  No posting and no text is shuffled, and no task holds a term's whole list.

Score of a document with ``n`` terms: the sum over the query's terms, once each, of
``w * ((10**9 * tf) div (1000 * tf + 8 * m))``, where ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``
in doubles and ``m = 10 + (90 * n * N) div L``.

Defined results: a null text has no terms; rows that repeat a doc_id are documents of
their own; rows without a doc_id are documents and come last among equal scores; items of
the same id are one query with the terms of all, items without an id are one query too;
items without terms or without matches give no rows; empty tables give an empty table.
Scores are 64-bit integers, and Spark's arithmetic raises where one does not fit.
"""

from __future__ import annotations

import math
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, docs_of, materialize, slices, string_buffers, tokenize

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
# Distinct terms of a block of queries, and bytes of them; both bound what is broadcast.
VOCABULARY = 200_000
VOCABULARY_BYTES = 16 << 20
# Postings that a task holds at once.
POSTINGS = 2 << 20
# Places read from each list in the first round; rounds double it.
FIRST_READ = 16
# Fixed values of the score.
SLOPE, SATURATION, GAIN = 90, 8, 1_000_000_000
FOUND = "item_id long, doc_id long, score long"


def terms_of(text: str | None) -> list[str]:
    """The terms of a text, in order."""
    return [] if text is None else TERM.findall(text.translate(LOWER))


def _term_bytes(raw: np.ndarray) -> np.ndarray:
    """Text with every byte that no term holds made a blank (multi-byte characters are all term)."""
    letter = ((raw | 32) - np.uint8(97)) < np.uint8(26)
    return np.where(letter | ((raw - np.uint8(48)) < np.uint8(10)) | (raw >= 128), raw, np.uint8(32))


class Vocabulary:
    """The distinct terms of a block of queries: found by hash, confirmed byte by byte."""

    def __init__(self, terms: list[str]):
        words = tokenize(pa.array(terms, pa.string()), lower=False)
        order = np.argsort(words.hash, kind="stable")
        if len(words.hash) != len(terms) or (np.diff(words.hash[order]) == 0).any():
            raise ValueError("two terms of the queries share a hash")
        self.hash, self.number = words.hash[order], order.astype(np.int32)
        self.raw, self.start, self.size = words.raw, words.start, words.end - words.start

    def find(self, hashes: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray):
        """``(at, number)``: which words are terms, and which terms they are."""
        if not len(self.hash):
            return np.empty(0, np.int64), np.empty(0, np.int32)
        place = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        number = self.number[place]
        at = np.flatnonzero((self.hash[place] == hashes) & (self.size[number] == end - start))
        number, sizes = number[at], (end - start)[at]
        first = np.cumsum(sizes) - sizes
        inner = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        mine, its = raw[np.repeat(start[at], sizes) + inner], self.raw[np.repeat(self.start[number], sizes) + inner]
        lowered = mine + (((mine - np.uint8(65)) < np.uint8(26)).view(np.uint8) << np.uint8(5))
        good = np.add.reduceat(lowered != its, first) == 0 if len(at) else np.empty(0, bool)
        return at[good], number[good]


def _note(shared):
    """Documents -> ``(doc_id, n, terms, counts)`` of every document with a term."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                        ("counts", pa.list_(pa.int32()))])

    def run(batches):
        vocabulary: Vocabulary = shared.value
        for b in slices(batches):
            column = b.column(1)
            raw, offsets = string_buffers(column)
            clean = pa.StringArray.from_buffers(len(column), pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                                pa.py_buffer(_term_bytes(raw).tobytes()))
            words = tokenize(clean, lower=True)
            n = np.diff(words.first)
            at, number = vocabulary.find(words.hash, words.raw, words.start, words.end)
            key = words.doc[at].astype(np.int64) << 32 | number
            key, count = np.unique(key, return_counts=True)
            some = np.flatnonzero(n)
            ends = np.searchsorted(key >> 32, some, side="right")
            starts = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(some)), pa.array(n[some]),
                 pa.ListArray.from_arrays(pa.array(starts), pa.array((key & 0xFFFFFFFF).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(starts), pa.array(count.astype(np.int32)))], schema=schema)
    return run


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What a term of ``weight`` with ``tf`` occurrences adds to a document of ``n`` terms."""
    most = int(n.max()) if len(n) else 0
    if (100 - SLOPE) * total + SLOPE * most * docs >= 1 << 63:
        raise OverflowError("90 * n * N does not fit 64 bits")
    m = (100 - SLOPE) + (SLOPE * n * docs) // total
    return weight * ((GAIN * tf) // (1000 * tf + SATURATION * m))


class Best:
    """The k best rows of a query so far: by score, rows with an id first, smaller id."""

    __slots__ = ("ids", "k", "none", "scores")

    def __init__(self, k: int):
        self.k = k
        self.scores, self.none, self.ids = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        """The k-th best score (0: fewer than k)."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores, none, ids) -> None:
        some = (scores > 0) & (scores >= self.floor)
        scores, none, ids = (np.concatenate([a, b[some]]) for a, b in (
            (self.scores, scores), (self.none, none), (self.ids, ids)))
        order = np.lexsort((ids, none, -scores))[:self.k]
        self.scores, self.none, self.ids = scores[order], none[order], ids[order]


class Lists:
    """Impact lists of a block of documents.

    Entries stand by term and, in a term, by falling impact: an entry's place in that order is its
    place in the list.  ``by_doc`` leads from a document to its entries in all lists: the direct access.
    """

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((-impact, term))
        self.doc, self.term, self.impact = doc[order], term[order], impact[order]
        self.first = np.searchsorted(self.term, np.arange(n_terms + 1))
        self.by_doc = np.argsort(self.doc, kind="stable")
        self.doc_first = np.searchsorted(self.doc[self.by_doc], np.arange(n_docs + 1))
        self.seen = np.zeros(len(doc), dtype=bool)
        self.met = np.zeros(n_docs, dtype=bool)

    def search(self, terms: np.ndarray, wanted: np.ndarray, best: Best, none: np.ndarray, ids: np.ndarray) -> int:
        """Offer the documents of the lists of ``terms`` (``wanted``: the same as a mask); returns how many were scored."""
        starts, ends = self.first[terms], self.first[terms + 1]
        some = ends > starts
        starts, ends = starts[some], ends[some]
        position = starts.copy()  # best positions: the first place of each list that was not seen
        touched, met, depth, scored = [], [], 0, 0
        step = FIRST_READ
        while True:
            open_lists = position < ends
            threshold = int(self.impact[position[open_lists]].sum())
            if not threshold or (best.floor and threshold < best.floor):
                break
            # Sorted access: the next places of every list.
            low, high = np.minimum(starts + depth, ends), np.minimum(starts + depth + step, ends)
            sizes = high - low
            read = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            docs = np.unique(self.doc[read])
            docs = docs[~self.met[docs]]
            self.met[docs] = True
            met.append(docs)
            # Direct access: the places of these documents in all lists of the query.
            low, high = self.doc_first[docs], self.doc_first[docs + 1]
            sizes = high - low
            place = self.by_doc[np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
            owner = np.repeat(np.arange(len(docs)), sizes)
            mine = wanted[self.term[place]]
            place, owner = place[mine], owner[mine]
            scores = np.zeros(len(docs), dtype=np.int64)
            np.add.at(scores, owner, self.impact[place])
            best.add(scores, none[docs], ids[docs])
            self.seen[place] = True
            touched.append(place)
            scored += len(docs)
            depth, step = depth + step, step * 2
            for i in np.flatnonzero(open_lists):  # past the contiguous run of places seen
                at, end, ahead = position[i], ends[i], 64
                while at < end:
                    gap = np.flatnonzero(~self.seen[at:min(end, at + ahead)])
                    if len(gap):
                        at += gap[0]
                        break
                    at, ahead = min(end, at + ahead), ahead * 4
                position[i] = at
        for place in touched:
            self.seen[place] = False
        for docs in met:
            self.met[docs] = False
        return scored


def _search(shared, k: int, postings: int):
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def blocks(batches):
        """Documents with at most ``postings`` entries, or one document."""
        held, size = [], 0
        for b in batches:
            ends = np.asarray(b.column(2).offsets)
            at = 0
            while at < b.num_rows:
                to = int(np.searchsorted(ends, ends[at] + max(postings - size, 0), side="right")) - 1
                to = min(b.num_rows, max(to, at + (not held)))
                if to > at:
                    held.append(b.slice(at, to - at))
                    size += int(ends[to] - ends[at])
                    at = to
                if at < b.num_rows:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def run(batches):
        items, terms, weights, docs, total = shared.value
        best = [Best(k) for _ in items]
        wanted = np.zeros(len(weights), dtype=bool)
        for block in blocks(batches):
            part = pa.Table.from_batches(block).combine_chunks()
            ids, n, numbers, counts = (c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in part.columns)
            sizes = np.diff(np.asarray(numbers.offsets))
            doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            term = np.asarray(numbers.flatten())
            tf = np.asarray(counts.flatten()).astype(np.int64)
            length = np.asarray(n)
            impact = impacts(weights[term], tf, length[doc], docs, total)
            lists = Lists(doc, term, impact, len(sizes), len(weights))
            none = np.asarray(ids.is_null())
            known = ids.fill_null(0).to_numpy()
            for q, own in enumerate(terms):
                wanted[own] = True
                lists.search(own, wanted, best[q], none, known)
                wanted[own] = False
        for item, found in zip(items, best, strict=True):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found.ids), pa.int64()), pa.array(found.ids, mask=found.none),
                     pa.array(found.scores)], schema=schema)
    return run


def weight_of(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def query_blocks(items: DataFrame, vocabulary: int = VOCABULARY, vocabulary_bytes: int = VOCABULARY_BYTES):
    """Blocks of queries ``[(item_id, terms)]``, each of a bounded vocabulary (one query at least).

    The items come one by one (``toLocalIterator``), so only one block is on the driver.
    """
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, held, size, now = [], set(), 0, []
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        terms = dict.fromkeys(terms_of(r["text"]))
        if now and now[0] == r["item_id"]:
            terms = {**now[1], **terms}
            block.pop()
        now = [r["item_id"], terms]
        fresh = [t for t in terms if t not in held]
        more = list(accumulate((len(t.encode()) for t in fresh), initial=size))[-1]
        if block and (len(held) + len(fresh) > vocabulary or more > vocabulary_bytes):
            yield block
            block, held, fresh, more = [], set(), list(terms), sum(len(t.encode()) for t in terms)
        block.append((r["item_id"], list(terms)))
        held.update(fresh)
        size = more
    if block:
        yield block


def rank(docs: DataFrame, items: DataFrame, k: int, vocabulary: int = VOCABULARY, postings: int = POSTINGS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    rows = docs_of(docs)
    found = None
    for block in query_blocks(items, vocabulary):
        numbers = {t: i for i, t in enumerate(dict.fromkeys(t for _, terms in block for t in terms))}
        if not numbers:
            continue
        shared = spark.sparkContext.broadcast(Vocabulary(list(numbers)))
        noted = materialize(arrow_map(rows, _note(shared), "doc_id long, n long, terms array<int>, counts array<int>"),
                            "postings")
        n_docs, total = noted.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        holding = np.zeros(len(numbers), dtype=np.int64)
        for r in noted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per term
            holding[r["term"]] = r["count"]
        weights = np.array([weight_of(n_docs, int(h)) for h in holding], dtype=np.int64)
        queries = ([i for i, _ in block], [np.array([numbers[t] for t in terms], dtype=np.int64) for _, terms in block],
                   weights, n_docs, total)
        part = materialize(arrow_map(noted, _search(spark.sparkContext.broadcast(queries), k, postings), FOUND), "ranked")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))

"""Near-duplicate detection with SuperMinHash signatures.

Every shingle ``d`` draws, for j = 0, 1, ..., a fraction r_j(d) and the j-th element of a
random permutation of the components; component ``p_j(d)`` keeps the least ``j + r_j(d)``
over all shingles.  Ranks of one element are thus correlated (each component gets a
different whole part), which lowers the variance below that of independent
MinHash.  Steps j run over all shingles of a slice of documents at once, and a
document leaves as soon as all its components hold a value under ``j + 1``: no later
step can lower them.

1. One pass makes a row per document: set size, a 128-bit digest of the set, one hash
   per band.  Documents with the same set are one class from here on (copies of any
   number cost one partial aggregation).
2. Classes that share a band are candidates.  Each bucket first tries its members
   against its least member only.  After the components of the confirmed links are
   known, the pairs of a bucket that lie in different components are settled too, once for
   all bands (see ``_rest``): two sets that can reach the similarity share one of
   the rarest shingles of each, so shared boilerplate makes no candidates.  No candidate pair of
   a bucket stays open.  Joins on buckets broadcast the heavy ones and shuffle the others.
3. A candidate counts as a link only after the comparison of the full shingle sets.
4. Links are grouped by union-find.

``bands`` bands of ``rows`` components miss a pair of similarity s with probability
``(1 - s**rows)**bands``: 24 x 4 gives 2e-8 at 0.85 and 3e-6 at 0.8.

Defined results: a null text or a text without words has an empty set, links with
nothing and keeps itself; fewer words than ``k`` form one shingle; rows that repeat
an id form one document with the largest of their sets (of equally large ones the one
with the greatest digest); a row without an id links
with nothing, stays, and has no component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, HEAVY, arrow_map, docs_of, heavy_join, materialize, mix, ship_package, slices, tokenize
from .components import components

BANDS, ROWS = 24, 4
# Sets that share a rare shingle: up to so many are paired, more go through the blocks of their buckets.
RARE_GROUP = 32
# A chunk of a bucket's rows: at most about so many rows and shingles.
CHUNK_ROWS, CHUNK_SHINGLES = 512, 1 << 20
# Shingles that one step of a block's comparison takes.
TILE = 4096
U32 = np.uint64(32)
LOW32 = np.uint64(0xFFFFFFFF)


def shingles(tokens, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k``-word shingle (a shorter text: all its words) and its document's index."""
    counts = np.diff(tokens.first)
    n_sh = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), n_sh)
    begin = np.repeat(tokens.first[:-1], n_sh) + np.arange(int(n_sh.sum())) - np.repeat(np.cumsum(n_sh) - n_sh, n_sh)
    length = np.minimum(counts, k)[doc]
    padded = np.concatenate([tokens.hash, np.zeros(k, np.uint64)])
    with np.errstate(over="ignore"):
        h = length.astype(np.uint64) * GOLDEN
        for i in range(k):
            h = np.where(i < length, mix(h * GOLDEN + padded[begin + i]), h)
    return h, doc


def distinct_sets(h: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted inside each document, and their counts."""
    bounds = np.searchsorted(doc, np.arange(n_docs + 1))
    parts = [np.unique(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return np.concatenate(parts) if parts else h, np.array([len(p) for p in parts], dtype=np.int64)


def signatures(h: np.ndarray, counts: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash of each document (n x m uint64: whole part in the high half); ``counts`` hashes each."""
    n = len(counts)
    sig = np.full(n * m, ~np.uint64(0), dtype=np.uint64)
    doc = np.repeat(np.arange(n), counts)
    swaps: list[np.ndarray] = []  # k_0 .. k_(j-1) of the hashes still in play
    with np.errstate(over="ignore"):
        for j in range(m):
            draw = mix(h + np.uint64(j + 1) * GOLDEN)
            pos = (np.uint64(j) + (((draw >> U32) * np.uint64(m - j)) >> U32)).astype(np.int64)
            swaps.append(pos)
            at = pos
            for t in range(j - 1, -1, -1):  # undo the earlier swaps of the lazy permutation
                at = np.where(at == swaps[t], t, at)
            np.minimum.at(sig, doc * m + at, (np.uint64(j) << U32) | (draw & LOW32))
            full = ((sig.reshape(n, m) >> U32) <= np.uint64(j)).all(axis=1)
            left = ~full[doc]
            if not left.any():
                break
            if not left.all():
                h, doc, swaps = h[left], doc[left], [s[left] for s in swaps]
    return sig.reshape(n, m)


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(sig), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            h = np.full(len(sig), np.uint64(b + 1) * GOLDEN)
            for r in range(rows):
                h = mix(h * GOLDEN + sig[:, b * rows + r])
            out[:, b] = h
    return out


def set_digests(h: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of each document's set; ``counts`` distinct hashes each."""
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + GOLDEN), dtype=np.uint64)])
        other = np.concatenate([[np.uint64(0)], np.cumsum(mix(h * GOLDEN), dtype=np.uint64)])
        ends = np.cumsum(counts)
        return [(x[ends] - x[ends - counts]).view(np.int64) for x in (total, other)]


def _sketch(k: int, bands: int, rows: int):
    def run(batches):
        for b in slices(batches, "text"):
            h, doc = shingles(tokenize(b.column(1), lower=True), k)
            h, counts = distinct_sets(h, doc, b.num_rows)
            some = counts > 0
            d1, d2 = set_digests(h, counts)
            lists = band_hashes(signatures(h, counts[some], bands * rows), bands, rows).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts), pa.array(d1), pa.array(d2),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists.ravel()))],
                names=["doc_id", "n", "d1", "d2", "bands"])
    return run


def _sets(k: int):
    def run(batches):
        for b in slices(batches, "text"):
            h, doc = shingles(tokenize(b.column(1), lower=True), k)
            h, counts = distinct_sets(h, doc, b.num_rows)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *map(pa.array, set_digests(h, counts)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))],
                names=["doc_id", "d1", "d2", "hashes"])
    return run


def _block(percent: int):
    """Links inside one block of a bucket, as a forest: rows (u, n, component, side, hashes) -> (u, v)."""
    def run(table: pa.Table) -> pa.Table:
        ids, n, component, side = (table.column(c).to_numpy() for c in ("u", "n", "component", "side"))
        col = table.column("hashes").combine_chunks()
        counts = np.diff(col.offsets.to_numpy())
        row = np.repeat(np.arange(len(ids)), counts)
        _, at, times = np.unique(col.flatten().to_numpy(), return_inverse=True, return_counts=True)
        row, at = row[times[at] > 1], at[times[at] > 1]
        _, at = np.unique(at, return_inverse=True)
        both = np.zeros((len(ids), len(ids)), dtype=np.float32)
        order = np.argsort(at, kind="stable")
        row, at = row[order], at[order]
        for low in range(0, int(at[-1]) + 1 if len(at) else 0, TILE):  # counts up to 2**24 are exact in float32
            s, e = np.searchsorted(at, [low, low + TILE])
            tile = np.zeros((len(ids), TILE), dtype=np.float32)
            tile[row[s:e], at[s:e] - low] = 1
            both += tile @ tile.T
        union = n[:, None] + n[None, :] - both
        linked = np.triu(both * 100 >= union * percent, 1)
        linked &= component[:, None] != component[None, :]
        if len(set(side.tolist())) > 1:  # two chunks: only pairs between them
            linked &= side[:, None] != side[None, :]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := root.get(x, x)) != x:
                x = y
            return x
        out = []
        for i, j in np.argwhere(linked).tolist():
            x, y = find(int(component[i])), find(int(component[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((ids[i], ids[j]))
        return pa.table({"u": pa.array([x for x, _ in out], pa.int64()), "v": pa.array([y for _, y in out], pa.int64())})
    return run


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """``rows`` (u, ...) with the component of u; an id without a link is its own."""
    return (rows.join(label.select(F.col("id").alias("u"), "component"), "u", "left")
            .withColumn("component", F.coalesce("component", "u")))


def _still_open(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (key, u, n, component) of buckets with several components, with the bucket's least n, rows and weight."""
    sides = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                    F.min("n").alias("least_n"), F.count(F.lit(1)).alias("rows"),
                                    F.sum("n").alias("weight")).filter("lo < hi").drop("lo", "hi")
    return heavy_join(rows.drop("least_n", "rows", "weight"), materialize(sides, "sides"), "key", "rows", total)


def _rest(member: DataFrame, label: DataFrame, sets: DataFrame, percent: int, total: int,
          rare_group: int = RARE_GROUP) -> DataFrame:
    """Links (u, v) across the components that meet in a bucket, after its least member was tried.

    A shingle that no other document of the open buckets has cannot be in an
    intersection: with ``r`` shared shingles a document of ``n`` reaches at most
    ``r / (n + m - r)`` with one of ``m`` or more.  Rows that cannot reach the
    similarity inside their bucket leave.
    """
    rows = materialize(_still_open(_labelled(member, label), total), "open")
    mine = rows.select("u").distinct().join(sets, "u").select("u", F.explode("hashes").alias("h"))
    common = materialize(mine.groupBy("h").agg(F.count(F.lit(1)).alias("docs")).filter("docs > 1"), "common")
    # The shared shingles of each set, rarest first (adaptive execution splits the side of a common shingle).
    shared = materialize(mine.join(common, "h").groupBy("u").agg(
        F.count(F.lit(1)).alias("r"), F.array_sort(F.collect_list(F.struct("docs", "h"))).alias("rare")), "shared")
    can = F.col("r") * 100 >= (F.col("n") + F.greatest("least_n", "r") - F.col("r")) * percent
    rows = materialize(_still_open(rows.join(shared.select("u", "r"), "u").filter(can), total), "open")
    pairs, crowded = rare_pairs(rows.select("u", "n", "component").distinct(), shared, percent, rare_group)
    links = _confirmed(pairs, sets, percent)
    if crowded.isEmpty():
        return links
    return links.unionByName(_blocks(_still_open(rows.join(crowded, "u"), total), sets, percent))


def rare_pairs(ids: DataFrame, shared: DataFrame, percent: int, rare_group: int = RARE_GROUP) -> tuple[DataFrame, DataFrame]:
    """Candidates ``(u, v)`` among ``ids`` (u, n, component), and the crowded ids ``(u)``.

    ``shared`` (u, r, rare): the shingles that other sets have too, rarest first.  Two sets that
    reach the similarity share ``ceil(percent * n / 100)`` shingles at least, ``n`` the size of
    either; so the first shingle that they share, in the order of rarity, is among the
    first ``r - ceil(percent * n / 100) + 1`` of both.  Sets that meet in one of these are paired where it
    has up to ``rare_group`` sets, each pair once; the sets of larger groups are crowded.
    """
    need = F.expr(f"({percent} * n + 99) div 100")
    first = F.slice("rare", F.lit(1), F.greatest(F.col("r") - need + 1, F.lit(0)).cast("int"))
    entries = ids.join(shared, "u").select("u", "n", "component", F.explode(first).alias("e")).select(
        "u", "n", "component", F.col("e.h").alias("h"))
    entries = materialize(entries, "rare")
    groups = materialize(entries.groupBy("h").agg(
        F.count(F.lit(1)).alias("docs"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo < hi").select("h", "docs"), "rare-groups")
    # Groups are bounded, so the pairs of an entry are too.
    small = entries.join(groups.filter(F.col("docs") <= rare_group).select("h"), "h")
    other = small.select(F.col("u").alias("v"), F.col("n").alias("m"), F.col("component").alias("c"), "h")
    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    pairs = small.join(other, "h").filter((F.col("u") < F.col("v")) & (F.col("component") != F.col("c")) & fits)
    total = entries.count()
    crowded = heavy_join(entries, groups.filter(F.col("docs") > rare_group), "h", "docs", total).select("u").distinct()
    return pairs.select("u", "v").distinct(), materialize(crowded, "crowded")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity."""
    both = F.size(F.array_intersect("a", "b"))
    held = pairs.join(sets.withColumnRenamed("hashes", "a"), "u").join(
        sets.select(F.col("u").alias("v"), F.col("hashes").alias("b")), "v")
    return held.filter(both * 100 >= (F.size("a") + F.size("b") - both) * percent).select("u", "v")


def _blocks(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``rows`` (key, u, n, component, rows, weight): all pairs of a bucket, in blocks of two chunks at most.

    A task gets a bounded number of sets, and gives back a forest of the links it found.
    """
    chunks = F.greatest(F.ceil(F.col("rows") / CHUNK_ROWS), F.ceil(F.col("weight") / CHUNK_SHINGLES)).cast("int")
    rows = (rows.withColumn("chunks", chunks)
            .withColumn("side", F.pmod(F.xxhash64("u", "key"), F.col("chunks")).cast("int")))
    dealt = rows.select("u", "n", "component", "key", "side", F.explode(F.expr("sequence(0, chunks - 1)")).alias("other"))
    dealt = dealt.select("u", "n", "component", "side", "key", F.least("side", "other").alias("a"),
                         F.greatest("side", "other").alias("b"))
    ship_package(rows.sparkSession)
    return (dealt.join(sets, "u").groupBy("key", "a", "b").applyInArrow(_block(percent), "u long, v long")
            .distinct())


def _largest(keyed: DataFrame, total: int) -> DataFrame:
    """``keyed`` (the sketch's rows with an id) with one set an id: the greatest by (n, d1, d2)."""
    parts = ("n", "d1", "d2")
    several = (keyed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{f.__name__}_{c}")
                                                                             for c in parts for f in (F.min, F.max)])
               .filter(" or ".join(f"min_{c} < max_{c}" for c in parts)).select("doc_id", "rows"))
    several = materialize(several, "several")
    if several.isEmpty():
        return keyed
    best = (heavy_join(keyed, several, "doc_id", "rows", total).groupBy("doc_id")
            .agg(F.max(F.struct(*parts, "bands")).alias("best")).select("doc_id", "best.*"))
    cut = max(2, -(-total // HEAVY))  # so many rows make at most HEAVY ids
    heavy, rest = (several.filter(c).select("doc_id") for c in (F.col("rows") >= cut, F.col("rows") < cut))
    others = keyed.join(F.broadcast(heavy), "doc_id", "left_anti").join(rest, "doc_id", "left_anti")
    return materialize(others.unionByName(best), "largest")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per id of ``docs`` (doc_id, text).

    Links documents whose sets of ``k``-word shingles have ``100 * intersection >=
    percent * union``; ``component_id`` is the least id that can be reached.
    """
    docs = docs_of(docs)
    sketch = arrow_map(docs, _sketch(k, bands, rows),
                       "doc_id long, n long, d1 long, d2 long, bands array<bigint>")
    sketch = materialize(sketch, "sketch")
    total = sketch.count()
    largest = _largest(sketch.filter("doc_id is not null"), total)
    # Classes of equal sets; ``u`` is the least id.
    classes = (largest.filter("n > 0").groupBy("d1", "d2", "n")
               .agg(F.min("doc_id").alias("u"), F.count(F.lit(1)).alias("size"), F.first("bands").alias("bands")))
    classes = materialize(classes, "classes")
    banded = classes.select("u", "n", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min(F.struct("u", "n")).alias("least"), F.count(F.lit(1)).alias("members"))
    buckets = materialize(buckets.filter("members > 1"), "shared-buckets")
    n_banded = classes.count() * bands
    member = materialize(heavy_join(banded, buckets, "key", "members", n_banded).drop("members"), "buckets")
    sets = arrow_map(docs.join(member.select(F.col("u").alias("doc_id")).distinct(), "doc_id", "left_semi"), _sets(k),
                     "doc_id long, d1 long, d2 long, hashes array<bigint>")
    sets = materialize(sets.groupBy(F.col("doc_id").alias("u"))
                       .agg(F.max_by("hashes", F.struct(F.size("hashes"), "d1", "d2")).alias("hashes")), "sets")
    # Sets whose sizes differ too much cannot reach the similarity.
    star = (member.select("u", "n", F.col("least.u").alias("v"), F.col("least.n").alias("m"))
            .filter((F.col("u") != F.col("v")) & (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent))
            .select("u", "v").distinct())
    links = materialize(_confirmed(star, sets, percent), "links")
    label = components(links)
    more = materialize(_rest(member.select("key", "u", "n"), label, sets, percent, n_banded), "more")
    if not more.isEmpty():
        label = components(links.unionByName(more))
    found = _labelled(classes.select("d1", "d2", "n", "u", "size"), label)
    found = materialize(found.select(F.struct("d1", "d2", "n").alias("set"), "size",
                                     F.col("component").alias("component_id")), "found")
    nameless = sketch.filter("doc_id is null").select("doc_id", F.col("n").alias("n_shingles"),
                                                      F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    keyed = largest.select("doc_id", "n", F.struct("d1", "d2", "n").alias("set"))
    empty = keyed.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    full = heavy_join(keyed.filter("n > 0"), found, "set", "size", total).select("doc_id", "n", "component_id")
    out = full.unionByName(empty).groupBy("doc_id").agg(F.max("n").alias("n_shingles"),
                                                        F.min("component_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id")).unionByName(nameless)


def keep_one(df: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` (doc_id, text, any others) that stay: one document of each group."""
    stay = near_duplicates(df, k, percent).filter("kept and doc_id is not null").select(
        F.col("doc_id").alias("id"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.col("doc_id").cast("long").alias("id"))
    kept = rows.filter("id is not null").join(stay, "id", "left_semi")
    return kept.select("row.*").unionByName(rows.filter("id is null").select("row.*"))

"""Exact top-k inner products by pivot-table elimination.

Vectors are quantised to whole numbers (held as doubles, so any size fits).  Pivots are
vectors of a hash sample, chosen one after the other as the one farthest from the span of
those before.  The pivot table is made once and stored beside the vectors: for every
vector the coordinates that its distances to the pivots determine (over the pivots'
orthonormal basis), and its distance ``off`` from their span.  For a query and a candidate

    q.x  <=  at(q).at(x) + off(q) * off(x)

(Cauchy-Schwarz outside the span; with all pivots at once this is at least as tight as any
triangle inequality over single ones).  A task takes the candidates in the order of that
bound and stops when the next bound lies under the k-th best exact score, so nothing that
could enter the result goes unevaluated.  The first k-th best score of each query comes
from the sample (all of it scored exactly), so tasks eliminate from their first row on.

Queries are taken in blocks of at most about ``query_block`` rows, broadcast one
block at a time (a fixed size); all candidates are read once per block, and each
task sends the k best of its rows for each query.

Defined results: vectors that are null, empty or hold a null or non-finite
component, and rows without an id, take no part; a shorter vector counts as padded
with zeros; rows that share the query's id are its own, rows that repeat another id are candidates
each, and an id with several vectors asks with the least of them; equal scores go to the
smaller id; fewer than k candidates give fewer rows.  Scores are exact whatever the
size of the components: where doubles or 64-bit integers do not hold a product it
is added up in unbounded integers, and an evaluated score that does not fit 64 bits raises, as does a
component whose quantised value is no finite double.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, hash_sample, materialize

# Pivots: three quarters of the dimensions, within these bounds.
LEAST_PIVOTS, MOST_PIVOTS = 32, 256
# Rows of which the pivots and the first scores are taken.
SAMPLE = 2048
QUERY_BLOCK = 16_384
# Queries and candidates of one matrix of bounds.
QUERY_STEP, CANDIDATE_BLOCK = 1024, 4096
SCHEMA = "query_id long, vec_id long, score long"
TABLE = "vec_id long, v array<double>, at array<double>, off double, norm double"
# Whole numbers and their sums below this are exact in doubles.
EXACT = float(1 << 52)
EXACT_LONG = float(1 << 62)
# Squares of larger vectors leave the range of doubles; they are always evaluated.
WILD = 1e150
# More than the rounding of a bound, as a share of |q||x|.
SLACK = 1e-9


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(vec_id, v array<double>)`` of the rows that take part: whole numbers ``floor(scale * x)``."""
    def sound(x: Column) -> Column:
        d = x.cast("double")
        return x.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf"))

    def whole(x: Column) -> Column:
        y = x.cast("double") * float(scale)
        large = F.abs(y) >= EXACT  # such doubles are whole numbers
        no = F.raise_error(F.lit("a component is too large to be quantised")).cast("double")
        return (F.when(F.abs(y) == float("inf"), no).when(large, y)
                .otherwise(F.floor(F.when(large, 0.0).otherwise(y)).cast("double")))
    v = F.col(f"`{vector_col}`")
    return (df.filter(v.isNotNull() & F.col(f"`{id_col}`").isNotNull() & (F.size(v) > 0) & F.forall(v, sound))
            .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.transform(v, whole).alias("v")))


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as doubles, padded with zeros to ``dim``."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(col.offsets.to_numpy())
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes),
        np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def norms(rows: np.ndarray) -> np.ndarray:
    """Lengths of the rows; infinite where a square leaves the range."""
    most = np.abs(rows).max(1, initial=0.0)
    with np.errstate(over="ignore"):
        return np.where(most < WILD, np.sqrt((np.where(most[:, None] < WILD, rows, 0.0) ** 2).sum(1)), np.inf)


def basis_of(sample: np.ndarray, n_pivots: int) -> np.ndarray:
    """Orthonormal basis (pivots x dimensions) of up to ``n_pivots`` rows, each farthest from the span of those before."""
    rest = sample[np.isfinite(norms(sample))].copy()
    basis = np.empty((0, sample.shape[1]))
    while len(basis) < n_pivots and len(rest):
        length = np.sqrt((rest * rest).sum(1))
        far = int(length.argmax())
        if length[far] < 1e-6:
            break
        new = rest[far] / length[far]
        new -= basis.T @ (basis @ new)  # once more, against rounding
        size = math.sqrt(new @ new)
        if size < 0.5:
            break
        basis = np.vstack([basis, new / size])
        rest -= np.outer(rest @ basis[-1], basis[-1])
    return basis


def coordinates(rows: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coordinates over the pivots, distance from their span, length."""
    size = norms(rows)
    fine = np.where(np.isfinite(size)[:, None], rows, 0.0)
    at = fine @ basis.T
    return at, norms(fine - at @ basis), size


def exact_scores(rows: np.ndarray, sizes: np.ndarray, query: np.ndarray, query_size: float) -> np.ndarray:
    """Inner products of whole numbers, exactly; all partial sums stay below |q||x|."""
    limit = sizes.max(initial=0.0) * query_size
    if limit < EXACT:
        return (rows @ query).astype(np.int64)
    out = np.empty(len(rows), dtype=np.int64)
    for i, (row, size) in enumerate(zip(rows, sizes.tolist(), strict=True)):
        if size * query_size < EXACT:
            out[i] = int(row @ query)
        elif size * query_size < EXACT_LONG and max(size, query_size) < EXACT_LONG:
            out[i] = row.astype(np.int64) @ query.astype(np.int64)
        else:
            score = sum(int(a) * int(b) for a, b in zip(row.tolist(), query.tolist(), strict=True))
            if not -(1 << 63) <= score < 1 << 63:
                raise OverflowError("a score does not fit 64 bits")
            out[i] = score
    return out


def _below(score: int) -> float:
    """A double that is not above ``score``."""
    x = float(score)
    return x if abs(score) < EXACT else math.nextafter(x, -math.inf)


class Best:
    """The k best (score, id) of one query so far; ``least`` is a score that k rows elsewhere reach."""

    __slots__ = ("ids", "k", "least", "scores")

    def __init__(self, k: int, least: float = -math.inf):
        self.k, self.least, self.scores, self.ids = k, least, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def floor(self) -> float:
        return max(self.least, _below(int(self.scores[-1]))) if len(self.scores) == self.k else self.least

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, ~scores))[:self.k]  # ~ turns the order round without overflow
        self.scores, self.ids = scores[order], ids[order]


def bounds(at: np.ndarray, off: np.ndarray, size: np.ndarray, q_at: np.ndarray, q_off: np.ndarray,
           q_size: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products (queries x candidates)."""
    with np.errstate(invalid="ignore", over="ignore"):
        most = q_at @ at.T + np.outer(q_off, off) + SLACK * np.outer(q_size, size) + 1
    return np.where(np.isfinite(most), most, np.inf)


def search_block(best: Best, query: np.ndarray, query_size: float, query_id: int, bound: np.ndarray, rows: np.ndarray,
                 sizes: np.ndarray, ids: np.ndarray) -> int:
    """Offer a block's rows to ``best`` in bound order; returns how many were evaluated."""
    order = np.flatnonzero((bound >= best.floor) & (ids != query_id))
    order = order[np.argsort(-bound[order], kind="stable")]
    step, at = 4 * best.k, 0
    while at < len(order) and bound[order[at]] >= best.floor:
        part = order[at:at + step]
        best.add(exact_scores(rows[part], sizes[part], query, query_size), ids[part])
        at, step = at + step, step * 2
    return min(at, len(order))


def _tabulate(shared, dim: int):
    def run(batches):
        basis = shared.value
        for b in batches:
            at, off, size = coordinates(matrix(b.column(1), dim), basis)
            ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * at.shape[1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(ends, pa.array(at.ravel())),
                                              pa.array(off), pa.array(size)], names=["vec_id", "v", "at", "off", "norm"])
    return run


def first_floors(queries: np.ndarray, query_ids: np.ndarray, sample: np.ndarray, sample_ids: np.ndarray, k: int) -> np.ndarray:
    """For each query the k-th best score in the sample (-inf: the sample has fewer, or products that doubles do not hold)."""
    floors = np.full(len(queries), -np.inf)
    q_size, s_size = norms(queries), norms(sample)
    fine = np.isfinite(s_size)
    if fine.sum() <= k:
        return floors
    sample, sample_ids, limit = sample[fine], sample_ids[fine], s_size[fine].max()
    safe = np.flatnonzero(q_size * limit < EXACT)
    for i in range(0, len(safe), QUERY_STEP):
        at = safe[i:i + QUERY_STEP]
        scores = queries[at] @ sample.T
        scores[query_ids[at][:, None] == sample_ids[None, :]] = -np.inf
        floors[at] = np.partition(scores, -k, axis=1)[:, -k]
    return floors


def top_k(vectors: DataFrame, queries: DataFrame, k: int, n_pivots: int | None = None,
          query_block: int = QUERY_BLOCK, tally=None) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for ``queries`` against ``vectors``, both from ``quantised``.

    ``tally``, an accumulator of the session, adds up the evaluated pairs.
    """
    spark = vectors.sparkSession
    vectors = materialize(vectors, "vectors")
    queries = materialize(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    total, dim = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    dim = max(dim or 0, queries.agg(F.max(F.size("v"))).first()[0] or 0)

    def held(rows) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((len(rows), dim))
        for i, r in enumerate(rows):
            out[i, :len(r["v"])] = r["v"]
        return np.array([r["vec_id"] for r in rows], dtype=np.int64), out
    sample_ids, sample = held(hash_sample(vectors, "vec_id", total, SAMPLE).collect())
    basis = basis_of(sample, n_pivots or min(MOST_PIVOTS, max(LEAST_PIVOTS, 3 * dim // 4)))
    table = materialize(arrow_map(vectors, _tabulate(spark.sparkContext.broadcast(basis), dim), TABLE), "pivot-table")
    blocks = max(1, -(-queries.count() // query_block))
    found = None
    for block in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect()
        if not rows:
            continue
        ids, q = held(rows)
        shared = spark.sparkContext.broadcast((ids, q, *coordinates(q, basis), first_floors(q, ids, sample, sample_ids, k)))
        part = materialize(arrow_map(table, _search(shared, k, dim, tally), SCHEMA), "topk")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _search(shared, k: int, dim: int, tally=None):
    def run(batches):
        query_ids, queries, q_at, q_off, q_size, floors = shared.value
        best, done = [Best(k, f) for f in floors.tolist()], 0
        for b in batches:
            for at in range(0, b.num_rows, CANDIDATE_BLOCK):
                part = b.slice(at, CANDIDATE_BLOCK)
                ids, rows = part.column(0).to_numpy(), matrix(part.column(1), dim)
                places, off, size = matrix(part.column(2), q_at.shape[1]), part.column(3).to_numpy(), part.column(4).to_numpy()
                for first in range(0, len(queries), QUERY_STEP):
                    some = slice(first, first + QUERY_STEP)
                    most = bounds(places, off, size, q_at[some], q_off[some], q_size[some])
                    now = np.array([x.floor for x in best[some]])
                    for i in np.flatnonzero((most >= now[:, None]).any(1)):
                        q = first + int(i)
                        done += search_block(best[q], queries[q], float(q_size[q]), int(query_ids[q]), most[i], rows, size, ids)
        if tally is not None:
            tally.add(done)
        n = [len(x.ids) for x in best]
        if sum(n):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(query_ids, n)), pa.array(np.concatenate([x.ids for x in best])),
                 pa.array(np.concatenate([x.scores for x in best]))], names=["query_id", "vec_id", "score"])
    return run

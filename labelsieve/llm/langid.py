"""Language identification by Bayesian fusion of four kinds of evidence.

For a row and a language l the posterior is proportional to

    p(text | l) ** t  *  p(declared | l)  *  p(suffix | l)  *  p(l | host)

* ``p(text | l)``: hashed byte trigrams, fitted on a bounded sample of the labelled texts
  of every language that occurs, whatever their number and the length of the texts.
  Trigrams are not independent, so a text counts as at most ``MAX_TRIGRAMS`` of them.
* ``p(declared | l)``, ``p(suffix | l)``: how often the markup's ``lang`` and the address
  suffix go with texts of that language; a row without them says nothing.
* ``p(l | host)``: the languages of the host's other rows, smoothed by those of its domain,
  which are smoothed by those of the whole table (Dirichlet, weights ``ALPHA``).

All but the text model come from grouped aggregations over all rows, with the text's own
posterior as a fractional count (in thousandths, so sums do not depend on order).
Declared languages and suffixes keep their whole value in lower case (``zh-hant``, ``xn--p1ai``); a declared
language with a region is smoothed by the language alone.  Tables of values
are broadcast after a look at their bytes, larger ones and those of hosts are joined by a
shuffle, the heavy values (1/1000 of all rows each) by broadcast.

Defined results: rows that repeat are rows of their own (each leaves its own share out of its host's count);
a null text, address or host is empty evidence; a row with no evidence
at all gets the language commonest in the table; without labelled texts the language
is null.  Ties go to the language first in code point order.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast
from .common import LOWER_A, SLICE_BYTES, arrow_map, heavy_join, materialize, slices, string_buffers

BUCKETS = 1 << 15
MAX_TRIGRAMS = 60
SAMPLE_PER_LANG = 500
SMOOTH = 0.1  # count of a bucket that no text of the language has
CELLS = 1 << 20  # rows x languages of one step
ALPHA = 5.0
UNIT = 1000

TAGS = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.IGNORECASE | re.DOTALL)
DECLARED = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3}(?:[-_][A-Za-z0-9]{1,8})*)(?![A-Za-z])""", re.IGNORECASE)


@dataclass(frozen=True)
class TextModel:
    """Natural logarithms of the buckets that a language has (``first``: its part of both arrays), and of any other."""
    languages: tuple[str, ...]
    first: np.ndarray
    buckets: np.ndarray
    logs: np.ndarray
    other: np.ndarray

    def row(self, i: int) -> np.ndarray:
        """Logarithms of all buckets in language ``i``."""
        out = np.full(BUCKETS, self.other[i])
        own = slice(self.first[i], self.first[i + 1])
        out[self.buckets[own]] = self.logs[own]
        return out


def trigram_buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram that starts at each byte, and whether it lies inside its text."""
    n = len(raw)
    low = raw + (((raw - np.uint8(LOWER_A)) < np.uint8(26)).view(np.uint8) << np.uint8(5))
    padded = np.concatenate([low, np.zeros(2, np.uint8)]).astype(np.uint32)
    code = padded[:n] | (padded[1:n + 1] << np.uint32(8)) | (padded[2:n + 2] << np.uint32(16))
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(17)
    inside = np.ones(n, dtype=bool)
    for back in (1, 2):
        ends = offsets[1:] - back
        inside[ends[ends >= offsets[:-1]]] = False
    return bucket, inside


def _count(batches):
    """Trigram buckets of the rows (lang, text) as (lang, bucket, n)."""
    for b in slices(batches, "text"):
        raw, offsets = string_buffers(b.column(1))
        names = b.column(0).dictionary_encode()
        lang = names.indices.to_numpy().astype(np.int64)
        parts = [(raw, offsets)]
        if b.num_rows == 1:  # a long text in pieces; a trigram belongs to the piece it starts in
            parts = [(p, np.array([0, len(p)])) for p in
                     (raw[at:at + SLICE_BYTES + 2] for at in range(0, len(raw), SLICE_BYTES))]
        for part, ends in parts:
            bucket, inside = trigram_buckets(part, ends)
            key, n = np.unique((np.repeat(lang, np.diff(ends)) * BUCKETS + bucket)[inside], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array(key // BUCKETS)), pa.array((key % BUCKETS).astype(np.int32)), pa.array(n)],
                names=["lang", "bucket", "n"])


def fit_text(labelled: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> TextModel:
    """Text model of every language in ``labelled`` (id, text, lang), from about ``sample_per_lang`` texts each.

    The sample is a share of the hash range that fits the language's rows (its least
    hash at least): the same on any partitioning, found and counted where the rows lie.
    """
    rows = labelled.filter("text is not null and lang is not null").select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("id", "text").alias("hash"))
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("least")).collect()
    langs = sorted(r["lang"] for r in known)
    least, top = -(1 << 63), (1 << 63) - 1
    cuts = [(r["lang"], max(r["least"], min(top, least + int(sample_per_lang / r["n"] * (1 << 64))))) for r in known]
    cuts = F.broadcast(labelled.sparkSession.createDataFrame(cuts, "lang string, cut long"))
    picked = rows.join(cuts, "lang").filter("hash <= cut").select("lang", "text")
    counts = (arrow_map(picked, _count, "lang string, bucket int, n long").groupBy("lang", "bucket")
              .agg(F.sum("n").alias("n")).toArrow().sort_by([("lang", "ascending"), ("bucket", "ascending")]))
    names = counts.column(0).combine_chunks().dictionary_encode()
    at = {x: i for i, x in enumerate(langs)}
    lang = np.array([at[x] for x in names.dictionary.to_pylist()], dtype=np.int64)[names.indices.to_numpy()]
    n = counts.column(2).to_numpy() + SMOOTH
    first = np.searchsorted(lang, np.arange(len(langs) + 1))
    whole = np.array([n[a:b].sum() + SMOOTH * (BUCKETS - (b - a)) for a, b in zip(first[:-1], first[1:], strict=True)])
    return TextModel(tuple(langs), first, counts.column(1).to_numpy(),
                     np.log(n / np.repeat(whole, np.diff(first))), np.log(SMOOTH / whole))


def text_weights(raw: np.ndarray, offsets: np.ndarray, model: TextModel) -> np.ndarray:
    """Tempered log-likelihoods (texts x languages); zeros for a text without a trigram."""
    n = len(offsets) - 1
    out = np.zeros((n, len(model.languages)))
    if not len(raw):
        return out
    bucket, inside = trigram_buckets(raw, offsets)
    sums = np.concatenate([[0], np.cumsum(inside)])
    many = sums[offsets[1:]] - sums[offsets[:-1]]
    some = many > 0
    starts = offsets[:-1][some]
    for i in range(len(model.languages)):
        row = model.row(i)
        out[some, i] = np.add.reduceat(np.where(inside, row[bucket], 0.0), starts)
    out[some] *= (np.minimum(many[some], MAX_TRIGRAMS) / many[some])[:, None]
    return out


def posterior(weights: np.ndarray) -> np.ndarray:
    if not weights.shape[1]:
        return weights
    p = np.exp(weights - weights.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def page_text(markup: str) -> str:
    """The text of a page, without scripts, styles, comments and tags."""
    return html.unescape(TAGS.sub(" ", markup))


def _evidence(model: TextModel, markup: bool, n_keys: int):
    step = max(1, CELLS // max(1, len(model.languages)))

    def run(batches):
        for b in (x.slice(at, step) for x in slices(batches, "text") for at in range(0, x.num_rows, step)):
            col = b.column(n_keys)
            declared = [None] * b.num_rows
            if markup:
                pages = [t.decode("utf-8", "replace") for t in col.cast(pa.binary()).to_pylist()]
                declared = [m.group(1).lower().replace("_", "-") if (m := DECLARED.search(p)) else None for p in pages]
                col = pa.array([page_text(p) for p in pages], pa.string())
            weights = text_weights(*string_buffers(col), model)
            mass = np.rint(posterior(weights) * UNIT).astype(np.int64)
            size = np.arange(b.num_rows + 1, dtype=np.int32) * len(model.languages)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n_keys], pa.array(declared, pa.string()),
                 pa.ListArray.from_arrays(pa.array(size), pa.array(weights.ravel())),
                 pa.ListArray.from_arrays(pa.array(size), pa.array(mass.ravel()))],
                names=[*b.schema.names[:n_keys], "declared", "weights", "mass"])
    return run


def text_evidence(rows: DataFrame, model: TextModel, markup: bool) -> DataFrame:
    """``rows`` with the last column, ``text``, replaced by declared, weights and mass."""
    keys = rows.columns[:-1]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return arrow_map(rows.withColumn("text", F.coalesce("text", F.lit(""))), _evidence(model, markup, len(keys)),
                     f"{schema}, declared string, weights array<double>, mass array<bigint>")


def host_of(url: Column) -> Column:
    """Host of an address in lower case; null without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def _value(value: Column) -> Column:
    """A declared language or suffix in lower case; null without one."""
    clean = F.lower(F.trim(value))
    return F.when(clean != "", clean)


def _total(name: str, n: int) -> list[Column]:
    return [F.sum(F.col("mass")[i]).alias(f"{name}{i}") for i in range(n)]


def _array(name: str, n: int) -> Column:
    return F.array(*[F.col(f"{name}{i}") for i in range(n)])


def fuse(evidence: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """``evidence`` (key columns, host, declared, weights, mass) with ``lang`` and ``confidence``."""
    n = len(languages)
    if not n:
        return evidence.withColumns({"lang": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    host = F.coalesce("host", F.lit(""))
    domain = F.when(F.col("host").isNull(), F.lit("")).otherwise(
        F.array_join(F.slice(F.split("host", "\\."), -2, 2), "."))
    rows = materialize(evidence.withColumns({
        "host_key": host, "declared": _value(F.col("declared")),
        "suffix": _value(F.when(F.col("host").contains("."), F.substring_index("host", ".", -1)))}), "evidence")
    hosts = rows.groupBy("host_key").agg(F.first("host", ignorenulls=True).alias("host"), *_total("h", n),
                                         F.count(F.lit(1)).alias("n_rows"))
    hosts = materialize(hosts.withColumn("domain", F.when(F.col("host").isNull() | ~F.col("host").contains("."),
                                                          F.col("host_key")).otherwise(domain)), "hosts")
    domains = hosts.groupBy("domain").agg(*[F.sum(f"h{i}").alias(f"d{i}") for i in range(n)])
    whole = hosts.agg(F.sum("n_rows"), *[F.sum(f"h{i}") for i in range(n)]).first()
    total = whole[0] or 0
    mass = sum(x or 0 for x in whole[1:]) or 1
    base = [((x or 0) + UNIT / n) / (mass + UNIT) for x in whole[1:]]
    common = F.array(*[F.lit(float(x)) for x in base])

    def smoothed(counts: Column, below: Column) -> Column:
        size = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
        return F.zip_with(counts, below, lambda c, p: (c + ALPHA * UNIT * p) / (size + ALPHA * UNIT))
    hosts = hosts.join(domains, "domain").select(
        "host_key", "n_rows", _array("h", n).alias("host_mass"),
        smoothed(_array("d", n), common).alias("domain_prior"))

    def table(column: str) -> DataFrame:
        """log p(value | l) and the number of rows of every value."""
        counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(*_total("c", n), F.count(F.lit(1)).alias("n_rows"))
        counts = materialize(counts.withColumn("plain", F.substring_index(column, "-", 1) if column == "declared"
                                               else F.col(column)), "values")
        # Of plain values (a region left off); all values of a row fall on one of them.
        plain = counts.groupBy("plain").agg(*[F.sum(f"c{i}").alias(f"p{i}") for i in range(n)])
        sums = plain.agg(*[F.sum(f"p{i}") for i in range(n)], F.count(F.lit(1))).first()
        kinds, logs = sums[n] + 1, []
        for i in range(n):
            mass = float(sums[i] or 0)
            below = (F.col(f"p{i}") + UNIT) / F.lit(mass + UNIT * kinds)
            own = (F.col(f"c{i}") + ALPHA * UNIT * below) / F.lit(mass + ALPHA * UNIT)
            logs.append(F.log(F.when(F.col(column) == F.col("plain"), below).otherwise(own)))
        return counts.join(plain, "plain").select(column, "n_rows", F.array(*logs).alias(f"{column}_log"))

    def with_logs(left: DataFrame, column: str) -> DataFrame:
        values, small = checked_broadcast(table(column))
        if small:
            return left.join(values.drop("n_rows"), column, "left")
        none = left.filter(F.col(column).isNull()).withColumn(f"{column}_log", F.lit(None).cast("array<double>"))
        found = heavy_join(left.filter(F.col(column).isNotNull()), values.withColumnRenamed("n_rows", "__rows"), column,
                           "__rows", total).drop("__rows")
        return found.unionByName(none)
    joined = heavy_join(rows, hosts, "host_key", "n_rows", total).drop("n_rows")
    for column in ("declared", "suffix"):
        joined = with_logs(joined, column)
    # The row's own share leaves its host's count.
    others = F.zip_with("host_mass", "mass", lambda a, b: F.greatest(a - b, F.lit(0)))
    nothing = F.array_repeat(F.lit(0.0), n)
    parts = [F.col("weights"), F.transform(smoothed(others, F.col("domain_prior")), lambda x: F.log(x)),
             *[F.coalesce(f"{c}_log", nothing) for c in ("declared", "suffix")]]
    score = parts[0]
    for p in parts[1:]:
        score = F.zip_with(score, p, lambda a, b: a + b)
    top = F.array_max("score")
    names = F.array(*[F.lit(x) for x in languages])
    best = F.array_position("score", top).cast("int")
    rest = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return joined.withColumn("score", score).withColumns(
        {"lang": F.element_at(names, best), "confidence": F.lit(1.0) / rest})

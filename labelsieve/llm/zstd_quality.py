"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A text is cut into chunks of ``CHUNK`` bytes and every chunk is compressed twice,
with a dictionary trained on good and on bad labelled text.  The normalised
difference of the summed sizes, ``(bad - good) / (bad + good)``, is turned into a
probability by a logistic calibration that also sees how far the text compresses
at all (endless repeats compress well with either dictionary).

Bounds: the dictionaries and the calibration are fitted on at most
``sample_per_class`` labelled rows a class (the first by a hash of the id) and
``sample_bytes`` bytes of them, half for the dictionaries and half for the
calibration; of a text over ``max_chars`` characters a run of so many, from a place chosen by
the hash.  Scoring covers every row and every byte of its text, in tasks; no
shuffle.

Defined results: a null text is empty; rows that repeat are scored each, and an id counts once in the
fit; an empty table gives an empty table; an empty text has no chunk and gets the
calibrated score of equal sizes; without labels of both classes every score is the
smoothed share of label 1 (0.5 without any).  Labels other than 0/1, null labels
and ids with contradicting labels are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, docs_of, hash_sample

CHUNK = 1024
LEVEL = 3
DICT_BYTES = 32768
SAMPLE_PER_CLASS = 2000
MAX_CHARS = 50_000
# Bytes of a class that reach the driver (a text at least).
SAMPLE_BYTES = 48 << 20
# Ratios from here on say nothing about quality (short texts do not compress).
PLAIN_RATIO = 0.3


@dataclass(frozen=True)
class Model:
    """Raw dictionary bytes (empty: class unseen) and the calibration weights."""

    good: bytes
    bad: bytes
    weights: tuple[float, float, float]


def _train_dictionary(texts: list[bytes]) -> bytes:
    chunks = [t[i:i + CHUNK] for t in texts for i in range(0, len(t), CHUNK)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, chunks).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves as a dictionary
        return b"".join(chunks)[-DICT_BYTES:]


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    trained = raw[:4] == b"\x37\xa4\x30\xec"
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    d = zstandard.ZstdCompressionDict(raw, dict_type=kind)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def sizes(texts, good, bad) -> np.ndarray:
    """Rows of (raw bytes, bytes with the good dictionary, bytes with the bad one)."""
    out = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        view = memoryview(text)
        for at in range(0, len(view), CHUNK):
            part = view[at:at + CHUNK]
            out[i, 1] += len(good.compress(part))
            out[i, 2] += len(bad.compress(part))
        out[i, 0] = len(view)
    return out


def features(size: np.ndarray) -> np.ndarray:
    raw, good, bad = size.T
    total = good + bad
    diff = np.divide(bad - good, total, out=np.zeros(len(size)), where=total > 0)
    ratio = np.divide(total / 2, raw, out=np.ones(len(size)), where=raw > 0)
    return np.column_stack([10 * diff, np.minimum(0, np.log(np.maximum(ratio, 1e-6) / PLAIN_RATIO)),
                            np.ones(len(size))])


def probability(x: np.ndarray, weights) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ np.asarray(weights), -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    w, ridge = np.zeros(x.shape[1]), 1e-2
    for _ in range(30):
        p = probability(x, w)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.linalg.solve(hess, x.T @ (y - p) - ridge * w)
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS,
        max_chars: int = MAX_CHARS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Learn from ``labels`` (doc_id, label 0/1) and the texts of ``docs`` (doc_id, text)."""
    known = (labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("__other"))
             .filter("label = __other").drop("__other"))
    many = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = None
    for label in (0, 1):
        part = hash_sample(known.filter(F.col("label") == label), "doc_id", many.get(label, 0), sample_per_class)
        picked = part if picked is None else picked.unionByName(part)
    # At most 2 * sample_per_class ids: safe to broadcast.
    begin = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - max_chars, F.lit(0)) + 1).cast("int")
    part = F.when(F.length("text") <= max_chars, F.col("text")).otherwise(F.substr("text", begin + 1, F.lit(max_chars)))
    rows = (docs.join(F.broadcast(picked), "doc_id").select("doc_id", "label", part.alias("text"))
            .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("text").alias("text")).orderBy(*order))
    by: dict[int, list[bytes]] = {0: [], 1: []}
    used = {0: 0, 1: 0}
    for r in rows.toLocalIterator():  # in the order of the hash, until a class has its bytes
        text, c = r["text"].encode("utf-8"), r["label"]
        if not by[c] or used[c] + len(text) <= sample_bytes:
            by[c].append(text)
            used[c] += len(text)
    if not by[0] or not by[1]:
        share = (len(by[1]) + 1) / (len(by[0]) + len(by[1]) + 2)
        return Model(b"", b"", (0.0, 0.0, float(np.log(share / (1 - share)))))
    half = {c: (len(v) + 1) // 2 for c, v in by.items()}
    good, bad = (_train_dictionary(by[c][:half[c]]) for c in (1, 0))
    if not good or not bad:  # only empty texts in a class
        return Model(b"", b"", (0.0, 0.0, 0.0))
    held = {c: v[half[c]:] or v for c, v in by.items()}
    x = features(sizes(held[0] + held[1], _compressor(good), _compressor(bad)))
    y = np.repeat([0.0, 1.0], [len(held[0]), len(held[1])])
    return Model(good, bad, calibrate(x, y))


def _scorer(model: Model):
    if not model.good or not model.bad:
        return lambda texts: probability(np.tile([0.0, 0.0, 1.0], (len(texts), 1)), model.weights)
    good, bad = _compressor(model.good), _compressor(model.bad)
    return lambda texts: probability(features(sizes(texts, good, bad)), model.weights)


def _texts(col: pa.Array) -> list[bytes]:
    return pc.fill_null(col, "").cast(pa.binary()).to_pylist()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row of ``docs`` (doc_id, text)."""
    def run(batches):
        scorer = _scorer(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scorer(_texts(b.column(1))), pa.float64())],
                                             names=["doc_id", "score"])
    return arrow_map(docs_of(docs), run, "doc_id long, score double")


def keep_good(df: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` (all its columns) whose text scores at least ``threshold``."""
    at = df.columns.index(text_col)

    def run(batches):
        scorer = _scorer(model)
        for b in batches:
            yield b.filter(pa.array(scorer(_texts(b.column(at))) >= threshold))
    return arrow_map(df, run, df.schema)


def training_labels(labels: DataFrame, folds: int, held: int = 0) -> DataFrame:
    """``(doc_id, label)`` of the rows outside the held-out fold."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
            .filter(F.crc32(F.col("doc_id").cast("string")) % folds != held))

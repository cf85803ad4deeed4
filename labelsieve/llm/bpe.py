"""Byte-level BPE with the tiktoken library and a local rank file.

The driver reads the rank file (fixed size, under 1 MB) and broadcasts it; a worker
builds one encoder and keeps it.  A text longer than ``PIECE_CHARS`` is cut at safe
boundaries, places where no match of the split pattern can reach across, so its ids
are those of the whole text and memory stays bounded by the piece:

* after a letter, digit or other visible ASCII character before a space or newline
  (white space only ever starts a match, or is matched alone);
* between an ASCII letter and a digit, either way.

A text without such a place is one piece.  Decoding joins the raw bytes of the ids.
No special token is ever produced; no shuffle.

Defined results: a null text is empty; the empty text has no ids and decodes to
nothing; bytes that are not UTF-8 count as U+FFFD.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, docs_of, slices

PIECE_CHARS = 1 << 16
# Ids handled at a time when digests are made.
DIGEST_IDS = 1 << 16
BOUNDARY = regex.compile(r"(?<=[\p{L}\p{N}!-~])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_ENCODERS: dict[str, tuple[tiktoken.Encoding, list[str]]] = {}


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoder(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, list[str]]:
    """The encoder of this worker process and the decimal text of every id."""
    name = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if name not in _ENCODERS:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        enc = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=table, special_tokens={})
        _ENCODERS[name] = enc, [str(i) for i in range(max(table.values(), default=0) + 1)]
    return _ENCODERS[name]


def pieces(text: str, size: int = PIECE_CHARS):
    """``text`` cut at safe boundaries into pieces of about ``size`` characters."""
    at = 0
    while len(text) - at > size:
        m = BOUNDARY.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:] if at else text


def encode_text(enc: tiktoken.Encoding, text: str, size: int = PIECE_CHARS) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for p in pieces(text, size):
        ids += enc.encode_ordinary(p)
    return ids


def texts_of(col: pa.Array) -> list[str]:
    return [b"" if t is None else t for t in col.cast(pa.binary()).to_pylist()]


def _decoded(raw: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "replace") for t in raw]


def encode(docs: DataFrame, ranks: bytes, pattern: str, text_col: str = "text",
           out_col: str = "ids") -> DataFrame:
    """``docs`` without its text column, with the ids (array<int>) as ``out_col``."""
    keep = [c for c in docs.columns if c not in (text_col, out_col)]
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(text_col, F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        enc, _ = encoder(shared.value, pattern)
        for b in slices(batches, "text"):
            ids = [encode_text(enc, t) for t in _decoded(texts_of(b.column(b.num_columns - 1)))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*keep, out_col])
    schema = source.select(*[F.col(f"`{c}`") for c in keep], F.lit(None).cast("array<int>").alias(out_col)).schema
    return arrow_map(source, run, schema)


def decode(rows: DataFrame, ranks: bytes, pattern: str, ids_col: str = "ids", out_col: str = "bytes") -> DataFrame:
    """``rows`` with ``ids_col`` replaced by the raw bytes it stands for."""
    keep = [c for c in rows.columns if c not in (ids_col, out_col)]
    empty = F.array().cast("array<int>")
    source = rows.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(ids_col, empty).alias(ids_col))
    shared = rows.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        enc, _ = encoder(shared.value, pattern)
        for b in batches:
            raw = [enc.decode_bytes(ids) for ids in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(raw, pa.binary())], names=[*keep, out_col])
    schema = source.select(*[F.col(f"`{c}`") for c in keep], F.lit(None).cast("binary").alias(out_col)).schema
    return arrow_map(source, run, schema)


def digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encodes and decodes piece by piece.

    The same pieces as ``encode``, without keeping a long text's ids in memory.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def one(enc, names, text):
        ids_sha, raw_sha, n = hashlib.sha256(), hashlib.sha256(), 0
        for p in pieces(text):
            ids = enc.encode_ordinary(p)
            for i in range(0, len(ids), DIGEST_IDS):
                part = ids[i:i + DIGEST_IDS]
                ids_sha.update((" " if n else "").encode() + " ".join(map(names.__getitem__, part)).encode())
                raw_sha.update(enc.decode_bytes(part))
                n += len(part)
        return n, ids_sha.hexdigest(), raw_sha.hexdigest()

    def run(batches):
        enc, names = encoder(shared.value, pattern)
        for b in slices(batches, "text"):
            rows = [one(enc, names, t) for t in _decoded(texts_of(b.column(1)))]
            n, ids, raw = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return arrow_map(docs_of(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

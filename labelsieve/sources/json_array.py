"""A1: one large JSON array of objects, read by many tasks.

Spark reads a JSON array file in one task, since a byte range by itself does not tell
whether it starts inside a string or how deep it is nested.  Here two passes over
byte ranges find out:

1. ``borders``: every range reports whether it holds an odd number of quotes, and by
   how much it changes the nesting depth if it starts outside a string and if it starts
   inside one.  Adding these up (a row per range, on the driver) gives the state at the start of each.
2. ``records``: every range yields the objects of the array that start in it, with their
   byte offset; the last one is read on beyond the end of the range.

Both are a Python data source (``json_array``), so Spark plans a task per range.  The rows
and their positions are the same whatever the ranges.  A file that is no array of objects, that
ends too early, or that has anything else between the objects, raises.

The files are opened with ``pyarrow.fs`` (local and mounted paths, HDFS, S3 and others).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship_package

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
# Bytes of records in a batch.
BATCH_BYTES = 8 << 20
QUOTE, BACKSLASH = ord('"'), ord("\\")
OPENING, CLOSING, ENDS = b"{[", b"}]", b"{}[]"
BETWEEN = b" \t\r\n,[]"


def open_file(path: str):
    """``(file, size)`` of a path or address."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    store, name = pyarrow.fs.FileSystem.from_uri(path)
    info = store.get_file_info(name)
    if info.type != pyarrow.fs.FileType.File:
        raise FileNotFoundError(f"no file at {path}")
    return store.open_input_file(name), info.size


class Scanner:
    """Brackets outside of strings, block by block, from a known or assumed state."""

    def __init__(self, file, size: int, start: int):
        self.file, self.size, self.at = file, size, start
        self.run = self._backslashes(start)
        self.quotes = 0  # parity of the unescaped quotes so far

    def _backslashes(self, start: int) -> int:
        """Backslashes right before ``start``."""
        run = 0
        while start - run > 0:
            n = min(1 << 10, start - run)
            before = self.file.read_at(n, start - run - n)
            kept = len(before.rstrip(b"\\"))
            run += n - kept
            if kept:
                break
        return run

    def block(self, n: int):
        """The next block: its bytes, the places of its brackets and the parity of quotes before each."""
        raw = self.file.read_at(min(n, self.size - self.at), self.at)
        self.at += len(raw)
        data = np.frombuffer(raw, dtype=np.uint8)
        quotes = np.flatnonzero(data == QUOTE)
        slashes = data == BACKSLASH
        if slashes.any() or self.run:
            # A quote is escaped behind an odd run of backslashes.
            places = np.arange(len(data))
            last_other = np.maximum.accumulate(np.where(slashes, -1 - self.run, places))
            before = np.where(quotes > 0, last_other[quotes - 1], -1 - self.run)
            quotes = quotes[(quotes - 1 - before) % 2 == 0]
            self.run = int(len(data) - 1 - last_other[-1]) if len(data) else self.run
        brackets = np.flatnonzero(np.isin(data, np.frombuffer(ENDS, np.uint8)))
        parity = (np.searchsorted(quotes, brackets) + self.quotes) % 2
        self.quotes = (self.quotes + len(quotes)) % 2
        return raw, data, brackets, parity


def _signs(chars: np.ndarray) -> np.ndarray:
    return np.where((chars == OPENING[0]) | (chars == OPENING[1]), 1, -1)


def borders(path: str, start: int, end: int) -> tuple[int, int, int]:
    """``(odd quotes, change of depth from outside, from inside)`` of a byte range."""
    file, size = open_file(path)
    with file:
        scan, delta = Scanner(file, size, start), [0, 0]
        while scan.at < end:
            _, data, brackets, parity = scan.block(min(BLOCK_BYTES, end - scan.at))
            signs = _signs(data[brackets])
            delta[0] += int(signs[parity == 0].sum())
            delta[1] += int(signs[parity == 1].sum())
        return scan.quotes, delta[0], delta[1]


def records(path: str, start: int, end: int, inside: bool, depth: int) -> Iterator[tuple[int, bytes]]:
    """``(offset, bytes)`` of the array's objects that start in a byte range of known state."""
    file, size = open_file(path)
    with file:
        scan, begun, parts, clean = Scanner(file, size, start), None, [], start
        scan.quotes = int(inside)
        own = depth <= 1 and not inside  # whether ``clean`` on lies between records
        while scan.at < end or (begun is not None and scan.at < size):
            at = scan.at
            raw, data, brackets, parity = scan.block(BLOCK_BYTES if at >= end else min(BLOCK_BYTES, end - at))
            brackets = brackets[parity == 0]
            chars = data[brackets]
            signs = _signs(chars)
            after = depth + np.cumsum(signs)
            if len(after) and after.min() < 0 or depth == 0 and len(chars) and chars[0] != ord("["):
                raise ValueError(f"{path}: no array of objects at byte {at}")
            starts = brackets[(signs > 0) & (after == 2)]
            stops = brackets[(signs < 0) & (after == 1)]
            depth = int(after[-1]) if len(after) else depth
            i = j = 0
            if begun is not None or not own:  # the first stop ends a record that was begun before
                if len(stops):
                    if begun is not None:
                        parts.append(raw[:stops[0] + 1])
                        yield begun, b"".join(parts)
                    clean, begun, parts, own, j = at + int(stops[0]) + 1, None, [], True, 1
                elif begun is not None:
                    parts.append(raw)
            while i < len(starts) and at + starts[i] < end:
                _only_commas(path, raw[max(clean - at, 0):starts[i]], clean)
                if chars[np.searchsorted(brackets, starts[i])] != ord("{"):
                    raise ValueError(f"{path}: an array inside the array at byte {at + int(starts[i])}")
                begun = at + int(starts[i])
                if j == len(stops):
                    parts = [raw[starts[i]:]]
                    break
                yield begun, raw[starts[i]:stops[j] + 1]
                begun, clean = None, at + int(stops[j]) + 1
                i, j = i + 1, j + 1
            if begun is None and own:
                _only_commas(path, raw[max(clean - at, 0):max(min(end, scan.at) - at, 0)], clean)
                clean = scan.at
        if begun is not None:
            raise ValueError(f"{path}: the file ends inside the record at byte {begun}")


def _only_commas(path: str, gap: bytes, at: int) -> None:
    if gap.removeprefix(b"\xef\xbb\xbf").strip(BETWEEN):
        raise ValueError(f"{path}: something else than objects behind byte {at}")


class ByteRange(InputPartition):
    def __init__(self, start: int, end: int, inside: bool = False, depth: int = 0):
        self.start, self.end, self.inside, self.depth = start, end, inside, depth


class JsonArraySource(DataSource):
    """``json_array``: options ``path``, ``rangeBytes`` (pass 1) or ``states`` (pass 2: JSON list of range states)."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        if "states" in self.options:
            return "position long, record string"
        return "start long, stop long, odd int, outside long, inside long"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return JsonArrayReader(dict(self.options))


class JsonArrayReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.states = json.loads(options["states"]) if "states" in options else None
        self.range_bytes = int(options.get("rangebytes", options.get("rangeBytes", RANGE_BYTES)))

    def partitions(self) -> list[ByteRange]:
        if self.states is not None:
            return [ByteRange(*s) for s in self.states]
        file, size = open_file(self.path)
        file.close()
        return [ByteRange(a, min(a + self.range_bytes, size)) for a in range(0, size, self.range_bytes)] or [ByteRange(0, 0)]

    def read(self, part: ByteRange):
        if self.states is None:
            yield (part.start, part.end, *borders(self.path, part.start, part.end))
            return
        at, texts, size = [], [], 0
        for position, raw in records(self.path, part.start, part.end, part.inside, part.depth):
            at.append(position)
            texts.append(raw.decode())
            size += len(raw)
            if size >= BATCH_BYTES:
                yield _batch(at, texts)
                at, texts, size = [], [], 0
        if at:
            yield _batch(at, texts)


def _batch(at: list[int], texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(texts, pa.string())], names=["position", "record"])


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The objects of a JSON array file as rows of ``schema`` with ``position``, their byte offset in the file."""
    ship_package(spark)
    spark.dataSource.register(JsonArraySource)
    source = spark.read.format("json_array").option("path", path)
    states, inside, depth = [], False, 0
    for r in sorted(source.option("rangeBytes", str(range_bytes)).load().collect()):
        states.append((r["start"], r["stop"], inside, depth))
        depth += r["inside"] if inside else r["outside"]
        inside ^= bool(r["odd"])
    if inside or depth:
        raise ValueError(f"{path}: the file ends inside a record or string")
    rows = spark.read.format("json_array").option("path", path).option("states", json.dumps(states)).load()
    parsed = rows.select(F.from_json("record", schema, {"mode": "FAILFAST"}).alias("r"), "position")
    return parsed.select("r.*", "position")

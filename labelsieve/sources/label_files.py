"""One text object per labelled frame, written by tasks, with a listing that commits them.

``label_files`` is a Python data source that writes rows ``(frame_id, text)``.  A task
puts each text under ``<folder>/<frame_id>.txt`` (a temporary object moved into place,
or one put where the store publishes an object when it is closed), so a retried task writes the
same objects again and no reader sees half of one.  With its last row it writes a Parquet
listing ``(frame_id, n_bytes, md5)``; the driver commits by writing ``_committed.json``,
which names the listings of the successful attempts.  Objects of an earlier run or of a failed
attempt that no listing names do not count.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..session import ship_package

LISTING = pa.schema([("frame_id", pa.string()), ("n_bytes", pa.int64()), ("md5", pa.string())])
EXTENSION = ".txt"
COMMIT, LISTINGS, PARTIAL = "_committed.json", "_listing", "_partial"
# Rows of a listing that a task holds before it writes them.
LISTING_ROWS = 100_000


def store_of(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and name of a path or address."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return pyarrow.fs.FileSystem.from_uri(path)


def put(store: pyarrow.fs.FileSystem, name: str, data: bytes) -> None:
    """Write an object whole or not at all."""
    if store.type_name not in ("local", "hdfs"):  # an object store publishes on close
        with store.open_output_stream(name) as out:
            out.write(data)
        return
    folder, base = os.path.split(name)
    partial = f"{folder}/{PARTIAL}-{uuid.uuid4().hex}-{base}"
    with store.open_output_stream(partial) as out:
        out.write(data)
    store.move(partial, name)


def object_name(folder: str, frame_id: str | None) -> str:
    if not frame_id or "/" in frame_id or frame_id.startswith("_"):
        raise ValueError(f"no frame id that can name a file: {frame_id!r}")
    return f"{folder}/{frame_id}{EXTENSION}"


@dataclass
class Written(WriterCommitMessage):
    listings: list[str]
    n_files: int
    n_bytes: int


class LabelFiles(DataSource):
    """``label_files``: the option ``path`` is the folder."""

    @classmethod
    def name(cls) -> str:
        return "label_files"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if [f.name for f in schema.fields] != ["frame_id", "text"]:
            raise ValueError("label files are written from rows (frame_id, text)")
        return LabelFileWriter(self.options["path"])


class LabelFileWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = store_of(self.folder)
        store.create_dir(f"{folder}/{LISTINGS}", recursive=True)
        done, rows, n_files, n_bytes = [], [], 0, 0
        for batch in iterator:
            for frame_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = (text or "").encode()
                put(store, object_name(folder, frame_id), data)
                rows.append((frame_id, len(data), hashlib.md5(data).hexdigest()))
                n_files, n_bytes = n_files + 1, n_bytes + len(data)
                if len(rows) >= LISTING_ROWS:
                    done.append(self._listing(store, folder, rows))
                    rows = []
        if rows:
            done.append(self._listing(store, folder, rows))
        return Written(done, n_files, n_bytes)

    @staticmethod
    def _listing(store, folder: str, rows: list[tuple]) -> str:
        name = f"{LISTINGS}/{uuid.uuid4().hex}.parquet"
        table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), LISTING.types, strict=True)], schema=LISTING)
        out = pa.BufferOutputStream()
        pyarrow.parquet.write_table(table, out)
        put(store, f"{folder}/{name}", out.getvalue().to_pybytes())
        return name

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = store_of(self.folder)
        store.create_dir(folder, recursive=True)
        done = [m for m in messages if m is not None]
        record = {"listings": sorted(x for m in done for x in m.listings), "n_files": sum(m.n_files for m in done),
                  "n_bytes": sum(m.n_bytes for m in done)}
        put(store, f"{folder}/{COMMIT}", json.dumps(record).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Listings of tasks that went well in a job that did not; the objects are written again by the next run."""
        store, folder = store_of(self.folder)
        for m in messages:
            for name in m.listings if m is not None else ():
                store.delete_file(f"{folder}/{name}")


def write_label_files(texts: DataFrame, folder: str) -> dict:
    """Write ``texts`` (frame_id, text), a row per frame; returns the commit record."""
    spark = texts.sparkSession
    ship_package(spark)
    spark.dataSource.register(LabelFiles)
    texts.select("frame_id", "text").write.format("label_files").mode("append").save(folder)
    return _record(folder)


def _record(folder: str) -> dict:
    store, name = store_of(folder)
    with store.open_input_file(f"{name}/{COMMIT}") as file:
        return json.loads(file.read())


def committed(spark: SparkSession, folder: str) -> DataFrame:
    """The listing ``(frame_id, n_bytes, md5)`` of the files that count."""
    names = _record(folder)["listings"]
    if not names:
        return spark.createDataFrame([], "frame_id string, n_bytes long, md5 string")
    return spark.read.schema("frame_id string, n_bytes long, md5 string").parquet(*[f"{folder}/{n}" for n in names])


def read_label_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(frame_id, text)`` of the committed files, read by tasks; a file that was changed since raises."""
    ship_package(spark)

    def read(batches):
        store, name = store_of(folder)
        for b in batches:
            texts = []
            for frame_id, md5 in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_input_file(object_name(name, frame_id)) as file:
                    data = file.read()
                if hashlib.md5(data).hexdigest() != md5:
                    raise ValueError(f"the label file of {frame_id} was changed since it was committed")
                texts.append(data.decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["frame_id", "text"])
    rows = committed(spark, folder).select("frame_id", F.col("md5"))
    tasks = max(1, spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, "frame_id").mapInArrow(read, "frame_id string, text string")

"""A3: image listing by tasks.

``file_names`` is a Python data source with a task per name prefix: each goes through the folder
entry by entry and yields the names that start with its prefix, so no list of files is
held anywhere, least of all by the driver.  One more task has the names that start with none
of the prefixes, so every file is listed once whatever prefixes are given.  Local and mounted
folders are walked entry by entry; other stores are listed by ``pyarrow.fs`` inside the task.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship_package
from .label_files import store_of

BATCH_ROWS = 20_000


def distinct_prefixes(prefixes) -> list[str]:
    """Prefixes of which none starts with another."""
    kept: list[str] = []
    for p in sorted(set(prefixes) - {""}):
        if not kept or not p.startswith(kept[-1]):
            kept.append(p)
    return kept


def names_in(folder: str) -> Iterator[str]:
    """Names of the files (not folders) in ``folder``."""
    store, path = store_of(folder)
    if isinstance(store, pyarrow.fs.LocalFileSystem):
        with os.scandir(path) as entries:
            for e in entries:
                if e.is_file():
                    yield e.name
        return
    for info in store.get_file_info(pyarrow.fs.FileSelector(path)):
        if info.type == pyarrow.fs.FileType.File:
            yield info.base_name


class NamePrefix(InputPartition):
    def __init__(self, prefix: str | None):
        self.prefix = prefix  # None: names that start with none of them


class FileNames(DataSource):
    """``file_names``: options ``path`` (a folder), ``prefixes`` (JSON list), ``extension``."""

    @classmethod
    def name(cls) -> str:
        return "file_names"

    def schema(self) -> str:
        return "name string"

    def reader(self, schema) -> DataSourceReader:
        return FileNameReader(dict(self.options))


class FileNameReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.prefixes = distinct_prefixes(json.loads(options.get("prefixes", "[]")))
        self.ending = "." + options["extension"]

    def partitions(self) -> list[NamePrefix]:
        return [*[NamePrefix(p) for p in self.prefixes], NamePrefix(None)]

    def read(self, part: NamePrefix) -> Iterator[pa.RecordBatch]:
        others = tuple(self.prefixes)
        held: list[str] = []
        for name in names_in(self.folder):
            if not name.endswith(self.ending) or name.startswith((".", "_")):
                continue
            mine = name.startswith(part.prefix) if part.prefix is not None else not name.startswith(others)
            if mine:
                held.append(name)
            if len(held) == BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(held)], names=["name"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held)], names=["name"])


def image_files(spark: SparkSession, directory: str, source_set: str, extension: str = "jpg",
                prefixes=()) -> DataFrame:
    """``(frame_id, path, source_set)`` of the ``*.<extension>`` files of a folder (not of its sub-folders)."""
    ship_package(spark)
    spark.dataSource.register(FileNames)
    names = (spark.read.format("file_names").option("path", directory).option("prefixes", json.dumps(list(prefixes)))
             .option("extension", extension).load())
    stem = F.substring("name", 1, F.length("name") - F.lit(len(extension) + 1))
    return names.select(stem.alias("frame_id"), F.concat(F.lit(directory.rstrip("/") + "/"), F.col("name")).alias("path"),
                        F.lit(source_set).alias("source_set"))

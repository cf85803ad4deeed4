"""A ledger of stages, so that a run does only what is not done yet.

A stage's record (``_ledger/<stage>.json``, put in place whole after the stage has finished)
holds fingerprints of its inputs and parameters, of the tables it wrote, and its counters.  A
stage is skipped when all of them are as recorded.  Otherwise it runs again (``on_change="rerun"``:
the tables it recorded are removed first) or the run refuses (``on_change="refuse"``).  A stage
without a record takes up what an interrupted run left (inference resumes by shards).

Fingerprints are counts and two 64-bit hash sums, computed by Spark: of a table given as a
DataFrame over its rows, of a path over the names, sizes and times of its files.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import path_exists
from ..sources.label_files import put, store_of

FOLDER = "_ledger"


def _digest(df: DataFrame, columns: list[Column]) -> str:
    def total(seed: int) -> Column:
        return F.coalesce(F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return df.agg(F.concat_ws(":", F.count(F.lit(1)), total(0), total(1))).first()[0]


def fingerprint(spark: SparkSession, source) -> str:
    """Fingerprint of a DataFrame's rows, of the files at a path, or of a list of either (in order)."""
    if isinstance(source, DataFrame):
        plain = [F.col(f"`{c}`") if not t.startswith("map") else F.to_json(F.col(f"`{c}`")) for c, t in sorted(source.dtypes)]
        return "rows:" + _digest(source, plain)
    if isinstance(source, (list, tuple)):
        return "[" + ",".join(fingerprint(spark, s) for s in source) + "]"
    if not path_exists(spark, source):
        return "none"
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
             .select("path", "length", "modificationTime"))
    return "files:" + _digest(found, [F.col(c) for c in found.columns])


class Ledger:
    def __init__(self, spark: SparkSession, root: str, on_change: str = "rerun"):
        if on_change not in ("rerun", "refuse"):
            raise ValueError("on_change must be 'rerun' or 'refuse'")
        self.spark, self.root, self.on_change = spark, root, on_change
        self.ran: list[str] = []

    def _path(self, stage: str) -> str:
        return os.path.join(self.root, FOLDER, f"{stage}.json")

    def record(self, stage: str) -> dict | None:
        store, name = store_of(self._path(stage))
        if not path_exists(self.spark, self._path(stage)):
            return None
        with store.open_input_file(name) as file:
            return json.loads(file.read())

    def run(self, stage: str, inputs: dict, outputs: list[str], params: dict, work: Callable[[], dict | None]) -> dict | None:
        """Run ``work`` unless it is done; returns its counters (a JSON object), recorded or new.

        ``inputs``: name -> DataFrame, path or list of them; ``outputs``: paths below the root.
        """
        key = {"params": json.loads(json.dumps(params, sort_keys=True)),
               "inputs": {n: fingerprint(self.spark, s) for n, s in inputs.items()}}
        places = [os.path.join(self.root, o) for o in outputs]
        old = self.record(stage)
        if old is not None:
            changed = [part for part in ("params", "inputs") if old[part] != key[part]]
            if not changed and old["outputs"] == {o: fingerprint(self.spark, p) for o, p in zip(outputs, places, strict=True)}:
                return old["result"]
            if self.on_change == "refuse":
                raise ValueError(f"stage {stage} was run with other {' and '.join(changed) or 'tables'}: "
                                 f"{ {p: old[p] for p in changed} } before, {({p: key[p] for p in changed})} now")
            for o in old["outputs"]:  # its own tables only
                self._remove(os.path.join(self.root, o))
            self._remove(self._path(stage))
        result = work()
        done = {**key, "outputs": {o: fingerprint(self.spark, p) for o, p in zip(outputs, places, strict=True)}, "result": result}
        store, name = store_of(self._path(stage))
        store.create_dir(os.path.dirname(name), recursive=True)
        put(store, name, json.dumps(done, sort_keys=True).encode())
        self.ran.append(stage)
        return result

    def _remove(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

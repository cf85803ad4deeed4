"""Session construction and the two materialisation helpers every stage uses.

* ``materialize`` cuts lineage with a reliable ``checkpoint()`` into the shared
  folder named by ``spark.checkpoint.dir``.  A private folder is only created
  when the setting is absent *and* the master is local (tests, laptop runs).
* ``checked_broadcast`` broadcasts a table only after looking at the bytes of its rows, so a
  side whose size grows with the data falls back to a shuffle join (with AQE skew
  splitting) instead of blowing up executor memory.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest size of a table's rows in memory to be broadcast by ``checked_broadcast``.
DEFAULT_BROADCAST_BYTES = 32 << 20
# Bytes of a row, and of a value or reference in it, besides its contents.
ROW_BYTES, VALUE_BYTES = 32, 8


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "labelsieve", extra: dict | None = None) -> SparkSession:
    """Session with AQE and skew-join splitting on, UI off, UTC clock."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this session.

    Uses the folder already set on the context, else ``spark.checkpoint.dir``.
    Only a local-mode session without either gets a fresh private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="labelsieve-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under this application's table folder, removed when the application ends."""
    root = os.path.join(checkpoint_dir(spark), "tables", spark.sparkContext.applicationId)
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_remove, spark.sparkContext, root)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


_ROOTS: set[str] = set()


def _remove(sc, root: str) -> None:
    try:
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(sc._jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # noqa: BLE001  the JVM is already gone at exit
        pass


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as a Parquet table under the checkpoint folder and read it back.

    Used wherever a result is read twice and must not be recomputed (global
    positions, ranks joined back on values, scored detections).  Unlike an
    eager RDD checkpoint, this computes ``df`` once, and the re-read gets
    column pruning and filter pushdown.  The table survives executor loss and
    is removed when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def memory_bytes(column: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes in memory, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(VALUE_BYTES) + F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, T.StructType):
        return sum((memory_bytes(column[f.name], f.dataType) for f in kind.fields), F.lit(VALUE_BYTES))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            return F.lit(VALUE_BYTES) + F.greatest(F.coalesce(F.size(column), F.lit(0)), F.lit(0)) * VALUE_BYTES
        inner = F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + memory_bytes(x, kind.elementType).cast("long"))
        return F.lit(VALUE_BYTES) + F.coalesce(inner, F.lit(0))
    if isinstance(kind, T.MapType):
        return memory_bytes(F.map_keys(column), T.ArrayType(kind.keyType)) + memory_bytes(
            F.map_values(column), T.ArrayType(kind.valueType))
    return F.lit(VALUE_BYTES)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers then import it wherever the driver was started from.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="labelsieve-zip-")
    target = os.path.join(folder, "labelsieve.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for at, dirs, names in os.walk(root):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    out.write(full, os.path.join("labelsieve", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialise an aggregated table and broadcast it if its rows are small.

    Returns ``(table, broadcast?)``.  The rows are measured while they are written, as
    they will stand in memory (files may be many times smaller: sorted ids, repeated
    values), so the table is computed once and not counted; a larger one
    stays a shuffle join, which adaptive execution splits where a key is hot.
    """
    seen = Observation()
    row = sum((memory_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(ROW_BYTES))
    table = materialize(df.observe(seen, F.sum(row.cast("long")).alias("bytes")))
    if (seen.get["bytes"] or 0) <= max_bytes:
        return F.broadcast(table), True
    return table, False


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

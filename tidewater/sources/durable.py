"""Shared-folder scratch space and durable intermediate tables.

Everything lives below ``spark.checkpoint.dir``. Only a local session, as in the tests, may
fall back to a temporary folder; on a cluster a missing setting is an error, because a folder
of one machine would be lost with it.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_SETTING} must name a shared folder")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewater-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_made: dict[str, list[str]] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables of this application once their results have been consumed."""
    paths, conf = _made.pop(spark.sparkContext.applicationId, []), spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def durable(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def durable_rounds(make: Callable[[int], DataFrame], rounds: int, label: str = "step") -> DataFrame:
    """``durable`` of the rows of ``make(0)`` to ``make(rounds - 1)``, written one after another."""
    path = None
    for k in range(rounds):
        df = make(k)
        path = path or scratch(df.sparkSession, label)
        df.write.mode("append").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs run herein delete their shuffle files when they end, not when the driver next collects its garbage.

    For results that are written; a frame acted on herein and once more later would make its shuffles again.
    """
    before = spark.conf.get(_FREEING, None)
    spark.conf.set(_FREEING, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREEING, before) if before is not None else spark.conf.unset(_FREEING)


def discard(*tables: DataFrame | None) -> None:
    """Delete intermediate tables that nothing unwritten reads any more; what is not a ``durable`` result is left alone."""
    for df in tables:
        if (path := getattr(df, "_scratch_path", None)) is None:
            continue
        spark = df.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        if path in (made := _made.get(spark.sparkContext.applicationId, [])):
            made.remove(path)


_SHUFFLING = re.compile(r"^[\s:+\-|~!]*(Join|Aggregate|Window|Sort|Distinct|Deduplicate|Repartition\w*)\b", re.M)


def settled(df: DataFrame, label: str = "input") -> DataFrame:
    """``df`` itself when it is a plain scan, else its result written once.

    Operators that first measure their input (key sizes, range bounds) would otherwise repeat the
    whole upstream work for each measurement.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return durable(df, label) if _SHUFFLING.search(plan) else df


def plain_rows(spark: SparkSession) -> int:
    """Rows of one key that a single task may handle (``spark.tidewater.plainRows``)."""
    return int(spark.conf.get("spark.tidewater.plainRows", "1000000"))

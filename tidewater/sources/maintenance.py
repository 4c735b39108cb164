"""Partition-level deletes, rollback, layout and statistics on Parquet folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.ordered import ROW_BYTES, parts_of
from tidewater.sources.durable import settled
from tidewater.sources.io import write_parquet


def drop_partition(spark: SparkSession, path: str, column: str, value) -> bool:
    """Delete one partition directory."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def delete_where(spark: SparkSession, path: str, partition: str, values: list, condition: Column, backup: str) -> None:
    """Delete rows of the listed partitions: copy them to ``backup``, then rewrite only those partitions."""
    touched = spark.read.parquet(path).filter(F.col(partition).isin(*values))
    write_parquet(touched, backup, [partition])
    saved = spark.read.parquet(backup)
    left = saved.filter(~F.coalesce(condition, F.lit(False)))
    (left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))
    alive = {r[0] for r in left.select(partition).distinct().collect()}       # at most len(values) rows
    for value in values:
        if value not in alive:
            drop_partition(spark, path, partition, value)


def write_batch(df: DataFrame, path: str, batch_id: str) -> None:
    """Append rows under their batch id; writing the same batch again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def rollback_batch(spark: SparkSession, path: str, batch_id: str) -> bool:
    return drop_partition(spark, path, "batch_id", batch_id)


def cluster_files(df: DataFrame, path: str, columns: list[str], file_bytes: int = 128 << 20) -> DataFrame:
    """Rewrite so that each file covers a narrow range of the query columns (better row-group pruning).

    A file holds about ``file_bytes`` of rows as they are sorted in memory, fewer once compressed.
    """
    df = settled(df)
    df.repartitionByRange(max(1, parts_of(df, file_bytes, ROW_BYTES)), *columns).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def analyze(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Table and column statistics for the optimizer."""
    which = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {which}")


def schema_changes(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """Columns added, removed or retyped."""
    a, b = {f.name: f.dataType.simpleString() for f in old}, {f.name: f.dataType.simpleString() for f in new}
    rows = [(n, "added" if n not in a else "removed" if n not in b else "retyped", a.get(n), b.get(n))
            for n in sorted(a.keys() | b.keys()) if a.get(n) != b.get(n)]
    return spark.createDataFrame(rows, "name string, change string, old_type string, new_type string")

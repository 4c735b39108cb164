"""Readers and writers."""

from __future__ import annotations

import logging
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.ordered import parts_of
from tidewater.sources.durable import scratch

log = logging.getLogger(__name__)


def write_parquet(df: DataFrame, path: str, partition_cols: list[str] | None = None, mode: str = "overwrite",
                  compression: str = "snappy", cluster: bool = True) -> str:
    """Partitioned Parquet write; ``cluster`` gathers rows by the partition columns to avoid small files.

    Gathering is a rebalance: adaptive execution splits large partition values over many tasks.
    """
    out = df.hint("rebalance", *map(F.col, partition_cols)) if cluster and partition_cols else df
    writer = out.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with a header; types are inferred only when no schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_json(spark: SparkSession, path: str, schema: str, corrupt: str = "_corrupt_record",
              multiline: bool = False) -> DataFrame:
    """JSON in permissive mode: unreadable records keep their text in ``corrupt``."""
    return (spark.read.schema(f"{schema}, {corrupt} string").option("mode", "PERMISSIVE")
            .option("multiLine", multiline).option("columnNameOfCorruptRecord", corrupt).json(path))


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: str | None = None,
                   required: list[str] | None = None) -> DataFrame:
    """Drop rows null in the required (or any) column, write Parquet, return the re-read table."""
    read_csv(spark, source, schema).dropna(subset=required).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def split_by_key(df: DataFrame, key: str, path: str) -> DataFrame:
    """One directory per key value, written in one job."""
    write_parquet(df, path, [key])
    return df.sparkSession.read.parquet(path)


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist, asked of the Hadoop file system."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        (found.append(p) if path.getFileSystem(conf).exists(path) else log.warning("missing input %s", p))
    return found


def union_of_paths(spark: SparkSession, paths: list[str], merge_schema: bool = True) -> DataFrame:
    """Read all existing inputs together; fails only when none exists."""
    found = existing(spark, paths)
    if not found:
        raise FileNotFoundError("none of the inputs exists")
    return spark.read.option("mergeSchema", merge_schema).parquet(*found)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` first (missing ones as typed nulls), then the new ones."""
    have = set(df.columns)
    wanted = [F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
              for f in schema.fields]
    return df.select(*wanted, *[c for c in df.columns if c not in set(schema.names)])


def with_ingest_columns(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Ingestion time and source file of every row."""
    return df.withColumns({"ingested_at": at if at is not None else F.current_timestamp(),
                           "source_file": F.input_file_name()})


def bucket_count(*tables: DataFrame, bucket_bytes: int = 128 << 20) -> int:
    """Buckets for tables that are to be joined: a power of two, by the size of the largest."""
    return max(8, 1 << max(parts_of(t, bucket_bytes) for t in tables).bit_length())


def save_table(df: DataFrame, label: str, bucket_by: str | None = None, buckets: int | None = None) -> str:
    """External catalog table below the shared folder, bucketed and sorted on request; returns its name.

    Rows are dealt by bucket first, so a task writes whole buckets. ``buckets`` follows the size of ``df`` unless given.
    """
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    writer = df.write.format("parquet").option("path", scratch(df.sparkSession, label))
    if bucket_by:
        buckets = buckets or bucket_count(df)
        writer = df.repartition(buckets, bucket_by).write.format("parquet").option("path", scratch(df.sparkSession, label))
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return name


def keep(df: DataFrame) -> DataFrame:
    """Persist an intermediate that several branches read."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def jdbc_sink(url: str, table: str, properties: dict[str, str] | None = None):
    """``foreachBatch`` function appending each micro-batch to a warehouse table, tagged by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.format("jdbc").option("url", url)
         .option("dbtable", table).options(**(properties or {})).mode("append").save())

    return write


def spine(bounds: DataFrame, start: str, end: str, name: str = "day", step: str = "interval 1 day") -> DataFrame:
    """One row per step between two columns of ``bounds``, other columns kept."""
    others = [c for c in bounds.columns if c not in (start, end)]
    return bounds.select(*others, F.explode(F.sequence(F.col(start), F.col(end), F.expr(step))).alias(name))


def date_spine(df: DataFrame, column: str, name: str = "day", step: str = "interval 1 day") -> DataFrame:
    """All dates between a column's minimum and maximum."""
    return spine(df.agg(F.to_date(F.min(column)).alias("_lo"), F.to_date(F.max(column)).alias("_hi")),
                 "_lo", "_hi", name, step)


def scalar(df: DataFrame, value: Column) -> Column:
    """One aggregated value as a scalar subquery; nothing travels to the driver."""
    return df.agg(value).scalar()

"""Named Parquet tables in one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, folder).orders`` reads ``folder/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def sql(self, text: str, *names: str, **args) -> DataFrame:
        """Run SQL text over the named tables as temporary views (values bound, not interpolated)."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
        return self.spark.sql(text, args=args) if args else self.spark.sql(text)

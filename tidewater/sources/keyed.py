"""Parquet tables whose changes rewrite only the partitions that hold a touched key.

Rows are dealt to partitions by the hash of their key. A change names its keys, so its partitions are known
beforehand: only those are read, joined and written again, by a dynamic partition overwrite; files of the others
stay as they are. The new rows are written beside the table first, so a failed overwrite can be repeated from there.
There is no log and no history (see ``snapshots`` for those); one writer at a time.

Tables made with ``changed_at`` take change data: they keep the recency of the change that a row shows and whether it
deleted the row, in two hidden columns, so changes may come in any order and any number of batches. ``purge`` drops
deleted rows that no change can concern any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.durable import discard, durable
from tidewater.sources.snapshots import CHANGED, DELETED, change_rows, latest_changes, merge_rows

PART = "_part"


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, keys: list[str], parts: int = 64):
        self.spark, self.root, self.keys, self.parts = spark, root.rstrip("/"), keys, parts

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.parts)).cast("int"))

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.root)

    def write(self, df: DataFrame, changed_at: str | None = None) -> None:
        """Make the table anew. ``changed_at`` is the type of a change's recency, e.g. ``struct<seq: int>``."""
        if changed_at:
            df = df.withColumns({CHANGED: F.lit(None).cast(changed_at), DELETED: F.lit(False)})
        rows = self._dealt(df).repartition(F.col(PART))
        if df.isEmpty():                 # one row of nulls keeps the schema, in a partition that no key has
            rows = self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema], F.lit(-1).alias(PART))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PART).parquet(self.root)

    def read(self) -> DataFrame:
        rows = self._stored().filter(F.col(PART) >= 0)
        return rows.filter(f"not {DELETED}").drop(CHANGED, DELETED, PART) if DELETED in rows.columns else rows.drop(PART)

    def _rewrite(self, source: DataFrame, new_rows: Callable[[DataFrame], DataFrame]) -> int:
        """Replace the partitions of ``source``'s keys by what ``new_rows`` makes of them; returns their number."""
        touched = sorted(r[0] for r in self._dealt(source.select(*self.keys)).select(PART).distinct().collect())      # at most ``parts``
        if not touched:
            return 0
        here = self._stored().filter(F.col(PART).isin(touched)).drop(PART)
        rows = durable(self._dealt(new_rows(here)), "rewritten")
        left = {r[0] for r in rows.select(PART).distinct().collect()}
        rows.repartition(F.col(PART)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.root)
        for part in set(touched) - left:          # an overwrite leaves partitions without new rows alone
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{PART}={part}")
            place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        discard(rows)
        return len(touched)

    def merge(self, source: DataFrame, keys: list[str] | None = None, update: list[str] | None = None, insert: bool = True, delete_when: Column | None = None) -> int:
        """Upsert, as ``SnapshotTable.merge``; one row per key in ``source``."""
        self._own(keys)
        return self._rewrite(source, lambda here: merge_rows(here, source, self.keys, update, insert, delete_when))

    def apply_changes(self, changes: DataFrame, keys: list[str] | None, op: str, *recency: str) -> int:
        """Change data, as ``SnapshotTable.apply_changes``; the table must have been made with ``changed_at``."""
        self._own(keys)
        if CHANGED not in self._stored().columns:
            raise ValueError("the table keeps no recency; make it with changed_at")
        return self._rewrite(changes, lambda here: change_rows(here, changes, self.keys, op, *recency))

    def load_newer(self, source: DataFrame, updated_at: str) -> int:
        """Merge source rows newer than the table's high-water mark."""
        mark = self.read().agg(F.max(updated_at)).scalar()
        newer = durable(latest_changes(source.filter(F.coalesce(F.col(updated_at) > mark, F.lit(True))), self.keys, updated_at), "newer")
        return self.merge(newer)

    def purge(self, before: Column) -> int:
        """Drop deleted rows whose recency lies before ``before``, a literal like the recency; only their partitions are written."""
        gone = F.col(DELETED) & (F.col(CHANGED) < before)
        return self._rewrite(durable(self._stored().filter(gone).select(*self.keys), "purged"), lambda here: here.filter(~gone))

    def _own(self, keys: list[str] | None) -> None:
        if keys is not None and list(keys) != list(self.keys):
            raise ValueError(f"the table is dealt by {self.keys}, not {keys}")

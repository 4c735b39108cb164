"""Versioned tables on plain Parquet.

Every change writes a new directory, then publishes it by the next entry of a small commit log. The
entry is written whole under another name and renamed without overwriting, so of two writers one
fails, and a reader sees the old or the new version, never a mix or half an entry. Old directories
stay readable: history and restore are log operations. A version is a list of directories; inserts
add one, other changes write the rows anew.

Tables that take change data keep two hidden columns: the recency of the change that a row shows, and
whether it deleted the row. So changes may come in any order and any number of batches.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.ordered import reach_back

CHANGED, DELETED = "_changed_at", "_deleted"


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._log = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_log")
        self._fs = self._log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # log -------------------------------------------------------------------------------------
    def versions(self) -> list[int]:
        if not self._fs.exists(self._log):
            return []
        return sorted(int(s.getPath().getName().split(".")[0]) for s in self._fs.listStatus(self._log))

    def _entry(self, version: int) -> dict:
        path = self._jvm.org.apache.hadoop.fs.Path(self._log, f"{version:08d}.json")
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, directories: list[str], operation: str, base: int) -> int:
        version, hadoop = base + 1, self._jvm.org.apache.hadoop.fs
        staged = hadoop.Path(f"{self.root}/_staged/{uuid.uuid4().hex}.json")
        out = self._fs.create(staged, False)
        out.write(bytearray(json.dumps({"version": version, "directories": directories, "operation": operation,
                                        "at": time.time()}).encode()))
        out.close()
        self._fs.mkdirs(self._log)
        files = hadoop.FileContext.getFileContext(self._log.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        plain = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        files.rename(staged, hadoop.Path(self._log, f"{version:08d}.json"), plain)      # fails when another writer took this version
        return version

    def _commit(self, df: DataFrame, operation: str, base: int, beside: list[str] | None = None) -> int:
        """Write rows and publish them, alone or with the directories ``beside``."""
        directory = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{directory}")
        return self._publish([*(beside or []), directory], operation, base)

    @property
    def version(self) -> int:
        return max(self.versions(), default=0)

    def history(self) -> DataFrame:
        rows = [self._entry(v) for v in self.versions()]
        return self.spark.createDataFrame([(r["version"], r["operation"], ",".join(r["directories"])) for r in rows],
                                          "version int, operation string, directory string")

    # read and write --------------------------------------------------------------------------
    def _stored(self, version: int) -> DataFrame:
        """Rows with the hidden columns, if the version has them."""
        return self.spark.read.parquet(*[f"{self.root}/{d}" for d in self._entry(version)["directories"]])

    def read(self, version: int | None = None) -> DataFrame:
        stored = self._stored(version or self.version)
        return stored.filter(f"not {DELETED}").drop(CHANGED, DELETED) if DELETED in stored.columns else stored

    def write(self, df: DataFrame, operation: str = "write") -> int:
        return self._commit(df, operation, self.version)

    def restore(self, version: int) -> int:
        """Make an old version current again; no data is copied."""
        return self._publish(self._entry(version)["directories"], f"restore {version}", self.version)

    def merge(self, source: DataFrame, keys: list[str], update: list[str] | None = None, insert: bool = True,
              delete_when: Column | None = None) -> int:
        """Upsert: matched rows take the source's ``update`` columns (default all), others are inserted.

        ``source`` must have one row per key; null keys match null keys. ``delete_when`` is an
        expression over the source columns, removing matched rows and suppressing inserts.
        """
        base = self.version
        return self._commit(merge_rows(self._stored(base), source, keys, update, insert, delete_when), "merge", base)

    def insert_new(self, source: DataFrame, keys: list[str]) -> int:
        """Insert source rows whose key is absent; only they are written."""
        base = self.version
        stored = self._stored(base)
        if DELETED in stored.columns:
            return self.merge(source.dropDuplicates(keys), keys, update=[])
        taken = stored.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
        fresh = source.select(*stored.columns).join(taken, same, "left_anti").dropDuplicates(keys)
        return self._commit(fresh.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema]), "insert", base, self._entry(base)["directories"])

    def apply_changes(self, changes: DataFrame, keys: list[str], op: str, *recency: str) -> int:
        """Change data capture: per key the change with the greatest ``recency`` of all batches so far decides.

        Older changes that arrive later, replayed ones among them, change nothing; a deleted key stays
        as a hidden row, so an older update cannot bring it back.
        """
        base = self.version
        return self._commit(change_rows(self._stored(base), changes, keys, op, *recency), "changes", base)

    def load_newer(self, source: DataFrame, keys: list[str], updated_at: str) -> int:
        """Merge source rows newer than the table's high-water mark."""
        mark = self.read().agg(F.max(updated_at)).scalar()
        newer = source.filter(F.coalesce(F.col(updated_at) > mark, F.lit(True)))
        return self.merge(latest_changes(newer, keys, updated_at), keys)


def merge_rows(stored: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None, insert: bool = True, delete_when: Column | None = None) -> DataFrame:
    """``stored`` (with its hidden columns, if any) after an upsert."""
    kept = DELETED in stored.columns
    columns = [c for c in stored.columns if c not in (CHANGED, DELETED)]
    rest = [c for c in columns if c not in keys]
    changed = set(update if update is not None else rest)
    gone = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    both = _matched(stored, source.withColumn("_gone", gone), keys).filter(~F.coalesce("_n__gone", F.lit(False)))
    was = F.col("_old") & ~F.col(f"_o_{DELETED}") if kept else F.coalesce("_old", F.lit(False))
    was = F.coalesce(was, F.lit(False))
    if not insert:
        both = both.filter("_old")
    new = F.coalesce("_new", F.lit(False)) & (was | F.lit(insert))
    here = set(source.columns)
    take = [F.when(new & (~was | F.lit(c in changed)), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c) if c in here
            else F.col(f"_o_{c}").alias(c) for c in rest]
    hidden = [F.col(f"_o_{CHANGED}").alias(CHANGED), (~was & ~new).alias(DELETED)] if kept else []
    return both.select(*keys, *take, *hidden).select(*columns, *([CHANGED, DELETED] if kept else []))


def change_rows(stored: DataFrame, changes: DataFrame, keys: list[str], op: str, *recency: str) -> DataFrame:
    """``stored`` after change data, with the hidden columns: per key the change with the greatest recency decides."""
    columns = [c for c in stored.columns if c not in (CHANGED, DELETED)]
    rest = [c for c in columns if c not in keys]
    latest = latest_changes(changes, keys, *recency).withColumn(CHANGED, F.struct(*recency))
    both = _matched(stored, latest, keys)
    kept = CHANGED in stored.columns
    seen, gone = (F.col(f"_o_{CHANGED}"), F.coalesce(f"_o_{DELETED}", F.lit(False))) if kept else (F.lit(None), F.lit(False))
    newer = F.coalesce(F.col("_new") & (seen.isNull() | (F.col(f"_n_{CHANGED}") > seen)), F.lit(False))
    drops = F.coalesce(F.col(f"_n_{op}") == "delete", F.lit(False))
    here = set(changes.columns)
    take = [F.when(newer & drops, F.lit(None)).when(newer, F.col(f"_n_{c}") if c in here else F.col(f"_o_{c}")).otherwise(F.col(f"_o_{c}")).alias(c) for c in rest]
    at = F.when(newer, F.col(f"_n_{CHANGED}"))
    hidden = [(at.otherwise(seen) if kept else at).alias(CHANGED), F.when(newer, drops).otherwise(gone).alias(DELETED)]
    return both.select(*keys, *take, *hidden).select(*columns, CHANGED, DELETED)


def _matched(stored: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Full join by key, null keys alike: keys, ``_o_`` and ``_n_`` columns, ``_old`` and ``_new``."""
    old = stored.select(*[F.col(c).alias(f"_o_{c}") for c in stored.columns], F.lit(True).alias("_old"))
    new = source.select(*[F.col(c).alias(f"_n_{c}") for c in source.columns], F.lit(True).alias("_new"))
    both = old.join(new, reduce(Column.__and__, [F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}")) for k in keys]), "full_outer")
    return both.select("*", *[F.coalesce(f"_o_{k}", f"_n_{k}").alias(k) for k in keys])


def latest_changes(changes: DataFrame, keys: list[str], *recency: str) -> DataFrame:
    """One row per key, the latest by ``recency``; combined on the map side."""
    rest = [c for c in changes.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*recency)).alias("_row")
    return changes.groupBy(*keys).agg(row).select(*keys, "_row.*")


def build_versions(changes: DataFrame, keys: list[str], tracked: list[str], effective: str, *seq: str) -> DataFrame:
    """Versioned dimension from a change list: start, end (exclusive), is_current.

    Changes at one time collapse to the last by ``seq``; a change that repeats the previous
    values opens no version. Ordered passes are sliced, so a key with very many changes is fine.
    """
    one = changes.groupBy(*keys, effective).agg(
        F.max_by(F.struct(*tracked), F.struct(*(seq or tracked))).alias("_v"))
    seen = reach_back(one, keys, [effective], 1, _before=lambda w: F.lag("_v").over(w), _first=lambda w: F.lag(F.lit(1)).over(w).isNull())
    kept = seen.filter(F.col("_first") | ~F.col("_v").eqNullSafe(F.col("_before"))).select(*keys, effective, "_v")
    ended = reach_back(kept, keys, [f"-{effective}"], 1, end=lambda w: F.lag(effective).over(w))
    return ended.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in tracked], F.col(effective).alias("start"), "end",
                        F.col("end").isNull().alias("is_current"))


def scd2_apply(dim: DataFrame, changes: DataFrame, keys: list[str], tracked: list[str], effective: str, *seq: str) -> DataFrame:
    """Close and open versions in one new snapshot; keys without changes are untouched.

    The affected keys' versions are rebuilt from their starts plus the changes, so late changes
    land in the right place.
    """
    touched = changes.select(*keys).distinct()
    kept = dim.join(touched, keys, "left_anti")
    order = [F.lit(None).cast(changes.schema[s].dataType).alias(s) for s in seq if s not in tracked]
    starts = dim.join(touched, keys, "left_semi").select(*keys, *tracked, F.col("start").alias(effective), *order)
    merged = starts.unionByName(changes.select(*keys, *tracked, effective, *[s for s in seq if s not in tracked]))
    return kept.unionByName(build_versions(merged, keys, tracked, effective, *seq))

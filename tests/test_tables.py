import datetime as dt

import itertools
import pathlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.sources import io, maintenance
from tidewater.sources.durable import durable, scratch, shared_root
from tidewater.sources.keyed import KeyedTable
from tidewater.sources.snapshots import SnapshotTable, build_versions, scd2_apply


def table(spark, data, schema="id int, v string, w int"):
    t = SnapshotTable(spark, scratch(spark, "t"))
    t.write(spark.createDataFrame(data, schema))
    return t


def test_merge_updates_inserts_and_keeps_nulls(spark):
    t = table(spark, [(1, "a", 1), (2, "b", 2)])
    t.merge(spark.createDataFrame([(2, None, 9), (3, "c", 3)], "id int, v string, w int"), ["id"])
    assert rows(t.read()) == [(1, "a", 1), (2, None, 9), (3, "c", 3)]
    t.merge(spark.createDataFrame([(1, "z", 7), (4, "n", 4)], "id int, v string, w int"), ["id"], update=["w"])
    assert rows(t.read()) == [(1, "a", 7), (2, None, 9), (3, "c", 3), (4, "n", 4)]
    t.merge(spark.createDataFrame([(9, "q", 0)], "id int, v string, w int"), ["id"], insert=False)
    assert t.read().count() == 4


def test_changes_replayed_twice_equal_once(spark):
    t = table(spark, [(1, "a", 1), (2, "b", 2)])
    log = spark.createDataFrame([(1, "x", 5, "update", 1), (1, None, None, "delete", 2), (2, "y", 6, "update", 1), (3, "n", 7, "insert", 1), (4, "m", 1, "insert", 1), (4, None, None, "delete", 2)],
                                "id int, v string, w int, op string, seq int")
    t.apply_changes(log, ["id"], "op", "seq")
    once = rows(t.read())
    t.apply_changes(log, ["id"], "op", "seq")
    assert once == rows(t.read()) == [(2, "y", 6), (3, "n", 7)]


CHANGE = "id int, v string, w int, op string, seq int"


def test_changes_in_any_order_of_batches(spark):
    t = table(spark, [(1, "a", 1), (2, "b", 2), (None, "n", 0)])
    for batch in ([(1, "new", 5, "update", 5), (2, None, None, "delete", 9)], [(1, "old", 2, "update", 2), (2, "back", 7, "update", 7)],
                  [(3, None, None, "delete", 4), (None, "m", 1, "update", 1)], [(3, "late", 3, "insert", 3), (None, "m", 1, "update", 1)]):
        t.apply_changes(spark.createDataFrame(batch, CHANGE), ["id"], "op", "seq")
    assert rows(t.read()) == rows(spark.createDataFrame([(1, "new", 5), (None, "m", 1)], "id int, v string, w int"))
    t.merge(spark.createDataFrame([(2, "again", 3), (1, "z", 0)], "id int, v string, w int"), ["id"], update=["w"])
    assert sorted(map(str, rows(t.read()))) == sorted(map(str, [(1, "new", 0), (2, "again", 3), (None, "m", 1)]))
    t.apply_changes(spark.createDataFrame([(2, "b", 8, "update", 10)], CHANGE), ["id"], "op", "seq")
    assert (2, "b", 8) in rows(t.read().filter("id is not null"))


def test_null_keys_match_on_replay(spark):
    t = table(spark, [(1, "a", 1)])
    more = spark.createDataFrame([(None, "n", 1)], "id int, v string, w int")
    for _ in range(2):
        t.merge(more, ["id"])
        t.insert_new(more, ["id"])
    assert t.read().count() == 2


def test_inserts_write_only_new_rows(spark):
    t = table(spark, [(1, "a", 1)])
    t.insert_new(spark.createDataFrame([(1, "zz", 0), (2, "b", 2)], "id int, v string, w int"), ["id"])
    first, second = t._entry(1)["directories"], t._entry(2)["directories"]
    assert second[:1] == first and spark.read.parquet(f"{t.root}/{second[1]}").count() == 1


def test_history_restore_and_insert_only(spark):
    t = table(spark, [(1, "a", 1)])
    t.insert_new(spark.createDataFrame([(1, "zz", 0), (2, "b", 2), (2, "b", 2)], "id int, v string, w int"), ["id"])
    assert rows(t.read()) == [(1, "a", 1), (2, "b", 2)]
    t.restore(1)
    assert rows(t.read()) == [(1, "a", 1)] and rows(t.read(2)) == [(1, "a", 1), (2, "b", 2)]
    assert rows(t.history(), "version", "operation") == [(1, "write"), (2, "insert"), (3, "restore 1")]


def test_second_writer_of_a_version_fails(spark):
    t = table(spark, [(1, "a", 1)])
    base = t.version
    t.write(spark.createDataFrame([(1, "b", 1)], "id int, v string, w int"))
    with pytest.raises(Exception):
        t._commit(spark.createDataFrame([(1, "c", 1)], "id int, v string, w int"), "late", base)
    assert rows(t.read()) == [(1, "b", 1)]


def test_high_water_mark(spark):
    t = table(spark, [(1, "a", 10), (2, "b", 20)])
    t.load_newer(spark.createDataFrame([(1, "old", 15), (2, "new", 21), (3, "n", 30)], "id int, v string, w int"), ["id"], "w")
    assert rows(t.read()) == [(1, "a", 10), (2, "new", 21), (3, "n", 30)]


def test_versions_close_open_and_late_change(spark, both_ways):
    d = lambda n: dt.date(2024, 1, n)
    first = spark.createDataFrame([("a", "x", d(1), 1), ("b", "y", d(1), 1)], "k string, v string, at date, seq int")
    dim = build_versions(first, ["k"], ["v"], "at", "seq")
    more = spark.createDataFrame([("a", "z", d(10), 1), ("a", "z", d(12), 1), ("a", "m", d(5), 1), ("c", "n", d(3), 1)], "k string, v string, at date, seq int")
    got = scd2_apply(dim, more, ["k"], ["v"], "at", "seq")
    assert rows(got, "k", "v", "start", "end", "is_current") == sorted([
        ("a", "x", d(1), d(5), False), ("a", "m", d(5), d(10), False), ("a", "z", d(10), None, True),
        ("b", "y", d(1), None, True), ("c", "n", d(3), None, True)], key=repr)


def test_delete_with_backup_and_rollback(spark):
    path, backup = scratch(spark, "p"), scratch(spark, "b")
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (3, None)], "p int, v int")
    io.write_parquet(df, path, ["p"])
    maintenance.delete_where(spark, path, "p", [1, 2], F.col("v") >= 2, backup)
    assert rows(spark.read.parquet(path), "p", "v") == [(1, 1), (3, None)]
    assert rows(spark.read.parquet(backup), "p", "v") == [(1, 1), (1, 2), (2, 3)]
    batches = scratch(spark, "batches")
    for b in ("b1", "b2"):
        maintenance.write_batch(df, batches, b)
    maintenance.rollback_batch(spark, batches, "b2")
    assert spark.read.parquet(batches).select("batch_id").distinct().first()[0] == "b1"


def test_schema_report_and_alignment(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, v string"), spark.createDataFrame([(1, 2)], "id long, n int")
    assert rows(maintenance.schema_changes(spark, a.schema, b.schema), "name", "change") == [("id", "retyped"), ("n", "added"), ("v", "removed")]
    assert io.align(b, a.schema).columns == ["id", "v", "n"]


def test_missing_paths(spark):
    path = scratch(spark, "one")
    spark.range(3).write.parquet(path)
    assert io.union_of_paths(spark, [path, path + "-absent"]).count() == 3
    with pytest.raises(FileNotFoundError):
        io.union_of_paths(spark, [path + "-absent"])


def test_corrupt_json_is_kept(spark):
    path = scratch(spark, "json")
    spark.createDataFrame([('{"a": 1}',), ("{oops",)], "value string").write.text(path)
    got = io.read_json(spark, path, "a int")
    assert rows(got, "a", "_corrupt_record") == [(1, None), (None, "{oops")]


def test_durable_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, [1, 2]), (None, None)], "a int, b array<int>")
    assert rows(durable(df)) == rows(df) and durable(df).schema.names == df.schema.names
    assert shared_root(spark)


def test_bucketed_join_has_no_exchange(spark):
    names = [io.save_table(spark.range(2000).withColumnRenamed("id", "k"), "bucketed", "k", 4) for _ in range(2)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table(names[0]).join(spark.table(names[1]), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


def test_clustered_files_cover_narrow_ranges(spark):
    rows_in = spark.range(20_000).select(F.hash("id").alias("v"))
    files = maintenance.cluster_files(rows_in, scratch(spark, "c"), ["v"], file_bytes=20_000).groupBy("_metadata.file_path").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    got = sorted((r.lo, r.hi, r.n) for r in files.collect())
    assert len(got) > 4 and sum(n for *_, n in got) == 20_000
    assert all(a[1] < b[0] for a, b in zip(got, got[1:]))


def test_buckets_follow_the_size(spark):
    df = spark.range(10_000)
    assert io.bucket_count(df) == 8 and io.bucket_count(df, bucket_bytes=1000) == 128


def keyed(spark, data, changed_at=None, parts=8):
    table = KeyedTable(spark, scratch(spark, "keyed"), ["k"], parts)
    table.write(spark.createDataFrame(data, "k string, v int, w int"), changed_at)
    return table


def files_of(table):
    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(table.root.removeprefix("file:")).glob("_part=*/*.parquet")}


def test_a_change_leaves_other_partitions_alone(spark):
    table = keyed(spark, [(f"k{i}", i, 0) for i in range(100)])
    before = files_of(table)
    assert table.merge(spark.createDataFrame([("k7", 70, 1), (None, 5, 5)], "k string, v int, w int")) in (1, 2)
    after = files_of(table)
    assert len(before) == 8 and 6 <= len(set(before.items()) & set(after.items())) < 8
    assert rows(table.read().filter("k is null or k in ('k7', 'k8')")) == sorted([("k7", 70, 1), ("k8", 8, 0), (None, 5, 5)], key=repr)
    assert table.read().count() == 101
    assert table.merge(spark.createDataFrame([], "k string, v int, w int")) == 0 and files_of(table) == after


def test_keyed_merge_agrees_with_the_snapshot(spark):
    base, change = [(f"k{i}", i, i) for i in range(30)], [(f"k{i}", -i, 0) for i in range(20, 40)]
    options = [{}, {"update": ["v"]}, {"insert": False}, {"delete_when": F.col("v") < -30}]
    for o in options:
        one, two = keyed(spark, base), SnapshotTable(spark, scratch(spark, "t"))
        two.write(spark.createDataFrame(base, "k string, v int, w int"))
        for t, extra in ((one, {}), (two, {})):
            t.merge(spark.createDataFrame(change, "k string, v int, w int"), ["k"], **o)
        assert rows(one.read().select("k", "v", "w")) == rows(two.read().select("k", "v", "w"))


def test_partitions_that_lose_all_rows_go(spark):
    table = keyed(spark, [("a", 1, 1), ("b", 2, 2)], parts=64)
    table.merge(spark.createDataFrame([("a", 1, 1)], "k string, v int, w int"), delete_when=F.col("v") == 1)
    assert rows(table.read()) == [("b", 2, 2)] and len(files_of(table)) == 1


def test_keyed_changes_in_any_order_and_purge(spark):
    shape = "k string, v int, w int, op string, seq int"
    batches = [[("a", 3, 3, "update", 3), ("b", 0, 0, "delete", 2)], [("a", 2, 2, "update", 2), ("b", 1, 1, "insert", 1), ("c", 9, 9, "insert", 1)], [("c", 0, 0, "delete", 5)]]
    for order in itertools.permutations(batches):
        table = keyed(spark, [("a", 0, 0)], "struct<seq: int>")
        for b in order:
            table.apply_changes(spark.createDataFrame(b, shape), ["k"], "op", "seq")
        assert rows(table.read().select("k", "v", "w")) == [("a", 3, 3)]
    hidden = table.spark.read.parquet(table.root).filter("_deleted").count()
    assert hidden == 2 and table.purge(F.struct(F.lit(3).alias("seq"))) == 1
    assert table.spark.read.parquet(table.root).filter("_deleted").count() == 1 and rows(table.read().select("k")) == [("a",)]
    with pytest.raises(ValueError):
        keyed(spark, [("a", 0, 0)]).apply_changes(spark.createDataFrame(batches[0], shape), ["k"], "op", "seq")
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([("a", 1, 1)], "k string, v int, w int"), ["v"])


def test_empty_keyed_table(spark):
    table = keyed(spark, [])
    assert table.read().columns == ["k", "v", "w"] and table.read().count() == 0
    table.merge(spark.createDataFrame([("a", 1, 1)], "k string, v int, w int"))
    assert rows(table.read()) == [("a", 1, 1)]


def test_clustered_files_follow_rows_not_compressed_bytes(spark):
    packed = durable(spark.range(200_000).selectExpr("id % 500 as v", "1L as w"), "packed")
    path = scratch(spark, "c")
    out = maintenance.cluster_files(packed, path, ["v"], file_bytes=1 << 20)
    sizes = out.groupBy("_metadata.file_path").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("lo").collect()
    assert out.count() == 200_000 and len(sizes) >= 3 and max(r.n for r in sizes) < 120_000
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:], strict=False))

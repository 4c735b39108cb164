"""L: table maintenance and change data."""

from pyspark.sql import functions as F

from tidewater.operators.quality import passes
from tidewater.plans.registry import query
from tidewater.sources import io
from tidewater.sources import maintenance as M
from tidewater.sources.durable import scratch
from tidewater.sources.keyed import KeyedTable
from tidewater.sources.snapshots import SnapshotTable, build_versions, scd2_apply

COLS = ["o_orderkey", "o_orderstatus", "o_totalprice"]
SUMMARY = "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM r GROUP BY 1"


def _summary(df):
    return df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def _old_orders(t):
    table = SnapshotTable(t.spark, scratch(t.spark, "snapshot"))
    table.write(t.orders.filter("o_orderdate < '1999-01-01'").select(*COLS))
    return table


def _keyed_orders(t, changed_at=None):
    table = KeyedTable(t.spark, scratch(t.spark, "keyed"), ["o_orderkey"], parts=16)
    table.write(t.orders.filter("o_orderdate < '1999-01-01'").select(*COLS), changed_at)
    return table


@query(f"""WITH a AS (SELECT * FROM orders WHERE o_orderdate < '1999-01-01'), b AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0),
          r AS (SELECT CASE WHEN b.o_orderkey IS NULL THEN a.o_orderstatus ELSE 'X' END AS o_orderstatus, CASE WHEN b.o_orderkey IS NULL THEN a.o_totalprice ELSE b.o_totalprice * 2 END AS o_totalprice
                FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey) {SUMMARY}""")
def l01_upsert(t):
    table = _keyed_orders(t)
    table.merge(t.orders.filter("o_orderkey % 3 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice")), ["o_orderkey"])
    return _summary(table.read())


@query(f"""WITH r AS (SELECT o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < '1999-01-01' UNION ALL SELECT 'NEW', o_totalprice FROM orders WHERE o_orderdate >= '1999-01-01' AND o_orderkey % 2 = 0) {SUMMARY}""")
def l02_insert_only_merge(t):
    table = _old_orders(t)
    table.insert_new(t.orders.filter("o_orderkey % 2 = 0").select("o_orderkey", F.lit("NEW").alias("o_orderstatus"), "o_totalprice"), ["o_orderkey"])
    return _summary(table.read())


@query(f"""WITH r AS (SELECT CASE WHEN o_orderkey % 5 = 1 THEN 'U' WHEN o_orderkey % 5 = 2 THEN 'I' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
          FROM orders WHERE o_orderkey % 5 IN (1, 2) OR (o_orderdate < '1999-01-01' AND o_orderkey % 5 <> 0)) {SUMMARY}""")
def l03_change_data(t):
    table = _keyed_orders(t, "struct<seq: int>")
    k = F.col("o_orderkey") % 5
    last = F.when(k == 0, "delete").when(k == 1, "update").when(k == 2, "insert")
    base = t.orders.filter(k <= 2)
    first = base.select("o_orderkey", F.lit("old").alias("o_orderstatus"), F.lit(0.0).alias("o_totalprice"), F.lit("update").alias("op"), F.lit(1).alias("seq"))
    final = base.select("o_orderkey", F.when(k == 1, "U").when(k == 2, "I").alias("o_orderstatus"), "o_totalprice", last.alias("op"), F.lit(2).alias("seq"))
    changes = first.unionByName(final)
    for _ in range(2):      # a replayed batch must not change the table
        table.apply_changes(changes, ["o_orderkey"], "op", "seq")
    return _summary(table.read())


VERSIONS = """WITH d AS (SELECT o_custkey, o_orderdate::DATE AS day, arg_max(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1, 2),
 c AS (SELECT *, lag(p) OVER (PARTITION BY o_custkey ORDER BY day) AS prev FROM d), k AS (SELECT * FROM c WHERE prev IS NULL OR prev <> p),
 v AS (SELECT *, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS nxt FROM k)
SELECT o_custkey, p AS o_orderpriority, CAST(day AS VARCHAR) AS "start", CAST(nxt AS VARCHAR) AS "end", nxt IS NULL AS is_current FROM v"""


@query(VERSIONS)
def l04_versioned_dimension(t):
    rows = t.orders.select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"), "o_orderkey")
    early = build_versions(rows.filter("day < '1999-01-01'"), ["o_custkey"], ["o_orderpriority"], "day", "o_orderkey")
    full = scd2_apply(early, rows.filter("day >= '1999-01-01'"), ["o_custkey"], ["o_orderpriority"], "day", "o_orderkey")
    return full.withColumns({"start": F.col("start").cast("string"), "end": F.col("end").cast("string")})


@query("""SELECT year(o_orderdate) AS y, count(*) AS n FROM orders WHERE NOT (year(o_orderdate) = 1997 AND o_totalprice < 250000) AND year(o_orderdate) <> 2001 GROUP BY 1""")
def l05_delete_with_backup(t):
    path = scratch(t.spark, "by_year")
    io.write_parquet(t.orders.withColumn("y", F.year("o_orderdate")), path, ["y"])
    gone = ((F.col("y") == 1997) & (F.col("o_totalprice") < 250000)) | (F.col("y") == 2001)
    M.delete_where(t.spark, path, "y", [1997, 2001], gone, scratch(t.spark, "backup"))
    return t.spark.read.parquet(path).groupBy("y").agg(F.count("*").alias("n"))


@query("SELECT 'b1' AS batch_id, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0")
def l06_batch_rollback(t):
    path = scratch(t.spark, "batches")
    M.write_batch(t.orders.filter("o_orderkey % 2 = 0"), path, "b1")
    M.write_batch(t.orders.filter("o_orderkey % 2 = 1"), path, "b2")
    M.rollback_batch(t.spark, path, "b2")
    return t.spark.read.parquet(path).groupBy("batch_id").agg(F.count("*").alias("n"))


@query("""SELECT 'restored' AS state, count(*) AS n, 3 AS versions FROM orders WHERE o_orderdate < '1999-01-01' UNION ALL SELECT 'version 2', count(*), 3 FROM orders WHERE o_orderdate < '1999-01-01' AND o_orderstatus = 'F'""")
def l07_history_and_restore(t):
    table = _old_orders(t)
    table.write(table.read().filter("o_orderstatus = 'F'"), "filter")
    table.restore(1)
    versions = table.history().count()
    state = lambda df, name: df.agg(F.lit(name).alias("state"), F.count("*").alias("n"), F.lit(versions).alias("versions"))
    return state(table.read(), "restored").unionByName(state(table.read(2), "version 2"))


@query("""SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate < '1999-01-01' OR o_orderdate > '1998-12-31' GROUP BY 1""")
def l08_incremental_load(t):
    table = KeyedTable(t.spark, scratch(t.spark, "incremental"), ["o_orderkey"], parts=16)
    cols = ["o_orderkey", "o_orderstatus", "o_orderdate"]
    table.write(t.orders.filter("o_orderdate < '1999-01-01'").select(*cols))
    table.load_newer(t.orders.select(*cols), "o_orderdate")
    return table.read().groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT year(l_shipdate) AS y, count(*) AS n, CAST(max(l_orderkey) AS BIGINT) AS last FROM lineitem GROUP BY 1")
def l09_layout_clustering(t):
    rows = M.cluster_files(t.lineitem.select("l_shipdate", "l_orderkey"), scratch(t.spark, "clustered"), ["l_shipdate"])
    return rows.groupBy(F.year("l_shipdate").alias("y")).agg(F.count("*").alias("n"), F.max("l_orderkey").cast("long").alias("last"))


@query("""SELECT year(o_orderdate) AS y, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_totalprice > 1000 AND o_custkey % 10 <> 3 GROUP BY 1""")
def l10_layered_flow(t):
    layer = lambda name: SnapshotTable(t.spark, scratch(t.spark, name))
    raw, clean, gold = layer("raw"), layer("clean"), layer("gold")
    raw.write(t.orders.withColumn("o_custkey", F.when(F.col("o_custkey") % 10 != 3, F.col("o_custkey"))))
    clean.write(raw.read().dropna(subset=["o_custkey"]).filter(passes(F.col("o_totalprice") > 1000)))
    gold.write(clean.read().groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")))
    return gold.read()


@query("SELECT count(*) AS rows, true AS has_stats FROM orders")
def l11_table_statistics(t):
    name = io.save_table(t.orders, "stats_table")
    M.analyze(t.spark, name, ["o_orderstatus", "o_totalprice"])
    info = t.spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'")
    known = info.agg(F.max(F.col("data_type").contains("rows"))).scalar()
    return t.spark.table(name).agg(F.count("*").alias("rows")).withColumn("has_stats", known)


@query("""SELECT * FROM (VALUES ('clerk', 'added', NULL, 'string'), ('o_custkey', 'retyped', 'bigint', 'string'), ('o_orderpriority', 'removed', 'string', NULL)) v("name", change, old_type, new_type)""")
def l12_schema_changes(t):
    new = t.orders.drop("o_orderpriority").withColumns({"o_custkey": F.col("o_custkey").cast("string"), "clerk": F.lit("x")})
    return M.schema_changes(t.spark, t.orders.schema, new.schema)

"""S: scans, writes and table I/O."""

from pyspark.sql import functions as F

from tidewater.functions.columns import text_day
from tidewater.plans.registry import query
from tidewater.sources import io
from tidewater.sources.durable import scratch


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
          WHERE l_quantity >= 45 AND l_returnflag = 'R'""")
def s01_parquet_scan(t):
    return (t.lineitem.filter("l_quantity >= 45 and l_returnflag = 'R'")
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"))


@query("""SELECT o_orderstatus, year(o_orderdate) AS order_year, count(*) AS n, round(sum(o_totalprice), 2) AS total
          FROM orders GROUP BY ALL""")
def s02_partitioned_write(t):
    path = scratch(t.spark, "orders")
    io.write_parquet(t.orders.withColumn("order_year", F.year("o_orderdate")), path, ["order_year", "o_orderstatus"])
    return (t.spark.read.parquet(path).groupBy("o_orderstatus", "order_year")
            .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))


@query("""SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1""")
def s03_csv_scan(t):
    path = scratch(t.spark, "customer")
    t.customer.write.option("header", True).csv(path)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return (io.read_csv(t.spark, path, schema).groupBy("c_mktsegment")
            .agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")))


@query("""SELECT CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END AS event_type,
                 count(CASE WHEN event_id % 10 = 0 THEN 1 END) AS corrupt, count(*) AS n FROM events GROUP BY 1""")
def s04_json_corrupt_rows(t):
    good = F.to_json(F.struct("event_id", F.struct("user_id", "event_type").alias("who"), "value"))
    path = scratch(t.spark, "json")
    t.events.select(F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken"), F.col("event_id")))
                    .otherwise(good).alias("value")).write.text(path)
    rows = io.read_json(t.spark, path, "event_id long, who struct<user_id: long, event_type: string>, value double")
    return (rows.groupBy(F.col("who.event_type").alias("event_type"))
            .agg(F.count("_corrupt_record").alias("corrupt"), F.count("*").alias("n")))


@query("""SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 5000""")
def s05_catalog_table(t):
    name = io.save_table(t.supplier, "supplier_table")
    return t.spark.table(name).filter("s_acctbal > 5000").select("s_suppkey", "s_name")


@query("""SELECT o_orderpriority, 2 * count(*) + count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n
          FROM orders GROUP BY 1""")
def s06_create_append_table(t):
    cols = ["o_orderkey", "o_orderpriority"]
    name = io.save_table(t.orders.select(*cols), "orders_table")
    t.orders.select(*cols).write.mode("append").insertInto(name)
    t.orders.filter("o_orderstatus = 'F'").select(*cols).write.insertInto(name)
    return t.spark.table(name).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("""SELECT v.label, count(*) AS n FROM orders JOIN (VALUES ('O', 'open'), ('F', 'filled'), ('P', 'partial'))
          v(code, label) ON o_orderstatus = v.code GROUP BY 1""")
def s07_literal_rows(t):
    codes = t.spark.createDataFrame([("O", "open"), ("F", "filled"), ("P", "partial")], "code string, label string")
    return t.orders.join(codes, F.col("o_orderstatus") == F.col("code")).groupBy("label").agg(F.count("*").alias("n"))


@query("""SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 200000 GROUP BY 1""")
def s08_view_sql(t):
    return t.sql("select o_orderpriority, count(*) as n from orders where o_totalprice > :low group by 1",
                 "orders", low=200000)


@query("""SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1""")
def s09_csv_to_parquet(t):
    source, target = scratch(t.spark, "csv"), scratch(t.spark, "parquet")
    t.customer.withColumn("c_name", F.when(F.col("c_custkey") % 7 != 0, F.col("c_name"))).write.option(
        "header", True).csv(source)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return (io.csv_to_parquet(t.spark, source, target, schema, ["c_name"])
            .groupBy("c_mktsegment").agg(F.count("*").alias("n")))


@query("""SELECT c_mktsegment, count(*) AS n, min(c_custkey) AS first_key FROM customer GROUP BY 1""")
def s10_split_by_key(t):
    return (io.split_by_key(t.customer, "c_mktsegment", scratch(t.spark, "segments"))
            .groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_key")))


@query("""SELECT year(o_orderdate) AS y, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1996, 1998) GROUP BY 1""")
def s11_union_of_paths(t):
    root = scratch(t.spark, "years")
    io.write_parquet(t.orders.withColumn("y", F.year("o_orderdate")), root, ["y"])
    rows = io.union_of_paths(t.spark, [f"{root}/y={y}" for y in (1996, 1998, 2050)])
    return rows.groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderstatus, count(CASE WHEN o_orderdate >= '1999-01-01' THEN 1 END) AS with_clerk, count(*) AS n
          FROM orders GROUP BY 1""")
def s12_merge_schema(t):
    root = scratch(t.spark, "evolving")
    cut = F.col("o_orderdate") < "1999-01-01"
    t.orders.filter(cut).select("o_orderkey", "o_orderstatus").write.parquet(f"{root}/part=old")
    (t.orders.filter(~cut).select("o_orderkey", "o_orderstatus", F.lit("clerk").alias("clerk"))
     .write.parquet(f"{root}/part=new"))
    merged = t.spark.read.option("mergeSchema", True).parquet(root)
    return merged.groupBy("o_orderstatus").agg(F.count("clerk").alias("with_clerk"), F.count("*").alias("n"))


@query("""SELECT 'orders.parquet' AS file_name, count(*) AS n, count(*) AS stamped FROM orders""")
def s13_ingest_columns(t):
    rows = io.with_ingest_columns(t.orders)
    return (rows.groupBy(F.element_at(F.split("source_file", "/"), -1).alias("file_name"))
            .agg(F.count("*").alias("n"), F.count("ingested_at").alias("stamped")))


@query("""SELECT o_orderstatus, count(*) AS n, round(sum(l_extendedprice), 2) AS value
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def s14_bucketed_join(t):
    orders, lines = t.orders.select("o_orderkey", "o_orderstatus"), t.lineitem.select("l_orderkey", "l_extendedprice")
    buckets = io.bucket_count(orders, lines)
    left, right = io.save_table(orders, "orders_b", "o_orderkey", buckets), io.save_table(lines, "lineitem_b", "l_orderkey", buckets)
    joined = t.spark.table(left).join(t.spark.table(right), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("value"))


@query("""SELECT CAST(l_shipdate::DATE AS VARCHAR) AS day, count(*) AS n FROM lineitem GROUP BY 1""")
def s16_repartition_before_write(t):
    path = scratch(t.spark, "by_month")
    rows = t.lineitem.withColumn("m", F.date_format("l_shipdate", "yyyy-MM"))
    io.write_parquet(rows, path, ["m"], cluster=True)
    return t.spark.read.parquet(path).groupBy(text_day("l_shipdate").alias("day")).agg(F.count("*").alias("n"))


@query("""SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS avg_qty FROM lineitem GROUP BY 1
          UNION ALL SELECT 'all', count(*), round(avg(l_quantity), 6) FROM lineitem""")
def s17_persist(t):
    rows = io.keep(t.lineitem.select("l_returnflag", "l_quantity"))
    aggs = (F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("avg_qty"))
    return rows.groupBy("l_returnflag").agg(*aggs).unionByName(rows.agg(F.lit("all").alias("l_returnflag"), *aggs))


@query("""WITH d AS (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))::DATE AS day FROM orders)
          SELECT CAST(d.day AS VARCHAR) AS day, count(o_orderkey) AS n FROM d LEFT JOIN orders ON o_orderdate::DATE = d.day GROUP BY 1""")
def s18_date_spine(t):
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    days = io.date_spine(t.orders, "o_orderdate")
    return days.join(per_day, "day", "left").select(F.col("day").cast("string"), F.coalesce("n", F.lit(0)).alias("n"))


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0.99 * (SELECT max(o_totalprice) FROM orders)""")
def s19_scalar(t):
    return (t.orders.filter(F.col("o_totalprice") > 0.99 * io.scalar(t.orders, F.max("o_totalprice")))
            .select("o_orderkey", "o_totalprice"))

"""A: aggregations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import line_revenue, month, pct
from tidewater.operators import agg
from tidewater.plans.registry import query
from tidewater.sources.durable import durable

AGE = "date_diff('day', o_orderdate, TIMESTAMP '2002-01-01')"


@query("SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 6) AS mean, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders")
def a01_global(t):
    p = F.col("o_totalprice")
    return t.orders.agg(F.count("*").alias("n"), F.round(F.sum(p), 2).alias("total"), F.round(F.avg(p), 6).alias("mean"),
                        F.min(p).alias("low"), F.max(p).alias("high"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, round(avg(l_discount), 6) AS disc, min(l_extendedprice) AS low, max(l_extendedprice) AS high
          FROM lineitem GROUP BY 1, 2""")
def a02_group_by(t):
    return (t.lineitem.groupBy("l_returnflag", "l_linestatus")
            .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.round(F.avg("l_discount"), 6).alias("disc"),
                 F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")))


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")
def a03_count_distinct(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders"))


@query("SELECT event_type, true AS close_enough FROM events GROUP BY 1")
def a04_approx_count_distinct(t):
    # Beside an exact count every (type, user) group would hold a sketch of its own; repeats do not change a sketch.
    users = t.events.select("event_type", "user_id").distinct()
    counts = users.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("approx"), F.count("user_id").alias("exact"))
    return counts.select("event_type", (F.abs(F.col("approx") - F.col("exact")) <= 0.1 * F.col("exact")).alias("close_enough"))


@query("""SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned, count(CASE WHEN l_discount > 0.05 THEN 1 END) AS discounted FROM lineitem GROUP BY 1""")
def a05_conditional(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)).alias("returned"),
                                               F.count_if(F.col("l_discount") > 0.05).alias("discounted"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def a06_having(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n >= 12")


@query("""SELECT CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS month, CAST(floor(o_totalprice / 100000) AS BIGINT) AS band, count(*) AS n FROM orders GROUP BY 1, 2""")
def a07_group_by_expression(t):
    return (t.orders.groupBy(month("o_orderdate").cast("string").alias("month"), F.floor(F.col("o_totalprice") / 100000).alias("band"))
            .agg(F.count("*").alias("n")))


@query("""SELECT o_orderpriority, round(avg(n), 6) AS avg_orders, max(n) AS most FROM (SELECT o_orderpriority, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""")
def a08_two_step(t):
    per = t.orders.groupBy("o_orderpriority", "o_custkey").agg(F.count("*").alias("n"))
    return per.groupBy("o_orderpriority").agg(F.round(F.avg("n"), 6).alias("avg_orders"), F.max("n").alias("most"))


@query("SELECT l_returnflag, round(sum(l_extendedprice) / count(l_extendedprice), 6) AS mean FROM lineitem GROUP BY 1")
def a09_sum_and_count_average(t):
    salted = t.lineitem.groupBy("l_returnflag", F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(16)).alias("salt")).agg(
        F.sum("l_extendedprice").alias("s"), F.count("l_extendedprice").alias("c"))
    return salted.groupBy("l_returnflag").agg(F.round(F.sum("s") / F.sum("c"), 6).alias("mean"))


@query("""SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY 1""")
def a10_collect_set(t):
    # the set has at most five members: event types are made distinct before collecting
    kinds = t.events.select("user_id", "event_type").distinct()
    return kinds.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"))


@query("""SELECT r_name, string_agg(n_name, ', ' ORDER BY n_nationkey) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def a11_string_aggregate(t):
    return (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name")
            .agg(F.expr("listagg(n_name, ', ') within group (order by n_nationkey)").alias("nations")))


@query("""SELECT r_name, '[' || string_agg('"' || n_name || '"', ',' ORDER BY n_name) || ']' AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def a12_json_aggregate(t):
    return (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name")
            .agg(F.to_json(F.sort_array(F.collect_list("n_name"))).alias("names")))


@query("""SELECT event_type, string_agg(h || '=' || n, ';' ORDER BY h) AS hours FROM (SELECT event_type, hour(ts) AS h, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")
def a13_struct_array(t):
    hourly = t.events.groupBy("event_type", F.hour("ts").alias("h")).agg(F.count("*").alias("n"))     # 24 rows per type at most
    packed = hourly.groupBy("event_type").agg(F.sort_array(F.collect_list(F.struct("h", "n"))).alias("hours"))
    return packed.select("event_type", F.array_join(F.transform("hours", lambda x: F.concat_ws("=", x["h"].cast("string"), x["n"].cast("string"))), ";").alias("hours"))


@query("SELECT l_returnflag, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY 1")
def a14_median(t):
    return agg.exact_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", median=0.5).withColumn("median", F.round("median", 4))


@query("""SELECT event_type, quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1""")
def a15_approx_percentile(t):
    p = F.percentile_approx("value", [0.25, 0.5, 0.95], 10000)
    return t.events.groupBy("event_type").agg(p.alias("p")).select("event_type", F.col("p")[0].alias("p25"), F.col("p")[1].alias("p50"), F.col("p")[2].alias("p95"))


RANK_BOUND = 0.015      # rank error of a KLL sketch with k = 400


def _daily(t):
    return durable(agg.daily_sketches(t.events, ["event_type"], "ts", "value", distinct="user_id"), "daily-sketches")


@query()
def a15_merged_sketches(t):
    """Percentiles of a month of stored daily sketches; the test holds their rank error."""
    return agg.merged_quantiles(_daily(t), ["event_type"], [0.25, 0.5, 0.95])


@query(f"""SELECT event_type, p, count(value) AS n, {RANK_BOUND} AS bound, true AS within FROM events, (SELECT unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.95::DOUBLE]) AS p) GROUP BY 1, 2""")
def a15_rank_error(t):
    """Whether the shares of rows below and up to the merged percentiles enclose p, to the sketch's bound."""
    found = agg.merged_quantiles(_daily(t), ["event_type"], [0.25, 0.5, 0.95])
    error = agg.quantile_rank_error(t.events, durable(found, "percentiles"), ["event_type"], "value")
    return error.select("event_type", "p", "n", F.lit(RANK_BOUND).alias("bound"), (F.col("error") <= RANK_BOUND).alias("within"))


@query()
def a04_merged_estimates(t):
    """Distinct users by day, week and month, from unions of stored daily sketches."""
    return agg.merged_distinct(_daily(t), ["event_type"]).select("event_type", "unit", F.col("period").cast("string").alias("period"), "estimate")


@query("""SELECT event_type, unit, CAST(period AS VARCHAR) AS period, count(DISTINCT user_id) AS users, true AS within FROM
          (SELECT event_type, user_id, u.unit, CASE u.unit WHEN 'day' THEN ts::DATE WHEN 'week' THEN date_trunc('week', ts)::DATE ELSE date_trunc('month', ts)::DATE END AS period
           FROM events, (SELECT unnest(['day', 'week', 'month']) AS unit) u) GROUP BY 1, 2, 3""")
def a04_estimate_error(t):
    """Exact distinct users beside whether the merged estimate lies within four standard errors (1.6 % each at lg_k = 12)."""
    estimates = agg.merged_distinct(_daily(t), ["event_type"])
    daily = t.events.select("event_type", "user_id", F.to_date("ts").alias("day")).distinct()
    exact = reduce(DataFrame.unionByName, [daily.groupBy("event_type", F.lit(u).alias("unit"), F.to_date(F.date_trunc(u, "day")).alias("period")).agg(F.count_distinct("user_id").alias("users"))
                                           for u in ("day", "week", "month")])
    near = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col("users"))
    return exact.join(estimates, ["event_type", "unit", "period"]).select("event_type", "unit", F.col("period").cast("string").alias("period"), "users", near.alias("within"))


@query("SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1, 2")
def a03_distinct_by_bitmaps(t):
    return agg.distinct_by_bitmaps(t.lineitem, ["l_returnflag", "l_linestatus"], parts="l_partkey", orders="l_orderkey", suppliers="l_suppkey")


@query("""SELECT p_brand, p_size, n FROM (SELECT p_brand, p_size, count(*) AS n, rank() OVER (PARTITION BY p_brand ORDER BY count(*) DESC) AS r FROM part GROUP BY 1, 2) WHERE r = 1""")
def a16_mode(t):
    return agg.modes(t.part, ["p_brand"], "p_size")


@query("SELECT o_orderpriority, round(var_samp(o_totalprice) / 1000000, 4) AS variance_m, round(stddev_samp(o_totalprice), 4) AS sd FROM orders GROUP BY 1")
def a17_spread(t):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.variance("o_totalprice") / 1000000, 4).alias("variance_m"), F.round(F.stddev("o_totalprice"), 4).alias("sd"))


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1")
def a18_correlation(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"))


@query("SELECT l_suppkey, round(sqrt(avg(pow(l_extendedprice - 1500 * l_quantity, 2))), 4) AS rmse FROM lineitem GROUP BY 1")
def a19_rmse(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.sqrt(F.avg(F.pow(F.col("l_extendedprice") - 1500 * F.col("l_quantity"), 2))), 4).alias("rmse"))


@query("""SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS "A", sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS "N", sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS "R"
          FROM lineitem GROUP BY 1""")
def a20_static_pivot(t):
    return agg.pivot_sum(t.lineitem, ["l_suppkey"], "l_returnflag", ["A", "N", "R"], F.col("l_quantity"))


@query("SELECT user_id, " + ", ".join(f"sum(CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END) AS {v}" for v in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1")
def a21_dynamic_pivot(t):
    return agg.pivot_discovered(t.events, ["user_id"], "event_type", F.lit(1)).fillna(0)


@query("SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY 1")
def a22_first_last(t):
    at = F.struct("ts", "event_id")
    return t.events.groupBy("user_id").agg(F.min_by("event_type", at).alias("first_type"), F.max_by("event_type", at).alias("last_type"))


@query("""SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 HAVING count(DISTINCT p_brand) = (SELECT count(DISTINCT p_brand) FROM part)""")
def a23_all_of(t):
    return agg.divides(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), "l_suppkey", "p_brand", t.part)


@query("SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 3")
def a24_exactly_k(t):
    return t.orders.groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("k")).filter("k = 3").select("o_custkey")


@query("""SELECT p_type, round(sum(l_extendedprice), 2) AS value, round(100 * sum(l_extendedprice) / (SELECT sum(l_extendedprice) FROM lineitem JOIN part ON l_partkey = p_partkey), 6) AS share
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def a25_share_of_total(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return agg.share_of_total(rows, ["p_type"], F.col("l_extendedprice")).withColumn("value", F.round("value", 2))


@query("""SELECT p_type, round(sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice * (1 - l_discount) END), 4) AS open_net, round(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice * (1 - l_discount) END), 4) AS filled_net,
          round(100.0 * count(CASE WHEN l_linestatus = 'O' THEN 1 END) / count(*), 6) AS open_pct FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def a26_variant_split(t):
    side = lambda s: F.round(F.sum(F.when(F.col("l_linestatus") == s, line_revenue())), 4)
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type")
            .agg(side("O").alias("open_net"), side("F").alias("filled_net"), pct(F.count_if(F.col("l_linestatus") == "O"), F.count("*")).alias("open_pct")))

"""W: window computations over sliced order, so no key needs a task of its own."""

from pyspark.sql import functions as F

from tidewater.functions.columns import ratio
from tidewater.operators import ordered, rel
from tidewater.operators.behaviour import cumulative_distinct, flag_groups, streaks
from tidewater.plans.registry import query
from tidewater.sources.io import date_spine

EV = ["user_id", "ts", "event_id"]


def _events(t, *more):
    return t.events.select(*EV, *more)


def _daily(t):
    """Order value per calendar day, days without orders included."""
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("v"))
    return date_spine(t.orders, "o_orderdate").join(per_day, "day", "left").fillna(0.0, ["v"])


DAILY = """daily AS (SELECT d.day, coalesce(sum(o_totalprice), 0) AS v FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))::DATE AS day FROM orders) d
 LEFT JOIN orders ON o_orderdate::DATE = d.day GROUP BY 1)"""


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events")
def w01_row_number(t):
    return ordered.row_numbers(_events(t), ["user_id"], ["ts", "event_id"]).select("event_id", "rn")


@query("SELECT l_orderkey, l_linenumber, l_partkey, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS rank FROM lineitem")
def w02_rank(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    ranks = ordered.rank_table(rows, ["l_suppkey"], "l_quantity", True).select("l_suppkey", "l_quantity", F.col("rows").alias("_rows"), "rank")
    return rel.attach(rows, ranks, ["l_suppkey", "l_quantity"]).select("l_orderkey", "l_linenumber", "l_partkey", "rank")


@query("SELECT DISTINCT l_suppkey, l_quantity, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS dense_rank FROM lineitem")
def w03_dense_rank(t):
    return ordered.rank_table(t.lineitem, ["l_suppkey"], "l_quantity", True).select("l_suppkey", "l_quantity", "dense_rank")


@query("SELECT DISTINCT o_orderpriority, o_totalprice, round(percent_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice), 6) AS pr FROM orders")
def w04_percent_rank(t):
    return ordered.rank_table(t.orders, ["o_orderpriority"], "o_totalprice").select("o_orderpriority", "o_totalprice", F.round("percent_rank", 6).alias("pr"))


@query("SELECT DISTINCT c_nationkey, c_acctbal, round(cume_dist() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal), 6) AS cd FROM customer")
def w05_cume_dist(t):
    return ordered.rank_table(t.customer, ["c_nationkey"], "c_acctbal").select("c_nationkey", "c_acctbal", F.round("cume_dist", 6).alias("cd"))


@query("SELECT o_orderkey, ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS decile, ntile(4) OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS quartile FROM orders")
def w06_ntile(t):
    rows = ordered.ntile(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), [], ["o_totalprice", "o_orderkey"], 10, "decile")
    return ordered.ntile(rows, ["o_orderpriority"], ["o_totalprice", "o_orderkey"], 4, "quartile").select("o_orderkey", "decile", "quartile")


@query("""SELECT event_id, lag(value, 2, 0.0) OVER w AS prev2, coalesce(lag(value) OVER w, value) AS prev_or_self FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def w07_lag(t):
    rows = ordered.reach_back(_events(t, "value"), ["user_id"], ["ts", "event_id"], 2, prev2=lambda w: F.lag("value", 2).over(w),
                              prev=lambda w: F.lag("value").over(w))
    return rows.select("event_id", F.coalesce("prev2", F.lit(0.0)).alias("prev2"), F.coalesce("prev", "value").alias("prev_or_self"))


@query("SELECT event_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events")
def w08_lead(t):
    return ordered.reach_back(_events(t, "event_type"), ["user_id"], ["-ts", "-event_id"], 1, next_type=lambda w: F.lag("event_type").over(w)).select("event_id", "next_type")


@query("""SELECT event_id, first_value(value) OVER w AS first_value, last_value(value) OVER w AS last_value FROM events
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def w09_first_last_value(t):
    at = F.struct("ts", "event_id")
    return rel.with_group_stats(_events(t, "value"), ["user_id"], first_value=F.min_by("value", at), last_value=F.max_by("value", at)).select("event_id", "first_value", "last_value")


@query("SELECT event_id, round(sum(value) OVER w, 2) AS running, max(value) OVER w AS peak FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def w10_running(t):
    return ordered.scan(_events(t, "value"), ["user_id"], ["ts", "event_id"], running=("sum", "value"), peak=("max", "value")).select("event_id", F.round("running", 2).alias("running"), "peak")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sum(l_quantity) OVER (PARTITION BY l_suppkey) AS supplier_qty FROM lineitem")
def w11_partition_total(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return rel.with_group_stats(rows, ["l_suppkey"], supplier_qty=F.sum("l_quantity")).drop("l_quantity")


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving FROM events")
def w12_moving_rows(t):
    rows = t.events.select("event_type", "ts", "event_id", "value")
    return ordered.reach_back(rows, ["event_type"], ["ts", "event_id"], 6, moving=lambda w: F.round(F.avg("value").over(w.rowsBetween(-6, 0)), 6)).select("event_id", "moving")


@query("""SELECT DISTINCT user_id, CAST(ts::DATE AS VARCHAR) AS day, round(sum(value) OVER w, 2) AS total, count(*) OVER w AS n FROM events
          WINDOW w AS (PARTITION BY user_id ORDER BY ts::DATE RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")
def w13_moving_days(t):
    rows = t.events.withColumn("day", F.unix_date(F.to_date("ts")))
    sums = ordered.trailing_sums(rows, ["user_id"], "day", 7, total=F.col("value"), n=F.lit(1))
    return sums.select("user_id", F.date_from_unix_date("day").cast("string").alias("day"), F.round("total", 2).alias("total"), "n")


@query(f"""WITH {DAILY} SELECT CAST(day AS VARCHAR) AS day, round(avg(v) OVER (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 4) AS this_30,
           round(avg(v) OVER (ORDER BY day ROWS BETWEEN 59 PRECEDING AND 30 PRECEDING), 4) AS previous_30 FROM daily""")
def w14_lagged_frame(t):
    rows = ordered.reach_back(_daily(t), [], ["day"], 59, this_30=lambda w: F.round(F.avg("v").over(w.rowsBetween(-29, 0)), 4),
                              previous_30=lambda w: F.round(F.avg("v").over(w.rowsBetween(-59, -30)), 4))
    return rows.select(F.col("day").cast("string"), "this_30", "previous_30")


@query("""WITH f AS (SELECT o_custkey, l_partkey, min(o_orderdate)::DATE AS day FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2), n AS (SELECT o_custkey, day, count(*) AS fresh FROM f GROUP BY 1, 2)
          SELECT o_custkey, CAST(day AS VARCHAR) AS day, CAST(sum(fresh) OVER (PARTITION BY o_custkey ORDER BY day) AS BIGINT) AS parts_so_far FROM n""")
def w15_cumulative_distinct(t):
    bought = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("day", F.to_date("o_orderdate"))
    return cumulative_distinct(bought, ["o_custkey"], "day", "l_partkey", "parts_so_far").select("o_custkey", F.col("day").cast("string"), "parts_so_far")


@query("""WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events), g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island FROM d)
          SELECT user_id, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, count(*) AS days FROM g GROUP BY user_id, island""")
def w16_islands(t):
    return streaks(t.events, ["user_id"], "ts").select("user_id", F.col("first_day").cast("string"), F.col("last_day").cast("string"), "days")


@query("""WITH f AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS flag FROM events)
          SELECT event_id, CAST(sum(flag) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS grp FROM f""")
def w17_flag_and_cumulate(t):
    changed = lambda w: ~F.col("event_type").eqNullSafe(F.lag("event_type").over(w))
    return flag_groups(_events(t, "event_type"), ["user_id"], ["ts", "event_id"], changed, "grp").select("event_id", "grp")


@query("""WITH r AS (SELECT *, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS total FROM events)
          SELECT event_id, CAST(floor(round(total, 4) / 100) AS BIGINT) AS bucket, round(sum(value) OVER (PARTITION BY user_id, floor(round(total, 4) / 100) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS in_bucket FROM r""")
def w18_reset_running_total(t):
    total = ordered.scan(_events(t, "value"), ["user_id"], ["ts", "event_id"], total=("sum", "value"))
    bucketed = total.withColumn("bucket", F.floor(F.round("total", 4) / 100))
    return ordered.scan(bucketed, ["user_id", "bucket"], ["ts", "event_id"], in_bucket=("sum", "value")).select("event_id", "bucket", F.round("in_bucket", 4).alias("in_bucket"))


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, CAST(round(value, 2) AS DECIMAL(18, 2)) AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
          r AS (SELECT event_id, user_id, rn, 1::BIGINT AS segment, CAST(v AS DECIMAL(28, 2)) AS total FROM e WHERE rn = 1
                UNION ALL SELECT e.event_id, e.user_id, e.rn, r.segment + CASE WHEN r.total >= 250 THEN 1 ELSE 0 END, CAST(CASE WHEN r.total >= 250 THEN 0 ELSE r.total END + e.v AS DECIMAL(28, 2)) FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1)
          SELECT event_id, segment, total FROM r""")
def w18_reset_at_threshold(t):
    """Spending per user that starts anew after it has reached 250."""
    rows = _events(t, "value").withColumn("v", F.round("value", 2).cast("decimal(18,2)"))
    return ordered.reset_totals(rows, ["user_id"], ["ts", "event_id"], "v", 250).select("event_id", "segment", "total")


@query("""SELECT c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS nation_rank, rank() OVER (PARTITION BY n_regionkey ORDER BY c_acctbal DESC) AS region_rank, rank() OVER (ORDER BY c_acctbal DESC) AS world_rank
          FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def w19_several_partitions(t):
    out = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_nationkey", "n_regionkey", "c_acctbal")
    base = out
    for keys, name in ((["c_nationkey"], "nation_rank"), (["n_regionkey"], "region_rank"), ([], "world_rank")):
        ranks = ordered.rank_table(base, keys, "c_acctbal", True).select(*keys, "c_acctbal", F.col("rows").alias("_rows"), F.col("rank").alias(name))
        out = rel.attach(out, ranks, [*keys, "c_acctbal"])
    return out.select("c_custkey", "nation_rank", "region_rank", "world_rank")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - avg(l_extendedprice) OVER w) / stddev_samp(l_extendedprice) OVER w, 6) AS z FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)""")
def w20_z_score(t):
    x = F.col("l_extendedprice")
    rows = rel.with_group_stats(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), ["l_suppkey"], mean=F.avg(x), sd=F.stddev(x))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.round(ratio(x - F.col("mean"), F.col("sd")), 6).alias("z"))

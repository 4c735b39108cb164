"""B101, ordered packs: gaps, trailing means, balances, cohorts and neighbours in time."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.columns import growth, month, pct
from tidewater.operators import rel
from tidewater.operators.ordered import reach_back, scan, trailing_sums
from tidewater.plans.ranking import STAFF, staff
from tidewater.plans.registry import query


@query("""WITH e AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events) SELECT event_id, strftime(nxt, '%Y-%m-%d %H:%M:%S') AS next_start_time, CAST(floor((floor(epoch(nxt)) - floor(epoch(ts))) / 60) AS BIGINT) AS gap_minutes FROM e""")
def b101_gap_analysis(t):
    rows = reach_back(t.events.select("user_id", "ts", "event_id"), ["user_id"], ["-ts", "-event_id"], 1, nxt=lambda w: F.lag("ts").over(w))
    gap = F.floor((F.unix_timestamp("nxt") - F.unix_timestamp("ts")) / 60)
    return rows.select("event_id", F.date_format("nxt", "yyyy-MM-dd HH:mm:ss").alias("next_start_time"), gap.alias("gap_minutes"))


TRAILING = "avg(value) OVER (PARTITION BY user_id ORDER BY ts::DATE RANGE BETWEEN INTERVAL {0} DAYS PRECEDING AND CURRENT ROW)"


@query(f"""SELECT event_id, round(m7 + 1e-9, 6) AS avg_7d_amount, round(m30 + 1e-9, 6) AS avg_30d_amount, value > 3 * m7 AS is_suspicious FROM (SELECT *, {TRAILING.format(6)} AS m7, {TRAILING.format(29)} AS m30 FROM events)""")
def b101_trailing_fraud(t):
    rows = t.events.select("user_id", "event_id", "value", F.unix_date(F.to_date("ts")).alias("day"))
    out = rows
    for days in (7, 30):
        sums = trailing_sums(rows, ["user_id"], "day", days, s=F.col("value"), c=F.lit(1))
        sizes = rows.groupBy("user_id", "day").agg(F.count("*").alias("_rows"))
        means = sums.join(sizes, ["user_id", "day"]).select("user_id", "day", "_rows", (F.col("s") / F.col("c")).alias(f"m{days}"))
        out = rel.attach(out, means, ["user_id", "day"])
    return out.select("event_id", F.round(F.col("m7") + 1e-9, 6).alias("avg_7d_amount"), F.round(F.col("m30") + 1e-9, 6).alias("avg_30d_amount"), (F.col("value") > 3 * F.col("m7")).alias("is_suspicious"))


@query("""SELECT event_id, round(sum(CASE WHEN event_type = 'purchase' THEN -value ELSE value END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS running_balance FROM events""")
def b101_running_balance(t):
    signed = t.events.select("user_id", "ts", "event_id", F.when(F.col("event_type") == "purchase", -F.col("value")).otherwise(F.col("value")).alias("v"))
    return scan(signed, ["user_id"], ["ts", "event_id"], running_balance=("sum", "v")).select("event_id", F.round("running_balance", 2).alias("running_balance"))


@query("""WITH f AS (SELECT o_custkey, min(o_orderdate) AS d0 FROM orders GROUP BY 1), r AS (SELECT DISTINCT f.o_custkey FROM f JOIN orders o ON o.o_custkey = f.o_custkey AND o_orderdate > d0 AND o_orderdate <= d0 + INTERVAL 30 DAY)
          SELECT CAST(date_trunc('month', d0)::DATE AS VARCHAR) AS cohort_month, count(*) AS total_customers, count(r.o_custkey) AS retained_30d, round(100.0 * count(r.o_custkey) / count(*), 6) AS retention_rate FROM f LEFT JOIN r ON r.o_custkey = f.o_custkey GROUP BY 1""")
def b101_cohort_retention(t):
    days = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("d")).distinct()
    w = Window.partitionBy("o_custkey").orderBy("d")            # one row per customer and date
    second = days.withColumns({"rn": F.row_number().over(w), "gap": F.datediff(F.lead("d").over(w), "d")}).filter("rn = 1")
    back = F.count_if(F.col("gap") <= 30)
    return second.groupBy(month("d").cast("string").alias("cohort_month")).agg(F.count("*").alias("total_customers"), back.alias("retained_30d"), pct(back, F.count("*")).alias("retention_rate"))


@query("""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS order_count FROM orders GROUP BY 1), p AS (SELECT *, lag(order_count) OVER (ORDER BY month) AS prev_month_count FROM m) SELECT month, order_count, prev_month_count, round(100.0 * (order_count - prev_month_count) / prev_month_count, 6) AS growth_rate FROM p""")
def b101_monthly_orders(t):
    m = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("order_count"))
    rows = reach_back(m, [], ["month"], 1, prev_month_count=lambda w: F.lag("order_count").over(w))
    return rows.withColumn("growth_rate", growth(F.col("order_count"), F.col("prev_month_count")))


@query("""WITH c AS (SELECT *, lag(o_orderpriority) OVER w AS was FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)), k AS (SELECT * FROM c WHERE was IS DISTINCT FROM o_orderpriority)
          SELECT o_orderkey, CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::DATE AS VARCHAR) AS next_start_date FROM k""")
def b101_department_transfer(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    seen = reach_back(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], 1, was=lambda w: F.lag("o_orderpriority").over(w))
    moves = seen.filter(~F.col("was").eqNullSafe(F.col("o_orderpriority"))).drop("was")
    nxt = reach_back(moves, ["o_custkey"], ["-o_orderdate", "-o_orderkey"], 1, nxt=lambda w: F.lag("o_orderdate").over(w))
    return nxt.select("o_orderkey", F.to_date("nxt").cast("string").alias("next_start_date"))


@query(f"WITH {STAFF} SELECT e.id, s_name AS manager_name FROM staff e LEFT JOIN supplier ON s_suppkey = e.boss")
def b101_manager_names(t):
    names = t.supplier.select(F.col("s_suppkey").alias("boss"), F.col("s_name").alias("manager_name"))
    return staff(t).join(names, "boss", "left").select("id", "manager_name")


@query("""WITH d AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events), g AS (SELECT *, d - lag(d) OVER (PARTITION BY user_id ORDER BY d) AS date_diff, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS g FROM d)
          SELECT user_id, CAST(d AS VARCHAR) AS day, date_diff, row_number() OVER (PARTITION BY user_id, g ORDER BY d) AS consecutive_days FROM g""")
def b101_consecutive_logins(t):
    days = t.events.select("user_id", F.to_date("ts").alias("d")).distinct()
    w = Window.partitionBy("user_id").orderBy("d")              # one row per user and date
    marked = days.withColumns({"date_diff": F.datediff("d", F.lag("d").over(w)), "grp": F.unix_date("d") - F.row_number().over(w)})
    return marked.select("user_id", F.col("d").cast("string").alias("day"), "date_diff", F.row_number().over(Window.partitionBy("user_id", "grp").orderBy("d")).alias("consecutive_days"))


@query("""WITH d AS (SELECT l_partkey, l_shipdate::DATE AS day, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) SELECT l_partkey, round(avg(q), 6) AS daily_sales_avg, round(10.0 * p_size / avg(q), 6) AS days_of_supply FROM d JOIN part ON p_partkey = l_partkey GROUP BY 1, p_size""")
def b101_supply_days(t):
    daily = t.lineitem.groupBy("l_partkey", F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("q")).groupBy("l_partkey").agg(F.avg("q").alias("m"))
    rows = daily.join(t.part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select("l_partkey", F.round("m", 6).alias("daily_sales_avg"), F.round(10.0 * F.col("p_size") / F.col("m"), 6).alias("days_of_supply"))


@query("SELECT max(s_acctbal) AS second_highest_salary FROM supplier WHERE s_acctbal < (SELECT max(s_acctbal) FROM supplier)")
def b101_second_salary(t):
    return rel.nth_distinct(t.supplier, [], "s_acctbal", 2).select(F.col("s_acctbal").alias("second_highest_salary"))

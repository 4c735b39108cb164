"""B01–B19: ranking, averages, trends, streaks and gaps."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.columns import line_revenue, month
from tidewater.operators import graph, quality, rel
from tidewater.operators.behaviour import gaps, longest_streak, streaks
from tidewater.operators.commerce import period_growth
from tidewater.operators.ordered import reach_back, row_numbers, scan
from tidewater.plans.registry import query
from tidewater.sources.io import date_spine, scalar

STAFF = "staff AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey > 0 THEN s_suppkey // 3 END AS boss, s_nationkey AS dept, s_acctbal AS salary FROM supplier)"


def staff(t):
    """Suppliers as employees; the boss of n is n div 3 and 0 is the head."""
    boss = F.when(F.col("s_suppkey") > 0, F.floor(F.col("s_suppkey") / 3))
    return t.supplier.select(F.col("s_suppkey").alias("id"), boss.alias("boss"), F.col("s_nationkey").alias("dept"), F.col("s_acctbal").alias("salary"))


@query("""SELECT 'all' AS scope, (SELECT max(c_acctbal) FROM customer WHERE c_acctbal < (SELECT max(c_acctbal) FROM customer)) AS second
          UNION ALL SELECT c_mktsegment, max(c_acctbal) FROM customer c WHERE c_acctbal < (SELECT max(c_acctbal) FROM customer i WHERE i.c_mktsegment = c.c_mktsegment) GROUP BY 1""")
def b01_second_highest(t):
    overall = rel.nth_distinct(t.customer, [], "c_acctbal", 2).select(F.lit("all").alias("scope"), F.col("c_acctbal").alias("second"))
    return overall.unionByName(rel.nth_distinct(t.customer, ["c_mktsegment"], "c_acctbal", 2).select(F.col("c_mktsegment").alias("scope"), F.col("c_acctbal").alias("second")))


@query("""SELECT c_nationkey, c_custkey, CASE WHEN hi = 1 THEN 'highest' ELSE 'lowest' END AS side FROM (SELECT *, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS hi, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) AS lo FROM customer) WHERE hi = 1 OR lo = 1""")
def b02_highest_and_lowest(t):
    rows = t.customer.select("c_nationkey", "c_custkey", "c_acctbal")
    side = lambda high, name: rel.best_rows(rows, ["c_nationkey"], "c_acctbal", high).select("c_nationkey", "c_custkey", F.lit(name).alias("side"))
    return side(True, "highest").unionByName(side(False, "lowest"))


@query("""SELECT p_type, p_partkey, round(revenue, 4) AS revenue, rk FROM (SELECT p_type, p_partkey, sum(l_extendedprice * (1 - l_discount)) AS revenue, rank() OVER (PARTITION BY p_type ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC) AS rk
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) WHERE rk <= 5""")
def b03_top_n_per_category(t):
    # revenue is summed per part before the join, so the join sees one row per part
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum(line_revenue()).alias("revenue"))
    sums = t.part.select("p_partkey", "p_type").join(sold, "p_partkey")
    return rel.top_k(sums, ["p_type"], ["-revenue"], 5, "all").select("p_type", "p_partkey", F.round("revenue", 4).alias("revenue"), "rk")


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > avg(o_totalprice) OVER (PARTITION BY o_orderpriority) THEN 'above' WHEN o_totalprice < avg(o_totalprice) OVER (PARTITION BY o_orderpriority) THEN 'below' ELSE 'equal' END AS side FROM orders""")
def b04_above_below_average(t):
    rows = rel.with_group_stats(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderpriority"], mean=F.avg("o_totalprice"))
    p, m = F.col("o_totalprice"), F.col("mean")
    return rows.select("o_orderkey", F.when(p > m, "above").when(p < m, "below").otherwise("equal").alias("side"))


@query(f"""WITH {STAFF} SELECT e.id, e.salary > m.salary AS earns_more, e.dept = m.dept AS same_dept FROM staff e JOIN staff m ON e.boss = m.id""")
def b05_versus_manager(t):
    people = staff(t)
    boss = people.select(F.col("id").alias("boss"), F.col("salary").alias("m_salary"), F.col("dept").alias("m_dept"))
    return people.join(boss, "boss").select("id", (F.col("salary") > F.col("m_salary")).alias("earns_more"), (F.col("dept") == F.col("m_dept")).alias("same_dept"))


@query(f"""WITH RECURSIVE {STAFF}, r AS (SELECT id, boss AS top, 1 AS depth FROM staff WHERE boss IS NOT NULL UNION ALL SELECT r.id, s.boss, depth + 1 FROM r JOIN staff s ON r.top = s.id WHERE s.boss IS NOT NULL)
          SELECT top AS manager, count(*) AS reports, count(CASE WHEN depth = 1 THEN 1 END) AS direct, max(depth) AS levels FROM r GROUP BY 1""")
def b06_org_hierarchy(t):
    return graph.ancestors(staff(t), "id", "boss").groupBy(F.col("ancestor").alias("manager")).agg(
        F.count("*").alias("reports"), F.count_if(F.col("depth") == 1).alias("direct"), F.max("depth").alias("levels"))


@query("SELECT n_name, count(c_custkey) AS heads FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def b07_headcount(t):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("heads"))
    return t.nation.join(counts, "n_nationkey", "left").select("n_name", F.coalesce("heads", F.lit(0)).alias("heads"))


@query("SELECT p_name, p_brand, count(*) AS copies FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def b08_duplicates(t):
    return quality.duplicates(t.part, ["p_name", "p_brand"])


@query("SELECT l_orderkey, l_linenumber, min(l_shipdate)::DATE::VARCHAR AS first_ship FROM lineitem GROUP BY 1, 2")
def b09_remove_duplicates(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.unix_date(F.to_date("l_shipdate")).alias("d"))
    kept = quality.keep_latest(rows.withColumn("age", -F.col("d")), ["l_orderkey", "l_linenumber"], "age")
    return kept.select("l_orderkey", "l_linenumber", F.date_from_unix_date("d").cast("string").alias("first_ship"))


@query("SELECT 'customer' AS kind, c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1999) UNION ALL SELECT 'part', p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_shipdate >= '2001-01-01')")
def b10_never_did(t):
    buyers = t.orders.filter(F.year("o_orderdate") == 1999).select(F.col("o_custkey").alias("id"))
    sold = t.lineitem.filter("l_shipdate >= '2001-01-01'").select(F.col("l_partkey").alias("id"))
    absent = lambda df, key, did, kind: rel.absent(df.select(F.col(key).alias("id")), did, ["id"]).select(F.lit(kind).alias("kind"), "id")
    return absent(t.customer, "c_custkey", buyers, "customer").unionByName(absent(t.part, "p_partkey", sold, "part"))


@query("SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running FROM orders")
def b11_running_total(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return scan(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], running=("sum", "o_totalprice")).select("o_orderkey", F.round("running", 2).alias("running"))


@query("""WITH d AS (SELECT o_orderdate::DATE AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1) SELECT CAST(day AS VARCHAR) AS day, round(avg(v) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS avg_7_rows,
          round(sum(v) OVER (ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW), 2) AS sum_30_days FROM d""")
def b12_moving_average(t):
    from tidewater.operators.ordered import trailing_sums
    days = t.orders.groupBy(F.unix_date(F.to_date("o_orderdate")).alias("day")).agg(F.sum("o_totalprice").alias("v"))
    rows = reach_back(days, [], ["day"], 6, avg_7_rows=lambda w: F.round(F.avg("v").over(w.rowsBetween(-6, 0)), 4))
    sums = trailing_sums(days, [], "day", 30, sum_30_days=F.col("v"))
    return rows.join(sums, "day").select(F.date_from_unix_date("day").cast("string").alias("day"), "avg_7_rows", F.round("sum_30_days", 2).alias("sum_30_days"))


@query("""WITH m AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, sum(o_totalprice) AS v FROM orders GROUP BY 1) SELECT CAST(m AS VARCHAR) AS month, round(v, 2) AS value, round(100 * (v - lag(v) OVER (ORDER BY m)) / lag(v) OVER (ORDER BY m), 6) AS growth_pct FROM m""")
def b13_month_over_month(t):
    return period_growth(t.orders, month("o_orderdate"), F.col("o_totalprice")).select(F.col("period").cast("string").alias("month"), F.round("value", 2).alias("value"), "growth_pct")


@query("""WITH y AS (SELECT n_name, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            WHERE (month(o_orderdate), day(o_orderdate)) <= (SELECT (month(max(o_orderdate)), day(max(o_orderdate))) FROM orders) GROUP BY 1, 2)
          SELECT n_name, y, round(v, 2) AS value, round(100 * (v - lag(v) OVER w) / lag(v) OVER w, 6) AS growth_pct FROM y WINDOW w AS (PARTITION BY n_name ORDER BY y)""")
def b14_year_over_year(t):
    """Every year is cut at the month and day the data end, so the last year compares fairly."""
    cut = scalar(t.orders, F.date_format(F.max("o_orderdate"), "MM-dd"))
    rows = (t.orders.filter(F.date_format("o_orderdate", "MM-dd") <= cut).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")))
    return period_growth(rows, F.year("o_orderdate"), F.col("o_totalprice"), ["n_name"]).select("n_name", F.col("period").alias("y"), F.round("value", 2).alias("value"), "growth_pct")


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders WHERE o_orderdate < '2001-01-01' GROUP BY 1, 2), d AS (SELECT o_custkey, v - lag(v) OVER (PARTITION BY o_custkey ORDER BY y) AS d FROM y)
          SELECT o_custkey, min(d) > 0 AS rising, max(d) <= 0 AS never_rising FROM d WHERE d IS NOT NULL GROUP BY 1 HAVING min(d) > 0 OR max(d) <= 0""")
def b15_strict_trend(t):
    yearly = t.orders.filter("o_orderdate < '2001-01-01'").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("v"))
    step = yearly.withColumn("d", F.col("v") - F.lag("v").over(Window.partitionBy("o_custkey").orderBy("y"))).filter("d is not null")
    return (step.groupBy("o_custkey").agg((F.min("d") > 0).alias("rising"), (F.max("d") <= 0).alias("never_rising")).filter("rising or never_rising"))


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2), d AS (SELECT *, v < lag(v) OVER w AND lag(v) OVER w < lag(v, 2) OVER w AND lag(v, 2) OVER w < lag(v, 3) OVER w AS falls FROM y WINDOW w AS (PARTITION BY o_custkey ORDER BY y))
          SELECT o_custkey, CAST(y AS INTEGER) AS y FROM d WHERE falls""")
def b15_declines_in_a_row(t):
    """Customers and years that end three declines in a row; one row per customer and year enters the window."""
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("v"))
    by_year = Window.partitionBy("o_custkey").orderBy("y")
    falls = yearly.withColumn("falls", (F.col("v") < F.lag("v").over(by_year)).cast("int"))
    return falls.withColumn("run", F.sum("falls").over(by_year.rowsBetween(-2, 0))).filter("run = 3").select("o_custkey", "y")


@query("""WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events), g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island FROM d)
          SELECT user_id, CAST(min(day) AS VARCHAR) AS first_day, count(*) AS days FROM g GROUP BY user_id, island HAVING count(*) >= 5""")
def b16_consecutive_days(t):
    return streaks(t.events, ["user_id"], "ts").filter("days >= 5").select("user_id", F.col("first_day").cast("string"), "days")


@query("""WITH h AS (SELECT event_id, event_id - row_number() OVER (ORDER BY event_id) AS island FROM events WHERE value > 60) SELECT min(event_id) AS first_id, max(event_id) AS last_id, count(*) AS n FROM h GROUP BY island HAVING count(*) >= 3""")
def b16_consecutive_rows(t):
    high = row_numbers(t.events.filter("value > 60").select("event_id"), [], ["event_id"])
    runs = high.groupBy((F.col("event_id") - F.col("rn")).alias("island")).agg(F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"), F.count("*").alias("n"))
    return runs.filter("n >= 3").drop("island")


@query("""WITH d AS (SELECT DISTINCT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) AS m FROM orders), g AS (SELECT *, m - row_number() OVER (PARTITION BY o_custkey ORDER BY m) AS island FROM d)
          SELECT o_custkey, max(n) AS longest FROM (SELECT o_custkey, island, count(*) AS n FROM g GROUP BY 1, 2) GROUP BY 1""")
def b17_longest_streak(t):
    return longest_streak(t.orders, ["o_custkey"], "o_orderdate", "month")


@query("""WITH g AS (SELECT o_custkey, date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS gap FROM orders) SELECT o_custkey, round(avg(gap), 6) AS avg_gap, max(gap) AS longest_gap FROM g WHERE gap IS NOT NULL GROUP BY 1""")
def b18_time_between(t):
    rows = gaps(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], "o_orderdate", ["o_orderkey"]).filter("gap_seconds is not null")
    days = F.col("gap_seconds") / 86400
    return rows.groupBy("o_custkey").agg(F.round(F.avg(days), 6).alias("avg_gap"), F.max(days).cast("long").alias("longest_gap"))


@query("""SELECT 'day' AS kind, CAST(d::DATE AS VARCHAR) AS missing FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders) WHERE d NOT IN (SELECT o_orderdate FROM orders)
          UNION ALL SELECT 'order', CAST(i AS VARCHAR) FROM (SELECT unnest(generate_series(min(l_orderkey), max(l_orderkey))) AS i FROM lineitem) WHERE i NOT IN (SELECT l_orderkey FROM lineitem)""")
def b19_missing_values(t):
    present = t.orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    days = date_spine(t.orders, "o_orderdate").join(present, "day", "left_anti").select(F.lit("day").alias("kind"), F.col("day").cast("string").alias("missing"))
    # ids are read off the gaps between neighbours: no list of all ids is built
    ids = t.lineitem.select(F.col("l_orderkey").alias("id")).distinct()
    after = reach_back(ids, [], ["id"], 1, before=lambda w: F.lag("id").over(w)).filter("id > before + 1")
    holes = after.select(F.explode(F.sequence(F.col("before") + 1, F.col("id") - 1)).alias("id")).select(F.lit("order").alias("kind"), F.col("id").cast("string").alias("missing"))
    return days.unionByName(holes)

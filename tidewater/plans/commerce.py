"""B52–B100: fulfilment, stock, margin, scores, forecasts, events, text, people, revenue."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.columns import bands, business_days, grid_cell, line_revenue, month, pct, ratio
from tidewater.operators import agg, behaviour as B, commerce as C, graph, nested, quality, rel
from tidewater.operators.ordered import as_of, rank_table, reach_back, row_numbers, scan
from tidewater.plans.registry import query
from tidewater.sources.durable import durable
from tidewater.sources.io import scalar

LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def _lines(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query(f"""WITH d AS (SELECT o_orderpriority, date_diff('day', o_orderdate, l_shipdate) AS delay FROM {LINES}) SELECT o_orderpriority, count(*) AS lines, round(avg(delay), 6) AS avg_delay, round(100.0 * count(CASE WHEN delay < 0 THEN 1 END) / count(*), 6) AS early_pct,
          round(100.0 * count(CASE WHEN delay BETWEEN 0 AND 60 THEN 1 END) / count(*), 6) AS on_time_pct, round(100.0 * count(CASE WHEN delay > 60 THEN 1 END) / count(*), 6) AS late_pct FROM d GROUP BY 1""")
def b52_fulfilment(t):
    d = F.datediff("l_shipdate", "o_orderdate")
    n = F.count("*")
    return _lines(t).groupBy("o_orderpriority").agg(n.alias("lines"), F.round(F.avg(d), 6).alias("avg_delay"), pct(F.count_if(d < 0), n).alias("early_pct"), pct(F.count_if(d.between(0, 60)), n).alias("on_time_pct"), pct(F.count_if(d > 60), n).alias("late_pct"))


@query("""SELECT p_partkey, round(10.0 * p_size / (s.qty / s.days), 6) AS coverage_days, round(s.qty / (10.0 * p_size), 6) AS turnover FROM part JOIN (SELECT l_partkey, sum(l_quantity) AS qty, date_diff('day', min(l_shipdate), max(l_shipdate)) + 1 AS days FROM lineitem GROUP BY 1) s ON l_partkey = p_partkey""")
def b53_stock_coverage(t):
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("qty"), (F.datediff(F.max("l_shipdate"), F.min("l_shipdate")) + 1).alias("days"))
    stock = F.col("p_size") * 10.0
    return t.part.join(sold, "p_partkey").select("p_partkey", F.round(ratio(stock, F.col("qty") / F.col("days")), 6).alias("coverage_days"), F.round(ratio(F.col("qty"), stock), 6).alias("turnover"))


@query("WITH d AS (SELECT user_id, ts::DATE AS day, min(value) < 1 AS out FROM events GROUP BY 1, 2) SELECT user_id, count(*) AS days, round(100.0 * count(CASE WHEN out THEN 1 END) / count(*), 6) AS stockout_pct FROM d GROUP BY 1")
def b54_stockout_rate(t):
    days = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg((F.min("value") < 1).alias("out"))
    return days.groupBy("user_id").agg(F.count("*").alias("days"), pct(F.count_if(F.col("out")), F.count("*")).alias("stockout_pct"))


@query("""WITH m AS (SELECT l_partkey, 100 * (1 - p_retailprice * 0.5 / avg(l_extendedprice / l_quantity)) AS margin FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, p_retailprice), r AS (SELECT *, percent_rank() OVER (ORDER BY round(margin, 6)) AS pr FROM m)
          SELECT l_partkey, round(margin, 6) AS margin, CASE WHEN margin < 0 THEN 'loss' WHEN margin < 60 THEN 'thin' WHEN margin < 80 THEN 'normal' ELSE 'wide' END AS band, CASE WHEN pr >= 0.9 THEN 'lower price' WHEN pr <= 0.1 THEN 'raise price' ELSE 'keep' END AS advice FROM r""")
def b55_margin_analysis(t):
    unit = t.lineitem.groupBy("l_partkey").agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"))
    m = unit.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("raw", 100 * (1 - F.col("p_retailprice") * 0.5 / F.col("unit"))).select("l_partkey", "raw", F.round("raw", 6).alias("margin"))
    m = durable(m, "margin")
    ranks = rank_table(m, [], "margin").select("margin", "percent_rank")
    advice = F.when(F.col("percent_rank") >= 0.9, "lower price").when(F.col("percent_rank") <= 0.1, "raise price").otherwise("keep")
    return rel.match(m, ranks, ["margin"]).select("l_partkey", "margin", bands(F.col("raw"), (0, "loss"), (60, "thin"), (80, "normal"), other="wide").alias("band"), advice.alias("advice"))


@query("SELECT p_brand, round(sum(l_extendedprice), 2) AS gross, round(sum(l_extendedprice * l_discount), 4) AS discount, round(sum(l_extendedprice * (1 - l_discount)), 4) AS net FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R' GROUP BY 1")
def b56_net_revenue(t):
    rows = t.lineitem.filter("l_returnflag <> 'R'").join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("p_brand").agg(F.round(F.sum("l_extendedprice"), 2).alias("gross"), F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 4).alias("discount"), F.round(F.sum(line_revenue()), 4).alias("net"))


@query("SELECT p_brand, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned, round(100 * sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity), 6) AS return_pct FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def b57_return_rate(t):
    back = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(back.alias("returned"), pct(back, F.sum("l_quantity")).alias("return_pct"))


@query("SELECT CAST(ts::DATE AS VARCHAR) AS day, count(CASE WHEN event_type = 'view' THEN 1 END) AS impressions, count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks, round(100.0 * count(CASE WHEN event_type = 'click' THEN 1 END) / count(CASE WHEN event_type = 'view' THEN 1 END), 6) AS ctr FROM events GROUP BY 1")
def b58_click_through(t):
    n = lambda k: F.count_if(F.col("event_type") == k)
    return t.events.groupBy(F.to_date("ts").cast("string").alias("day")).agg(n("view").alias("impressions"), n("click").alias("clicks"), pct(n("click"), n("view")).alias("ctr"))


@query("""WITH r AS (SELECT event_type, ts::DATE AS day, least(5, 1 + CAST(floor(value / 20) AS BIGINT)) AS stars FROM events), d AS (SELECT event_type, day, avg(stars) AS mean, count(CASE WHEN stars = 5 THEN 1 END) AS five, count(CASE WHEN stars <= 2 THEN 1 END) AS low, count(*) AS n FROM r GROUP BY 1, 2)
          SELECT event_type, CAST(day AS VARCHAR) AS day, round(mean, 6) AS mean, five, low, round(avg(mean) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS trend FROM d""")
def b59_ratings(t):
    stars = F.least(F.lit(5), 1 + F.floor(F.col("value") / 20))
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg(stars).alias("mean"), F.count_if(stars == 5).alias("five"), F.count_if(stars <= 2).alias("low"))
    w = Window.partitionBy("event_type").orderBy("day").rowsBetween(-2, 0)       # one row per day
    return daily.select("event_type", F.col("day").cast("string"), F.round("mean", 6).alias("mean"), "five", "low", F.round(F.avg("mean").over(w), 6).alias("trend"))


@query("""WITH s AS (SELECT l_suppkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1) SELECT n_name, s_suppkey, revenue, rank() OVER (PARTITION BY n_name ORDER BY revenue DESC) AS place FROM s JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def b60_ranking_board(t):
    sums = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    rows = sums.join(t.supplier, "s_suppkey").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "s_suppkey", "revenue")
    ranks = rank_table(rows, ["n_name"], "revenue", True).select("n_name", "revenue", F.col("rank").alias("place"))
    return rel.match(rows, ranks, ["n_name", "revenue"])


@query("""WITH m AS (SELECT o_custkey, sum(o_totalprice) AS money, count(*) AS freq, date_diff('day', max(o_orderdate), TIMESTAMP '2001-08-02') AS idle FROM orders GROUP BY 1), z AS (SELECT o_custkey, 0.5 * (money - avg(money) OVER ()) / stddev_samp(money) OVER () + 0.3 * (freq - avg(freq) OVER ()) / stddev_samp(freq) OVER () - 0.2 * (idle - avg(idle) OVER ()) / stddev_samp(idle) OVER () AS score FROM m)
          SELECT o_custkey, round(score, 6) AS score, CASE WHEN score < -0.5 THEN 'low' WHEN score < 0.5 THEN 'middle' ELSE 'high' END AS band FROM z""")
def b61_composite_score(t):
    m = durable(t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("money"), F.count("*").alias("freq"), F.datediff(F.lit("2001-08-02"), F.max("o_orderdate")).alias("idle")), "metrics")
    z = lambda c: ratio(F.col(c) - scalar(m, F.avg(c)), scalar(m, F.stddev(c)))
    s = m.withColumn("score", 0.5 * z("money") + 0.3 * z("freq") - 0.2 * z("idle"))
    return s.select("o_custkey", F.round("score", 6).alias("score"), bands(F.col("score"), (-0.5, "low"), (0.5, "middle"), other="high").alias("band"))


@query("""WITH m AS (SELECT l_suppkey, round(sum(l_extendedprice), 2) AS revenue, avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) AS return_share, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1), q AS (SELECT quantile_disc(revenue, 0.9) AS p90, quantile_disc(revenue, 0.5) AS p50 FROM m)
          SELECT l_suppkey, revenue, round(return_share, 6) AS return_share, parts, CASE WHEN revenue >= p90 THEN 'gold' WHEN revenue >= p50 THEN 'silver' ELSE 'bronze' END AS tier FROM m, q""")
def b62_supplier_performance(t):
    m = durable(t.lineitem.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.round(F.avg((F.col("l_returnflag") == "R").cast("double")), 6).alias("return_share"), F.count_distinct("l_partkey").alias("parts")), "suppliers")
    q = durable(agg.exact_quantiles(m, [], "revenue", continuous=False, p90=0.9, p50=0.5), "cuts")
    tier = F.when(F.col("revenue") >= scalar(q, F.max("p90")), "gold").when(F.col("revenue") >= scalar(q, F.max("p50")), "silver").otherwise("bronze")
    return m.withColumn("tier", tier)


@query("""WITH g AS (SELECT CAST(floor(((c_custkey % 170) - 85.0) / 30) AS BIGINT) || ':' || CAST(floor(((c_custkey * 7 % 360) - 180.0) / 30) AS BIGINT) AS cell, sum(o_totalprice) AS v, count(DISTINCT c_custkey) AS customers FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1) SELECT cell, round(v, 2) AS value, customers FROM g ORDER BY v DESC LIMIT 10""")
def b63_top_cells(t):
    spend = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("v"))
    k = F.col("c_custkey")
    cells = t.customer.join(spend, "c_custkey").groupBy(grid_cell((k % 170) - 85.0, (k * 7 % 360) - 180.0, 30).alias("cell")).agg(F.sum("v").alias("v"), F.count("*").alias("customers"))
    return cells.orderBy(F.desc("v")).limit(10).select("cell", F.round("v", 2).alias("value"), "customers")


@query("""WITH m AS (SELECT p_type, date_trunc('month', l_shipdate) AS m, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), s AS (SELECT p_type, month(m) AS mon, avg(q) AS avg_q FROM m GROUP BY 1, 2), i AS (SELECT *, avg_q / avg(avg_q) OVER (PARTITION BY p_type) AS idx FROM s)
          SELECT p_type, mon, round(idx, 6) AS idx, row_number() OVER (PARTITION BY p_type ORDER BY round(idx, 9) DESC, mon) = 1 AS peak FROM i""")
def b64_seasonality(t):
    monthly = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type", month("l_shipdate").alias("m")).agg(F.sum("l_quantity").alias("q"))
    seasonal = monthly.groupBy("p_type", F.month("m").alias("mon")).agg(F.avg("q").alias("avg_q"))
    w = Window.partitionBy("p_type")             # twelve rows per type
    idx = seasonal.withColumn("idx", F.col("avg_q") / F.avg("avg_q").over(w))
    peak = F.row_number().over(w.orderBy(F.desc(F.round("idx", 9)), "mon")) == 1
    return idx.select("p_type", "mon", F.round("idx", 6).alias("idx"), peak.alias("peak"))


@query("""WITH d AS (SELECT o_orderdate::DATE AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1), e AS (SELECT *, v - lag(v) OVER (ORDER BY day) AS miss FROM d) SELECT dayofweek(day) + 1 AS dow, round(avg(v), 4) AS mean, round(avg(v) - 1.96 * stddev_samp(v), 4) AS low, round(avg(v) + 1.96 * stddev_samp(v), 4) AS high, round(sqrt(avg(pow(miss, 2))), 4) AS naive_rmse FROM e GROUP BY 1""")
def b65_forecast_band(t):
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("v"))
    steps = reach_back(days, [], ["day"], 1, miss=lambda w: F.col("v") - F.lag("v").over(w))
    mean, sd = F.avg("v"), F.stddev("v")
    return steps.groupBy(F.dayofweek("day").alias("dow")).agg(F.round(mean, 4).alias("mean"), F.round(mean - 1.96 * sd, 4).alias("low"), F.round(mean + 1.96 * sd, 4).alias("high"), F.round(F.sqrt(F.avg(F.pow("miss", F.lit(2)))), 4).alias("naive_rmse"))


@query("WITH v AS (SELECT o_custkey, sum(o_totalprice) AS x FROM orders GROUP BY 1), r AS (SELECT x, row_number() OVER (ORDER BY x) AS i FROM v) SELECT round(2 * sum(i * x) / (count(*) * sum(x)) - (count(*) + 1) / count(*), 6) AS gini FROM r")
def b66_gini(t):
    return agg.gini(t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("x")), "x").select(F.round("gini", 6).alias("gini"))


@query("WITH d AS (SELECT year(o_orderdate) AS y, o_orderdate::DATE AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2), c AS (SELECT *, sum(v) OVER (PARTITION BY y ORDER BY day) AS cum, sum(v) OVER (PARTITION BY y) AS tot FROM d) SELECT y, CAST(min(day) AS VARCHAR) AS median_day FROM c WHERE cum >= tot / 2 GROUP BY 1")
def b67_median_day(t):
    days = t.orders.groupBy(F.year("o_orderdate").alias("y"), F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("v"))
    run = days.withColumns({"cum": F.sum("v").over(Window.partitionBy("y").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)), "tot": F.sum("v").over(Window.partitionBy("y"))})      # 366 rows per year
    return run.filter("cum >= tot / 2").groupBy("y").agg(F.min("day").cast("string").alias("median_day"))


@query("SELECT c_nationkey, round(median(c_acctbal), 4) AS median FROM customer GROUP BY 1")
def b68_median_by_group(t):
    return agg.exact_quantiles(t.customer, ["c_nationkey"], "c_acctbal", median=0.5).withColumn("median", F.round("median", 4))


@query("""SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.1), 4) AS p10, round(quantile_cont(o_totalprice, 0.25), 4) AS q1, round(quantile_cont(o_totalprice, 0.75), 4) AS q3, round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM orders GROUP BY 1""")
def b69_percentile_thresholds(t):
    q = agg.exact_quantiles(t.orders, ["o_orderpriority"], "o_totalprice", p10=0.1, q1=0.25, q3=0.75, p90=0.9)
    return q.select("o_orderpriority", *[F.round(c, 4).alias(c) for c in ("p10", "q1", "q3", "p90")])


@query("SELECT CAST(floor(n / 2) AS BIGINT) AS band, count(*) AS customers FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1")
def b70_histogram(t):
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return per.groupBy(F.floor(F.col("n") / 2).alias("band")).agg(F.count("*").alias("customers"))


STAYS = "st AS (SELECT o_orderkey AS id, o_custkey AS k, o_orderdate::DATE AS s, o_orderdate::DATE + CAST(10 + o_orderkey % 40 AS INTEGER) AS e FROM orders)"


def _stays(t):
    """Each order as a stay of 10–49 days."""
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("s"), F.date_add(F.to_date("o_orderdate"), (10 + F.col("o_orderkey") % 40).cast("int")).alias("e"))


@query(f"WITH {STAYS} SELECT a.k, a.id AS left_id, b.id AS right_id FROM st a JOIN st b ON a.k = b.k AND a.id < b.id AND a.s <= b.e AND b.s <= a.e")
def b71_interval_overlap(t):
    return rel.overlapping_pairs(_stays(t), ["k"], "id", "s", "e")


@query(f"WITH {STAYS}, x AS (SELECT s AS t, 1 AS d FROM st UNION ALL SELECT e, -1 FROM st), r AS (SELECT sum(d) OVER (ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS n FROM x), y AS (SELECT k, s AS t, 1 AS d FROM st UNION ALL SELECT k, e, -1 FROM st), z AS (SELECT k, sum(d) OVER (PARTITION BY k ORDER BY t, d DESC ROWS UNBOUNDED PRECEDING) AS n FROM y) SELECT -1 AS k, CAST(max(n) AS BIGINT) AS peak FROM r UNION ALL SELECT k, CAST(max(n) AS BIGINT) FROM z GROUP BY 1")
def b72_max_concurrency(t):
    overall = C.max_concurrency(_stays(t), [], "s", "e").select(F.lit(-1).cast("long").alias("k"), "peak")
    return overall.unionByName(C.max_concurrency(_stays(t), ["k"], "s", "e", closed=True))


@query("""WITH v AS (SELECT *, CASE WHEN lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus THEN 1 ELSE 0 END AS f FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)), g AS (SELECT *, sum(f) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS g FROM v)
          SELECT o_custkey, o_orderstatus, CAST(min(o_orderdate)::DATE AS VARCHAR) AS from_day, CAST(max(o_orderdate)::DATE AS VARCHAR) AS to_day, count(*) AS n FROM g GROUP BY o_custkey, o_orderstatus, g""")
def b73_constant_periods(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    groups = B.flag_groups(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], lambda w: ~F.col("o_orderstatus").eqNullSafe(F.lag("o_orderstatus").over(w)))
    return groups.groupBy("o_custkey", "o_orderstatus", "grp").agg(F.to_date(F.min("o_orderdate")).cast("string").alias("from_day"), F.to_date(F.max("o_orderdate")).cast("string").alias("to_day"), F.count("*").alias("n")).drop("grp")


@query("""SELECT user_id FROM events GROUP BY 1 HAVING max(CASE WHEN event_type = 'signup' THEN ts END) > coalesce(max(CASE WHEN event_type = 'error' THEN ts END), TIMESTAMP '1970-01-01')""")
def b74_currently_in(t):
    last = lambda k: F.max(F.when(F.col("event_type") == k, F.col("ts")))
    out = t.events.groupBy("user_id").agg(last("signup").alias("came"), last("error").alias("left"))
    return out.filter("came is not null and (left is null or came > left)").select("user_id")


@query("""WITH c AS (SELECT p_brand, p_partkey, p_size, sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey ROWS UNBOUNDED PRECEDING) AS used FROM part) SELECT p_brand, count(*) AS riders, CAST(max(used) AS BIGINT) AS used, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_size, p_partkey) AS names FROM c WHERE used <= 300 GROUP BY 1""")
def b75_capacity_fill(t):
    fit = C.fill_in_order(t.part.select("p_brand", "p_partkey", "p_size"), ["p_brand"], ["p_size", "p_partkey"], "p_size", 300)
    order = F.array_sort(F.collect_list(F.struct("p_size", "p_partkey")))       # sizes are at least 1, so at most 300 entries
    return fit.groupBy("p_brand").agg(F.count("*").alias("riders"), F.max("used").alias("used"), F.array_join(F.transform(order, lambda x: x["p_partkey"].cast("string")), ",").alias("names"))


@query("""WITH p AS (SELECT p_retailprice AS price, count(*) AS c FROM part GROUP BY 1), r AS (SELECT p_partkey, p_retailprice, sum(p_retailprice) OVER (ORDER BY p_retailprice, p_partkey ROWS UNBOUNDED PRECEDING) AS cost, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS n FROM part)
          SELECT c_custkey, coalesce(max(n), 0) AS bought, round(coalesce(max(cost), 0), 2) AS spent FROM customer LEFT JOIN r ON round(cost, 2) <= round(c_acctbal * 10, 2) GROUP BY 1""")
def b76_budget_fill(t):
    # running costs and budgets are merged in one order: each budget reads the last affordable step
    run = scan(t.part.select("p_partkey", "p_retailprice"), [], ["p_retailprice", "p_partkey"], cost=("sum", "p_retailprice"), n=("count", F.lit(1)))
    steps = run.select(F.round("cost", 2).alias("money"), F.round("cost", 2).alias("spent"), F.col("n").alias("bought"))
    budgets = t.customer.select("c_custkey", F.round(F.col("c_acctbal") * 10, 2).alias("money"))
    got = as_of(budgets, steps, [], "money", ["spent", "bought"], ["c_custkey"])
    return got.select("c_custkey", F.coalesce("bought", F.lit(0)).alias("bought"), F.coalesce("spent", F.lit(0.0)).alias("spent"))


@query("""WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer) SELECT c_custkey, CASE WHEN rn % 2 = 1 THEN coalesce(lead(c_custkey) OVER (ORDER BY rn), c_custkey) ELSE lag(c_custkey) OVER (ORDER BY rn) END AS swapped FROM r""")
def b77_seat_swap(t):
    seats = durable(row_numbers(t.customer.select("c_custkey"), [], ["c_custkey"]), "seats")
    other = seats.select(F.col("c_custkey").alias("_other"), F.when(F.col("rn") % 2 == 1, F.col("rn") + 1).otherwise(F.col("rn") - 1).alias("rn"))
    return seats.join(other, "rn", "left").select("c_custkey", F.coalesce("_other", "c_custkey").alias("swapped"))


@query("""WITH p AS (SELECT o_custkey AS k, round(o_totalprice) AS pts FROM orders UNION ALL SELECT (o_custkey + o_orderkey) % (SELECT max(c_custkey) + 1 FROM customer), round(o_totalprice / 2) FROM orders), s AS (SELECT c_nationkey, k, sum(pts) AS pts FROM p JOIN customer ON k = c_custkey GROUP BY 1, 2)
          SELECT c_nationkey, k, pts FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY pts DESC, k) AS rn FROM s) WHERE rn = 1""")
def b78_group_winner(t):
    size = scalar(t.customer, F.max("c_custkey")) + 1
    home = t.orders.select(F.col("o_custkey").alias("k"), F.round("o_totalprice").alias("pts"))
    away = t.orders.select(((F.col("o_custkey") + F.col("o_orderkey")) % size).alias("k"), F.round(F.col("o_totalprice") / 2).alias("pts"))
    sums = home.unionByName(away).groupBy("k").agg(F.sum("pts").alias("pts")).join(t.customer, F.col("k") == F.col("c_custkey"))
    return rel.top_k(sums.select("c_nationkey", "k", "pts"), ["c_nationkey"], ["-pts", "k"], 1).drop("rk")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW'))")
def b79_exclusive_winners(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey").distinct()
    other = t.orders.filter(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")).select("o_custkey")
    return rel.absent(urgent, other, ["o_custkey"])


@query("""WITH e AS (SELECT DISTINCT c_nationkey AS a, s_nationkey AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey) SELECT DISTINCT x.a AS origin, x.b AS via, y.b AS destination FROM e x JOIN e y ON x.b = y.a AND x.a <> y.b""")
def b80_routes(t):
    edges = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
             .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("c_nationkey").alias("a"), F.col("s_nationkey").alias("b")).distinct())
    return graph.two_leg_routes(edges, "a", "b")


@query("""WITH o AS (SELECT o_orderdate AS day, o_custkey AS seller, lead(o_custkey) OVER w AS buyer, row_number() OVER w AS rn FROM orders WINDOW w AS (PARTITION BY o_orderdate ORDER BY o_orderkey)), p AS (SELECT day, seller, buyer FROM o WHERE rn % 2 = 1 AND buyer IS NOT NULL)
          SELECT seller, buyer, count(*) AS n FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.day = p.day AND q.buyer = p.seller) AND NOT EXISTS (SELECT 1 FROM p q WHERE q.day = p.day AND q.seller = p.buyer) GROUP BY 1, 2""")
def b81_event_pairs(t):
    """Each day's orders in pairs, seller then buyer; customers on both sides that day are left out."""
    rows = row_numbers(t.orders.select(F.col("o_orderdate").alias("day"), "o_orderkey", "o_custkey"), ["day"], ["o_orderkey"])
    half = rows.groupBy("day", F.ceil(F.col("rn") / 2).alias("pair")).agg(F.max(F.when(F.col("rn") % 2 == 1, F.col("o_custkey"))).alias("seller"), F.max(F.when(F.col("rn") % 2 == 0, F.col("o_custkey"))).alias("buyer"))
    pairs = durable(half.filter("buyer is not null").select("day", "seller", "buyer"), "pairs")
    both = pairs.select("day", F.col("seller").alias("c")).intersect(pairs.select("day", F.col("buyer").alias("c")))
    clean = pairs.join(both.withColumnRenamed("c", "seller"), ["day", "seller"], "left_anti").join(both.withColumnRenamed("c", "buyer"), ["day", "buyer"], "left_anti")
    return clean.groupBy("seller", "buyer").agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT o_totalprice / 365 AS v, o_orderdate::DATE + CAST(i AS INTEGER) AS d FROM orders, range(365) r(i)) SELECT year(d) AS y, round(sum(v), 2) AS value FROM x GROUP BY 1""")
def b82_range_to_years(t):
    start, end = F.to_date("o_orderdate"), F.date_add(F.to_date("o_orderdate"), 364)
    rows = t.orders.select("o_totalprice", start.alias("s"), end.alias("e"), F.explode(F.sequence(F.year(start), F.year(end))).alias("y"))
    inside = F.datediff(F.least("e", F.make_date("y", F.lit(12), F.lit(31))), F.greatest("s", F.make_date("y", F.lit(1), F.lit(1)))) + 1
    return rows.groupBy("y").agg(F.round(F.sum(F.col("o_totalprice") / 365 * inside), 2).alias("value"))


@query(f"WITH {STAYS} SELECT id, (SELECT count(*) FROM range(0, CAST(e - s AS BIGINT) + 1) r(i) WHERE isodow(s + CAST(i AS INTEGER)) < 6 AND s + CAST(i AS INTEGER) <> DATE '1997-12-25') AS days FROM st")
def b83_business_days(t):
    return _stays(t).select("id", business_days(F.col("s"), F.col("e"), ["1997-12-25"]).alias("days"))


@query("""SELECT p_brand, sum(CASE WHEN year(l_shipdate) = 1995 THEN l_quantity END) AS "1995", sum(CASE WHEN year(l_shipdate) = 1996 THEN l_quantity END) AS "1996", sum(CASE WHEN year(l_shipdate) = 1997 THEN l_quantity END) AS "1997", sum(CASE WHEN year(l_shipdate) = 1998 THEN l_quantity END) AS "1998", sum(CASE WHEN year(l_shipdate) = 1999 THEN l_quantity END) AS "1999", sum(CASE WHEN year(l_shipdate) = 2000 THEN l_quantity END) AS "2000", sum(CASE WHEN year(l_shipdate) = 2001 THEN l_quantity END) AS "2001" FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def b84_pivot_report(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("y", F.year("l_shipdate"))
    return agg.pivot_discovered(rows, ["p_brand"], "y", F.col("l_quantity"))


@query(r"""WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents) SELECT word, count(*) AS n, count(DISTINCT doc_id) AS docs FROM w WHERE word <> '' GROUP BY 1""")
def b85_word_counts(t):
    # words of a text in order, so the first of equal ones is known in the row: one explode serves both counts,
    # which combine on the map side by word alone
    words = t.documents.select(F.sort_array(F.split(F.lower("text"), r"\s+")).alias("w"))
    marked = words.select(F.explode(F.arrays_zip(F.col("w").alias("word"), F.concat(F.array(F.lit(None).cast("string")), F.col("w")).alias("before"))).alias("x")).select("x.*")
    return marked.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("word").eqNullSafe(F.col("before"))).alias("docs"))


@query("""WITH i AS (SELECT o_orderkey, o_orderstatus, 1 + unnest(range(1 + o_orderkey % 3)) AS item_id, o_totalprice FROM orders), x AS (SELECT o_orderkey, o_orderstatus, item_id, round(o_totalprice * item_id, 2) AS price FROM i) SELECT o_orderkey AS order_id, count(*) AS items, round(sum(price), 2) AS total, o_orderstatus = 'F' AS failed FROM x GROUP BY 1, o_orderstatus""")
def b86_nested_orders(t):
    item = lambda i: F.struct(i.alias("item_id"), F.round(F.col("o_totalprice") * i, 2).alias("price"))
    docs = t.orders.select(F.col("o_orderkey").alias("order_id"), F.struct(F.col("o_orderstatus").alias("status")).alias("payment"), F.transform(F.sequence(F.lit(1).cast("long"), 1 + F.col("o_orderkey") % 3), item).alias("items"))
    flat = docs.select("order_id", "payment.status", F.explode("items").alias("item"))
    return flat.groupBy("order_id", (F.col("status") == "F").alias("failed")).agg(F.count("*").alias("items"), F.round(F.sum("item.price"), 2).alias("total"))


def _order_texts(t):
    """Orders as JSON texts whose fields differ by row: absent notes, prices as texts, a discount in some items, no items, broken texts."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")

    def item(i):
        cents = F.round(price * i, 2)
        shown = F.when(key % 7 == 0, F.concat(F.lit('"'), cents.cast("string"), F.lit('"'))).otherwise(cents.cast("string"))
        return F.concat(F.lit('{"item_id":'), i.cast("string"), F.lit(',"price":'), shown, F.when((key + i) % 3 == 0, F.lit(',"discount":{"pct":5}}')).otherwise(F.lit("}")))

    items = F.when(key % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(',"items":['), F.array_join(F.transform(F.sequence(F.lit(1).cast("long"), 1 + key % 3), item), ","), F.lit("]")))
    note = F.when(key % 5 == 0, F.lit(',"note":"gift"')).when(key % 5 == 1, F.lit(',"note":null')).otherwise(F.lit(""))
    whole = F.concat(F.lit('{"order_id":'), key.cast("string"), F.lit(',"payment":{"status":"'), F.col("o_orderstatus"), F.lit('"}'), note, items, F.when(key % 97 == 0, F.lit("")).otherwise(F.lit("}")))
    return t.orders.select("o_orderkey", whole.alias("body"))


@query("""WITH i AS (SELECT o_orderkey AS k, o_orderstatus AS status, unnest(CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 11 = 0 THEN [NULL::BIGINT] ELSE range(1, 2 + o_orderkey % 3) END) AS item_id, o_totalprice FROM orders)
          SELECT k AS o_orderkey, k % 97 = 0 AS broken, CASE WHEN k % 97 <> 0 THEN status END AS status, CASE WHEN k % 97 <> 0 AND k % 5 = 0 THEN 'gift' END AS note, item_id, round(round(o_totalprice * item_id, 2) * CASE WHEN (k + item_id) % 3 = 0 THEN 0.95 ELSE 1 END, 4) AS net FROM i""")
def b86_varying_orders(t):
    rows = nested.open_items(_order_texts(t), "body", "$.items", head={"status": ("$.payment.status", "string"), "note": ("$.note", "string")},
                             fields={"item_id": ("$.item_id", "long"), "price": ("$.price", "double"), "pct": ("$.discount.pct", "double")})
    net = F.col("price") * (1 - F.coalesce("pct", F.lit(0.0)) / 100)
    return rows.select("o_orderkey", F.col("is_broken").alias("broken"), "status", "note", "item_id", F.round(net, 4).alias("net"))


@query("""WITH o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 97 <> 0), i AS (SELECT k, unnest(range(1, 2 + k % 3)) AS i FROM o WHERE k % 11 <> 0)
          SELECT field, type, count(*) AS n FROM (
          SELECT 'order_id' AS field, 'number' AS type FROM o UNION ALL SELECT 'payment', 'object' FROM o UNION ALL SELECT 'payment.status', 'string' FROM o
          UNION ALL SELECT 'note', CASE WHEN k % 5 = 0 THEN 'string' ELSE 'null' END FROM o WHERE k % 5 < 2 UNION ALL SELECT 'items', 'array' FROM o WHERE k % 11 <> 0 UNION ALL SELECT 'items[]', 'object' FROM i
          UNION ALL SELECT 'items[].item_id', 'number' FROM i UNION ALL SELECT 'items[].price', CASE WHEN k % 7 = 0 THEN 'string' ELSE 'number' END FROM i
          UNION ALL SELECT 'items[].discount', 'object' FROM i WHERE (k + i) % 3 = 0 UNION ALL SELECT 'items[].discount.pct', 'number' FROM i WHERE (k + i) % 3 = 0) GROUP BY ALL""")
def f19_field_inventory(t):
    return nested.field_inventory(_order_texts(t), "body")


@query("""SELECT o_orderkey, n_name, o_orderdate::DATE BETWEEN DATE '1996-01-01' + CAST(c_custkey % 365 AS INTEGER) AND DATE '1996-01-01' + CAST(c_custkey % 365 + 730 AS INTEGER) AS eligible FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def b87_enrichment(t):
    start = F.date_add(F.lit("1996-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
    plans = t.customer.join(rel.small_side(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", start.alias("s"), F.date_add(start, 730).alias("e"))
    return t.orders.join(plans, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "n_name", F.to_date("o_orderdate").between(F.col("s"), F.col("e")).alias("eligible"))


@query(f"""WITH {STAYS}, m AS (SELECT k, sum(e - s) AS supplied, max(e) - min(s) AS observed FROM st GROUP BY 1), c AS (SELECT k, count(DISTINCT s + CAST(i AS INTEGER)) AS covered FROM (SELECT k, s, unnest(range(e - s)) AS i FROM st) GROUP BY 1)
          SELECT m.k, round(supplied / observed, 6) AS mpr, round(covered / observed, 6) AS pdc, CASE WHEN covered / observed < 0.1 THEN 'low' WHEN covered / observed < 0.2 THEN 'partial' ELSE 'adherent' END AS band FROM m JOIN c ON m.k = c.k""")
def b88_adherence(t):
    fills = _stays(t)
    m = fills.groupBy("k").agg(F.sum(F.datediff("e", "s")).alias("supplied"), F.datediff(F.max("e"), F.min("s")).alias("observed"))
    pdc = ratio(F.col("covered"), F.col("observed"))
    return m.join(B.covered_days(fills, ["k"], "s", "e"), "k").select("k", F.round(ratio(F.col("supplied"), F.col("observed")), 6).alias("mpr"), F.round(pdc, 6).alias("pdc"), bands(pdc, (0.1, "low"), (0.2, "partial"), other="adherent").alias("band"))


@query(f"""WITH v AS (SELECT o_custkey AS k, o_orderdate::DATE AS d, l_suppkey AS s FROM {LINES}) SELECT a.k, CAST(max(a.n) AS BIGINT) AS prescribers FROM (SELECT x.k, x.d, count(DISTINCT y.s) AS n FROM (SELECT DISTINCT k, d FROM v) x JOIN v y ON x.k = y.k AND y.d BETWEEN x.d - 29 AND x.d GROUP BY 1, 2) a GROUP BY 1 HAVING max(a.n) >= 12""")
def b89_many_prescribers(t):
    rows = _lines(t).select(F.col("o_custkey").alias("k"), "o_orderdate", "l_suppkey")
    return B.trailing_distinct(rows, ["k"], "l_suppkey", "o_orderdate", 30, "n").groupBy("k").agg(F.max("n").alias("prescribers")).filter("prescribers >= 12")


@query("""WITH g AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events WHERE event_type = 'purchase') SELECT user_id, count(*) AS quick FROM g WHERE date_trunc('second', ts) - date_trunc('second', prev) <= INTERVAL 24 HOUR GROUP BY 1""")
def b89_pickups_within_day(t):
    rows = t.events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    return B.gaps(rows, ["user_id"], "ts", ["event_id"]).filter("gap_seconds <= 86400").groupBy("user_id").agg(F.count("*").alias("quick"))


@query("""SELECT e.event_id, CAST((SELECT min(p.ts) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts >= e.ts) <= e.ts + INTERVAL 3 DAY AS BOOLEAN) IS TRUE AS treated FROM events e WHERE event_type = 'error' AND value > 80""")
def b90_treated_after(t):
    marks = t.events.filter("event_type = 'purchase' or (event_type = 'error' and value > 80)").select("user_id", "ts", "event_id", "event_type")
    marks = marks.withColumns({"_p": F.when(F.col("event_type") == "purchase", F.col("ts")), "_o": (F.col("event_type") == "error").cast("int")})
    nxt = scan(marks, ["user_id"], ["-ts", "_o", "event_id"], _next=("min", "_p")).filter("event_type = 'error'")
    return nxt.select("event_id", F.coalesce(F.col("_next") <= F.col("ts") + F.expr("interval 3 days"), F.lit(False)).alias("treated"))


@query("""SELECT c_custkey, upper(c_name) AS name, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, round(c_acctbal * CASE WHEN c_custkey % 2 = 0 THEN 10 ELSE 50 END, 2) AS cost FROM customer WHERE c_acctbal BETWEEN 1000 AND 5000 AND c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')""")
def b91_listing(t):
    even = F.col("c_custkey") % 2 == 0
    rows = t.customer.filter(F.col("c_acctbal").between(1000, 5000) & F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"))
    return rows.select("c_custkey", F.upper("c_name").alias("name"), F.when(even, "even").otherwise("odd").alias("parity"), F.round(F.col("c_acctbal") * F.when(even, 10).otherwise(50), 2).alias("cost"))


@query("""WITH y AS (SELECT o_custkey AS k, year(o_orderdate) AS y, max(o_orderpriority) AS g FROM orders WHERE year(o_orderdate) IN (1999, 2000) GROUP BY 1, 2), a AS (SELECT * FROM y WHERE y = 1999), b AS (SELECT * FROM y WHERE y = 2000)
          SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'new' WHEN b.k IS NULL THEN 'resigned' ELSE 'changed' END AS status FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.g <> b.g""")
def b92_change_detection(t):
    year = lambda y: t.orders.filter(F.year("o_orderdate") == y).groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderpriority").alias("g"))
    label = F.when(F.col("status") == "right_only", "new").when(F.col("status") == "left_only", "resigned").otherwise("changed")
    return rel.differences(year(1999), year(2000), ["k"], ["g"]).select("k", label.alias("status"))


@query("""WITH r AS (SELECT *, o_totalprice > lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS up FROM orders), l AS (SELECT o_custkey, max(CASE WHEN up THEN o_orderdate END) AS last_up FROM r GROUP BY 1) SELECT o_custkey FROM l WHERE last_up IS NULL OR last_up < TIMESTAMP '1999-08-01'""")
def b93_no_raise(t):
    rows = reach_back(t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 1, up=lambda w: F.col("o_totalprice") > F.lag("o_totalprice").over(w))
    last = rows.groupBy("o_custkey").agg(F.max(F.when(F.col("up"), F.col("o_orderdate"))).alias("last_up"))
    return last.filter("last_up is null or last_up < '1999-08-01'").select("o_custkey")


@query("SELECT abs(max(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_acctbal END) - max(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal END)) AS gap, round(avg(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_acctbal END), 6) AS mean_a, round(avg(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal END), 6) AS mean_b FROM customer")
def b94_group_comparison(t):
    at = lambda s: F.when(F.col("c_mktsegment") == s, F.col("c_acctbal"))
    return t.customer.agg(F.abs(F.max(at("HOUSEHOLD")) - F.max(at("MACHINERY"))).alias("gap"), F.round(F.avg(at("HOUSEHOLD")), 6).alias("mean_a"), F.round(F.avg(at("MACHINERY")), 6).alias("mean_b"))


@query(f"""WITH m AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, sum(l_extendedprice) AS gross, sum(l_extendedprice * l_discount) AS discount, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * (1 - l_discount) ELSE 0 END) AS refunds FROM {LINES} GROUP BY 1), n AS (SELECT *, gross - discount - refunds AS net FROM m)
          SELECT CAST(m AS VARCHAR) AS month, round(gross, 2) AS gross, round(discount, 4) AS discount, round(refunds, 4) AS refunds, round(net, 4) AS net, round(net - lag(net) OVER (ORDER BY m), 4) AS change FROM n""")
def b95_revenue_decomposition(t):
    m = _lines(t).groupBy(month("o_orderdate").alias("m")).agg(F.sum("l_extendedprice").alias("gross"), F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
                                                               F.sum(F.when(F.col("l_returnflag") == "R", line_revenue()).otherwise(0.0)).alias("refunds")).withColumn("net", F.col("gross") - F.col("discount") - F.col("refunds"))
    steps = reach_back(m, [], ["m"], 1, change=lambda w: F.col("net") - F.lag("net").over(w))
    return steps.select(F.col("m").cast("string").alias("month"), F.round("gross", 2).alias("gross"), *[F.round(c, 4).alias(c) for c in ("discount", "refunds", "net", "change")])


@query("""SELECT count(*) AS joined_rows, count(DISTINCT c_custkey) AS customers, round(sum(c_acctbal), 2) AS inflated, round(sum(c_acctbal) / (SELECT sum(c_acctbal) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)), 6) AS factor FROM customer JOIN orders ON c_custkey = o_custkey""")
def b96_join_inflation(t):
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    bal = F.col("c_acctbal")
    return t.customer.join(per, "c_custkey").agg(F.sum("n").alias("joined_rows"), F.count("*").alias("customers"), F.round(F.sum(bal * F.col("n")), 2).alias("inflated"), F.round(ratio(F.sum(bal * F.col("n")), F.sum(bal)), 6).alias("factor"))


@query("WITH m AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS m, count(*) AS n FROM orders GROUP BY 1, 2) SELECT CAST(m AS VARCHAR) AS month, count(*) AS active, count(CASE WHEN n = 1 THEN 1 END) AS once_only, round(100.0 * count(CASE WHEN n = 1 THEN 1 END) / count(*), 6) AS once_pct FROM m GROUP BY m")
def b97_active_once(t):
    per = t.orders.groupBy("o_custkey", month("o_orderdate").alias("m")).agg(F.count("*").alias("n"))
    once = F.count_if(F.col("n") == 1)
    return per.groupBy(F.col("m").cast("string").alias("month")).agg(F.count("*").alias("active"), once.alias("once_only"), pct(once, F.count("*")).alias("once_pct"))


@query("SELECT user_id, CAST(date_trunc('week', ts)::DATE AS VARCHAR) AS week, arg_max(event_type, (ts, event_id)) AS region FROM events GROUP BY 1, 2")
def b98_region_pick(t):
    rows = t.events.select("user_id", F.to_date(F.date_trunc("week", "ts")).cast("string").alias("week"), "ts", "event_id", F.col("event_type").alias("region"))
    return quality.keep_latest(rows, ["user_id", "week"], "ts", "event_id").select("user_id", "week", "region")


@query(f"""WITH b AS (SELECT o_custkey AS k, o_orderdate::DATE AS d, l_partkey AS p FROM {LINES}), f AS (SELECT k, min(d) AS d0 FROM b GROUP BY 1), s AS (SELECT DISTINCT b.k, p FROM b JOIN f ON b.k = f.k AND d = d0) SELECT count(DISTINCT b.k) AS customers FROM b JOIN f ON b.k = f.k WHERE d > d0 AND (b.k, p) NOT IN (SELECT (k, p) FROM s)""")
def b99_new_product_after_first_day(t):
    bought = _lines(t).select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("d"), F.col("l_partkey").alias("p"))
    # a product is new when its own first date is later than the customer's first date
    first = bought.groupBy("k", "p").agg(F.min("d").alias("pd"))
    per = first.groupBy("k").agg(F.min("pd").alias("d0"), F.max("pd").alias("newest"))
    return per.agg(F.count_if(F.col("newest") > F.col("d0")).alias("customers"))


@query(f"""SELECT n_name, p_brand, round(sum(l_extendedprice), 2) AS value, round(100 * sum(l_extendedprice) / sum(sum(l_extendedprice)) OVER (PARTITION BY n_name), 6) AS share FROM {LINES} JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def b100_market_share(t):
    rows = _lines(t).join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return agg.share_of_total(rows, ["n_name", "p_brand"], F.col("l_extendedprice"), ["n_name"]).withColumn("value", F.round("value", 2))

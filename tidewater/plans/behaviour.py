"""B20–B51: sessions, retention, churn, funnels, value segments, fraud signals."""

from pyspark.sql import functions as F

from tidewater.functions.columns import is_weekend, line_revenue, pct
from tidewater.operators import agg, behaviour as B, commerce as C, graph, rel
from tidewater.operators.ordered import reach_back, trailing_sums
from tidewater.plans.registry import query
from tidewater.sources.io import scalar


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS f FROM events)
          SELECT event_id, CAST(sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g""")
def b20_sessions(t):
    return B.sessionize(t.events.select("user_id", "ts", "event_id"), ["user_id"], "ts", ["event_id"]).select("event_id", "session")


@query("""WITH f AS (SELECT user_id, min(ts)::DATE AS d0 FROM events GROUP BY 1), a AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events)
          SELECT CAST(d0 AS VARCHAR) AS signup_day, count(*) AS users, count(a.d) AS retained, round(100.0 * count(a.d) / count(*), 6) AS rate FROM f LEFT JOIN a ON a.user_id = f.user_id AND a.d = d0 + 7 GROUP BY 1""")
def b21_day_n_retention(t):
    return B.day_n_retention(t.events, t.events, "user_id", 7).withColumn("signup_day", F.col("signup_day").cast("string"))


@query("""WITH s AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate) AS p FROM orders), c AS (SELECT *, min(p) OVER (PARTITION BY o_custkey) AS cohort FROM s),
          n AS (SELECT cohort, date_diff('month', cohort, p) AS period, count(*) AS users FROM c GROUP BY 1, 2), z AS (SELECT cohort, users AS size FROM n WHERE period = 0)
          SELECT CAST(cohort::DATE AS VARCHAR) AS cohort, CAST(period AS INTEGER) AS period, users, size, round(100.0 * users / size, 6) AS rate FROM n JOIN z USING (cohort)""")
def b22_cohort_matrix(t):
    return B.cohort_retention(t.orders, "o_custkey", "o_orderdate", "month").withColumn("cohort", F.col("cohort").cast("string"))


@query("""WITH s AS (SELECT DISTINCT user_id, date_trunc('week', ts)::DATE AS p FROM events), c AS (SELECT *, min(p) OVER (PARTITION BY user_id) AS cohort FROM s)
          SELECT CAST(cohort AS VARCHAR) AS cohort, CAST((p - cohort) // 7 AS INTEGER) AS period, count(*) AS users FROM c GROUP BY 1, 2""")
def b22_weekly_cohorts(t):
    return B.cohort_counts(t.events, "user_id", "ts", "week").withColumn("cohort", F.col("cohort").cast("string"))


@query("""SELECT o_custkey, date_diff('day', max(o_orderdate), TIMESTAMP '2001-08-01') AS idle_days, CASE WHEN date_diff('day', max(o_orderdate), TIMESTAMP '2001-08-01') <= 90 THEN 'active' WHEN date_diff('day', max(o_orderdate), TIMESTAMP '2001-08-01') <= 365 THEN 'at_risk' ELSE 'churned' END AS status FROM orders GROUP BY 1""")
def b23_churn_labels(t):
    return B.activity_status(t.orders, "o_custkey", "o_orderdate", F.lit("2001-08-01").cast("date"), 90, 365).select("o_custkey", "idle_days", "status")


@query("""WITH m AS (SELECT DISTINCT o_custkey AS u, date_trunc('month', o_orderdate)::DATE AS m FROM orders), x AS (SELECT m.*, EXISTS (SELECT 1 FROM m p WHERE p.u = m.u AND p.m = (m.m - INTERVAL 1 MONTH)::DATE) AS was, EXISTS (SELECT 1 FROM m p WHERE p.u = m.u AND p.m < m.m) AS before FROM m),
          s AS (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH))::DATE AS m FROM m), a AS (SELECT m, count(*) AS active, count(CASE WHEN NOT before THEN 1 END) AS "new", count(CASE WHEN was THEN 1 END) AS retained, count(CASE WHEN before AND NOT was THEN 1 END) AS returned FROM x GROUP BY m),
          c AS (SELECT (m.m + INTERVAL 1 MONTH)::DATE AS m, count(*) AS churned FROM m WHERE NOT EXISTS (SELECT 1 FROM m p WHERE p.u = m.u AND p.m = (m.m + INTERVAL 1 MONTH)::DATE) GROUP BY 1)
          SELECT CAST(s.m AS VARCHAR) AS m, coalesce(active, 0) AS active, coalesce("new", 0) AS "new", coalesce(retained, 0) AS retained, coalesce(returned, 0) AS returned, coalesce(churned, 0) AS churned FROM s LEFT JOIN a ON a.m = s.m LEFT JOIN c ON c.m = s.m""")
def b24_monthly_flow(t):
    return B.monthly_flow(t.orders, "o_custkey", "o_orderdate").withColumn("m", F.col("m").cast("string"))


@query("""WITH u AS (SELECT user_id, max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS v, max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS c, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p FROM events GROUP BY 1),
          n AS (SELECT sum(v) AS a, sum(v * c) AS b, sum(v * c * p) AS d FROM u) SELECT CAST(a AS BIGINT) AS "view", CAST(b AS BIGINT) AS click, CAST(d AS BIGINT) AS purchase, round(100.0 * b / a, 6) AS click_of_view, round(100.0 * d / b, 6) AS purchase_of_click, round(100.0 * b / a, 6) AS click_overall, round(100.0 * d / a, 6) AS purchase_overall FROM n""")
def b25_funnel(t):
    return B.funnel(t.events, "user_id", "event_type", ["view", "click", "purchase"])


@query("""SELECT DISTINCT g.user_id FROM events s JOIN events g ON s.user_id = g.user_id AND s.event_type = 'signup' AND g.event_type = 'purchase' AND g.ts >= s.ts AND g.ts <= s.ts + INTERVAL 2 HOUR""")
def b25_converted_within(t):
    return B.converted_within(t.events, "user_id", "ts", "event_id", "event_type", "signup", "purchase", 2)


@query("""WITH o AS (SELECT *, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events) SELECT event_type, count(*) AS n, round(100.0 * count(CASE WHEN nxt = 'purchase' THEN 1 END) / count(*), 6) AS next_is_purchase FROM o GROUP BY 1""")
def b25_next_event(t):
    rows = reach_back(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["-ts", "-event_id"], 1, nxt=lambda w: F.lag("event_type").over(w))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), pct(F.count_if(F.col("nxt") == "purchase"), F.count("*")).alias("next_is_purchase"))


@query("""SELECT user_id, CAST(ts::DATE AS VARCHAR) AS day, count(CASE WHEN event_type = 'click' THEN 1 END) AS adds FROM events GROUP BY 1, 2 HAVING count(CASE WHEN event_type = 'click' THEN 1 END) > 0 AND count(CASE WHEN event_type = 'purchase' THEN 1 END) = 0""")
def b26_abandoned_cart(t):
    flags = t.events.groupBy("user_id", F.to_date("ts").cast("string").alias("day")).agg(F.count_if(F.col("event_type") == "click").alias("adds"), F.count_if(F.col("event_type") == "purchase").alias("buys"))
    return flags.filter("adds > 0 and buys = 0").drop("buys")


@query("""WITH b AS (SELECT o_custkey, date_diff('day', max(o_orderdate), TIMESTAMP '2001-08-02') AS recency, count(*) AS frequency, sum(o_totalprice) AS monetary FROM orders GROUP BY 1),
          s AS (SELECT *, 6 - (1 + (recency > 30)::INT + (recency > 90)::INT + (recency > 180)::INT + (recency > 365)::INT) AS r, 1 + (frequency > 5)::INT + (frequency > 8)::INT + (frequency > 11)::INT + (frequency > 14)::INT AS f,
                1 + (monetary > 1e6)::INT + (monetary > 2e6)::INT + (monetary > 3e6)::INT + (monetary > 4e6)::INT AS m FROM b)
          SELECT o_custkey, r, f, m, r + f + m AS rfm, CASE WHEN r + f + m >= 13 THEN 'champion' WHEN r + f + m >= 9 THEN 'loyal' WHEN r + f + m >= 6 THEN 'potential' ELSE 'at_risk' END AS segment FROM s""")
def b27_rfm(t):
    out = C.rfm(t.orders, "o_custkey", "o_orderdate", "o_totalprice", F.lit("2001-08-02").cast("date"), [30, 90, 180, 365], [5, 8, 11, 14], [1e6, 2e6, 3e6, 4e6],
                [(13, "champion"), (9, "loyal"), (6, "potential")], "at_risk")
    return out.select("o_custkey", "r", "f", "m", "rfm", "segment")


@query("""SELECT o_custkey, round(sum(o_totalprice), 2) AS total, count(*) AS orders, round(avg(o_totalprice), 6) AS avg_order, date_diff('day', min(o_orderdate), max(o_orderdate)) AS tenure_days,
          round(sum(o_totalprice) / greatest(date_diff('day', min(o_orderdate), max(o_orderdate)) / 30.0, 1.0), 6) AS monthly_value FROM orders GROUP BY 1""")
def b28_lifetime_value(t):
    out = C.lifetime_value(t.orders, "o_custkey", "o_orderdate", "o_totalprice")
    return out.withColumns({"total": F.round("total", 2), "avg_order": F.round("avg_order", 6), "monthly_value": F.round("monthly_value", 6)})


PART_VALUE = "v AS (SELECT l_partkey, round(sum(l_extendedprice), 2) AS value FROM lineitem GROUP BY 1), c AS (SELECT *, sum(value) OVER (ORDER BY value DESC, l_partkey ROWS UNBOUNDED PRECEDING) / (SELECT sum(value) FROM v) AS s FROM v)"


def _part_value(t):
    return t.lineitem.groupBy("l_partkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))


@query(f"WITH {PART_VALUE} SELECT l_partkey, round(s, 6) AS cum_share FROM c WHERE s <= 0.8")
def b29_pareto(t):
    return agg.pareto(_part_value(t), "l_partkey", "value", 0.8).select("l_partkey", F.round("cum_share", 6).alias("cum_share"))


@query(f"WITH {PART_VALUE} SELECT CASE WHEN s <= 0.8 THEN 'A' WHEN s <= 0.95 THEN 'B' ELSE 'C' END AS class, count(*) AS parts, round(sum(value), 2) AS value FROM c GROUP BY 1")
def b29_abc_classes(t):
    return agg.abc_classes(_part_value(t), "l_partkey", "value").groupBy("class").agg(F.count("*").alias("parts"), F.round(F.sum("value"), 2).alias("value"))


@query("""SELECT n_name, c_mktsegment, round(sum(o_totalprice), 2) AS value, round(100 * sum(o_totalprice) / sum(sum(o_totalprice)) OVER (PARTITION BY n_name), 6) AS share FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def b30_contribution_share(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return agg.share_of_total(rows, ["n_name", "c_mktsegment"], F.col("o_totalprice"), ["n_name"]).withColumn("value", F.round("value", 2))


@query("""WITH b AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) SELECT x.l_partkey AS item_a, y.l_partkey AS item_b, count(*) AS support FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey GROUP BY 1, 2 HAVING count(*) >= 2""")
def b31_basket_pairs(t):
    return C.pair_counts(t.lineitem, "l_orderkey", "l_partkey", 2)


@query("""WITH n AS (SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_item FROM events) SELECT event_type, next_item, count(*) AS n FROM n WHERE next_item IS NOT NULL GROUP BY 1, 2""")
def b32_item_sequence(t):
    return C.next_items(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type")


FOLLOWS = "f AS (SELECT DISTINCT user_id AS a, event_id % (SELECT max(user_id) + 1 FROM events) AS b FROM events WHERE event_type = 'view' AND user_id <> event_id % (SELECT max(user_id) + 1 FROM events))"


def _follows(t):
    who = F.col("event_id") % (scalar(t.events, F.max("user_id")) + 1)
    return t.events.filter("event_type = 'view'").select(F.col("user_id").alias("a"), who.alias("b")).filter("a <> b").distinct()


@query(f"WITH {FOLLOWS} SELECT x.a, x.b FROM f x JOIN f y ON x.a = y.b AND x.b = y.a AND x.a < x.b")
def b33_mutual(t):
    return graph.mutual(_follows(t), "a", "b")


@query(f"""WITH {FOLLOWS}, l AS (SELECT a AS u, b AS v FROM f UNION SELECT b, a FROM f) SELECT x.u AS item_a, y.u AS item_b, count(*) AS common FROM l x JOIN l y ON x.v = y.v AND x.u < y.u
          WHERE NOT EXISTS (SELECT 1 FROM l d WHERE d.u = x.u AND d.v = y.u) GROUP BY 1, 2 HAVING count(*) >= 8""")
def b34_friends_of_friends(t):
    return graph.friends_of_friends(_follows(t), "a", "b", 8)


@query("""WITH s AS (SELECT event_type, least(CAST(floor(value / 10) AS BIGINT), 10) AS s FROM events) SELECT event_type, round(100.0 * (count(CASE WHEN s >= 9 THEN 1 END) - count(CASE WHEN s <= 6 THEN 1 END)) / count(*), 6) AS nps FROM s GROUP BY 1""")
def b35_net_promoter(t):
    s = F.least(F.floor(F.col("value") / 10), F.lit(10))
    return t.events.groupBy("event_type").agg(pct(F.count_if(s >= 9) - F.count_if(s <= 6), F.count("*")).alias("nps"))


@query("""WITH v AS (SELECT event_type, avg(CASE WHEN user_id % 2 = 0 THEN value END) AS control, avg(CASE WHEN user_id % 2 = 1 THEN value END) AS variant FROM events GROUP BY 1) SELECT event_type, round(control, 6) AS control, round(variant, 6) AS variant, round(100 * (variant - control) / control, 6) AS lift FROM v""")
def b36_variant_lift(t):
    arm = lambda k: F.avg(F.when(F.col("user_id") % 2 == k, F.col("value")))
    v = t.events.groupBy("event_type").agg(arm(0).alias("control"), arm(1).alias("variant"))
    return v.select("event_type", F.round("control", 6).alias("control"), F.round("variant", 6).alias("variant"), pct(F.col("variant") - F.col("control"), F.col("control")).alias("lift"))


@query("""SELECT 'day' AS unit, CAST(ts::DATE AS VARCHAR) AS period, count(DISTINCT user_id) AS users FROM events GROUP BY 2 UNION ALL SELECT 'week', CAST(date_trunc('week', ts)::DATE AS VARCHAR), count(DISTINCT user_id) FROM events GROUP BY 2
          UNION ALL SELECT 'month', CAST(date_trunc('month', ts)::DATE AS VARCHAR), count(DISTINCT user_id) FROM events GROUP BY 2""")
def b37_active_users(t):
    # users are made distinct per day once; weeks and months are built from that smaller set
    daily = t.events.select("user_id", F.to_date("ts").alias("d")).distinct()
    per = lambda unit: daily.groupBy(F.lit(unit).alias("unit"), F.to_date(F.date_trunc(unit, "d")).cast("string").alias("period")).agg(F.count_distinct("user_id").alias("users"))
    return per("day").unionByName(per("week")).unionByName(per("month"))


@query("""WITH d AS (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY))::DATE AS day FROM events) SELECT CAST(d.day AS VARCHAR) AS day, count(DISTINCT user_id) AS active FROM d JOIN events ON ts::DATE BETWEEN d.day - 2 AND d.day GROUP BY 1""")
def b38_rolling_active(t):
    return B.rolling_active(t.events, "user_id", "ts", 3).select(F.col("day").cast("string"), "active")


@query("""WITH s AS (SELECT DISTINCT o_custkey, date_trunc('quarter', o_orderdate)::DATE AS q FROM orders), f AS (SELECT o_custkey, min(q) AS q0 FROM s GROUP BY 1) SELECT CAST(q AS VARCHAR) AS period, count(CASE WHEN q = q0 THEN 1 END) AS "new", count(CASE WHEN q > q0 THEN 1 END) AS returning FROM s JOIN f ON s.o_custkey = f.o_custkey GROUP BY 1""")
def b39_new_versus_returning(t):
    return C.first_is_new(t.orders, "o_custkey", "o_orderdate", F.to_date(F.date_trunc("quarter", "o_orderdate"))).withColumn("period", F.col("period").cast("string"))


@query("""SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order, CAST(min(o_orderdate)::DATE AS VARCHAR) AS first_day, date_diff('day', min(o_orderdate), max(o_orderdate)) AS days FROM orders GROUP BY 1""")
def b40_first_and_last(t):
    at = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(F.min_by("o_orderkey", at).alias("first_order"), F.max_by("o_orderkey", at).alias("last_order"), F.to_date(F.min("o_orderdate")).cast("string").alias("first_day"),
                                             F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).alias("days"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def b41_most_recent(t):
    return rel.top_k(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["-ts", "-event_id"], 1).select("user_id", "event_id", "event_type")


@query("""WITH d AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders), g AS (SELECT o_custkey, date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), o_orderdate) AS gap FROM d) SELECT o_custkey, count(*) AS repeats FROM g WHERE gap <= 7 GROUP BY 1""")
def b42_repeat_within_days(t):
    days = t.orders.select("o_custkey", "o_orderdate").distinct()           # orders of one moment are one visit
    rows = B.gaps(days, ["o_custkey"], "o_orderdate", [])
    return rows.filter(F.col("gap_seconds") <= 7 * 86400).groupBy("o_custkey").agg(F.count("*").alias("repeats"))


@query("""WITH f AS (SELECT user_id, min(ts) AS t0 FROM events WHERE event_type = 'purchase' GROUP BY 1) SELECT DISTINCT e.user_id FROM events e JOIN f ON e.user_id = f.user_id WHERE event_type = 'purchase' AND ts > t0 AND ts <= t0 + INTERVAL 2 DAY""")
def b42_returning_after_first(t):
    buys = t.events.filter("event_type = 'purchase'").select("user_id", "ts")
    rows = rel.with_group_stats(buys, ["user_id"], t0=F.min("ts"))
    return rows.filter((F.col("ts") > F.col("t0")) & (F.col("ts") <= F.col("t0") + F.expr("interval 2 days"))).select("user_id").distinct()


@query("""SELECT days, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders, (VALUES (7), (30), (180)) v(days) WHERE o_orderdate > TIMESTAMP '2001-08-01' - INTERVAL 1 DAY * days AND o_orderdate <= TIMESTAMP '2001-08-01' GROUP BY 1""")
def b43_recent_window(t):
    age = F.datediff(F.lit("2001-08-01"), "o_orderdate")
    rows = t.orders.filter((age >= 0) & (age < 180)).withColumn("days", F.explode(F.filter(F.array(F.lit(7), F.lit(30), F.lit(180)), lambda d: age < d)))
    return rows.groupBy("days").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT CASE WHEN isodow(ts) >= 6 THEN 'weekend' ELSE 'weekday' END AS part, CASE WHEN hour(ts) BETWEEN 9 AND 16 THEN 'office' ELSE 'other' END AS hours, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2""")
def b44_calendar_split(t):
    part = F.when(is_weekend("ts"), "weekend").otherwise("weekday").alias("part")
    hours = F.when(F.hour("ts").between(9, 16), "office").otherwise("other").alias("hours")
    return t.events.groupBy(part, hours).agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("""SELECT unit, CAST(CASE unit WHEN 'day' THEN l_shipdate::DATE WHEN 'week' THEN date_trunc('week', l_shipdate)::DATE WHEN 'month' THEN date_trunc('month', l_shipdate)::DATE ELSE date_trunc('quarter', l_shipdate)::DATE END AS VARCHAR) AS period,
          round(sum(l_extendedprice * (1 - l_discount)), 4) AS net FROM lineitem, (VALUES ('day'), ('week'), ('month'), ('quarter')) u(unit) GROUP BY 1, 2""")
def b45_period_totals(t):
    daily = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.sum(line_revenue()).alias("v"))
    units = [daily.groupBy(F.lit(u).alias("unit"), F.to_date(F.date_trunc(u, "d")).cast("string").alias("period")).agg(F.round(F.sum("v"), 4).alias("net")) for u in ("day", "week", "month", "quarter")]
    return units[0].unionByName(units[1]).unionByName(units[2]).unionByName(units[3])


@query("""WITH m AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2) SELECT y, arg_max(m, v) AS peak_month, max(v) AS value FROM m GROUP BY 1""")
def b46_peak_month(t):
    monthly = t.orders.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    return monthly.groupBy("y").agg(F.max_by("m", "v").alias("peak_month"), F.max("v").alias("value"))


@query("""SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) = (SELECT count(DISTINCT year(o_orderdate)) FROM orders)""")
def b47_active_every_period(t):
    years = t.orders.select("o_custkey", F.year("o_orderdate").alias("y"))
    return agg.divides(years, "o_custkey", "y", years)


@query("""WITH s AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, count(*) AS c FROM events GROUP BY 1, 2), w AS (SELECT user_id, s, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY s RANGE BETWEEN 1799 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM s)
          SELECT user_id, s - CAST(epoch(TIMESTAMP '2024-01-01') AS BIGINT) AS second, n FROM w WHERE n >= 3""")
def b48_velocity(t):
    start = F.unix_timestamp(F.lit("2024-01-01").cast("timestamp_ntz"))
    return B.velocity(t.events, ["user_id"], "ts", 1800, 3).select("user_id", (F.col("_t") - start).alias("second"), "n")


@query("""WITH l AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events), m AS (SELECT *, avg(value) OVER (PARTITION BY user_id ORDER BY ts::DATE RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS mean7 FROM l)
          SELECT event_id, prev IS NOT NULL AND value > 5 * prev AS jump, value > 3 * mean7 AS above_week FROM m WHERE value > 5 * prev OR value > 3 * mean7""")
def b49_amount_jump(t):
    rows = t.events.select("user_id", "ts", "event_id", "value", F.unix_date(F.to_date("ts")).alias("day"))
    prev = reach_back(rows, ["user_id"], ["ts", "event_id"], 1, prev=lambda w: F.lag("value").over(w))
    week = trailing_sums(rows, ["user_id"], "day", 7, s=F.col("value"), c=F.lit(1))
    per_day = week.join(rows.groupBy("user_id", "day").agg(F.count("*").alias("_rows")), ["user_id", "day"])
    out = rel.attach(prev, per_day, ["user_id", "day"])
    jump = F.coalesce(F.col("value") > 5 * F.col("prev"), F.lit(False))
    return out.select("event_id", jump.alias("jump"), (F.col("value") > 3 * F.col("s") / F.col("c")).alias("above_week")).filter("jump or above_week")


@query("SELECT user_id, CAST(ts::DATE AS VARCHAR) AS day, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) > 1")
def b50_two_kinds_same_day(t):
    return t.events.groupBy("user_id", F.to_date("ts").cast("string").alias("day")).agg(F.count_distinct("event_type").alias("kinds")).filter("kinds > 1")


@query("""SELECT event_id FROM events WHERE isodow(ts) >= 6 OR hour(ts) < 9 OR hour(ts) >= 16 OR ts::DATE IN (DATE '2024-01-01', DATE '2024-01-15')""")
def b51_invalid_times(t):
    outside = is_weekend("ts") | (F.hour("ts") < 9) | (F.hour("ts") >= 16) | F.to_date("ts").isin("2024-01-01", "2024-01-15")
    return t.events.filter(outside).select("event_id")

"""B102–B143: recognition, licences, jobs, rates in force, pairs and period conditions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.columns import month, parse_date, pct
from tidewater.operators import agg, behaviour as B, ml, quality, rel
from tidewater.operators.ordered import as_of, rank_table, reach_back, row_numbers
from tidewater.plans.ranking import STAFF, staff
from tidewater.plans.registry import query
from tidewater.sources.durable import scratch
from tidewater.sources.io import date_spine, scalar
from tidewater.sources.keyed import KeyedTable
from tidewater.streaming import jobs


@query("""WITH x AS (SELECT o_totalprice / 12 AS v, (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH * i)::DATE AS m FROM orders, range(12) r(i)) SELECT CAST(m AS VARCHAR) AS month, round(sum(v), 4) AS recognized FROM x GROUP BY m""")
def b102_revenue_recognition(t):
    # amounts are summed per contract month before they are spread
    booked = t.orders.groupBy(month("o_orderdate").alias("m0")).agg(F.sum("o_totalprice").alias("v"))
    spread = booked.select((F.col("v") / 12).alias("v"), F.explode(F.sequence("m0", F.add_months("m0", 11), F.expr("interval 1 month"))).alias("m"))
    return spread.groupBy(F.col("m").cast("string").alias("month")).agg(F.round(F.sum("v"), 4).alias("recognized"))


@query("""WITH h AS (SELECT n_nationkey, n_name, n_nationkey * 2 + 1 AS held FROM nation), u AS (SELECT c_nationkey, count(*) AS used FROM customer WHERE c_acctbal > 9500 GROUP BY 1) SELECT n_name, held, coalesce(used, 0) AS used, round(100.0 * coalesce(used, 0) / held, 6) AS used_pct, coalesce(used, 0) <= held AS compliant FROM h LEFT JOIN u ON c_nationkey = n_nationkey""")
def b103_licence_use(t):
    held = t.nation.select("n_nationkey", "n_name", (F.col("n_nationkey") * 2 + 1).alias("held"))
    used = t.customer.filter("c_acctbal > 9500").groupBy("c_nationkey").agg(F.count("*").alias("used"))
    both = used.join(held, F.col("c_nationkey") == F.col("n_nationkey"), "right").withColumn("used", F.coalesce("used", F.lit(0)))
    return both.select("n_name", "held", "used", pct(F.col("used"), F.col("held")).alias("used_pct"), (F.col("used") <= F.col("held")).alias("compliant"))


@query("""WITH f AS (SELECT o_custkey, min(o_orderdate)::DATE AS d FROM orders GROUP BY 1) SELECT o_custkey, CAST(d AS VARCHAR) AS since, year(DATE '2002-01-01') - year(d) AS years, date_diff('month', d, DATE '2002-01-01') AS months FROM f WHERE month(d) = 3 OR d < DATE '1995-02-01'""")
def b104_tenure(t):
    since = t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("d")).filter("month(d) = 3 or d < '1995-02-01'")
    months = (F.year(F.lit("2002-01-01")) - F.year("d")) * 12 + 1 - F.month("d")
    return since.select("o_custkey", F.col("d").cast("string").alias("since"), (2002 - F.year("d")).alias("years"), months.alias("months"))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 3 OR (s_acctbal BETWEEN 2000 AND 3000 AND s_name IS NOT NULL)")
def b105_list_filter(t):
    return t.supplier.filter("s_nationkey = 3 or (s_acctbal between 2000 and 3000 and s_name is not null)").select("s_suppkey", "s_name")


@query("""SELECT coalesce(r_name, 'ALL') AS region, coalesce(c_mktsegment, 'ALL') AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, c_mktsegment)""")
def b106_totals(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    sums = rows.rollup("r_name", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))
    return sums.select(F.coalesce("r_name", F.lit("ALL")).alias("region"), F.coalesce("c_mktsegment", F.lit("ALL")).alias("segment"), "n", "total")


@query("""WITH d AS (SELECT DISTINCT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS p FROM orders)
          SELECT year(day) AS y, count(*) AS n, round(sum(coalesce(p, (SELECT avg(p) FROM d))) / 1000, 2) AS total_k FROM d WHERE day IS NOT NULL GROUP BY 1""")
def b107_cleaning_job(t):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy/MM/dd")).when(k == 2, F.date_format(d, "dd-MM-yyyy")).otherwise("garbage")
    raw = t.orders.select("o_orderkey", "o_custkey", text.alias("day"), F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("p"))
    clean = quality.impute(raw.unionByName(raw).dropDuplicates(["o_orderkey"]), means=["p"]).withColumn("day", parse_date("day")).filter("day is not null")
    return clean.groupBy(F.year("day").alias("y")).agg(F.count("*").alias("n"), F.round(F.sum("p") / 1000, 2).alias("total_k"))


@query("""SELECT o_orderpriority, count(*) AS lines, round(sum(l_extendedprice), 2) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def b108_skew_job(t):
    facts = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_extendedprice")
    hot = quality.key_skew(facts, ["o_orderkey"], 2.0).select("o_orderkey")
    joined = rel.salted_join(facts, t.orders.select("o_orderkey", "o_orderpriority"), ["o_orderkey"], hot=hot, spread=["l_linenumber", "l_partkey"], salts=10)
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("value"))


@query("""SELECT user_id, count(*) AS n, round(sum(value), 2) AS total, max(value) > 150 AS alert FROM events WHERE value >= 1 GROUP BY 1""")
def b109_streaming_job(t):
    stream = jobs.file_stream(t.spark, t.folder, t.events.schema, "parquet", pathGlobFilter="events.parquet")
    totals = stream.filter("value >= 1").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), (F.max("value") > 150).alias("alert"))
    table = KeyedTable(t.spark, scratch(t.spark, "user_totals"), ["user_id"], parts=16)
    table.write(t.spark.createDataFrame([], totals.schema))
    jobs.drain(totals, scratch(t.spark, "state"), jobs.merge_sink(table, ["user_id"], "n"), mode="update")
    return table.read()


@query("""SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'C' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 11 <> 0) GROUP BY 1""")
def b110_lakehouse_job(t):
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    table = KeyedTable(t.spark, scratch(t.spark, "lake"), ["o_orderkey"], parts=16)
    table.write(t.orders.select(*cols), "struct<seq: int>")
    k = F.col("o_orderkey")
    changes = t.orders.filter((k % 7 == 0) | (k % 11 == 0)).select("o_orderkey", F.lit("C").alias("o_orderstatus"), "o_totalprice", F.when(k % 11 == 0, "delete").otherwise("update").alias("op"), F.lit(1).alias("seq"))
    table.apply_changes(changes, ["o_orderkey"], "op", "seq")
    return table.read().groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT sha256('pepper' || c_custkey) AS token, '***@mail.test' AS email, CASE WHEN c_acctbal < 500 THEN 'low' ELSE '' END AS failed FROM customer WHERE c_mktsegment <> 'FURNITURE'""")
def b111_privacy_job(t):
    rows = t.customer.withColumn("email", F.concat(F.lower("c_mktsegment"), F.lit("@mail.test")))
    kept, _ = quality.expect(rows, drop={"segment": F.col("c_mktsegment") != "FURNITURE"})
    tagged = quality.tag(kept, {"low": F.col("c_acctbal") >= 500})
    return quality.mask(tagged, "pepper", hashed={"c_custkey": "token"}, emails=["email"]).select("token", "email", "failed")


@query("""SELECT p_type, r_name, round(sum(l_extendedprice), 2) AS value FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE l_shipdate >= '2000-01-01' GROUP BY 1, 2""")
def b112_tuning_job(t):
    # filter and prune at the scan, sum before joining, broadcast only what is measured to be small
    sold = t.lineitem.filter("l_shipdate >= '2000-01-01'").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_extendedprice").alias("v"))
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    rows = sold.join(rel.small_side(places), F.col("l_suppkey") == F.col("s_suppkey")).join(rel.small_side(t.part.select("p_partkey", "p_type")), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("p_type", "r_name").agg(F.round(F.sum("v"), 2).alias("value"))


@query()
def b113_learning_job(t):
    per = t.events.groupBy("user_id").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.count_distinct("event_type").alias("kinds"))
    return ml.segments(per, ["n", "mean"], 3).groupBy("cluster").agg(F.count("*").alias("users"), F.round(F.avg("n"), 4).alias("n"), F.round(F.avg("mean"), 4).alias("mean"))


@query("""WITH c AS (SELECT l_partkey AS k, l_shipdate AS d, max(l_discount) AS rate FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2), f AS (SELECT l_orderkey, l_linenumber, l_partkey AS k, l_suppkey, l_shipdate AS d, l_extendedprice AS p FROM lineitem WHERE l_returnflag = 'N')
          SELECT f.l_orderkey, f.l_linenumber, f.k, f.l_suppkey, round(f.p * c.rate, 4) AS charge FROM f ASOF LEFT JOIN c ON f.k = c.k AND f.d >= c.d""")
def b114_rate_in_force(t):
    rates = t.lineitem.filter("l_returnflag = 'A'").groupBy(F.col("l_partkey").alias("k"), F.col("l_shipdate").alias("d")).agg(F.max("l_discount").alias("rate"))
    work = t.lineitem.filter("l_returnflag = 'N'").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("k"), "l_suppkey", F.col("l_shipdate").alias("d"), "l_extendedprice")
    out = as_of(work, rates, ["k"], "d", ["rate"], ["l_orderkey", "l_linenumber", "l_suppkey"])
    return out.select("l_orderkey", "l_linenumber", "k", "l_suppkey", F.round(F.col("l_extendedprice") * F.col("rate"), 4).alias("charge"))


TALK = "talk AS (SELECT ts::DATE AS day, user_id AS a, event_id % (SELECT max(user_id) + 1 FROM events) AS b, value FROM events WHERE user_id <> event_id % (SELECT max(user_id) + 1 FROM events))"


def _talk(t):
    """Each event as a message from its user to another one."""
    other = F.col("event_id") % (scalar(t.events, F.max("user_id")) + 1)
    return t.events.select(F.to_date("ts").alias("day"), F.col("user_id").alias("a"), other.alias("b"), "value").filter("a <> b")


@query(f"WITH {TALK} SELECT least(a, b) AS low, greatest(a, b) AS high, CAST(day AS VARCHAR) AS day, count(*) AS messages FROM talk GROUP BY 1, 2, 3")
def b115_undirected_totals(t):
    return _talk(t).groupBy(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"), F.col("day").cast("string").alias("day")).agg(F.count("*").alias("messages"))


@query("""SELECT c.c_custkey, m.s_name AS mother, f.s_name AS father FROM customer c LEFT JOIN supplier m ON m.s_suppkey = c.c_custkey % (SELECT count(*) FROM supplier) LEFT JOIN supplier f ON f.s_suppkey = (c.c_custkey * 3 + 1) % (SELECT count(*) FROM supplier)""")
def b116_parent_columns(t):
    size = scalar(t.supplier, F.count("*"))
    links = t.customer.select("c_custkey", F.explode(F.array(F.struct(F.lit("m").alias("role"), (F.col("c_custkey") % size).alias("parent")), F.struct(F.lit("f").alias("role"), ((F.col("c_custkey") * 3 + 1) % size).alias("parent")))).alias("x")).select("c_custkey", "x.*")
    named = links.join(t.supplier, F.col("parent") == F.col("s_suppkey"), "left")
    name = lambda role: F.max(F.when(F.col("role") == role, F.col("s_name")))
    return named.groupBy("c_custkey").agg(name("m").alias("mother"), name("f").alias("father"))


@query(f"""WITH {TALK} SELECT CAST(day AS VARCHAR) AS day, low, high, CASE WHEN d = 2 AND big > 0 THEN 'both sided with large' WHEN d = 2 THEN 'both sided' WHEN big > 0 THEN 'one sided with large' ELSE 'one sided' END AS kind FROM (SELECT day, least(a, b) AS low, greatest(a, b) AS high, count(DISTINCT a) AS d, count(CASE WHEN value > 100 THEN 1 END) AS big FROM talk GROUP BY 1, 2, 3)""")
def b117_interaction_type(t):
    per = _talk(t).groupBy(F.col("day").cast("string").alias("day"), F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).agg(F.count_distinct("a").alias("d"), F.count_if(F.col("value") > 100).alias("big"))
    sides = F.when(F.col("d") == 2, "both sided").otherwise("one sided")
    return per.select("day", "low", "high", F.concat(sides, F.when(F.col("big") > 0, " with large").otherwise("")).alias("kind"))


@query("""WITH u AS (SELECT ts::DATE AS day, user_id, count(DISTINCT event_type) AS n, min(event_type) AS one, sum(value) AS v FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1, 2), d AS (SELECT DISTINCT ts::DATE AS day FROM events)
          SELECT CAST(d.day AS VARCHAR) AS day, p.platform, count(u.user_id) AS users, round(coalesce(sum(v), 0), 2) AS value FROM d CROSS JOIN (VALUES ('click'), ('purchase'), ('both')) p(platform) LEFT JOIN u ON u.day = d.day AND CASE WHEN n = 2 THEN 'both' ELSE one END = p.platform GROUP BY 1, 2""")
def b118_exclusive_platform(t):
    used = t.events.filter(F.col("event_type").isin("click", "purchase")).groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.count_distinct("event_type").alias("n"), F.min("event_type").alias("one"), F.sum("value").alias("v"))
    sums = used.groupBy("day", F.when(F.col("n") == 2, "both").otherwise(F.col("one")).alias("platform")).agg(F.count("*").alias("users"), F.sum("v").alias("value"))
    grid = date_spine(t.events, "ts").withColumn("platform", F.explode(F.array(*[F.lit(p) for p in ("click", "purchase", "both")])))
    return grid.join(sums, ["day", "platform"], "left").select(F.col("day").cast("string"), "platform", F.coalesce("users", F.lit(0)).alias("users"), F.round(F.coalesce("value", F.lit(0.0)), 2).alias("value"))


@query("""WITH g AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1), d AS (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) AS r FROM g WHERE c > 1) SELECT l.l_orderkey, l.l_partkey, 'DUP' || r AS label FROM lineitem l LEFT JOIN d ON l.l_orderkey = d.l_orderkey""")
def b119_label_duplicates(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey")
    sizes = rows.groupBy("l_orderkey").agg(F.count("*").alias("_rows"))
    numbered = row_numbers(sizes.filter("_rows > 1").select("l_orderkey"), [], ["l_orderkey"], "r")
    labels = sizes.join(numbered, "l_orderkey", "left").withColumn("label", F.concat(F.lit("DUP"), F.col("r"))).drop("r")
    return rel.attach(rows, labels, ["l_orderkey"])


@query("""WITH u AS (SELECT p_name, p_size, count(*) AS c FROM part GROUP BY 1, 2), o AS (SELECT * FROM u WHERE c = 1) SELECT p_name, count(*) AS singles, max(p_size) AS highest FROM o GROUP BY 1""")
def b120_values_once(t):
    once = t.part.groupBy("p_name", "p_size").agg(F.count("*").alias("c")).filter("c = 1")
    return once.groupBy("p_name").agg(F.count("*").alias("singles"), F.max("p_size").alias("highest"))


@query("""WITH s AS (SELECT *, value > 50 AS up, lag(value > 50) OVER w AS was FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), g AS (SELECT *, sum(CASE WHEN up AND was IS NOT TRUE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM s)
          SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M') AS login, strftime(max(ts), '%Y-%m-%d %H:%M') AS logout, count(CASE WHEN up THEN 1 END) AS on_rows FROM g WHERE g > 0 GROUP BY user_id, g""")
def b121_on_off_segments(t):
    rows = t.events.select("user_id", "ts", "event_id", (F.col("value") > 50).alias("up"))
    starts = lambda w: F.col("up") & ~F.coalesce(F.lag("up").over(w), F.lit(False))
    seg = B.flag_groups(rows, ["user_id"], ["ts", "event_id"], starts).filter("grp > 0")
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    return seg.groupBy("user_id", "grp").agg(shown(F.min("ts")).alias("login"), shown(F.max("ts")).alias("logout"), F.count_if("up").alias("on_rows")).drop("grp")


@query("""SELECT user_id, count(*) AS n FROM (SELECT user_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events) WHERE event_type = 'view' AND nxt = 'click' GROUP BY 1""")
def b122_direct_next_state(t):
    rows = reach_back(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], 1, prev=lambda w: F.lag("event_type").over(w))
    return rows.filter("event_type = 'click' and prev = 'view'").groupBy("user_id").agg(F.count("*").alias("n"))


@query("""SELECT user_id, count(CASE WHEN event_type = 'click' THEN 1 END) = count(CASE WHEN event_type = 'view' THEN 1 END) AS equal_marks FROM events WHERE event_type IN ('click', 'view') GROUP BY 1 HAVING count(DISTINCT event_type) = 2""")
def b123_two_attributes(t):
    n = lambda k: F.count_if(F.col("event_type") == k)
    per = t.events.groupBy("user_id").agg(n("click").alias("c"), n("view").alias("v")).filter("c > 0 and v > 0")
    return per.select("user_id", (F.col("c") == F.col("v")).alias("equal_marks"))


@query("""WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) SELECT o_custkey, o_orderkey FROM r WHERE rn = 2 OR n = 1""")
def b124_second_or_only(t):
    two = rel.top_k(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["-o_orderdate", "-o_orderkey"], 2)
    return two.groupBy("o_custkey").agg(F.max_by("o_orderkey", "rk").alias("o_orderkey"))


@query("SELECT event_id, repeat('*', CAST(1 + least(floor(value / 20), 4) AS INTEGER)) AS bar FROM events")
def b125_text_bar(t):
    return t.events.select("event_id", F.repeat(F.lit("*"), (1 + F.least(F.floor(F.col("value") / 20), F.lit(4))).cast("int")).alias("bar"))


@query(f"""WITH {STAFF}, m AS (SELECT DISTINCT boss AS id FROM staff WHERE boss IS NOT NULL) SELECT e.id, e.boss, round(avg(CASE WHEN e.id NOT IN (SELECT id FROM m) THEN salary END) OVER (PARTITION BY dept), 6) AS peer_mean FROM staff e""")
def b126_peer_mean(t):
    people = staff(t)
    bosses = people.filter("boss is not null").select(F.col("boss").alias("id")).distinct().withColumn("is_boss", F.lit(True))
    marked = people.join(bosses, "id", "left")
    return rel.with_group_stats(marked, ["dept"], peer_mean=F.round(F.avg(F.when(F.col("is_boss").isNull(), F.col("salary"))), 6)).select("id", "boss", "peer_mean")


@query(f"WITH {TALK}, d AS (SELECT day FROM talk GROUP BY 1 HAVING count(DISTINCT b) > count(DISTINCT a)) SELECT CAST(day AS VARCHAR) AS day, a, b, value FROM talk WHERE day IN (SELECT day FROM d)")
def b127_group_filter_keep_rows(t):
    talk = _talk(t)
    days = talk.groupBy("day").agg(F.count_distinct("a").alias("s"), F.count_distinct("b").alias("r")).filter("r > s").select("day")
    return talk.join(days, "day", "left_semi").select(F.col("day").cast("string"), "a", "b", "value")


@query(f"""WITH {TALK}, f AS (SELECT DISTINCT a, b FROM talk), s AS (SELECT user_id, sum(value) AS score FROM events GROUP BY 1) SELECT a, count(*) AS friends, round(sum(score), 2) AS score FROM f JOIN s ON s.user_id = f.b GROUP BY 1 HAVING sum(score) > 150000""")
def b128_neighbour_sum(t):
    links = _talk(t).select("a", F.col("b").alias("user_id")).distinct()
    scores = t.events.groupBy("user_id").agg(F.sum("value").alias("score"))
    degree = links.groupBy("user_id").agg(F.count("*").alias("_rows")).join(scores, "user_id")
    return rel.attach(links, degree, ["user_id"]).groupBy("a").agg(F.count("*").alias("friends"), F.round(F.sum("score"), 2).alias("score")).filter("score > 150000")


@query("""WITH c AS (SELECT DISTINCT o_custkey, o_orderdate, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE round(o_totalprice) END AS m FROM orders), u AS (SELECT c_custkey, c_mktsegment, coalesce(sum(coalesce(m, 0)), 0) AS minutes, count(o_orderdate) AS calls FROM customer LEFT JOIN c ON o_custkey = c_custkey GROUP BY 1, 2)
          SELECT c_custkey, minutes, calls, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY minutes DESC) AS place FROM u""")
def b129_usage_report(t):
    calls = (t.orders.select("o_custkey", "o_orderdate", "o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.round("o_totalprice")).alias("m")).distinct()
             .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(F.coalesce("m", F.lit(0.0))).alias("minutes"), F.count("*").alias("calls")))
    use = t.customer.select("c_custkey", "c_mktsegment").join(calls, "c_custkey", "left").fillna({"minutes": 0.0, "calls": 0})
    ranks = rank_table(use, ["c_mktsegment"], "minutes", True).select("c_mktsegment", "minutes", F.col("rows").alias("_rows"), F.col("dense_rank").alias("place"))
    return rel.attach(use, ranks, ["c_mktsegment", "minutes"]).drop("c_mktsegment")


@query("""SELECT CAST(date_trunc('week', o_orderdate)::DATE AS VARCHAR) AS week, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS pending, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS shipped, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS delivered FROM orders GROUP BY 1""")
def b130_status_per_week(t):
    n = lambda s: F.count_if(F.col("o_orderstatus") == s)
    return t.orders.groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).cast("string").alias("week")).agg(n("O").alias("pending"), n("P").alias("shipped"), n("F").alias("delivered"))


@query("""WITH m AS (SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS m, round(sum(l_extendedprice), 2) AS v FROM lineitem GROUP BY 1, 2) SELECT l_partkey, min(m) AS launch, arg_min(v, m) AS launch_value FROM m GROUP BY 1""")
def b131_first_period(t):
    m = t.lineitem.groupBy("l_partkey", F.date_format("l_shipdate", "yyyy-MM").alias("m")).agg(F.round(F.sum("l_extendedprice"), 2).alias("v"))
    return m.groupBy("l_partkey").agg(F.min("m").alias("launch"), F.min_by("v", "m").alias("launch_value"))


@query("""WITH s AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders), g AS (SELECT o_custkey, y - lag(y) OVER (PARTITION BY o_custkey ORDER BY y) AS gap FROM s) SELECT o_custkey, min(gap) AS step FROM g GROUP BY 1 HAVING count(gap) >= 1 AND min(gap) = max(gap)""")
def b132_constant_spacing(t):
    """Customers whose years with orders are equally far apart."""
    years = t.orders.select("o_custkey", F.year("o_orderdate").alias("y")).distinct()
    steps = reach_back(years, ["o_custkey"], ["y"], 1, gap=lambda w: F.col("y") - F.lag("y").over(w))
    return steps.groupBy("o_custkey").agg(F.min("gap").alias("step"), F.max("gap").alias("hi")).filter("step = hi").select("o_custkey", "step")


@query("""SELECT o_custkey FROM orders GROUP BY 1 HAVING count(CASE WHEN year(o_orderdate) = 1999 THEN 1 END) > 2 AND count(CASE WHEN year(o_orderdate) = 2000 THEN 1 END) > 2""")
def b133_both_years(t):
    years = agg.pivot_sum(t.orders.withColumn("y", F.year("o_orderdate")), ["o_custkey"], "y", [1999, 2000], F.lit(1))
    return years.filter("`1999` > 2 and `2000` > 2").select("o_custkey")


@query("SELECT CAST(ts::DATE AS VARCHAR) AS day, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def b134_last_row_per_day(t):
    rows = t.events.select(F.to_date("ts").cast("string").alias("day"), "ts", "event_id")
    return quality.keep_latest(rows, ["day"], "ts", "event_id").select("day", "event_id")


@query("""SELECT c.pos, c.label, count(customer.c_custkey) AS n FROM (VALUES (1, 'low', -99999, 0), (2, 'average', 0, 9000), (3, 'high', 9000, 99999), (4, 'very high', 99999, 999999)) c(pos, label, lo, hi) LEFT JOIN customer ON c_acctbal >= lo AND c_acctbal < hi GROUP BY 1, 2""")
def b135_fixed_categories(t):
    b = F.col("c_acctbal")
    counts = t.customer.groupBy(F.when(b < 0, 1).when(b < 9000, 2).when(b < 99999, 3).otherwise(4).alias("pos")).agg(F.count("*").alias("n"))
    names = t.spark.createDataFrame([(1, "low"), (2, "average"), (3, "high"), (4, "very high")], "pos int, label string")
    return names.join(counts, "pos", "left").fillna(0, ["n"])


@query(f"WITH {STAFF} SELECT boss, count(*) AS reports FROM staff WHERE boss IS NOT NULL GROUP BY 1 HAVING count(*) >= 3")
def b136_managers_with_reports(t):
    return staff(t).filter("boss is not null").groupBy("boss").agg(F.count("*").alias("reports")).filter("reports >= 3")


@query(f"""WITH {STAFF}, d AS (SELECT dept, count(*) AS n FROM staff GROUP BY 1), b AS (SELECT dept FROM d WHERE n = (SELECT max(n) FROM d)) SELECT id, dept FROM staff WHERE dept IN (SELECT dept FROM b) AND id IN (SELECT boss FROM staff)""")
def b137_largest_department_managers(t):
    people = staff(t)
    sizes = people.groupBy("dept").agg(F.count("*").alias("n"))
    largest = sizes.filter(F.col("n") == scalar(sizes, F.max("n"))).select("dept")
    bosses = people.select(F.col("boss").alias("id")).filter("id is not null")
    return people.join(largest, "dept", "left_semi").join(bosses, "id", "left_semi").select("id", "dept")


@query("""SELECT c_mktsegment, c_nationkey, round(1000000.0::DOUBLE / count(*), 6) AS per_head FROM customer GROUP BY 1, 2""")
def b138_budget_split(t):
    return t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.round(F.lit(1000000.0) / F.count("*"), 6).alias("per_head"))


@query("""SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-08-01' AND o_orderdate < TIMESTAMP '2001-02-01' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-02-01')""")
def b139_lapsed_customers(t):
    before = t.orders.filter("o_orderdate >= '2000-08-01' and o_orderdate < '2001-02-01'").select("o_custkey").distinct()
    return rel.absent(before, t.orders.filter("o_orderdate >= '2001-02-01'"), ["o_custkey"])


@query("""SELECT o_custkey, round(100.0 * count(CASE WHEN o_orderdate >= '2000-01-01' THEN 1 END) / count(*), 6) AS recent_pct FROM orders GROUP BY 1 HAVING count(CASE WHEN o_orderdate >= '2000-01-01' THEN 1 END) * 2 > count(*)""")
def b140_recent_share(t):
    recent = F.count_if(F.col("o_orderdate") >= "2000-01-01")
    per = t.orders.groupBy("o_custkey").agg(recent.alias("r"), F.count("*").alias("n")).filter("r * 2 > n")
    return per.select("o_custkey", pct(F.col("r"), F.col("n")).alias("recent_pct"))


@query("""WITH d AS (SELECT l_suppkey, l_shipdate::DATE AS day, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), m AS (SELECT *, avg(q) OVER (PARTITION BY l_suppkey) AS mean FROM d) SELECT l_suppkey, CAST(day AS VARCHAR) AS day, sum(q) OVER (PARTITION BY l_suppkey ORDER BY day) AS running FROM m WHERE q > mean""")
def b141_running_over_filtered(t):
    days = t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("q"))
    w = Window.partitionBy("l_suppkey")        # one row per date
    kept = days.withColumn("mean", F.avg("q").over(w)).filter("q > mean")
    return kept.select("l_suppkey", F.col("day").cast("string"), F.sum("q").over(w.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)).alias("running"))


@query("SELECT o_custkey, round(max(o_totalprice) - min(o_totalprice), 2) AS spread FROM orders GROUP BY 1")
def b142_spread(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.max("o_totalprice") - F.min("o_totalprice"), 2).alias("spread"))


@query("""WITH m AS (SELECT c_mktsegment AS g, date_trunc('month', o_orderdate)::DATE AS m, round(sum(o_totalprice), 2) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) SELECT a.g, CAST(a.m AS VARCHAR) AS month, a.v AS value, b.v AS last_year FROM m a JOIN m b ON a.g = b.g AND a.m = (b.m + INTERVAL 12 MONTH)::DATE""")
def b143_same_month_last_year(t):
    m = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("g"), month("o_orderdate").alias("m")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    before = m.select("g", F.add_months("m", 12).alias("m"), F.col("value").alias("last_year"))
    return m.join(before, ["g", "m"]).select("g", F.col("m").cast("string").alias("month"), "value", "last_year")

"""P, J, O, U: projection, predicates, joins, ordering, sets."""


from pyspark.sql import functions as F

from tidewater.functions.columns import line_revenue, month
from tidewater.operators import rel
from tidewater.operators.ordered import reach_back, row_numbers
from tidewater.plans.registry import query
from tidewater.sources.io import scalar, spine



@query("SELECT c_custkey AS id, c_name AS full_name FROM customer")
def p01_select_rename(t):
    return t.customer.drop("c_acctbal").withColumnsRenamed({"c_custkey": "id", "c_name": "full_name"}).select("id", "full_name")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * (1 - l_discount), 4) AS net,
                 round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charged FROM lineitem""")
def p02_computed_column(t):
    return (t.lineitem.withColumn("net", F.round(line_revenue(), 4))
            .withColumn("charged", F.round(line_revenue() * (1 + F.col("l_tax")), 6))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "net", "charged"))


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 150000
          AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def p03_range_filter(t):
    return (t.orders.filter(F.col("o_totalprice").between(100000, 150000)
                            & (F.col("o_orderdate") >= "1998-01-01") & (F.col("o_orderdate") < "1999-01-01"))
            .select("o_orderkey", "o_totalprice"))


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')")
def p04_membership(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")).select("o_orderkey")


@query("""SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%' OR regexp_matches(p_name, '(bolt|ring)$')
          OR contains(p_brand, '#17')""")
def p05_pattern(t):
    return (t.part.filter(F.col("p_name").like("small%") | F.col("p_name").rlike("(bolt|ring)$")
                          | F.col("p_brand").contains("#17")).select("p_partkey", "p_name"))


@query("""SELECT d.doc_id, CASE WHEN quality IS NULL THEN 'unlabelled' ELSE 'labelled' END AS state
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR l.toxic IS NOT NULL""")
def p06_null_predicate(t):
    both = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return (both.filter(F.col("quality").isNull() | F.col("toxic").isNotNull())
            .select("doc_id", F.when(F.col("quality").isNull(), "unlabelled").otherwise("labelled").alias("state")))


@query("""SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'O') IS DISTINCT FROM
          CASE WHEN o_totalprice > 250000 THEN o_orderstatus END""")
def p07_null_safe_difference(t):
    a = F.nullif(F.col("o_orderstatus"), F.lit("O"))
    b = F.when(F.col("o_totalprice") > 250000, F.col("o_orderstatus"))
    return t.orders.filter(~a.eqNullSafe(b)).select("o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium'
          ELSE 'small' END AS size FROM orders""")
def p08_case(t):
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.when(p >= 300000, "large").when(p >= 100000, "medium").otherwise("small").alias("size"))


@query("SELECT DISTINCT p_brand, p_type FROM part")
def p09_distinct(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("SELECT l_orderkey, l_linenumber, count(*) > 0 AS kept FROM lineitem GROUP BY 1, 2")
def p10_dedup_by_key(t):
    return t.lineitem.select("l_orderkey", "l_linenumber").dropDuplicates(["l_orderkey", "l_linenumber"]).withColumn("kept", F.lit(True))


@query("""SELECT n_name, row_number() OVER (ORDER BY CASE WHEN n_name = 'NATION_7' THEN 0 ELSE 1 END, n_name) AS place FROM nation""")
def p11_custom_sort(t):
    first = F.when(F.col("n_name") == "NATION_7", 0).otherwise(1)
    return row_numbers(t.nation.withColumn("first", first), [], ["first", "n_name"], "place").select("n_name", "place")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)")
def p12_scalar_subquery(t):
    return t.customer.filter(F.col("c_acctbal") > scalar(t.customer, F.avg("c_acctbal"))).select("c_custkey", "c_acctbal")


@query("""SELECT c_custkey, 'any_all' AS test FROM customer
          WHERE c_acctbal < ANY (SELECT s_acctbal FROM supplier WHERE s_nationkey = 3)
            AND c_acctbal > ALL (SELECT s_acctbal FROM supplier WHERE s_nationkey = 7)
          UNION ALL SELECT c_custkey, 'exists' FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 490000)
          UNION ALL SELECT c_custkey, 'not_in' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)""")
def p13_quantified_subqueries(t):
    at = lambda n, f: scalar(t.supplier.filter(F.col("s_nationkey") == n), f("s_acctbal"))
    c, o = t.customer, t.orders
    bal = F.col("c_acctbal")
    above_all = at(7, F.max).isNull() | (bal > at(7, F.max))          # ALL over an empty set is true, ANY is false
    quantified = c.filter((bal < at(3, F.max)) & above_all).select("c_custkey", F.lit("any_all").alias("test"))
    big = lambda low: o.filter(F.col("o_totalprice") > low).select(F.col("o_custkey").alias("c_custkey"))
    exists = rel.present(c, big(490000), ["c_custkey"]).select("c_custkey", F.lit("exists").alias("test"))
    absent = rel.absent(c, big(250000), ["c_custkey"]).select("c_custkey", F.lit("not_in").alias("test"))
    return quantified.unionByName(exists).unionByName(absent)


@query("""SELECT o_orderkey FROM orders o WHERE o_totalprice > 1.5 * (SELECT avg(o_totalprice) FROM orders i WHERE i.o_orderpriority = o.o_orderpriority)""")
def p14_correlated_subquery(t):
    rows = rel.with_group_stats(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderpriority"], mean=F.avg("o_totalprice"))
    return rows.filter(F.col("o_totalprice") > 1.5 * F.col("mean")).select("o_orderkey")


P15 = """WITH spend AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey),
     big AS (SELECT * FROM spend WHERE total > 2000000),
     named AS (SELECT c_mktsegment, total FROM big JOIN customer ON c_custkey = o_custkey)
SELECT c_mktsegment, count(*) AS n, round(sum(total), 2) AS total FROM named GROUP BY c_mktsegment"""


@query(P15)
def p15_cte_chain(t):
    return t.sql(P15, "orders", "customer")


@query("""SELECT s_suppkey, CASE WHEN s_nationkey = 5 THEN round(s_acctbal * 1.1, 4) ELSE s_acctbal END AS s_acctbal FROM supplier""")
def p16_update_values(t):
    raised = F.when(F.col("s_nationkey") == 5, F.round(F.col("s_acctbal") * 1.1, 4)).otherwise(F.col("s_acctbal"))
    return t.supplier.withColumn("s_acctbal", raised).select("s_suppkey", "s_acctbal")


@query("SELECT c_custkey FROM customer WHERE NOT (c_acctbal < 1000 AND c_mktsegment = 'HOUSEHOLD')")
def p17_delete_rows(t):
    gone = (F.col("c_acctbal") < 1000) & (F.col("c_mktsegment") == "HOUSEHOLD")
    return t.customer.filter(~F.coalesce(gone, F.lit(False))).select("c_custkey")


@query("SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def j01_inner_join(t):
    states = t.orders.select("o_orderkey", "o_orderstatus")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")
    return states.join(lines, "o_orderkey")


@query("""SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey
          AND o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1""")
def j02_left_join(t):
    recent = (t.orders.filter(F.col("o_orderdate") >= "2001-01-01").groupBy(F.col("o_custkey").alias("c_custkey"))
              .agg(F.count("*").alias("n")))
    return t.customer.select("c_custkey").join(recent, "c_custkey", "left").fillna(0, ["n"])


@query("""SELECT n_name, count(s_suppkey) AS suppliers FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def j03_right_join(t):
    return (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right")
            .groupBy("n_name").agg(F.count("s_suppkey").alias("suppliers")))


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS n1997 FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1),
               b AS (SELECT o_custkey AS k, count(*) AS n1998 FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1)
          SELECT coalesce(a.k, b.k) AS custkey, n1997, n1998 FROM a FULL JOIN b ON a.k = b.k""")
def j04_full_outer_join(t):
    year = lambda y: (t.orders.filter(F.year("o_orderdate") == y).groupBy(F.col("o_custkey").alias("custkey"))
                      .agg(F.count("*").alias(f"n{y}")))
    return year(1997).join(year(1998), "custkey", "full_outer")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 1997)""")
def j05_anti_join(t):
    active = t.orders.filter(F.year("o_orderdate") == 1997).select(F.col("o_custkey").alias("c_custkey"))
    return rel.absent(t.customer, active, ["c_custkey"]).select("c_custkey")


@query("""SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R')""")
def j06_semi_join(t):
    sold = t.lineitem.filter("l_quantity = 50 and l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return rel.present(t.part, sold, ["p_partkey"]).select("p_partkey")


@query("""SELECT s_suppkey FROM supplier LEFT JOIN (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_discount = 0.1 AND l_quantity = 1) x
          ON s_suppkey = l_suppkey WHERE l_suppkey IS NULL""")
def j07_left_join_is_null(t):
    hit = t.lineitem.filter("l_discount = 0.1 and l_quantity = 1").select("l_suppkey").distinct()
    return (t.supplier.join(hit, F.col("s_suppkey") == F.col("l_suppkey"), "left").filter(F.col("l_suppkey").isNull())
            .select("s_suppkey"))


@query("""WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders), s AS (SELECT DISTINCT c_mktsegment FROM customer),
          n AS (SELECT c_mktsegment, date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
          SELECT s.c_mktsegment, CAST(m.m::DATE AS VARCHAR) AS month, coalesce(n.n, 0) AS n FROM s CROSS JOIN m LEFT JOIN n ON n.m = m.m AND n.c_mktsegment = s.c_mktsegment""")
def j08_key_date_grid(t):
    sold = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_mktsegment", month("o_orderdate").alias("month")).agg(F.count("*").alias("n")))
    edge = lambda f: scalar(t.orders, f(month("o_orderdate")))
    keys = t.customer.select("c_mktsegment").distinct().withColumns({"lo": edge(F.min), "hi": edge(F.max)})
    grid = spine(keys, "lo", "hi", "month", "interval 1 month")
    return (grid.join(sold, ["c_mktsegment", "month"], "left")
            .select("c_mktsegment", F.col("month").cast("string"), F.coalesce("n", F.lit(0)).alias("n")))


@query("""SELECT a.s_suppkey AS left_id, b.s_suppkey AS right_id, a.s_nationkey FROM supplier a JOIN supplier b
          ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey AND abs(a.s_acctbal - b.s_acctbal) < 500""")
def j09_unordered_pairs(t):
    # the balance is bucketed by the tolerance, so only neighbours meet, not whole nations
    near = t.supplier.select("s_nationkey", "s_suppkey", "s_acctbal", F.floor(F.col("s_acctbal") / 500).alias("cell"))
    left = near.withColumn("cell", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1))).alias("a")
    right = near.alias("b")
    return (left.join(right, (F.col("a.s_nationkey") == F.col("b.s_nationkey")) & (F.col("a.cell") == F.col("b.cell"))
                      & (F.col("a.s_suppkey") < F.col("b.s_suppkey"))
                      & (F.abs(F.col("a.s_acctbal") - F.col("b.s_acctbal")) < 500))
            .select(F.col("a.s_suppkey").alias("left_id"), F.col("b.s_suppkey").alias("right_id"), F.col("a.s_nationkey")))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
          SELECT a.event_id, b.event_id AS next_event, b.event_type AS next_type FROM r a JOIN r b ON a.user_id = b.user_id AND b.rn = a.rn + 1""")
def j10_next_row(t):
    rows = t.events.select("user_id", "ts", "event_id", "event_type")
    # look-ahead is a look-back in reversed order
    seen = reach_back(rows, ["user_id"], ["-ts", "-event_id"], 1, next_event=lambda w: F.lag("event_id").over(w),
                      next_type=lambda w: F.lag("event_type").over(w))
    return seen.filter(F.col("next_event").isNotNull()).select("event_id", "next_event", "next_type")


@query("""WITH e AS (SELECT o_orderkey AS id, o_custkey, o_orderdate::DATE AS s, o_orderdate::DATE + 29 AS e FROM orders WHERE o_orderstatus = 'F')
          SELECT o.o_orderkey, e.id AS cover FROM orders o JOIN e ON o.o_custkey = e.o_custkey AND o.o_orderdate::DATE BETWEEN e.s AND e.e""")
def j11_interval_join(t):
    cover = (t.orders.filter("o_orderstatus = 'F'")
             .select("o_custkey", F.col("o_orderkey").alias("cover"), F.to_date("o_orderdate").alias("s"),
                     F.date_add("o_orderdate", 29).alias("e")))
    points = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return rel.interval_join(points, cover, ["o_custkey"], "day", "s", "e").select("o_orderkey", "cover")


@query("""WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events), s AS (SELECT user_id, min(ts::DATE) AS first_day FROM events GROUP BY 1)
          SELECT s.user_id, CAST(s.first_day AS VARCHAR) AS first_day FROM s JOIN d ON d.user_id = s.user_id AND d.day = s.first_day + 7""")
def j12_offset_date_join(t):
    days = t.events.select("user_id", F.to_date("ts").alias("day")).distinct()
    first = t.events.groupBy("user_id").agg(F.to_date(F.min("ts")).alias("first_day"))
    return (first.withColumn("day", F.date_add("first_day", 7)).join(days, ["user_id", "day"])
            .select("user_id", F.col("first_day").cast("string")))


@query("""SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def j13_broadcast_join(t):
    return (t.customer.join(rel.small_side(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(rel.small_side(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
            .groupBy("r_name").agg(F.count("*").alias("n")))


@query("""SELECT o_orderkey, l_linenumber, l_partkey, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def j14_salted_join(t):
    facts = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    return rel.salted_join(facts, t.orders.select("o_orderkey", "o_orderpriority"), ["o_orderkey"],
                           spread=["l_linenumber", "l_partkey"], hot_rows=8)


@query("""WITH a AS (SELECT c_custkey AS k, c_acctbal AS v, c_mktsegment AS g FROM customer WHERE c_custkey % 11 <> 0),
               b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS v, c_mktsegment AS g FROM customer WHERE c_custkey % 13 <> 0)
          SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'changed' END AS status,
                 a.v AS left_v, b.v AS right_v, a.g AS left_g, b.g AS right_g
          FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v IS DISTINCT FROM b.v OR a.g IS DISTINCT FROM b.g""")
def j15_table_difference(t):
    base = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.col("c_mktsegment").alias("g"))
    left = base.filter("k % 11 <> 0")
    right = base.filter("k % 13 <> 0").withColumn("v", F.when(F.col("k") % 5 != 0, F.col("v")))
    return rel.differences(left, right, ["k"], ["v", "g"])


@query("""SELECT r_name, p_type, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def j16_star_join(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("r_name", "p_type").agg(F.round(F.sum(line_revenue()), 4).alias("revenue")))


@query("""WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer WHERE c_mktsegment = 'HOUSEHOLD'),
               b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer WHERE c_mktsegment = 'MACHINERY')
          SELECT a.c_custkey AS first_id, b.c_custkey AS second_id FROM a LEFT JOIN b ON a.rn = b.rn""")
def j17_rank_join(t):
    numbered = lambda seg, name: row_numbers(t.customer.filter(F.col("c_mktsegment") == seg).select(F.col("c_custkey").alias(name)), [], [name])
    return numbered("HOUSEHOLD", "first_id").join(numbered("MACHINERY", "second_id"), "rn", "left").drop("rn")


@query("""SELECT c_custkey, count(*) AS n FROM (SELECT nullif(o_custkey % 50, 0) AS k FROM orders) o JOIN customer ON c_custkey = o.k GROUP BY 1""")
def j18_null_key_join(t):
    keyed = t.orders.select(F.nullif(F.col("o_custkey") % 50, F.lit(0)).alias("c_custkey")).filter(F.col("c_custkey").isNotNull())
    counts = keyed.groupBy("c_custkey").agg(F.count("*").alias("n"))
    return t.customer.select("c_custkey").join(counts, "c_custkey")


@query("""SELECT count(*) AS joined_rows, count(DISTINCT o_orderkey) AS orders, round(sum(o_totalprice), 2) AS inflated,
          (SELECT round(sum(o_totalprice), 2) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS true_total
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def j19_fan_out_audit(t):
    # counting lines per order first gives the inflated figures without materializing the join
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    return (t.orders.join(lines, "o_orderkey")
            .agg(F.sum("lines").alias("joined_rows"), F.count("*").alias("orders"),
                 F.round(F.sum(F.col("o_totalprice") * F.col("lines")), 2).alias("inflated"),
                 F.round(F.sum("o_totalprice"), 2).alias("true_total")))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS place FROM orders")
def o01_total_order(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return row_numbers(rows, [], ["o_orderpriority", "-o_totalprice", "o_orderkey"], "place").select("o_orderkey", "place")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def o02_limit(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("""SELECT c_nationkey, c_custkey, c_acctbal, rk FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rk FROM customer) WHERE rk <= 3""")
def o03_top_k_per_group(t):
    return rel.top_k(t.customer.select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], ["-c_acctbal", "c_custkey"], 3)


@query("""SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem l WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem i WHERE i.l_suppkey = l.l_suppkey)""")
def o04_top_1_with_ties(t):
    return rel.best_rows(t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"), ["l_suppkey"], "l_quantity")


@query("""SELECT p_brand, p_size FROM (SELECT p_brand, p_size, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS d FROM part) WHERE d = 3 GROUP BY 1, 2""")
def o05_nth_value(t):
    return rel.nth_distinct(t.part, ["p_brand"], "p_size", 3)


@query("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def o06_last_n_rows(t):
    return t.events.orderBy(F.desc("ts"), F.desc("event_id")).limit(20).select("event_id", "event_type")


@query("""SELECT c_custkey, c_acctbal FROM (SELECT *, percent_rank() OVER (ORDER BY c_acctbal DESC) AS pr FROM customer) WHERE pr <= 0.05""")
def o07_top_percent(t):
    from tidewater.operators.ordered import rank_table
    cut = scalar(rank_table(t.customer, [], "c_acctbal", True).filter("percent_rank <= 0.05"), F.min("c_acctbal"))
    return t.customer.filter(F.col("c_acctbal") >= cut).select("c_custkey", "c_acctbal")


@query("""SELECT l_suppkey, l_partkey, qty FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS qty, row_number() OVER (PARTITION BY l_suppkey ORDER BY sum(l_quantity) DESC, l_partkey) AS rn
          FROM lineitem GROUP BY 1, 2) WHERE rn = 1""")
def o08_tie_break(t):
    sums = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("qty"))
    return rel.top_k(sums, ["l_suppkey"], ["-qty", "l_partkey"], 1).drop("rk")


@query("SELECT c_custkey AS id, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def u01_union_all(t):
    return (t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"))
            .unionByName(t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"))))


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def u02_union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("nation")).union(t.supplier.select("s_nationkey")).distinct()


@query("SELECT o_custkey AS custkey FROM orders WHERE year(o_orderdate) = 1996 INTERSECT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2000")
def u03_intersect(t):
    year = lambda y: t.orders.filter(F.year("o_orderdate") == y).select(F.col("o_custkey").alias("custkey"))
    return year(1996).distinct().intersect(year(2000).distinct())


@query("""SELECT l_partkey AS partkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 30""")
def u04_except(t):
    parts = lambda cond: t.lineitem.filter(cond).select(F.col("l_partkey").alias("partkey"))
    return rel.absent(parts("l_returnflag = 'R'").distinct(), parts("l_returnflag = 'A' and l_quantity > 30"), ["partkey"])

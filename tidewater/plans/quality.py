"""Q: data quality and privacy."""

from pyspark.sql import functions as F

from tidewater.operators import quality as Q
from tidewater.plans.registry import query
from tidewater.sources.durable import durable

HOLES = "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END"


def _holes(t):
    return t.customer.withColumn("c_acctbal", F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")))


def _rules():
    return {"positive_qty": F.col("l_quantity") > 5, "discount_range": F.col("l_discount") < 0.1,
            "not_future": F.col("l_shipdate") <= "2001-06-30"}


@query(f"""SELECT count(*) AS rows, count(*) - count({HOLES}) AS "null_c_acctbal", count(CASE WHEN {HOLES} < 100 THEN 1 END) AS "invalid_low",
          round(100.0 * (count(*) - count(DISTINCT c_nationkey)) / count(*), 6) AS duplicate_pct FROM customer""")
def q01_quality_metrics(t):
    return Q.quality_metrics(_holes(t), ["c_nationkey"], ["c_acctbal"], {"low": F.col("c_acctbal") < 100})


@query("""SELECT 'positive_qty' AS rule, count(CASE WHEN NOT l_quantity > 5 THEN 1 END) AS failed, count(CASE WHEN l_quantity > 5 THEN 1 END) AS passed FROM lineitem
          UNION ALL SELECT 'discount_range', count(CASE WHEN NOT l_discount < 0.1 THEN 1 END), count(CASE WHEN l_discount < 0.1 THEN 1 END) FROM lineitem
          UNION ALL SELECT 'not_future', count(CASE WHEN l_shipdate > '2001-06-30' THEN 1 END), count(CASE WHEN l_shipdate <= '2001-06-30' THEN 1 END) FROM lineitem""")
def q02_expectations(t):
    return Q.rule_report(t.lineitem, _rules())


@query("""SELECT r.rule, (SELECT count(*) FROM lineitem) AS seen, (SELECT count(*) FROM lineitem WHERE l_quantity > 5 AND l_discount < 0.1) AS written,
          CASE r.rule WHEN 'positive_qty' THEN (SELECT count(*) FROM lineitem WHERE NOT l_quantity > 5) WHEN 'discount_range' THEN (SELECT count(*) FROM lineitem WHERE NOT l_discount < 0.1)
          ELSE (SELECT count(*) FROM lineitem WHERE NOT l_shipdate <= '2001-06-30') END AS failed FROM (SELECT unnest(['positive_qty', 'discount_range', 'not_future']) AS rule) r""")
def q02_expectations_observed(t):
    """One write that drops rows failing two rules, warns of a third, and counts all of them on the way."""
    rules = _rules()
    kept, seen = Q.expect(t.lineitem, warn={"not_future": rules["not_future"]}, drop={k: rules[k] for k in ("positive_qty", "discount_range")})
    written = durable(kept, "kept")
    found = seen.get
    counts = t.spark.createDataFrame([(n, found["rows"], found[n]) for n in rules], "rule string, seen long, failed long")
    return counts.crossJoin(written.agg(F.count(F.lit(1)).alias("written"))).select("rule", "seen", "written", "failed")


@query("""SELECT CASE WHEN l_quantity > 5 AND l_discount < 0.1 AND l_shipdate <= '2001-06-30' THEN 'valid' ELSE 'quarantined' END AS side, count(*) AS n FROM lineitem GROUP BY 1""")
def q03_quarantine_split(t):
    valid, bad = Q.split(t.lineitem, _rules())
    count = lambda df, side: durable(df, side).agg(F.lit(side).alias("side"), F.count("*").alias("n"))
    return count(valid, "valid").unionByName(count(bad, "quarantined"))


@query(f"""WITH h AS (SELECT c_custkey, c_mktsegment, {HOLES} AS b, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS nat FROM customer),
          m AS (SELECT nat FROM h WHERE nat IS NOT NULL GROUP BY nat ORDER BY count(*) DESC, nat LIMIT 1)
          SELECT c_custkey, round(coalesce(b, (SELECT avg(b) FROM h)), 4) AS by_mean, round(coalesce(b, avg(b) OVER (PARTITION BY c_mktsegment)), 4) AS by_group, coalesce(nat, (SELECT nat FROM m)) AS nat FROM h""")
def q04_imputation(t):
    rows = _holes(t).select("c_custkey", "c_mktsegment", "c_acctbal", F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).alias("nat"))
    both = Q.impute(rows.withColumn("by_mean", F.col("c_acctbal")), means=["by_mean"], mode_of=["nat"])
    out = Q.impute_group_mean(both, ["c_mktsegment"], "c_acctbal")
    return out.select("c_custkey", F.round("by_mean", 4).alias("by_mean"), F.round("c_acctbal", 4).alias("by_group"), "nat")


@query("""WITH q AS (SELECT quantile_disc(value, 0.25) AS a, quantile_disc(value, 0.75) AS b FROM events) SELECT event_id, value FROM events, q WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""")
def q05_iqr_outliers(t):
    return Q.iqr_outliers(t.events.select("event_id", "value"), "value", exact=True)


@query("""SELECT event_id, value FROM (SELECT *, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s FROM events WINDOW w AS (PARTITION BY user_id)) WHERE value > m + 2 * s""")
def q06_sigma_outliers(t):
    return Q.sigma_outliers(t.events.select("event_id", "user_id", "value"), ["user_id"], "value").select("event_id", "value")


@query("""SELECT event_id FROM (SELECT *, avg(value) OVER (PARTITION BY event_type) AS m FROM events) WHERE value < 0.5 * m""")
def q07_below_group_mean(t):
    return Q.below_group_mean(t.events.select("event_id", "event_type", "value"), ["event_type"], "value", 0.5).select("event_id")


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q08_duplicate_report(t):
    return Q.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT o_custkey, o_orderkey, CAST(o_orderdate::DATE AS VARCHAR) AS day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def q09_keep_latest(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return Q.keep_latest(rows, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"))


@query("""SELECT sha256('pepper' || c_custkey) AS token, '***@example.com' AS email, regexp_replace(left(c_name, 14), '[0-9]', '*', 'g') || right(c_name, 4) AS c_name, 'REDACTED' AS c_mktsegment FROM customer""")
def q10_masking(t):
    rows = t.customer.select("c_custkey", F.concat("c_name", F.lit("@example.com")).alias("email"), "c_name", "c_mktsegment")
    return Q.mask(rows, "pepper", hashed={"c_custkey": "token"}, emails=["email"], numbers=["c_name"], redacted=["c_mktsegment"])


@query("""SELECT 'analyst' AS role, s_suppkey, '***' AS s_name FROM supplier WHERE s_nationkey < 10 UNION ALL SELECT 'admin', s_suppkey, s_name FROM supplier""")
def q11_role_view(t):
    view = lambda role: Q.role_view(t.supplier, role, {"s_name": F.lit("***")}, F.col("s_nationkey") < 10).select(F.lit(role).alias("role"), "s_suppkey", "s_name")
    return view("analyst").unionByName(view("admin"))


@query("SELECT c_custkey, sha256('pepper' || c_custkey) AS token FROM customer")
def q12_masking_audit(t):
    from tidewater.functions.columns import salted_hash
    return durable(t.customer.select("c_custkey", salted_hash(F.col("c_custkey"), "pepper").alias("token")), "audit")


@query("""SELECT 'run-1' AS run_id, count(*) AS rows, CAST(min(o_orderdate)::DATE AS VARCHAR) AS first, CAST(max(o_orderdate)::DATE AS VARCHAR) AS last, true AS stamped FROM orders""")
def q13_run_audit(t):
    return Q.run_audit(t.orders, "run-1", "o_orderdate").select("run_id", "rows", F.to_date("first").cast("string").alias("first"), F.to_date("last").cast("string").alias("last"), F.col("logged_at").isNotNull().alias("stamped"))


@query("""SELECT failed, count(*) AS n FROM (SELECT concat_ws(',', CASE WHEN NOT l_quantity > 5 THEN 'positive_qty' END, CASE WHEN NOT l_discount < 0.1 THEN 'discount_range' END, CASE WHEN l_shipdate > '2001-06-30' THEN 'not_future' END) AS failed FROM lineitem) GROUP BY 1""")
def q14_business_rules(t):
    return Q.tag(t.lineitem, _rules()).groupBy("failed").agg(F.count("*").alias("n"))


@query("""SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 1.5 * (SELECT count(*) / count(DISTINCT o_custkey) FROM orders)""")
def q15_key_skew(t):
    return Q.key_skew(t.orders, ["o_custkey"], 1.5)


@query("SELECT sum(n) AS rows FROM (SELECT count(*) AS n FROM lineitem)")
def q15_partition_report(t):
    return Q.partition_report(t.lineitem).agg(F.sum("rows").alias("rows"))


@query("""SELECT CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'FILLED' ELSE o_orderstatus END AS o_orderstatus, count(*) AS n FROM orders GROUP BY 1""")
def q16_code_repair(t):
    mapping = t.spark.createDataFrame([("O", "OPEN"), ("F", "FILLED")], "bad string, good string")
    return Q.repair(t.orders, "o_orderstatus", mapping).groupBy("o_orderstatus").agg(F.count("*").alias("n"))

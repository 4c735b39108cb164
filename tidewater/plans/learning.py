"""M: machine learning and function extension."""

from pyspark.sql import functions as F

from tidewater.functions.columns import line_revenue, pct
from tidewater.operators import ml
from tidewater.plans.registry import query
from tidewater.sources.durable import discard, durable, freed_shuffles

SALES = "lineitem JOIN part ON l_partkey = p_partkey"


def _sales(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))


def _daily(t):
    return _sales(t).groupBy("p_type", F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("qty"))


@query("SELECT p_partkey, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS flipped FROM part")
def m01_registered_function(t):
    flip = F.udf(lambda s: " ".join(reversed(s.split(" "))) if s is not None else None, "string", useArrow=True)
    t.spark.udf.register("flip_words", flip)
    return t.part.select("p_partkey", F.call_udf("flip_words", F.col("p_name")).alias("flipped"))


@query(f"""WITH d AS (SELECT p_type, date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) AS x, sum(l_quantity) AS y FROM {SALES} GROUP BY 1, 2) SELECT p_type, round(regr_slope(y, x), 8) AS slope, count(*) AS points FROM d GROUP BY 1""")
def m02_grouped_pandas(t):
    days = _daily(t).select("p_type", F.datediff("day", F.lit("1995-01-01")).alias("x"), F.col("qty").alias("y"))     # one row per type and date
    return ml.line_fits(days, "p_type", "x", "y").withColumn("slope", F.round("slope", 8))


@query(f"""WITH b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM {SALES}), n AS (SELECT count(DISTINCT o) AS n FROM b), s AS (SELECT i, count(*) AS c FROM b GROUP BY 1), p AS (SELECT x.i AS a, y.i AS c, count(*) AS k FROM b x JOIN b y ON x.o = y.o AND x.i <> y.i GROUP BY 1, 2),
          t AS (SELECT x.i AS a, y.i AS b, z.i AS c, count(*) AS k FROM b x JOIN b y ON x.o = y.o AND x.i < y.i JOIN b z ON x.o = z.o AND z.i <> x.i AND z.i <> y.i GROUP BY 1, 2, 3),
          r AS (SELECT p.a AS antecedent, p.c AS consequent, k * 1.0::DOUBLE / s.c AS confidence, k FROM p JOIN s ON s.i = p.a UNION ALL SELECT t.a || '+' || t.b, t.c, t.k * 1.0::DOUBLE / p.k, t.k FROM t JOIN p ON p.a = t.a AND p.c = t.b)
          SELECT antecedent, consequent, round(confidence, 6) AS confidence, round(k * 1.0::DOUBLE / n.n, 6) AS support FROM r, n WHERE k >= 0.01 * n.n AND confidence >= 0.16""")
def m03_frequent_items(t):
    # a basket holds each brand once, so its size is bounded by the number of brands
    brands = _sales(t).select("l_orderkey", "p_brand").distinct()
    baskets = brands.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("items"))
    rules = ml.association_rules(baskets, "items", 0.01, 0.16)
    return rules.select(F.array_join(F.array_sort("antecedent"), "+").alias("antecedent"), F.element_at("consequent", 1).alias("consequent"), F.round("confidence", 6).alias("confidence"), F.round("support", 6).alias("support"))


@query(f"""WITH b AS (SELECT DISTINCT o_custkey AS o, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey), n AS (SELECT count(DISTINCT o) AS n FROM b), s AS (SELECT i, count(*) AS c FROM b GROUP BY 1 HAVING count(*) >= 4),
          p AS (SELECT x.i AS a, y.i AS c, count(*) AS k FROM b x JOIN b y ON x.o = y.o AND x.i <> y.i GROUP BY 1, 2 HAVING count(*) >= 4),
          t AS (SELECT p.a, p.c AS b, z.i AS c, count(*) AS k FROM p JOIN b x ON x.i = p.a JOIN b y ON y.i = p.c AND y.o = x.o JOIN b z ON z.o = x.o AND z.i <> p.a AND z.i <> p.c WHERE p.a < p.c GROUP BY 1, 2, 3 HAVING count(*) >= 4),
          r AS (SELECT [p.a] AS antecedent, p.c AS consequent, p.k, s.c AS held FROM p JOIN s ON s.i = p.a UNION ALL SELECT [t.a, t.b], t.c, t.k, p.k FROM t JOIN p ON p.a = t.a AND p.c = t.b)
          SELECT array_to_string(antecedent, '+') AS antecedent, consequent, k AS support, round(k * 1.0::DOUBLE / held, 6) AS confidence, round(k * 1.0::DOUBLE * n.n / (held * s.c), 4) AS lift FROM r JOIN s ON s.i = r.consequent, n WHERE k * 10 >= held""")
def m03_product_rules(t):
    # all products a customer ever bought; rules of one or two products before the arrow, seen with four customers at least
    bought = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey").distinct()
    with freed_shuffles(t.spark):
        baskets = durable(bought.groupBy("o_custkey").agg(F.collect_list("l_partkey").alias("items")), "baskets")
    n = baskets.count()
    rules = ml.association_rules(baskets, "items", 3.5 / max(n, 1), 0.1 - 1e-9, longest=2)
    discard(baskets)
    return rules.select(F.array_join(F.array_sort("antecedent"), "+").alias("antecedent"), F.element_at("consequent", 1).alias("consequent"),
                        F.round(F.col("support") * n).cast("long").alias("support"), F.round("confidence", 6).alias("confidence"), F.round("lift", 4).alias("lift"))


def _ratings(t):
    bought = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    counts = bought.groupBy("o_custkey", "p_brand").agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("spent"))
    return counts.select("o_custkey", F.regexp_extract("p_brand", r"\d+", 0).cast("int").alias("brand"), (F.log1p("n") * F.log1p("spent")).alias("rating"))


@query()
def m04_recommender(t):
    ratings = _ratings(t).withColumn("o_custkey", F.col("o_custkey").cast("int"))
    return ml.recommend(ratings, "o_custkey", "brand", "rating", 10, 5).withColumn("score", F.round("score", 3))


@query()
def m05_segments(t):
    m = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("money"), F.count("*").alias("frequency"), F.datediff(F.lit("2001-08-02"), F.max("o_orderdate")).alias("idle"))
    out = ml.segments(m, ["money", "frequency", "idle"])
    return out.groupBy("cluster").agg(F.count("*").alias("customers"), F.round(F.avg("money"), 2).alias("money"), F.round(F.avg("frequency"), 4).alias("frequency"), F.round(F.avg("idle"), 4).alias("idle"))


@query()
def m06_series_forecast(t):
    out = ml.forecast(_daily(t), "p_type", "day", "qty", "2001-01-01", 10)
    return out.groupBy("p_type").agg(F.count("*").alias("days"), F.round(F.sqrt(F.avg(F.pow(F.col("qty") - F.col("forecast"), 2))), 4).alias("rmse"))


@query(f"""WITH r AS (SELECT o_custkey AS u, p_brand AS i, ln(1 + count(*)) AS r FROM {SALES} JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2), n AS (SELECT i, sqrt(sum(r * r)) AS n FROM r GROUP BY 1), d AS (SELECT x.i AS a, y.i AS b, sum(x.r * y.r) AS d FROM r x JOIN r y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2)
          SELECT a AS item_a, b AS item_b, round(d / (na.n * nb.n), 6) AS similarity FROM d JOIN n na ON na.i = a JOIN n nb ON nb.i = b""")
def m07_item_similarity(t):
    bought = _sales(t).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ratings = bought.groupBy("o_custkey", "p_brand").agg(F.log1p(F.count("*")).alias("r"))        # 25 brands
    return ml.cosine_items(ratings, "o_custkey", "p_brand", "r").withColumn("similarity", F.round("similarity", 6))


@query("""WITH r AS (SELECT o_custkey AS u, l_partkey AS i, ln(1 + count(*)) AS r FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2), n AS (SELECT i, sqrt(sum(r * r)) AS n FROM r GROUP BY 1), d AS (SELECT x.i AS a, y.i AS b, sum(x.r * y.r) AS d FROM r x JOIN r y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2)
          SELECT a AS item_a, b AS item_b, round(d / (na.n * nb.n), 6) AS similarity FROM d JOIN n na ON na.i = a JOIN n nb ON nb.i = b WHERE d / (na.n * nb.n) >= 0.12 - 1e-9""")
def m07_product_similarity(t):
    bought = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ratings = bought.groupBy("o_custkey", "l_partkey").agg(F.log1p(F.count("*")).alias("r"))
    return ml.cosine_items(ratings, "o_custkey", "l_partkey", "r", least=0.12).withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH d AS (SELECT p_type, l_shipdate::DATE AS day, sum(l_quantity) AS qty FROM {SALES} GROUP BY 1, 2) SELECT p_type, CAST(day AS VARCHAR) AS day, lag(qty) OVER w AS lag_1, lag(qty, 7) OVER w AS lag_7, round(avg(qty) OVER (PARTITION BY p_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS mean_7,
          dayofweek(day) + 1 AS dow, isodow(day) >= 6 AS is_weekend, quarter(day) AS quarter FROM d WINDOW w AS (PARTITION BY p_type ORDER BY day)""")
def m08_feature_table(t):
    out = ml.series_features(_daily(t), ["p_type"], "day", "qty", windows=(7,))
    return out.select("p_type", F.col("day").cast("string"), "lag_1", "lag_7", F.round("mean_7", 6).alias("mean_7"), "dow", "is_weekend", "quarter")


@query(f"SELECT p_type, round(sum(l_extendedprice * (1 - l_discount)), 4) AS net, round(100.0 * count(CASE WHEN l_returnflag = 'R' THEN 1 END) / count(*), 6) AS return_pct FROM {SALES} WHERE l_quantity > 10 GROUP BY 1")
def m09_composed_functions(t):
    def large(df):
        return df.filter("l_quantity > 10")

    def by_type(df):
        return df.groupBy("p_type").agg(F.round(F.sum(line_revenue()), 4).alias("net"), pct(F.count_if(F.col("l_returnflag") == "R"), F.count("*")).alias("return_pct"))

    return _sales(t).transform(large).transform(by_type)

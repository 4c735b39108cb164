"""F: scalar functions."""

from pyspark.sql import functions as F

from tidewater.functions import columns as C
from tidewater.plans.registry import query

AS_OF = "2002-01-01"


@query("SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS title FROM part")
def f01_case_change(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"), F.initcap("p_name").alias("title"))


@query("SELECT p_partkey, substr(p_name, 1, 3) AS prefix, length(p_name) AS len, lower(substr(p_name, 1, 1)) = lower(right(p_name, 1)) AS same_ends FROM part")
def f02_substring_length(t):
    n = F.col("p_name")
    return t.part.select("p_partkey", F.substring(n, 1, 3).alias("prefix"), F.length(n).alias("len"),
                         (F.lower(F.left(n, F.lit(1))) == F.lower(F.right(n, F.lit(1)))).alias("same_ends"))


@query("SELECT c_custkey, c_name || '@' || c_mktsegment AS tag, concat_ws('-', c_nationkey, c_mktsegment) AS code FROM customer")
def f03_concat(t):
    return t.customer.select("c_custkey", F.concat("c_name", F.lit("@"), "c_mktsegment").alias("tag"),
                             F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("code"))


@query("SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[-1] AS last_word, len(string_split(p_name, ' ')) AS words FROM part")
def f04_split(t):
    parts = F.split("p_name", " ")
    return t.part.select("p_partkey", F.element_at(parts, 1).alias("first_word"), F.element_at(parts, -1).alias("last_word"), F.size(parts).alias("words"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_replace(url, '[0-9]', '#', 'g') AS masked FROM pages")
def f05_regex(t):
    return t.pages.select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.regexp_replace("url", "[0-9]", "#").alias("masked"))


@query("SELECT c_custkey, sha256('pepper' || c_name) AS token FROM customer")
def f06_hash(t):
    return t.customer.select("c_custkey", C.salted_hash(F.col("c_name"), "pepper").alias("token"))


@query("""SELECT event_id, year(ts) AS y, quarter(ts) AS q, month(ts) AS m, weekofyear(ts) AS wk, hour(ts) AS h, dayofweek(ts) + 1 AS dow, CAST(date_trunc('week', ts)::DATE AS VARCHAR) AS week_start, dayname(ts) AS day_name FROM events""")
def f07_date_parts(t):
    ts = F.col("ts")
    return t.events.select("event_id", F.year(ts).alias("y"), F.quarter(ts).alias("q"), F.month(ts).alias("m"), F.weekofyear(ts).alias("wk"), F.hour(ts).alias("h"),
                           F.dayofweek(ts).alias("dow"), C.text_day(F.date_trunc("week", ts)).alias("week_start"), F.date_format(ts, "EEEE").alias("day_name"))


@query(f"""SELECT o_orderkey, CAST((o_orderdate + INTERVAL 30 DAY)::DATE AS VARCHAR) AS due, CAST((o_orderdate - INTERVAL 7 DAY)::DATE AS VARCHAR) AS before, CAST((o_orderdate::DATE + INTERVAL 3 MONTH)::DATE AS VARCHAR) AS later,
          date_diff('day', o_orderdate, TIMESTAMP '{AS_OF}') AS age FROM orders""")
def f08_date_arithmetic(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.date_add(d, 30).cast("string").alias("due"), F.date_sub(d, 7).cast("string").alias("before"),
                           F.add_months(d, 3).cast("string").alias("later"), F.datediff(F.lit(AS_OF), d).alias("age"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderdate::DATE AS VARCHAR) END AS parsed, strftime(o_orderdate, '%d/%m/%Y') AS shown FROM orders""")
def f09_parse_dates(t):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    raw = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy/MM/dd"))
           .when(k == 2, F.date_format(d, "dd-MM-yyyy")).otherwise(F.lit("not a date")))
    return t.orders.select("o_orderkey", C.parse_date(raw).cast("string").alias("parsed"), F.date_format(d, "dd/MM/yyyy").alias("shown"))


@query("SELECT event_id, CAST(floor(epoch(ts - TIMESTAMP '2024-01-01') / 60) AS BIGINT) AS minutes FROM events")
def f10_epoch(t):
    start = F.unix_timestamp(F.lit("2024-01-01").cast("timestamp_ntz"))
    return t.events.select("event_id", F.floor((C.epoch("ts") - start) / 60).alias("minutes"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '2001-07-01' - 30 AND DATE '2001-07-01'")
def f11_as_of(t):
    as_of = F.lit("2001-07-01").cast("date")
    return t.orders.filter(F.to_date("o_orderdate").between(F.date_sub(as_of, 30), as_of)).select("o_orderkey")


@query("""WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate::DATE AS a, l_shipdate::DATE AS b FROM lineitem JOIN orders ON o_orderkey = l_orderkey), d AS (SELECT DATE '1980-01-01' + CAST(i AS INTEGER) AS d FROM range(18000) r(i)),
          cal AS (SELECT d, CAST(count(CASE WHEN isodow(d) < 6 AND d NOT IN (DATE '1998-12-25', DATE '1999-01-01') THEN 1 END) OVER (ORDER BY d) AS BIGINT) AS c FROM d)
          SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN b < a THEN 0 ELSE e.c - f.c END AS work_days FROM s JOIN cal e ON e.d = b JOIN cal f ON f.d = a - 1""")
def f12_business_days(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = C.business_days(F.to_date("o_orderdate"), F.to_date("l_shipdate"), ["1998-12-25", "1999-01-01"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", days.alias("work_days"))


@query("""SELECT c_custkey, abs(c_acctbal) AS a, round(pow(c_acctbal / 1000, 2), 6) AS p, round(sqrt(abs(c_acctbal)), 6) AS s, round(ln(1 + abs(c_acctbal)), 6) AS l, CAST(floor(c_acctbal / 100) AS BIGINT) AS f, CAST(ceil(c_acctbal / 100) AS BIGINT) AS c FROM customer""")
def f13_math(t):
    x = F.col("c_acctbal")
    return t.customer.select("c_custkey", F.abs(x).alias("a"), F.round(F.pow(x / 1000, 2), 6).alias("p"), F.round(F.sqrt(F.abs(x)), 6).alias("s"),
                             F.round(F.log1p(F.abs(x)), 6).alias("l"), F.floor(x / 100).alias("f"), F.ceil(x / 100).alias("c"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, greatest(l_discount, l_tax, 0.03) AS hi, least(l_discount, l_tax, 0.03) AS lo FROM lineitem")
def f14_greatest_least(t):
    args = (F.col("l_discount"), F.col("l_tax"), F.lit(0.03))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.greatest(*args).alias("hi"), F.least(*args).alias("lo"))


@query("SELECT d.doc_id, coalesce(toxic, -1) AS toxic, n_chars / nullif(coalesce(quality, 0), 0) AS per_quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def f15_null_guards(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    return rows.select("doc_id", F.coalesce("toxic", F.lit(-1)).alias("toxic"), C.ratio(F.col("n_chars"), F.col("quality")).alias("per_quality"))


@query("SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, TRY_CAST(event_type AS INTEGER) AS bad, CAST(value AS VARCHAR) IS NOT NULL AS shown FROM events")
def f16_cast(t):
    return t.events.select("event_id", F.regexp_extract("props", "[0-9]+", 0).try_cast("int").alias("k"), F.col("event_type").try_cast("int").alias("bad"),
                           F.col("value").cast("string").isNotNull().alias("shown"))


@query("""WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS ws FROM part) SELECT p_partkey, u.word, len(ws) AS n, list_contains(ws, 'ring') AS has_ring, array_to_string(ws[1:1], '+') AS head FROM w, unnest(ws) AS u(word)""")
def f17_arrays(t):
    ws = F.split("p_name", " ")
    return (t.part.withColumn("ws", ws).select("p_partkey", F.explode("ws").alias("word"), F.size("ws").alias("n"),
                                               F.array_contains("ws", "ring").alias("has_ring"), F.array_join(F.slice("ws", 1, 1), "+").alias("head")))


@query("SELECT o_orderkey, o_custkey AS customer_id, o_orderstatus AS status FROM orders")
def f18_struct_navigation(t):
    nested = t.orders.select("o_orderkey", F.struct(F.col("o_custkey").alias("id")).alias("customer"),
                             F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount")).alias("payment"))
    return nested.select("o_orderkey", F.col("customer.id").alias("customer_id"), "payment.status")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def f19_json_decode(t):
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))




@query(f"""WITH g AS (SELECT c_custkey, (c_custkey % 170) - 85.0::DOUBLE AS lat, (c_custkey * 7 % 360) - 180.0::DOUBLE AS lon FROM customer)
          SELECT c_custkey, round(2 * 6371.0 * asin(sqrt(pow(sin(radians(48.85 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(48.85)) * pow(sin(radians(2.35 - lon) / 2), 2))), 4) AS km FROM g""")
def f20_haversine(t):
    lat, lon = (F.col("c_custkey") % 170) - 85.0, (F.col("c_custkey") * 7 % 360) - 180.0
    return t.customer.select("c_custkey", F.round(C.haversine_km(lat, lon, F.lit(48.85), F.lit(2.35)), 4).alias("km"))


@query("""SELECT CAST(floor(((c_custkey % 170) - 85.0) / 10) AS BIGINT) || ':' || CAST(floor(((c_custkey * 7 % 360) - 180.0) / 10) AS BIGINT) AS cell, count(*) AS n FROM customer GROUP BY 1""")
def f21_grid(t):
    lat, lon = (F.col("c_custkey") % 170) - 85.0, (F.col("c_custkey") * 7 % 360) - 180.0
    return t.customer.groupBy(C.grid_cell(lat, lon, 10).alias("cell")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 100 = 0")
def f22_modulo(t):
    return t.orders.filter((F.col("o_orderkey") % 2 == 0) & (F.col("o_custkey") % 100 == 0)).select("o_orderkey", "o_custkey")


@query("""SELECT s_suppkey, '<supplier><name>' || s_name || '</name><note>A&amp;B &lt; C</note></supplier>' AS xml FROM supplier""")
def f23_xml_row(t):
    return t.supplier.select("s_suppkey", C.xml_row("supplier", name=F.col("s_name"), note=F.lit("A&B < C")).alias("xml"))


@query("""SELECT p_partkey, round((150 + p_size) / 30.48, 4) AS feet, round((40 + p_size) * 2.20462, 4) AS pounds, round((40 + p_size) / pow((150 + p_size) / 100.0, 2), 4) AS bmi FROM part""")
def f24_units(t):
    cm, kg = F.lit(150) + F.col("p_size"), F.lit(40) + F.col("p_size")
    return t.part.select("p_partkey", F.round(cm / 30.48, 4).alias("feet"), F.round(kg * 2.20462, 4).alias("pounds"), F.round(kg / F.pow(cm / 100.0, 2), 4).alias("bmi"))

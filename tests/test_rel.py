import itertools
import random

import pytest

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import rel


def facts(spark):
    rnd = random.Random(1)
    data = [("hot" if i % 3 == 0 else rnd.choice("abcd"), i) for i in range(300)] + [(None, 999)]
    return spark.createDataFrame(data, "k string, id int")


def test_attach_equals_window(spark, both_ways):
    df = facts(spark)
    got = rel.with_group_stats(df, ["k"], n=F.count("*"), top=F.max("id"))
    want = df.selectExpr("k", "id", "count(*) over (partition by k) as n", "max(id) over (partition by k) as top")
    assert rows(got) == rows(want)


def test_salted_join_equals_plain_join(spark):
    df = facts(spark)
    dim = spark.createDataFrame([("hot", 1), ("a", 2), ("z", 3)], "k string, x int")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        for how in ("inner", "left"):
            got = rel.salted_join(df, dim, ["k"], spread=["id"], salts=7, hot_rows=50, how=how)
            assert rows(got, "k", "id", "x") == rows(df.join(dim, "k", how), "k", "id", "x")
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_salting_spreads_the_hot_key(spark):
    df = facts(spark).filter("k = 'hot'").select(rel._salt(facts(spark), ["id"], 8).alias("s"))
    assert df.distinct().count() == 8


def test_top_k_ties(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 9), ("a", 3, 8), ("a", 4, 8), ("b", 5, 1)], "k string, id int, v int")
    assert rows(rel.top_k(df, ["k"], ["-v", "id"], 1), "id") == [(1,), (5,)]
    assert rows(rel.top_k(df, ["k"], ["-v"], 3, "all"), "id") == [(1,), (2,), (3,), (4,), (5,)]
    assert rows(rel.top_k(df, [], ["-v", "id"], 2), "id", "rk") == [(1, 1), (2, 2)]
    assert rows(rel.top_k(df, [], ["-v"], 1, "all"), "id", "rk") == [(1, 1), (2, 1)]


def test_top_k_uses_group_limit(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    plan = rel.top_k(df, ["k"], ["-v"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_nth_distinct_ignores_repeats_and_nulls(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 3), ("a", None), ("b", 1)], "k string, v int")
    assert rows(rel.nth_distinct(df, ["k"], "v", 2)) == [("a", 3)]
    assert rows(rel.nth_distinct(df, [], "v", 3), "v") == [(1,)]


def test_differences_are_null_safe(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (4, None)], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, None), (5, "w")], "id int, v string")
    assert rows(rel.differences(a, b, ["id"], ["v"]), "id", "status") == [(2, "changed"), (3, "left_only"), (5, "right_only")]
    assert rel.differences(a, a, ["id"], ["v"]).count() == 0


def test_interval_join_inclusive_ends(spark):
    points = spark.sql("select * from values ('a', date'2024-01-31', 1), ('a', date'2024-03-01', 2), ('a', date'2024-03-02', 3), ('b', date'2024-02-01', 4) as t(k, d, id)")
    spans = spark.sql("select * from values ('a', date'2024-01-31', date'2024-03-01', 'x') as t(k, s, e, name)")
    got = rel.interval_join(points, spans, ["k"], "d", "s", "e", bucket_days=7)
    assert rows(got, "id", "name") == [(1, "x"), (2, "x")]


def test_interval_join_long_and_open_intervals(spark):
    rnd = random.Random(5)
    spans = [(rnd.choice("ab"), s := rnd.randrange(4000), rnd.choice([s + rnd.randrange(20), s + rnd.randrange(4000), None, 2932896]), i) for i in range(40)]
    points = [(rnd.choice("ab"), rnd.randrange(6000), i) for i in range(150)]
    a = spark.createDataFrame(points, "k string, d int, id int").withColumn("d", F.date_from_unix_date("d"))
    b = spark.createDataFrame(spans, "k string, s int, e int, x int").withColumn("s", F.date_from_unix_date("s")).withColumn("e", F.date_from_unix_date("e"))
    want = sorted((i, x) for k, d, i in points for q, s, e, x in spans if k == q and s <= d and (e is None or d <= e))
    assert sorted(rows(rel.interval_join(a, b, ["k"], "d", "s", "e", 7), "id", "x")) == want
    left = rel.interval_join(a, b, ["k"], "d", "s", "e", 7, how="left")
    assert left.count() == len(want) + len(points) - len({i for i, _ in want})
    half = sorted((i, x) for k, d, i in points for q, s, e, x in spans if k == q and s <= d and (e is None or d < e))
    assert sorted(rows(rel.interval_join(a, b, ["k"], "d", "s", "e", 7, closed=False), "id", "x")) == half
    pairs = sorted((p[0], p[3], q[3]) for p, q in itertools.combinations(spans, 2) if p[0] == q[0] and p[1] <= (q[2] or 1 << 30) and q[1] <= (p[2] or 1 << 30))
    assert sorted(tuple(r) for r in rel.overlapping_pairs(b, ["k"], "x", "s", "e", 7).collect()) == pairs


def test_overlapping_pairs_brute_force(spark):
    rnd = random.Random(3)
    data = [(rnd.choice("ab"), i, s := rnd.randrange(300), s + rnd.randrange(60)) for i in range(80)]
    df = spark.createDataFrame(data, "k string, id int, s int, e int").select("k", "id", F.date_from_unix_date("s").alias("s"), F.date_from_unix_date("e").alias("e"))
    want = sorted((x[0], x[1], y[1]) for x, y in itertools.combinations(data, 2) if x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3])
    assert sorted(tuple(r) for r in rel.overlapping_pairs(df, ["k"], "id", "s", "e", 10).collect()) == want


def test_salted_join_refuses_outer_sides(spark):
    df = spark.createDataFrame([(1, 1)], "k int, id int")
    with pytest.raises(ValueError):
        rel.salted_join(df, df.select("k"), ["k"], how="full")

import datetime as dt
import itertools
import random
from collections import Counter

import pytest

from tests.conftest import rows
from tidewater.operators import commerce as C
from tidewater.operators import graph


def baskets():
    rnd = random.Random(4)
    out = [("big1", i) for i in range(12)] + [("big2", i) for i in range(4, 14)]
    for b in range(60):
        out += [(f"b{b}", i) for i in rnd.sample(range(15), 3)]
    return out + [("b0", 1), ("b0", 1)]


@pytest.mark.parametrize("support,big", [(1, 1000), (3, 1000), (3, 5), (2, 5), (1, 5)])
def test_pair_counts_all_ways(spark, both_ways, support, big):
    """No large baskets; large ones looked up (support above their number); large ones in blocks."""
    data = baskets()
    counts = Counter()
    for b in {b for b, _ in data}:
        counts.update(itertools.combinations(sorted({i for x, i in data if x == b}), 2))
    want = sorted((a, b, n) for (a, b), n in counts.items() if n >= support)
    got = C.pair_counts(spark.createDataFrame(data, "b string, i int"), "b", "i", support, big)
    assert sorted(tuple(r) for r in got.select("item_a", "item_b", "support").collect()) == want


def test_max_concurrency_edges(spark, both_ways):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    df = spark.createDataFrame([("a", t(1), t(3)), ("a", t(3), t(5)), ("a", t(2), t(4)), ("b", t(1), t(2))], "k string, s timestamp, e timestamp")
    assert rows(C.max_concurrency(df, ["k"], "s", "e")) == [("a", 2), ("b", 1)]
    assert rows(C.max_concurrency(df, ["k"], "s", "e", closed=True)) == [("a", 3), ("b", 1)]
    assert C.max_concurrency(df, [], "s", "e").first().peak == 2      # at 2 the row of b ends before another starts


def test_next_items(spark, both_ways):
    df = spark.createDataFrame([("u", 1, "x"), ("u", 2, "y"), ("u", 3, "y"), ("w", 1, "x"), ("w", 2, "y")], "u string, t int, i string")
    assert rows(C.next_items(df, ["u"], ["t"], "i")) == [("x", "y", 2), ("y", "y", 1)]


def test_growth_with_zero_base(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, 0.0), (2, 10.0), (3, 15.0)], "p int, v double")
    got = C.period_growth(df, F.col("p"), F.col("v"))
    assert rows(got, "period", "growth_pct") == [(1, None), (2, None), (3, 50.0)]


def test_ancestors_with_cycle_and_root(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (10, 11), (11, 10)], "id int, boss int")
    assert rows(graph.ancestors(df, "id", "boss"), "node", "ancestor", "depth") == [
        (10, 11, 1), (11, 10, 1), (2, 1, 1), (3, 1, 2), (3, 2, 1), (4, 1, 3), (4, 2, 2), (4, 3, 1)]


def test_mutual_and_two_hops(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (1, 2), (3, 4), (5, 5)], "a int, b int")
    assert rows(graph.mutual(df, "a", "b")) == [(1, 2)]
    assert rows(graph.friends_of_friends(df, "a", "b"), "item_a", "item_b", "common") == [(1, 3, 1), (2, 4, 1)]
    assert rows(graph.two_leg_routes(df, "a", "b")) == [(1, 2, 3), (2, 3, 4)]


def test_deep_hierarchies_lose_no_level(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(24)], "id int, boss int")
    assert graph.ancestors(chain, "id", "boss").count() == 24 * 25 // 2


def test_many_pairs_are_dealt_by_their_number(spark, monkeypatch):
    rnd = random.Random(4)
    data = [(g, i) for g in range(300) for i in rnd.sample(range(120), rnd.randrange(1, 6))] + [(None, 1), (None, 2), (1, None)]
    held = {}
    for g, i in data:
        if g is not None and i is not None:
            held.setdefault(g, set()).add(i)
    want = Counter(p for b in held.values() for p in itertools.combinations(sorted(b), 2))
    df = spark.createDataFrame(data, "g int, i int")
    monkeypatch.setattr(C, "PAIR_ROWS", 50)
    out = C.pair_counts(df, "g", "i", 2)
    assert rows(out) == sorted(((a, b, n) for (a, b), n in want.items() if n >= 2), key=repr)
    plan = C.pair_counts(df, "g", "i", 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 3 and "partial_count" in plan
    few = C.pair_counts(df.selectExpr("g", "i % 4 as i"), "g", "i", 2)
    assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()

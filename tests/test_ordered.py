"""Ordered operators against plain Python, with one key holding a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import ordered


def skewed(n=600, seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        out.append((key, rnd.randrange(200), i, rnd.choice([None, 1, 2, 3, 4, 5])))
    return out


@pytest.fixture(scope="module")
def data():
    return skewed()


def by_key(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


def frame(spark, data):
    return spark.createDataFrame(data, "k string, t int, id int, v int")


def test_scan_matches_loop(spark, data, both_ways):
    got = ordered.scan(frame(spark, data), ["k"], ["t", "id"], s=("sum", "v"), n=("count", "v"), lo=("min", "v"), hi=("max", "v"), last=("last", "v"))
    want = []
    for key, items in by_key(data).items():
        seen, last = [], None
        for r in items:
            if r[3] is not None:
                seen.append(r[3])
                last = r[3]
            want.append((r[2], sum(seen) if seen else None, len(seen), min(seen, default=None), max(seen, default=None), last))
    assert rows(got, "id", "s", "n", "lo", "hi", "last") == sorted(want, key=repr)


def test_scan_without_keys_and_descending(spark, data, both_ways):
    got = ordered.scan(frame(spark, data), [], ["-t", "id"], n=("count", F.lit(1)))
    order = sorted(data, key=lambda r: (-r[1], r[2]))
    assert rows(got, "id", "n") == sorted(((r[2], i + 1) for i, r in enumerate(order)), key=repr)


def test_reach_back_crosses_slices(spark, data, both_ways):
    got = ordered.reach_back(frame(spark, data), ["k"], ["t", "id"], 3, prev=lambda w: F.lag("id").over(w), third=lambda w: F.lag("id", 3).over(w),
                             total=lambda w: F.sum("t").over(w.rowsBetween(-3, 0)))
    want = []
    for items in by_key(data).values():
        for i, r in enumerate(items):
            want.append((r[2], items[i - 1][2] if i else None, items[i - 3][2] if i >= 3 else None, sum(x[1] for x in items[max(0, i - 3):i + 1])))
    assert rows(got, "id", "prev", "third", "total") == sorted(want, key=repr)


def test_hot_key_is_cut_into_slices(spark, data):
    sliced = ordered.slice_rows(frame(spark, data), ["k"], ["t", "id"])
    pieces = sliced.filter("k = 'hot'").select(ordered.SLICE).distinct().count()
    largest = sliced.groupBy(ordered.SLICE).count().agg(F.max("count")).first()[0]
    assert pieces > 1 and largest < 0.5 * len(data)


def test_as_of_takes_latest_at_or_before(spark, both_ways):
    facts = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("a", 9, 3), ("b", 9, 4)], "k string, t int, id int")
    rates = spark.createDataFrame([("a", 2, 10.0), ("a", 9, 20.0), ("b", 10, 30.0)], "k string, t int, rate double")
    assert rows(ordered.as_of(facts, rates, ["k"], "t", ["rate"], ["id"]), "id", "rate") == [(1, 10.0), (2, None), (3, 20.0), (4, None)]


def test_trailing_sums_is_half_open(spark, both_ways):
    df = spark.createDataFrame([("a", 0, 1), ("a", 10, 2), ("a", 10, 3), ("a", 19, 4), ("b", 10, 5)], "k string, t long, v int")
    got = ordered.trailing_sums(df, ["k"], "t", 10, s=F.col("v"), n=F.lit(1))
    # at 10 the row of time 0 has left: the window is (0, 10]
    assert rows(got, "k", "t", "s", "n") == [("a", 0, 1, 1), ("a", 10, 5, 2), ("a", 19, 9, 3), ("b", 10, 5, 1)]


def test_rank_table_with_ties(spark, both_ways):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", 3), ("b", 7)], "k string, v int")
    got = ordered.rank_table(df, ["k"], "v", descending=True)
    assert rows(got, "k", "v", "rank", "dense_rank", "percent_rank", "cume_dist") == [
        ("a", 1, 4, 3, 1.0, 1.0), ("a", 2, 2, 2, pytest.approx(1 / 3), 0.75), ("a", 3, 1, 1, 0.0, 0.25), ("b", 7, 1, 1, 0.0, 1.0)]


@pytest.mark.parametrize("tiles,count", [(4, 10), (3, 2), (1, 5)])
def test_ntile_sizes(spark, both_ways, tiles, count):
    df = spark.range(count).select(F.lit("k").alias("k"), F.col("id"))
    want = spark.range(count).selectExpr("id", f"ntile({tiles}) over (order by id) as tile")
    assert rows(ordered.ntile(df, ["k"], ["id"], tiles), "id", "tile") == rows(want, "id", "tile")
    assert rows(ordered.ntile(df, [], ["id"], tiles), "id", "tile") == rows(want, "id", "tile")


def test_empty_input(spark, both_ways):
    empty = frame(spark, [])
    assert ordered.scan(empty, ["k"], ["t"], s=("sum", "v")).collect() == []
    assert ordered.reach_back(empty, ["k"], ["t"], 1, p=lambda w: F.lag("v").over(w)).collect() == []


def test_totals_reset_like_a_loop(spark, both_ways):
    rnd = random.Random(4)
    data = [("hot" if i % 3 else rnd.choice("ab"), i, rnd.choice([0, 1, 2, 5, 40])) for i in range(900)] + [("big", 0, 99), ("none", 0, 0)]
    df = spark.createDataFrame(data, "k string, i long, v long").repartition(6)
    got = {(r.k, r.i): (r.segment, r.total) for r in ordered.reset_totals(df, ["k"], ["i"], "v", 10).collect()}
    want, state = {}, {}
    for k, i, v in sorted(data):
        segment, total = state.get(k, (1, 0))
        if total >= 10:
            segment, total = segment + 1, 0
        state[k] = want[k, i] = (segment, total + v)
    assert got == want
    assert ordered.reset_totals(df.limit(0), ["k"], ["i"], "v", 10).count() == 0
    with pytest.raises(Exception, match="negative or null"):
        ordered.reset_totals(spark.createDataFrame([("a", 1, None)], "k string, i long, v long"), ["k"], ["i"], "v", 10).collect()

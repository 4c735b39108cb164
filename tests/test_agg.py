import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from tidewater.operators import agg
from tidewater.sources.durable import durable


def test_exact_quantiles_match_numpy(spark, both_ways):
    rnd = random.Random(2)
    data = [("hot" if i % 3 == 0 else rnd.choice("ab"), float(rnd.randrange(40))) for i in range(301)] + [("one", 7.0), ("a", None), ("nulls", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: (r.m, r.q) for r in agg.exact_quantiles(df, ["k"], "v", m=0.5, q=0.9).collect()}
    for key in ("hot", "a", "b", "one"):
        values = [v for k, v in data if k == key and v is not None]
        assert got[key] == (pytest.approx(np.quantile(values, 0.5)), pytest.approx(np.quantile(values, 0.9)))
    assert got["nulls"] == (None, None)
    low = agg.exact_quantiles(df, [], "v", continuous=False, m=0.5).first().m
    assert low == np.quantile([v for _, v in data if v is not None], 0.5, method="inverted_cdf")


def test_modes_keep_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", 2), ("a", 3), ("b", None)], "k string, v int")
    assert rows(agg.modes(df, ["k"], "v")) == [("a", 1, 2), ("a", 2, 2)]


def test_gini_by_hand(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (4.0,)], "v double")
    x = [1, 1, 2, 4]
    want = 2 * sum((i + 1) * v for i, v in enumerate(x)) / (4 * sum(x)) - 5 / 4
    assert agg.gini(df, "v").first().gini == pytest.approx(want)


def test_pareto_crossing_row(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 25.0), ("c", 25.0)], "id string, v double")
    assert rows(agg.pareto(df, "id", "v", 0.7), "id") == [("a",)]
    assert rows(agg.pareto(df, "id", "v", 0.7, include_crossing=True), "id") == [("a",), ("b",)]


def test_division_and_shares(spark):
    df = spark.createDataFrame([("u", 1), ("u", 2), ("u", 2), ("w", 1), ("x", 3)], "e string, m int")
    need = spark.createDataFrame([(1,), (2,)], "m int")
    assert rows(agg.divides(df, "e", "m", need)) == [("u",)]
    assert rows(agg.share_of_total(df, ["e"], F.lit(1)), "e", "share") == [("u", 60.0), ("w", 20.0), ("x", 20.0)]


def test_discovered_pivot_takes_every_value(spark):
    assert len(agg.pivot_discovered(spark.range(300), [], "id", F.lit(1)).columns) == 300


def test_bracketed_selection_with_ties_and_missed_brackets(spark, monkeypatch):
    rnd = random.Random(9)
    data = [("ties", float(rnd.choice([1, 2, 2, 2, 3]))) for _ in range(5000)] + [("wide", rnd.random() ** 9) for _ in range(7001)] + [("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    points = {"a": 0.0, "b": 0.013, "c": 0.5, "d": 0.987, "e": 1.0}

    def check():
        got = {r.k: r for r in agg.exact_quantiles(df, ["k"], "v", **points).collect()}
        disc = {r.k: r for r in agg.exact_quantiles(df, ["k"], "v", continuous=False, **points).collect()}
        for key in ("ties", "wide", "two"):
            values = [v for k, v in data if k == key]
            for name, p in points.items():
                assert got[key][name] == pytest.approx(np.quantile(values, p))
                assert disc[key][name] == np.quantile(values, p, method="inverted_cdf")

    check()
    real = F.percentile_approx
    monkeypatch.setattr(agg.F, "percentile_approx", lambda c, p, n: F.transform(real(c, p, n), lambda x: x + 0.4))      # brackets beside the position
    check()


def test_merged_quantiles_keep_their_bound(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    daily = agg.daily_sketches(df, ["event_type"], "ts", "value", distinct="user_id")
    found = agg.merged_quantiles(daily, ["event_type"], [0.01, 0.25, 0.5, 0.95])
    errors = agg.quantile_rank_error(df, found, ["event_type"], "value").collect()
    assert len(errors) == 20 and max(r.error for r in errors) < 0.015
    sizes = {(r.event_type): r["count"] for r in df.groupBy("event_type").count().collect()}
    assert all(r.n == sizes[r.event_type] for r in errors)


def test_merged_distinct_counts_within_three_standard_errors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    daily = agg.daily_sketches(df, [], "ts", "value", distinct="user_id")
    got = {(r.unit, r.period): r.estimate for r in agg.merged_distinct(daily, []).collect()}
    for unit in ("day", "week", "month"):
        for r in df.groupBy(F.to_date(F.date_trunc(unit, "ts")).alias("p")).agg(F.count_distinct("user_id").alias("n")).collect():
            assert abs(got[unit, r.p] - r.n) <= max(1, 3 * 1.04 / 64 * r.n)


def test_bitmaps_count_distinct_ids_in_one_pass_each(spark):
    data = [("a", 1, 40_000), ("a", 1, 70_000), ("a", None, 40_000), ("b", 32_767, None), ("b", 32_768, None), ("b", 0, None), (None, 5, 5)]
    df = spark.createDataFrame(data, "k string, x long, y long")
    out = agg.distinct_by_bitmaps(df, ["k"], xs="x", ys="y")
    assert rows(out) == [("a", 1, 2), ("b", 3, 0), (None, 1, 1)]
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert agg.distinct_by_bitmaps(df, [], xs="x").first().xs == 5
    with pytest.raises(Exception, match="negative"):
        agg.distinct_by_bitmaps(spark.createDataFrame([("a", -1)], "k string, x long"), ["k"], xs="x").collect()


def test_no_sketch_is_kept_for_every_user(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["a04_approx_count_distinct"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    with_sketch = [line for line in plan.splitlines() if "approx_count_distinct" in line]
    assert with_sketch and not any("user_id" in line.split("functions=")[0] for line in with_sketch)


def test_packs_deal_rows_by_what_they_count(spark, monkeypatch):
    from tidewater.operators import packs

    data = [(c, o, float(q)) for c in ("a", "b", None) for o in (1, 2, 2, None) for q in range(3)]
    df = durable(spark.createDataFrame(data, "category string, order_id int, qty double"), "lines")
    pack = packs.Pack("sales", ("category",), {"orders": packs.uniq("order_id"), "qty": packs.total("qty")}, deal=("category", "order_id"))
    plain = rows(packs.run(pack, df))
    monkeypatch.setattr(packs, "PLAIN_BYTES", 0)
    monkeypatch.setattr(packs, "TASK_BYTES", 100)
    out = packs.run(pack, df)
    assert rows(out) == plain == sorted([("a", 2, 12.0), ("b", 2, 12.0), (None, 2, 12.0)], key=repr)
    plan = packs.run(pack, df)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning(category") == 2      # dealt once, then one row per task and group

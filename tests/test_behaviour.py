import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.operators import behaviour as B


def test_streaks_cross_month_and_year(spark):
    days = ["2023-12-30", "2023-12-31", "2023-12-31", "2024-01-01", "2024-01-03", "2024-02-29", "2024-03-01"]
    df = spark.createDataFrame([("u", d) for d in days], "u string, d string")
    got = B.streaks(df, ["u"], "d").select(F.col("first_day").cast("string"), F.col("last_day").cast("string"), "days")
    assert rows(got) == [("2023-12-30", "2024-01-01", 3), ("2024-01-03", "2024-01-03", 1), ("2024-02-29", "2024-03-01", 2)]
    months = spark.createDataFrame([("u", d) for d in ("2023-11-05", "2023-12-31", "2024-01-01", "2024-03-01")], "u string, d string")
    assert B.longest_streak(months, ["u"], "d", "month").first().longest == 3


def test_session_gap_of_exactly_thirty_minutes_stays(spark, both_ways):
    times = ["10:00:00", "10:30:00", "11:00:01", "11:00:01"]
    df = spark.createDataFrame([("u", f"2024-01-01 {x}", i) for i, x in enumerate(times)], "u string, s string, id int").withColumn("ts", F.to_timestamp("s"))
    got = B.sessionize(df, ["u"], "ts", ["id"])
    assert rows(got, "id", "session") == [(0, 1), (1, 1), (2, 2), (3, 2)]


def test_retention_counts_only_the_nth_day(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-08"), ("b", "2024-01-01"), ("b", "2024-01-09")], "u string, ts string")
    r = B.day_n_retention(df, df, "u", 7).first()
    assert (r.users, r.retained, r.rate) == (2, 1, 50.0)


def test_cohort_rates_keep_empty_periods(spark):
    df = spark.createDataFrame([("a", "2023-12-05"), ("a", "2024-02-01"), ("b", "2023-12-31")], "u string, ts string")
    r = B.cohort_rates(df, "u", "ts", "month", 3).first()
    assert (r["size"], r.p0, r.p1, r.p2) == (2, 100.0, 0.0, 50.0)


def test_monthly_flow(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-03-01"), ("b", "2024-01-01"), ("b", "2024-02-01"), ("c", "2024-03-05")], "u string, ts string")
    got = B.monthly_flow(df, "u", "ts").select(F.col("m").cast("string"), "active", "new", "retained", "returned", "churned")
    assert rows(got) == [("2024-01-01", 2, 2, 0, 0, 0), ("2024-02-01", 1, 0, 1, 0, 1), ("2024-03-01", 2, 1, 0, 1, 1)]
    gap = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-03-01")], "u string, ts string")
    assert rows(B.monthly_flow(gap, "u", "ts").select(F.col("m").cast("string"), "active", "returned", "churned")) == [("2024-01-01", 1, 0, 0), ("2024-02-01", 0, 0, 1), ("2024-03-01", 1, 1, 0)]


def test_funnel_counts_users_not_rows(spark):
    df = spark.createDataFrame([("a", "view"), ("a", "view"), ("a", "buy"), ("b", "view"), ("c", "buy")], "u string, s string")
    r = B.funnel(df, "u", "s", ["view", "buy"]).first()
    assert (r.view, r.buy, r.buy_of_view) == (2, 1, 50.0)


@pytest.mark.parametrize("later,hit", [(48 * 3600, True), (48 * 3600 + 1, False), (0, True), (-1, False)])
def test_converted_within_limits(spark, both_ways, later, hit):
    start = dt.datetime(2024, 1, 10)
    data = [("u", start, 1, "signup"), ("u", start + dt.timedelta(seconds=later), 2, "purchase")]
    df = spark.createDataFrame(data, "u string, ts timestamp, id int, s string")
    assert (B.converted_within(df, "u", "ts", "id", "s", "signup", "purchase", 48).count() == 1) is hit


def test_rolling_active_brute_force(spark, both_ways):
    data = [("a", 1), ("a", 2), ("b", 2), ("a", 7), ("c", 9)]
    df = spark.createDataFrame([(u, dt.date(2024, 1, d)) for u, d in data], "u string, ts date")
    want = [(dt.date(2024, 1, d), len({u for u, x in data if d - 3 < x <= d})) for d in range(1, 10)]
    assert rows(B.rolling_active(df, "u", "ts", 3), "day", "active") == sorted(want, key=repr)


def test_covered_days_counts_overlaps_once(spark, both_ways):
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    spans = [(0, 10), (5, 8), (9, 12), (20, 21), (20, 25)]
    df = spark.createDataFrame([("k", d(a), d(b)) for a, b in spans], "k string, s date, e date")
    want = len(set(itertools.chain.from_iterable(range(a, b) for a, b in spans)))
    assert B.covered_days(df, ["k"], "s", "e").first().covered == want


def test_activity_status_boundaries(spark):
    df = spark.createDataFrame([("a", "2024-01-31"), ("b", "2024-01-01"), ("c", "2023-06-01")], "u string, ts string")
    got = B.activity_status(df, "u", "ts", F.lit("2024-01-31").cast("date"), 0, 30)
    assert rows(got, "u", "status") == [("a", "active"), ("b", "at_risk"), ("c", "churned")]

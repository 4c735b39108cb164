"""User behaviour over time: streaks, sessions, retention, churn, funnels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewater.functions.columns import epoch, month, pct
from tidewater.operators.ordered import reach_back, scan, trailing_sums
from tidewater.sources.io import spine


def streaks(df: DataFrame, keys: list[str], time: str, unit: str = "day") -> DataFrame:
    """Runs of consecutive days (or months) per key: first_day, last_day, days.

    Repeats inside a day are removed first, so a key has at most one row per calendar unit.
    """
    at = F.to_date(time) if unit == "day" else month(time)
    dates = df.select(*keys, at.alias("_d")).distinct()
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy("_d"))
    number = F.unix_date("_d") if unit == "day" else F.year("_d") * 12 + F.month("_d")
    return (dates.withColumn("_island", number - pos).groupBy(*keys, "_island")
            .agg(F.min("_d").alias("first_day"), F.max("_d").alias("last_day"), F.count("*").alias("days"))
            .drop("_island"))


def longest_streak(df: DataFrame, keys: list[str], time: str, unit: str = "day") -> DataFrame:
    return streaks(df, keys, time, unit).groupBy(*keys).agg(F.max("days").alias("longest"))


def flag_groups(df: DataFrame, keys: list[str], order: list[str], starts: Callable[[WindowSpec], Column],
                name: str = "grp") -> DataFrame:
    """Number the groups of a sequence: a new one begins where ``starts`` (a one-row look-back) is true."""
    flagged = reach_back(df, keys, order, 1, _flag=lambda w: starts(w).cast("int"))
    return scan(flagged, keys, order, **{name: ("sum", "_flag")}).drop("_flag")


def sessionize(df: DataFrame, keys: list[str], time: str, tie: list[str], gap_seconds: int = 1800,
               name: str = "session") -> DataFrame:
    """Session number per row; a gap longer than ``gap_seconds`` starts a new one."""
    def starts(w: WindowSpec) -> Column:
        gap = F.col("_t") - F.lag("_t").over(w)
        return F.coalesce(gap > gap_seconds, F.lit(True))
    rows = df.withColumn("_t", F.unix_micros(F.col(time).cast("timestamp")) / 1e6)
    return flag_groups(rows, keys, [time, *tie], starts, name).drop("_t")


def gaps(df: DataFrame, keys: list[str], time: str, tie: list[str], name: str = "gap_seconds") -> DataFrame:
    """Seconds since the key's previous row (null on the first)."""
    return reach_back(df, keys, [time, *tie], 1, **{name: lambda w: epoch(time) - F.lag(epoch(time)).over(w)})


def cumulative_distinct(df: DataFrame, keys: list[str], period: str, member: str, name: str) -> DataFrame:
    """Distinct members seen up to each period that brings a new one (first appearances, then a running sum)."""
    first = df.groupBy(*keys, member).agg(F.min(period).alias(period))
    fresh = first.groupBy(*keys, period).agg(F.count("*").alias("_fresh"))
    w = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return fresh.withColumn(name, F.sum("_fresh").over(w)).drop("_fresh")


def day_n_retention(signups: DataFrame, activity: DataFrame, user: str, n: int) -> DataFrame:
    """Share of users active exactly ``n`` days after their signup day, per signup day."""
    first = signups.groupBy(user).agg(F.to_date(F.min("ts")).alias("signup_day"))
    days = activity.select(user, F.to_date("ts").alias("_d")).distinct()
    back = first.withColumn("_d", F.date_add("signup_day", n)).join(days.withColumn("_hit", F.lit(1)), [user, "_d"], "left")
    return back.groupBy("signup_day").agg(F.count("*").alias("users"), F.count("_hit").alias("retained"),
                                          pct(F.count("_hit"), F.count("*")).alias("rate"))


def cohort_counts(df: DataFrame, user: str, time: str, unit: str = "month") -> DataFrame:
    """Users per (cohort, periods since): cohort is the user's first month (or week)."""
    if unit == "month":
        at, index = month(time), F.floor(F.months_between("_p", "cohort"))
    else:
        at, index = F.to_date(F.date_trunc("week", time)), F.floor(F.datediff("_p", "cohort") / 7)
    seen = df.select(user, at.alias("_p")).distinct()
    first = seen.withColumn("cohort", F.min("_p").over(Window.partitionBy(user)))     # one row per user and period
    return first.groupBy("cohort", index.cast("int").alias("period")).agg(F.count("*").alias("users"))


def cohort_rates(df: DataFrame, user: str, time: str, unit: str, periods: int) -> DataFrame:
    """Cohort matrix: size and retention percentage for periods 0..n-1, one row per cohort."""
    counts = cohort_counts(df, user, time, unit)
    at = lambda i: F.sum(F.when(F.col("period") == i, F.col("users")))
    return counts.groupBy("cohort").agg(at(0).alias("size"), *[
        pct(F.coalesce(at(i), F.lit(0)), at(0)).alias(f"p{i}") for i in range(periods)])


def cohort_retention(df: DataFrame, user: str, time: str, unit: str) -> DataFrame:
    """(cohort, period, users, size, rate) for every period in which a cohort has users."""
    counts = cohort_counts(df, user, time, unit)
    sizes = counts.filter("period = 0").select("cohort", F.col("users").alias("size"))
    return counts.join(sizes, "cohort").withColumn("rate", pct(F.col("users"), F.col("size")))


def activity_status(df: DataFrame, user: str, time: str, as_of: Column, risk_days: int, churn_days: int) -> DataFrame:
    """Active / at risk / churned by days since the last activity."""
    last = df.groupBy(user).agg(F.to_date(F.max(time)).alias("last_day"))
    idle = F.datediff(as_of, "last_day")
    return last.withColumn("idle_days", idle).withColumn(
        "status", F.when(idle <= risk_days, "active").when(idle <= churn_days, "at_risk").otherwise("churned"))


def monthly_flow(df: DataFrame, user: str, time: str) -> DataFrame:
    """Per month: active, new, returned (not active the month before), retained, churned (active the month before only).

    Every month between the first and the last has a row, also without activity.
    """
    months = df.select(user, month(time).alias("m")).filter("m is not null").distinct()
    w = Window.partitionBy(user).orderBy("m")
    marked = months.withColumns({"_prev": F.lag("m").over(w), "_next": F.lead("m").over(w)})
    stayed, after = F.col("_prev").eqNullSafe(F.add_months("m", -1)), F.add_months("m", 1)
    seen = F.struct("m", F.lit(1).alias("active"), F.col("_prev").isNull().cast("int").alias("new"), stayed.cast("int").alias("retained"),
                    (F.col("_prev").isNotNull() & ~stayed).cast("int").alias("returned"), F.lit(0).alias("churned"))
    gone = F.struct(after.alias("m"), *[F.lit(0).alias(c) for c in ("active", "new", "retained", "returned")], F.lit(1).alias("churned"))
    booked = marked.select(F.explode(F.when(F.col("_next").eqNullSafe(after), F.array(seen)).otherwise(F.array(seen, gone))).alias("x")).select("x.*")
    sums = booked.groupBy("m").agg(*[F.sum(c).alias(c) for c in ("active", "new", "retained", "returned", "churned")])
    every = spine(months.agg(F.min("m").alias("lo"), F.max("m").alias("hi")), "lo", "hi", "m", "interval 1 month")
    return every.join(sums, "m", "left").fillna(0)


def funnel(df: DataFrame, user: str, stage: str, stages: list[str]) -> DataFrame:
    """Distinct users per stage and conversion against the first and the previous stage."""
    users = df.filter(F.col(stage).isin(*stages)).groupBy(user).agg(
        *[F.max((F.col(stage) == s).cast("int")).alias(f"_s{i}") for i, s in enumerate(stages)])
    reached, cols = None, []
    for i, s in enumerate(stages):
        reached = F.col(f"_s{i}") == 1 if reached is None else reached & (F.col(f"_s{i}") == 1)
        cols.append(F.count_if(reached).alias(s))
    counts = users.agg(*cols)
    rates = [pct(F.col(s), F.col(stages[i])).alias(f"{s}_of_{stages[i]}") for i, s in enumerate(stages[1:])]
    total = [pct(F.col(s), F.col(stages[0])).alias(f"{s}_overall") for s in stages[1:]]
    return counts.select(*stages, *rates, *total)


def converted_within(df: DataFrame, user: str, time: str, tie: str, stage: str, start: str, goal: str, hours: int) -> DataFrame:
    """Users with any start–goal pair where 0 <= gap <= ``hours``.

    The latest start at or before each goal is enough, so one ordered pass replaces a pair join.
    """
    marks = df.filter(F.col(stage).isin(start, goal)).select(user, time, tie, stage).withColumn(
        "_s", F.when(F.col(stage) == start, F.col(time))).withColumn("_o", (F.col(stage) == goal).cast("int"))
    seen = scan(marks, [user], [time, "_o", tie], _last=("max", "_s"))
    gap = F.col(time).cast("timestamp").cast("double") - F.col("_last").cast("timestamp").cast("double")
    return seen.filter((F.col(stage) == goal) & (gap <= hours * 3600)).select(user).distinct()


def trailing_distinct(df: DataFrame, keys: list[str], member: str, time: str, days: int, name: str = "members") -> DataFrame:
    """Distinct members in the trailing ``days`` window at every date where that number changes.

    A member's dates become coverage intervals; +1 / -1 steps are summed per date and run up, so
    the cost follows distinct (key, member, date) rows and not the window length.
    """
    seen = df.select(*keys, member, F.to_date(time).alias("day")).distinct()
    nxt = F.lead("day").over(Window.partitionBy(*keys, member).orderBy("day"))      # one row per date
    spans = seen.withColumn("_end", F.least(F.date_add("day", days), F.coalesce(nxt, F.date_add("day", days))))
    steps = (spans.select(*keys, "day", F.lit(1).alias("_step"))
             .unionByName(spans.select(*keys, F.col("_end").alias("day"), F.lit(-1).alias("_step")))
             .groupBy(*keys, "day").agg(F.sum("_step").alias("_step")))
    return scan(steps, keys, ["day"], **{name: ("sum", "_step")}).drop("_step")


def rolling_active(df: DataFrame, user: str, time: str, days: int) -> DataFrame:
    """Distinct users in each trailing ``days`` window, one row per calendar day."""
    changes = trailing_distinct(df, [], user, time, days, "active")
    bounds = df.agg(F.to_date(F.min(time)).alias("lo"), F.to_date(F.max(time)).alias("hi"))
    line = spine(bounds, "lo", "hi").join(changes, "day", "left")
    return scan(line, [], ["day"], _now=("last", "active")).select("day", F.col("_now").alias("active"))


def covered_days(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Days covered by at least one [start, end) interval per key; overlaps count once."""
    top = scan(df.select(*keys, start, end), keys, [start, end], _reach=("max", end))
    seen = reach_back(top, keys, [start, end], 1, _before=lambda w: F.lag("_reach").over(w))
    fresh = F.datediff("_reach", F.greatest(F.col(start), F.coalesce("_before", start)))
    return seen.groupBy(*keys).agg(F.sum(F.greatest(fresh, F.lit(0))).alias("covered"))


def velocity(df: DataFrame, keys: list[str], time: str, seconds: int, at_least: int) -> DataFrame:
    """(key, second) points whose trailing window holds at least ``at_least`` rows."""
    rows = df.withColumn("_t", epoch(time))
    return trailing_sums(rows, keys, "_t", seconds, n=F.lit(1)).filter(F.col("n") >= at_least)

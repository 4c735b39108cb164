"""Aggregations that need more than one built-in function."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import ratio
from tidewater.operators.ordered import scan
from tidewater.operators.rel import attach, best_rows, match
from tidewater.sources.durable import settled


BRACKET = 1000        # accuracy of the sketch that brackets a quantile position


def exact_quantiles(df: DataFrame, keys: list[str], value: str, continuous: bool = True,
                    **points: float) -> DataFrame:
    """Exact quantiles per key without holding a group in one task, and without ordering it.

    One pass sketches every group and takes two values around each position, further apart than the
    sketch can err. A second pass counts what lies below them and keeps the values between, a few in a
    thousand, with their counts. Only those are ordered, by a sliced scan. A key whose position falls outside its
    bracket, which the sketch's bound rules out, would be bracketed by its extremes. ``continuous`` interpolates as
    PERCENTILE_CONT does; otherwise the lowest value with cumulative share >= p is returned.
    """
    one = keys or ["_all"]
    base = settled((df if keys else df.withColumn("_all", F.lit(0))).select(*one, value))
    names = list(points)
    margin = 2.0 / BRACKET
    asked = [F.lit(min(1.0, max(0.0, points[n] + d))) for n in names for d in (-margin, margin)]
    sketch = F.percentile_approx(F.col(value).cast("double"), F.array(*asked), BRACKET).alias("_q")
    groups = base.groupBy(*one).agg(F.count(value).alias("_total"), F.count(F.lit(1)).alias("_rows"), F.min(value).cast("double").alias("_least"),
                                    F.max(value).cast("double").alias("_most"), sketch)
    # extremes of the bracket: beyond the group's own when the position could be its first or last
    ends = [c for i, n in enumerate(names) for c in (
        F.when(F.col("_total") * (points[n] - margin) < 2, F.col("_least")).otherwise(F.col("_q")[2 * i]).alias(f"_lo_{n}"),
        F.when(F.col("_total") * (1 - points[n] - margin) < 2, F.col("_most")).otherwise(F.col("_q")[2 * i + 1]).alias(f"_hi_{n}"))]
    groups = settled(groups.select(*one, "_total", "_rows", "_least", "_most", *ends), "brackets")
    out = _between(base, groups, one, value, points, continuous)
    missed = reduce(lambda x, y: x + y, [F.col(f"_missed_{n}") for n in names])
    if not (lost := out.filter(missed > 0).select(*one)).isEmpty():
        whole = match(groups, lost, one, "left_semi").withColumns({f"_{side}_{n}": F.col(f"_{end}") for n in names for side, end in (("lo", "least"), ("hi", "most"))})
        out = out.filter(missed == 0).unionByName(_between(match(base, lost, one, "left_semi"), whole, one, value, points, continuous))
    return out.select(*keys, *names)


def _between(base: DataFrame, groups: DataFrame, one: list[str], value: str, points: dict[str, float], continuous: bool) -> DataFrame:
    """Quantiles from the rows inside the brackets of ``groups``; ``_missed_*`` is 1 where a position lies outside.

    Rows outside all brackets are one row a key, first in order, that brings the numbers below each bracket.
    So a running sum of what lies below or inside a bracket is the rank of every value inside it.
    """
    names, v = list(points), F.col(value).cast("double")
    inside = {n: F.coalesce(v.between(F.col(f"_lo_{n}"), F.col(f"_hi_{n}")), F.lit(False)) for n in names}
    flags = [c for n in names for c in (inside[n].cast("int").alias(f"_in_{n}"), F.coalesce(v < F.col(f"_lo_{n}"), F.lit(False)).cast("int").alias(f"_under_{n}"))]
    rows = attach(base, groups, one).select(*one, "_total", F.when(reduce(lambda x, y: x | y, inside.values()), v).alias("_v"), *flags)
    sums = [c for n in names for c in (F.sum(f"_in_{n}").alias(f"_in_{n}"), F.sum(F.col(f"_in_{n}") + F.col(f"_under_{n}")).alias(f"_upto_{n}"))]
    counts = settled(rows.groupBy(*one, "_total", "_v").agg(*sums), "counts")
    run = scan(counts, one, ["_v"], **{f"_rank_{n}": ("sum", f"_upto_{n}") for n in names})
    aggs: list[Column] = []
    for name, p in points.items():
        place = (F.col("_total") - 1) * F.lit(p) + 1
        low, high = (F.floor(place), F.ceil(place)) if continuous else (F.greatest(F.ceil(F.col("_total") * F.lit(p)), F.lit(1)),) * 2
        holds = lambda at, n=name: (F.col(f"_in_{n}") > 0) & (F.col(f"_rank_{n}") - F.col(f"_in_{n}") < at) & (F.col(f"_rank_{n}") >= at)
        at_low, at_high = (F.max(F.when(holds(at), F.col("_v"))) for at in (low, high))
        share = F.max(place - F.floor(place)) if continuous else F.lit(0.0)
        missed = (F.max("_total") > 0) & (F.isnull(at_low) | F.isnull(at_high))
        aggs += [(at_low + (at_high - at_low) * share).alias(name), missed.cast("int").alias(f"_missed_{name}")]
    return settled(run.groupBy(*one).agg(*aggs), "quantiles")


def daily_sketches(df: DataFrame, keys: list[str], time: str, value: str, distinct: str | None = None, k: int = 400, lg_k: int = 12) -> DataFrame:
    """One row a key and day that later periods are merged from: a KLL sketch of ``value``, an HLL sketch of ``distinct``.

    Sketches are of bounded size, so weeks, months and totals never go back to the rows.
    """
    aggs = [F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("values")]
    if distinct:
        aggs.append(F.hll_sketch_agg(distinct, lg_k).alias("ids"))
    return df.groupBy(*keys, F.to_date(time).alias("day")).agg(*aggs)


def merged_quantiles(sketches: DataFrame, keys: list[str], points: list[float]) -> DataFrame:
    """(keys, p, n, value): quantiles of the merged value sketches."""
    whole = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("values").alias("s"))
    each = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias("value")) for p in points])
    return whole.select(*keys, F.kll_sketch_get_n_double("s").alias("n"), F.explode(each).alias("x")).select(*keys, "x.p", "n", "x.value")


def merged_distinct(sketches: DataFrame, keys: list[str], units: tuple[str, ...] = ("day", "week", "month")) -> DataFrame:
    """(keys, unit, period, estimate): distinct ids of each period, from unions of the daily sketches."""
    per = [sketches.groupBy(*keys, F.lit(u).alias("unit"), F.to_date(F.date_trunc(u, "day")).alias("period")).agg(F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("estimate")) for u in units]
    return reduce(DataFrame.unionByName, per)


def quantile_rank_error(df: DataFrame, found: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``found`` (keys, p, n, value) with ``error``: how far p lies outside the share of rows below, and up to, the value.

    ``found`` holds a few rows a key and is sent to the rows.
    """
    both = df.select(*keys, F.col(value).alias("_v")).filter("_v is not null").join(F.broadcast(found), keys)
    ranked = both.groupBy(*keys, "p", "n", "value").agg((F.count_if(F.col("_v") < F.col("value")) / F.col("n")).alias("_under"), (F.count_if(F.col("_v") <= F.col("value")) / F.col("n")).alias("_upto"))
    return ranked.withColumn("error", F.greatest(F.col("_under") - F.col("p"), F.col("p") - F.col("_upto"), F.lit(0.0))).drop("_under", "_upto")


def distinct_by_bitmaps(df: DataFrame, keys: list[str], **ids: str) -> DataFrame:
    """Exact distinct counts of dense non-negative ids per key, for groups that hold a good part of the ids.

    Every id sets one bit of a 32,768-bit map by (key, bucket of ids); maps are merged by OR and counted. Each
    column is one aggregate whose partial results are maps, so rows are neither multiplied nor shuffled, as an
    aggregate over several distinct counts would do. Null ids count nothing; negative ones are refused.
    """
    base, out = settled(df.select(*keys, *set(ids.values()))), None
    for name, column in ids.items():
        bit = F.when(F.col(column) >= 0, F.col(column).cast("long")).when(F.col(column) < 0, F.raise_error(F.lit(f"{column} is negative")).cast("long"))
        maps = base.groupBy(*keys, F.bitmap_bucket_number(bit).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_map"))
        one = maps.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("_bucket").isNotNull(), F.bitmap_count("_map"))), F.lit(0)).alias(name))
        out = one if out is None else (match(out, one, keys) if keys else out.crossJoin(one))
    return out


def modes(df: DataFrame, keys: list[str], value: str, name: str = "n") -> DataFrame:
    """Most frequent value(s) per key, ties kept, with the count."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias(name))
    if keys:
        return best_rows(counts, keys, name)
    return counts.filter(F.col(name) == counts.agg(F.max(name)).scalar())


def share_of_total(df: DataFrame, keys: list[str], measure: Column, within: list[str] | None = None,
                   digits: int = 6) -> DataFrame:
    """Sum per key and its percentage of the grand total, or of the ``within`` group's total."""
    sums = df.groupBy(*keys).agg(F.sum(measure).alias("value"))
    if within:
        tot = sums.groupBy(*within).agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("_rows"))
        sums = attach(sums, tot, within)
        total = F.col("total")
    else:
        total = sums.agg(F.sum("value")).scalar()
    return sums.withColumn("share", F.round(ratio(F.col("value"), total) * 100, digits)).drop("total")


def divides(df: DataFrame, entity: str, member: str, required: DataFrame) -> DataFrame:
    """Entities that cover every ``member`` of ``required`` (relational division)."""
    need = required.select(member).distinct()
    held = df.join(need, member, "left_semi").groupBy(entity).agg(F.count_distinct(member).alias("_held"))
    return held.filter(F.col("_held") == need.agg(F.count(F.lit(1))).scalar()).drop("_held")


def pivot_sum(df: DataFrame, keys: list[str], column: str, values: list, measure: Column) -> DataFrame:
    """Static pivot: one pass, one column per listed value."""
    return df.groupBy(*keys).pivot(column, values).agg(F.sum(measure))


def pivot_discovered(df: DataFrame, keys: list[str], column: str, measure: Column) -> DataFrame:
    """Pivot over all values found in the data; they become columns, so the driver must know them."""
    found = [r[0] for r in df.select(column).distinct().orderBy(column).collect()]
    return df.groupBy(*keys).pivot(column, found).agg(F.sum(measure))


def gini(df: DataFrame, value: str) -> DataFrame:
    """Gini coefficient (2·Σ i·x)/(n·Σ x) − (n+1)/n with i the ascending position.

    Equal values are grouped first; a group of c values ending at position e contributes
    x·c·(2e − c + 1)/2 to Σ i·x, so no row-level global order is needed.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    run = scan(counts, [], [value], _e=("sum", "_c"))
    x, c, e = F.col(value), F.col("_c"), F.col("_e")
    n, total = F.sum(c), F.sum(x * c)
    return run.agg((2 * F.sum(x * c * (2 * e - c + 1) / 2) / (n * total) - (n + 1) / n).alias("gini"))


def pareto(df: DataFrame, entity: str, value: str, share: float, include_crossing: bool = False) -> DataFrame:
    """Entities, largest first, whose cumulative share stays within ``share`` (id breaks ties)."""
    run = scan(df, [], [f"-{value}", entity], cumulative=("sum", value))
    total = df.agg(F.sum(value)).scalar()
    reached = F.col("cumulative") - (F.col(value) if include_crossing else F.lit(0))
    test = reached < total * share if include_crossing else reached <= total * share
    return run.withColumn("cum_share", ratio(F.col("cumulative"), total)).filter(test)


def abc_classes(df: DataFrame, entity: str, value: str, a: float = 0.8, b: float = 0.95) -> DataFrame:
    """Class A / B / C by cumulative share of value."""
    run = scan(df, [], [f"-{value}", entity], cumulative=("sum", value))
    part = ratio(F.col("cumulative"), df.agg(F.sum(value)).scalar())
    return (run.withColumn("cum_share", part)
            .withColumn("class", F.when(part <= a, "A").when(part <= b, "B").otherwise("C")))

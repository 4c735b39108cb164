"""Metric packs: one grouped aggregate that yields a named set of measures.

A pack is plain SQL expressions over a prepared table, so counts, rates, distinct counts and
percentiles of one grouping come out of a single partial + final aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tidewater.functions.columns import bands
from tidewater.operators.ordered import input_bytes, rank_table
from tidewater.operators.rel import match
from tidewater.sources.durable import settled

PLAIN_BYTES = 64 << 20       # tables up to this size are aggregated where they lie
TASK_BYTES = 8 << 20         # of compressed tables, behind the rows of one task


@dataclass(frozen=True)
class Pack:
    source: str
    by: tuple[str, ...]
    measures: dict[str, str]
    rank: tuple[str, str] | None = None                      # (output, measure), highest first
    tier: tuple[str, str, tuple, str] | None = None          # (output, measure, ((upper edge, label)…), other)
    derived: dict[str, str] = field(default_factory=dict)    # expressions over the measures
    deal: tuple[str, ...] = ()                               # columns that deal many rows over tasks: the group and what is counted in it, or a fine group alone


def total(x: str) -> str:
    return f"round(sum({x}), 2)"


def mean(x: str) -> str:
    """Average to six digits, ties upwards; the sum is a decimal, so its order does not matter."""
    return f"floor(1e6 * (cast(sum(cast({x} as decimal(18, 6))) as double) / nullif(count({x}), 0)) + 0.5e0) / 1e6"


def uniq(x: str) -> str:
    return f"count(distinct {x})"


def hits(condition: str) -> str:
    return f"count(case when {condition} then 1 end)"


def rate(condition: str, base: str = "true") -> str:
    """Percentage of the rows of ``base`` that meet the condition; null without such rows."""
    return f"round(100e0 * {hits(condition)} / nullif({hits(base)}, 0), 6)"


def over(part: str, whole: str) -> str:
    """Quotient to six digits, ties upwards; null for a zero divisor."""
    return f"floor(1e6 * (1e0 * ({part}) / nullif({whole}, 0)) + 0.5e0) / 1e6"


def percentile(x: str, p: float) -> str:
    """Bounded sketch, exact while a group has fewer rows than half the accuracy."""
    return f"percentile_approx({x}, {p}, 10000)"


def dealt(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows dealt by ``columns`` over as many tasks as the tables behind them need.

    Distinct counts keep a group for almost every row while they are added up. Left where they are, a scan or the
    session's fixed number of shuffle partitions would give each task more such groups as tables grow.
    """
    known = input_bytes(df)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    if not columns or known is None or known <= PLAIN_BYTES:
        return df
    return df.repartition(max(parts, known // TASK_BYTES), *columns)


def run(pack: Pack, df: DataFrame) -> DataFrame:
    """Compute a pack. Dates stay dates inside the aggregate (text minima would rule out hash
    aggregation) and are shown as text."""
    df = dealt(df, pack.deal)
    out = df.groupBy(*pack.by).agg(*[F.expr(e).alias(n) for n, e in pack.measures.items()])
    shown = {f.name: F.col(f.name).cast("string") for f in out.schema if f.dataType == DateType()}
    out = out.withColumns(shown) if shown else out
    if pack.derived:
        out = out.select("*", *[F.expr(e).alias(n) for n, e in pack.derived.items()])
    if pack.tier:
        name, measure, edges, other = pack.tier
        out = out.withColumn(name, bands(F.col(measure), *edges, other=other))
    if pack.rank:
        name, measure = pack.rank
        out = settled(out, "pack")
        ranks = rank_table(out, [], measure, descending=True).select(measure, F.col("rank").alias(name))
        out = match(out, ranks, [measure])
    return out

"""Data quality and privacy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.functions.columns import mask_digits, mask_email, pct, salted_hash
from tidewater.operators.agg import exact_quantiles, modes
from tidewater.operators.rel import with_group_stats
from tidewater.sources.durable import durable
from tidewater.sources.io import scalar


def passes(rule: Column) -> Column:
    """A rule holds only when it is true; null counts as failed."""
    return F.coalesce(rule, F.lit(False))


def quality_metrics(df: DataFrame, key: list[str], required: list[str], invalid: dict[str, Column],
                    distinct_keys: bool = True) -> DataFrame:
    """One row: row count, nulls per column, invalid counts and duplicate rate of the key."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]
    aggs += [F.count_if(c).alias(f"invalid_{n}") for n, c in invalid.items()]
    if distinct_keys:
        extra = F.count(F.lit(1)) - F.count_distinct(F.struct(*key))
        aggs.append(pct(extra, F.count(F.lit(1))).alias("duplicate_pct"))
    return df.agg(*aggs)


def tag(df: DataFrame, rules: dict[str, Column], name: str = "failed") -> DataFrame:
    """Comma-separated names of the failed rules, empty when the row is valid."""
    labels = [F.when(~passes(rule), F.lit(label)) for label, rule in rules.items()]
    return df.withColumn(name, F.concat_ws(",", *labels))


def expect(df: DataFrame, warn: dict[str, Column] | None = None,
           drop: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Drop rows failing a ``drop`` rule, keep those failing a ``warn`` rule, count both in the same pass."""
    warn, drop = warn or {}, drop or {}
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                         *[F.count_if(~passes(r)).alias(n) for n, r in {**warn, **drop}.items()])
    for rule in drop.values():
        counted = counted.filter(passes(rule))
    return counted, seen


def rule_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Failed and passed rows per rule, one pass and then one row per rule."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(~passes(r)).alias(n) for n, r in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed"), (F.col("_rows") - F.col(n)).alias("passed"))
                      for n in rules])
    return one.select(F.inline(pairs))


def split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): every input row is in exactly one of them."""
    tagged = tag(df, rules)
    return tagged.filter("failed = ''").drop("failed"), tagged.filter("failed <> ''")


def impute(df: DataFrame, defaults: dict | None = None, means: list[str] = (), mode_of: list[str] = ()) -> DataFrame:
    """Fill nulls with a default, the column's mean, or its most frequent value (lowest on ties)."""
    out = df.fillna(defaults) if defaults else df
    for c in means:
        out = out.withColumn(c, F.coalesce(F.col(c), scalar(df, F.avg(c))))
    for c in mode_of:
        out = out.withColumn(c, F.coalesce(F.col(c), scalar(modes(df, [], c), F.min(c))))
    return out


def impute_group_mean(df: DataFrame, keys: list[str], column: str, spread: list[str] | None = None) -> DataFrame:
    rows = with_group_stats(df, keys, spread, _mean=F.avg(column))
    return rows.withColumn(column, F.coalesce(column, "_mean")).drop("_mean")


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5, exact: bool = False) -> DataFrame:
    """Rows outside the quartile fences; a bounded sketch by default, exact quartiles on request."""
    if exact:
        q = durable(exact_quantiles(df, [], column, continuous=False, q1=0.25, q3=0.75), "quartiles")
        q1, q3 = scalar(q, F.max("q1")), scalar(q, F.max("q3"))
    else:
        q1, q3 = (scalar(df, F.percentile_approx(column, p, 10000)) for p in (0.25, 0.75))
    width = q3 - q1
    return df.filter((F.col(column) < q1 - factor * width) | (F.col(column) > q3 + factor * width))


def sigma_outliers(df: DataFrame, keys: list[str], column: str, sigmas: float = 2.0) -> DataFrame:
    """Rows above their group's mean plus ``sigmas`` standard deviations."""
    rows = with_group_stats(df, keys, _mean=F.avg(column), _sd=F.stddev(column))
    return rows.filter(F.col(column) > F.col("_mean") + sigmas * F.col("_sd")).drop("_mean", "_sd")


def below_group_mean(df: DataFrame, keys: list[str], column: str, share: float) -> DataFrame:
    rows = with_group_stats(df, keys, _mean=F.avg(column))
    return rows.filter(F.col(column) < share * F.col("_mean")).drop("_mean")


def duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def keep_latest(df: DataFrame, keys: list[str], *recency: str) -> DataFrame:
    """One row per key, the latest by ``recency``; a map-side combined aggregate, not a window."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*recency))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def mask(df: DataFrame, salt: str, hashed: dict[str, str] | None = None, emails: list[str] = (),
         numbers: list[str] = (), redacted: list[str] = ()) -> DataFrame:
    """Replace identifiers by salted hashes (original dropped), shorten e-mails and numbers, redact the rest."""
    out = df
    for column, name in (hashed or {}).items():
        out = out.withColumn(name, salted_hash(F.col(column), salt)).drop(column)
    changes = {c: mask_email(F.col(c)) for c in emails}
    changes |= {c: mask_digits(F.col(c)) for c in numbers}
    changes |= {c: F.when(F.col(c).isNotNull(), F.lit("REDACTED")) for c in redacted}
    return out.withColumns(changes) if changes else out


def role_view(df: DataFrame, role: str, masked: dict[str, Column], row_filter: Column, full_role: str = "admin") -> DataFrame:
    """Full rows for ``full_role``; others see masked columns and only the rows of the filter."""
    full = F.lit(role == full_role)
    out = df.filter(full | passes(row_filter))
    return out.withColumns({c: F.when(full, F.col(c)).otherwise(m) for c, m in masked.items()})


def run_audit(df: DataFrame, run_id: str, time: str, at: Column | None = None) -> DataFrame:
    """One audit row of a job run."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first"), F.max(time).alias("last")).withColumns(
        {"run_id": F.lit(run_id), "logged_at": at if at is not None else F.current_timestamp()})


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per Spark partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def key_skew(df: DataFrame, keys: list[str], factor: float = 10.0) -> DataFrame:
    """Keys holding more than ``factor`` times the mean rows per key."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.filter(F.col("rows") > factor * scalar(sizes, F.avg("rows")))


def repair(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace known bad codes by their canonical form (``mapping``: bad, good)."""
    from tidewater.operators.rel import small_side
    fixed = df.join(small_side(mapping.select(F.col("bad").alias("_bad"), F.col("good").alias("_good"))),
                    F.col(column) == F.col("_bad"), "left")
    return fixed.withColumn(column, F.coalesce("_good", column)).drop("_bad", "_good")

"""Joins, ranking and set operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.ordered import estimated_bytes, sort_columns
from tidewater.sources.durable import plain_rows, settled

SALTS = 64            # where the caller lists the hot keys


def small_side(df: DataFrame, max_bytes: int = 50 << 20) -> DataFrame:
    """Broadcast hint only while the optimizer's size estimate is below ``max_bytes``."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def _salt(df: DataFrame, spread: list[str] | None, salts: int | str) -> Column:
    """Part of a row among ``salts``, a number or a column's name; 0 where that is null."""
    parts = F.col(salts) if isinstance(salts, str) else F.lit(salts)
    return F.coalesce(F.pmod(F.xxhash64(*[F.col(c) for c in (spread or df.columns)]), parts), F.lit(0)).cast("int")


def attach(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner",
           spread: list[str] | None = None) -> DataFrame:
    """Join rows to a one-row-per-key table whose ``_rows`` column counts the key's rows.

    The table is written once, so its true size decides about broadcasting and the largest
    ``_rows`` about skew. Keys above ``spark.tidewater.plainRows`` rows are hot: they are salted on
    the row side, in as many parts as they hold that number, and replicated as often on the other.
    ``_rows`` is dropped from the result.
    """
    if not keys:
        raise ValueError("use a scalar subquery for a keyless aggregate")
    per_key = settled(per_key, "per_key")
    values = [c for c in per_key.columns if c not in (*keys, "_rows")]
    plain = max(plain_rows(rows.sparkSession), 1)
    if (per_key.agg(F.max("_rows")).first()[0] or 0) <= plain:
        return match(rows, per_key.drop("_rows"), keys, how)
    parts = F.ceil(F.col("_rows") / plain).cast("int")
    hot = settled(per_key.filter(F.col("_rows") > plain).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], parts.alias("_parts")), "hot")
    salted = (rows.join(small_side(hot), _same(keys, "_hot_"), "left")
              .select(*rows.columns, _salt(rows, spread, "_parts").alias("_salt")))
    copies = F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)
    spread_out = per_key.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *values,
                                F.explode(copies).alias("_key__salt"))
    return (salted.join(spread_out, _same([*keys, "_salt"], "_key_"), how)
            .select(*rows.columns, *values))


def _same(names: list[str], prefix: str) -> Column:
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).eqNullSafe(F.col(prefix + name))
    return cond


def match(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named keys where null matches null."""
    values = [c for c in table.columns if c not in keys]
    right = table.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    return rows.join(right, _same(keys, "_key_"), how).select(*rows.columns, *values)


def with_group_stats(df: DataFrame, keys: list[str], spread: list[str] | None = None,
                     **stats: Column) -> DataFrame:
    """Group aggregates beside every row: partial aggregation plus a hot-key-safe join back."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"),
                                    *[c.alias(n) for n, c in stats.items()])
    return attach(df, per_key, keys, spread=spread)


def salted_join(facts: DataFrame, dim: DataFrame, keys: list[str], hot: DataFrame | None = None,
                spread: list[str] | None = None, salts: int = SALTS, hot_rows: int | None = None,
                how: str = "inner") -> DataFrame:
    """Equi-join whose hot keys are spread over ``salts`` tasks; equal to the plain join.

    ``hot`` lists the hot keys; by default keys above ``hot_rows`` rows, ``spark.tidewater.plainRows``
    unless given, each in as many parts as it holds that number.
    Right and full joins are refused: copies of a dimension row without partner would appear as rows.
    """
    if how.replace("_", "") not in ("inner", "left", "leftouter", "leftsemi", "semi", "leftanti", "anti"):
        raise ValueError(f"salted_join cannot do {how}")
    if hot is None:
        limit = hot_rows or max(plain_rows(facts.sparkSession), 1)
        sizes = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
        hot = settled(sizes.select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_parts")), "hot")
    else:
        hot = hot.select(*keys).distinct().withColumn("_parts", F.lit(salts))
    hot = small_side(hot)
    left = facts.join(hot, keys, "left").withColumn("_salt", _salt(facts, spread, "_parts")).drop("_parts")
    right = (dim.join(hot, keys, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts"))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def top_k(df: DataFrame, keys: list[str], order: list[str], k: int, ties: str = "first",
          name: str = "rk") -> DataFrame:
    """Top ``k`` rows per key. ``ties="all"`` keeps every row of the k-th rank, ``"first"`` exactly k.

    The rank filter is pushed below the shuffle as a per-task group limit.
    """
    rank = {"first": F.row_number, "all": F.rank}[ties]()
    if keys:
        w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        return df.withColumn(name, rank.over(w)).filter(F.col(name) <= k)
    best = df.orderBy(*sort_columns(order)).limit(k)                # k rows
    if ties == "all":
        names = [o.lstrip("-") for o in order]
        cut = best.select(*names).distinct()
        best = df.join(F.broadcast(cut.withColumnsRenamed({n: f"_cut_{n}" for n in names})), _same(names, "_cut_"), "left_semi")
    return best.withColumn(name, rank.over(Window.partitionBy(F.lit(0)).orderBy(*sort_columns(order))))


def nth_distinct(df: DataFrame, keys: list[str], value: str, n: int, descending: bool = True) -> DataFrame:
    """The n-th distinct value per key, one row per key that has that many."""
    distinct = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    order = [("-" if descending else "") + value]
    return top_k(distinct, keys, order, n, "first", "_n").filter(F.col("_n") == n).drop("_n")


def best_rows(df: DataFrame, keys: list[str], value: str, highest: bool = True) -> DataFrame:
    """All rows holding the best value of their key: one aggregate and a semi join."""
    pick = F.max if highest else F.min
    best = df.groupBy(*keys).agg(pick(value).alias(value))
    return df.join(best, [*keys, value], "left_semi").select(*df.columns)


def present(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs in ``other``; its keys are made distinct before they are shuffled."""
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def absent(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def differences(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys present on one side only, or with a differing column; null-safe."""
    a = left.select(*keys, F.struct(*columns).alias("_l"), F.lit(True).alias("_in_l"))
    b = right.select(*keys, F.struct(*columns).alias("_r"), F.lit(True).alias("_in_r"))
    both = a.join(b, keys, "full_outer")
    status = (F.when(F.col("_in_l").isNull(), F.lit("right_only")).when(F.col("_in_r").isNull(), F.lit("left_only"))
              .when(~F.col("_l").eqNullSafe(F.col("_r")), F.lit("changed")))
    return (both.withColumn("status", status).filter(F.col("status").isNotNull())
            .select(*keys, "status", *[F.col(f"_l.{c}").alias(f"left_{c}") for c in columns],
                    *[F.col(f"_r.{c}").alias(f"right_{c}") for c in columns]))


LEVELS, FANOUT = 8, 8         # bucket sizes grow by FANOUT from level to level; the last one spans any date


def _bucket(c: Column, level: Column, days: int) -> Column:
    return F.floor(F.unix_date(c) / (days * F.pow(F.lit(FANOUT), level))).cast("long")


def _level(start: Column, end: Column, days: int) -> Column:
    """Finest level on which an interval touches few buckets."""
    out = F.lit(LEVELS - 1)
    for level in reversed(range(LEVELS - 1)):
        out = F.when(F.datediff(end, start) <= days * FANOUT ** (level + 1), F.lit(level)).otherwise(out)
    return out


def _levels_of(spans: DataFrame) -> list[int]:
    """Levels in use, at most LEVELS numbers."""
    return sorted(r[0] for r in spans.select("_level").distinct().collect()) or [0]


def _open(end: str) -> Column:
    return F.coalesce(F.col(end), F.lit("9999-12-31").cast("date"))


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], time: str, start: str, end: str,
                  bucket_days: int = 30, how: str = "inner", closed: bool = True) -> DataFrame:
    """Points with the intervals that contain their date, as an equi-join on (key, level, day bucket).

    ``time``, ``start``, ``end`` are dates; a null end is open, ``closed=False`` makes ends exclusive.
    Long intervals lie on levels of longer buckets, so none is listed more than FANOUT + 1 times; a
    point is listed once for each level in use, and no pair repeats. ``how`` is inner or left; a left
    join puts all intervals on the highest level in use, so that an unmatched point appears once.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"interval_join cannot do {how}")
    spans = intervals.withColumn("_level", _level(F.col(start), _open(end), bucket_days))
    levels = _levels_of(spans)
    if how == "left":
        levels = levels[-1:]
        spans = spans.withColumn("_level", F.lit(levels[0]))
    right = spans.withColumn("_bucket", F.explode(F.sequence(_bucket(F.col(start), F.col("_level"), bucket_days), _bucket(_open(end), F.col("_level"), bucket_days))))
    left = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels)))).withColumn("_bucket", _bucket(F.col(time), F.col("_level"), bucket_days))
    day, last = F.col(f"p.{time}"), F.coalesce(F.col(f"i.{end}"), F.lit("9999-12-31").cast("date"))
    cond = (day >= F.col(f"i.{start}")) & ((day <= last) if closed else (day < last))
    for k in [*keys, "_level", "_bucket"]:
        cond = cond & (F.col(f"p.{k}") == F.col(f"i.{k}"))
    extra = [c for c in intervals.columns if c not in keys]
    return left.alias("p").join(right.alias("i"), cond, how).select(
        *[F.col(f"p.{c}") for c in points.columns], *[F.col(f"i.{c}") for c in extra])


def overlapping_pairs(df: DataFrame, keys: list[str], row_id: str, start: str, end: str,
                      bucket_days: int = 30) -> DataFrame:
    """Unordered pairs of intervals of one key that overlap (dates, both ends inclusive, a null end is open).

    A pair meets on the coarser of its two levels, and there only in the bucket where the later
    interval starts, so just the rows that share a bucket meet and every pair appears once.
    """
    spans = df.select(*keys, row_id, start, _open(end).alias(end)).withColumn("_level", _level(F.col(start), F.col(end), bucket_days))
    at = spans.withColumn("_at", F.explode(F.filter(F.array(*map(F.lit, _levels_of(spans))), lambda x: x >= F.col("_level"))))
    parts = at.withColumn("_bucket", F.explode(F.sequence(*[_bucket(F.col(c), F.col("_at"), bucket_days) for c in (start, end)])))
    a, b = parts.alias("a"), parts.alias("b")
    cond = F.col(f"a.{row_id}") < F.col(f"b.{row_id}")
    for k in [*keys, "_at", "_bucket"]:
        cond = cond & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    later = F.greatest(F.col(f"a.{start}"), F.col(f"b.{start}"))
    cond = (cond & (F.col("a._at") == F.greatest("a._level", "b._level"))
            & (F.col(f"a.{start}") <= F.col(f"b.{end}")) & (F.col(f"b.{start}") <= F.col(f"a.{end}"))
            & (_bucket(later, F.col("a._at"), bucket_days) == F.col("a._bucket")))
    return a.join(b, cond).select(*[F.col(f"a.{k}") for k in keys], F.col(f"a.{row_id}").alias("left_id"),
                                  F.col(f"b.{row_id}").alias("right_id"))

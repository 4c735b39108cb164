"""Ordered computations that do not depend on one task holding one key.

A window with ``partitionBy(key)`` puts a key's rows on one task. That is the cheapest plan while
every key is small, so the operators count the rows per key first (a scan of the key columns with
map-side combining). Beyond ``spark.tidewater.plainRows`` rows in one key they range-partition
the rows by (key, order) instead: a large key, or no key at all, is cut into slices. Inside a slice
an ordinary window runs; what crosses a slice border is carried over by a table with at most two
rows per slice, which is therefore safe to broadcast. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewater.sources.durable import discard, durable, plain_rows, settled

SLICE = "_slice"
SLICE_BYTES = 64 << 20
ROW_BYTES = 32                # that a sort holds beside a row's values
UNKNOWN_BYTES = 1 << 60       # Spark's estimate of a size it does not know lies above


def sort_columns(order: list[str], reverse: bool = False) -> list[Column]:
    """Sort columns from names; a leading ``-`` means descending."""
    out = []
    for name in order:
        down = name.startswith("-") != reverse
        col = F.col(name.lstrip("-"))
        out.append(col.desc_nulls_last() if down else col.asc_nulls_first())
    return out


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int | None:
    """Size of the tables that a query reads, None when one is unknown; bounds estimates that multiply in joins."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(sizes) if max(sizes, default=0) < UNKNOWN_BYTES else None


def parts_of(df: DataFrame, part_bytes: int, beside: int = 0) -> int:
    """So many parts of ``part_bytes`` as the rows need; counts ``df``.

    Compressed files say little about rows in memory, and a schema little about long texts, so the larger of the two
    counts: stored bytes, or rows times the width of a row and the bytes ``beside`` it, ROW_BYTES where rows are sorted.
    """
    known, width = input_bytes(df), int(df._jdf.schema().defaultSize()) + beside
    stored = min(estimated_bytes(df), known) if known is not None else 0
    return int(max(stored, df.count() * width) // part_bytes)


def slice_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Range-partition by keys and order and record the slice number of every row."""
    parts = max(4, parts_of(df, SLICE_BYTES, ROW_BYTES))
    ranged = df.repartitionByRange(parts, *[F.col(k) for k in keys], *sort_columns(order))
    return durable(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def keys_are_small(df: DataFrame, keys: list[str]) -> bool:
    """True when no key has more rows than one task may handle; one number reaches the driver."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest = counts.agg(F.max("_n")).first()[0] or 0
    return largest <= plain_rows(df.sparkSession)


def _fold(kind: str, col: Column) -> Column:
    return {
        "sum": F.sum, "count": F.count, "min": F.min, "max": F.max,
        "last": lambda c: F.last(c, ignorenulls=True),
    }[kind](col)


def _join(kind: str, local: Column, carried: Column) -> Column:
    if kind in ("sum", "count"):
        return F.coalesce(local + carried, local, carried)
    if kind == "min":
        return F.least(local, carried)
    if kind == "max":
        return F.greatest(local, carried)
    return F.coalesce(local, carried)


def _same(names: list[str], prefix: str) -> Column:
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).eqNullSafe(F.col(prefix + name))
    return cond


def _prefixed(df: DataFrame, names: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({n: prefix + n for n in names})


def _keys_window(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*[F.col(k) for k in keys]) if keys else Window.partitionBy(F.lit(0))


def scan(df: DataFrame, keys: list[str], order: list[str],
         **running: tuple[str, Column | str]) -> DataFrame:
    """Running aggregates from the first row of each key to the current row.

    ``running`` maps an output name to (kind, column) with kind in sum, count, min, max, last.
    ``order`` should be total within a key; ``keys=[]`` gives one global sequence.
    """
    columns = {n: (k, F.col(c) if isinstance(c, str) else c) for n, (k, c) in running.items()}
    df = settled(df)
    if keys_are_small(df, keys):
        w = _keys_window(keys).orderBy(*sort_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
        return df.select(*df.columns, *[_fold(k, c).over(w).alias(n) for n, (k, c) in columns.items()])
    inputs = {f"_in_{n}": c for n, (_, c) in columns.items()}
    rows = slice_rows(df.withColumns(inputs), keys, order)
    here = (Window.partitionBy(SLICE, *keys).orderBy(*sort_columns(order))
            .rowsBetween(Window.unboundedPreceding, 0))
    local = rows.withColumns({f"_run_{n}": _fold(k, F.col(f"_in_{n}")).over(here)
                              for n, (k, _) in columns.items()})
    if any(k == "last" for k, _ in columns.values()):
        # the running value on a slice's last row is the slice total; positions mark that row
        ranked = local.withColumn("_pos", F.count(F.lit(1)).over(here))
        totals = ranked.groupBy(*keys, SLICE).agg(
            *[F.max_by(f"_run_{n}", "_pos").alias(f"_tot_{n}") for n in columns])
    else:
        totals = rows.groupBy(*keys, SLICE).agg(
            *[_fold(k, F.col(f"_in_{n}")).alias(f"_tot_{n}") for n, (k, _) in columns.items()])
    spans = totals.withColumn("_pieces", F.count(F.lit(1)).over(_keys_window(keys)))
    before = (_keys_window(keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1))
    again = {"count": "sum"}
    carried = (spans.filter("_pieces > 1")
               .select(*keys, SLICE, *[_fold(again.get(k, k), F.col(f"_tot_{n}")).over(before)
                                       .alias(f"_car_{n}") for n, (k, _) in columns.items()]))
    carried = F.broadcast(_prefixed(carried, [*keys, SLICE], "_at_"))  # at most two rows per slice
    joined = local.join(carried, _same([*keys, SLICE], "_at_"), "left")
    return joined.select(*df.columns, *[
        _join(k, F.col(f"_run_{n}"), F.col(f"_car_{n}")).alias(n) for n, (k, _) in columns.items()])


def reach_back(df: DataFrame, keys: list[str], order: list[str], rows_back: int,
               **exprs: Callable[[WindowSpec], Column]) -> DataFrame:
    """Window expressions that look at most ``rows_back`` rows back within a key.

    Each expression receives the ordered window, for example
    ``prev=lambda w: F.lag("v").over(w)`` or ``avg3=lambda w: F.avg("v").over(w.rowsBetween(-2, 0))``.
    Look-ahead is the same with the order reversed. Rows near a slice border are recomputed
    from the border rows alone (at most 4 x rows_back per slice).
    """
    df = settled(df)
    if keys_are_small(df, keys):
        w = _keys_window(keys).orderBy(*sort_columns(order))
        return df.select(*df.columns, *[e(w).alias(n) for n, e in exprs.items()])
    rows = slice_rows(df, keys, order)
    here = Window.partitionBy(SLICE, *keys).orderBy(*sort_columns(order))
    spans = (rows.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_size"))
             .withColumn("_pieces", F.count(F.lit(1)).over(_keys_window(keys)))
             .filter("_pieces > 1").select(*keys, SLICE, "_size"))
    spans = F.broadcast(_prefixed(spans, [*keys, SLICE], "_at_"))  # at most two rows per slice
    numbered = rows.withColumn("_pos", F.row_number().over(here))
    numbered = numbered.withColumns({f"_out_{n}": e(here) for n, e in exprs.items()})
    marked = (numbered.join(spans, _same([*keys, SLICE], "_at_"), "left")
              .select(*numbered.columns, "_size"))
    head = F.coalesce(F.col("_size").isNotNull() & (F.col("_pos") <= rows_back), F.lit(False))
    tail = F.coalesce(F.col("_pos") > F.col("_size") - rows_back, F.lit(False))
    inner = marked.filter(~head).select(*df.columns, *[F.col(f"_out_{n}").alias(n) for n in exprs])
    across = _keys_window(keys).orderBy(SLICE, *sort_columns(order))
    border = (marked.filter(head | tail).withColumns({n: e(across) for n, e in exprs.items()})
              .filter(F.col("_pos") <= rows_back).select(*df.columns, *exprs))
    return inner.unionByName(border)


def as_of(facts: DataFrame, changes: DataFrame, keys: list[str], time: str,
          values: list[str], tie: list[str] | None = None) -> DataFrame:
    """Each fact row with the latest change at or before its time (``values`` null when none).

    Both inputs name the time column ``time``. One merged ordered pass, no range join.
    """
    changes = settled(changes, "changes")      # then the merged input is two scans and needs no copy of the facts
    marks = changes.select(*keys, time, F.struct(*values).alias("_change"), F.lit(0).alias("_side"))
    merged = facts.withColumn("_side", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    out = scan(merged, keys, [time, "_side", *(tie or [])], _now=("last", "_change"))
    return out.filter("_side = 1").select(*facts.columns, *[F.col(f"_now.{v}").alias(v) for v in values])


def trailing_sums(df: DataFrame, keys: list[str], time: str, width: int,
                  **measures: Column) -> DataFrame:
    """Sums over the trailing ``(t - width, t]`` range per key, one row per (key, time).

    ``time`` is an integer column. Rows are first summed to (key, time); each sum enters at its
    time and leaves ``width`` later, so a running total of entries and exits is the range sum.
    """
    grain = df.groupBy(*keys, time).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    enter = grain.withColumn("_real", F.lit(1))
    leave = grain.select(*keys, (F.col(time) + width).alias(time),
                         *[(-F.col(n)).alias(n) for n in measures], F.lit(0).alias("_real"))
    steps = (enter.unionByName(leave).groupBy(*keys, time)
             .agg(*[F.sum(n).alias(n) for n in measures], F.max("_real").alias("_real")))
    totals = scan(steps, keys, [time], **{f"_sum_{n}": ("sum", n) for n in measures})
    return totals.filter("_real = 1").select(
        *keys, time, *[F.col(f"_sum_{n}").alias(n) for n in measures])


def rank_table(df: DataFrame, keys: list[str], value: str, descending: bool = False) -> DataFrame:
    """Rank statistics per distinct (key, value): one row each, with ``rows`` holding its row count.

    Columns: rows, total, rank, dense_rank, percent_rank, cume_dist.
    """
    from tidewater.operators.rel import attach

    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("rows"))
    counts = settled(counts, "counts")
    order = [("-" if descending else "") + value]
    run = scan(counts, keys, order, _cum=("sum", "rows"), dense_rank=("count", F.lit(1)))
    if keys:
        sizes = counts.groupBy(*keys).agg(F.sum("rows").alias("total"), F.count(F.lit(1)).alias("_rows"))
        run = attach(run, sizes, keys)
    else:
        run = run.withColumn("total", counts.agg(F.sum("rows")).scalar())
    rank = (F.col("_cum") - F.col("rows") + 1)
    return (run.withColumn("rank", rank)
            .withColumn("percent_rank", F.when(F.col("total") > 1, (F.col("rank") - 1) / (F.col("total") - 1))
                        .otherwise(F.lit(0.0)))
            .withColumn("cume_dist", F.col("_cum") / F.col("total")).drop("_cum"))


def row_numbers(df: DataFrame, keys: list[str], order: list[str], name: str = "rn") -> DataFrame:
    """Row number within each key for a total order; works for one global sequence too."""
    return scan(df, keys, order, **{name: ("count", F.lit(1))})


def ntile(df: DataFrame, keys: list[str], order: list[str], tiles: int, name: str = "tile") -> DataFrame:
    """``NTILE`` over sliced row numbers: the first ``total % tiles`` tiles get one row more."""
    from tidewater.operators.rel import attach

    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    if keys:
        numbered = attach(row_numbers(df, keys, order, "_rn"), sizes.withColumn("_total", F.col("_rows")), keys)
        total = F.col("_total")
    else:
        numbered, total = row_numbers(df, keys, order, "_rn"), sizes.scalar()
    numbered = numbered.withColumn("_size", total.cast("long"))
    base, extra = F.floor(F.col("_size") / tiles), F.col("_size") % tiles
    fat = extra * (base + 1)
    tile = F.when(F.col("_rn") <= fat, F.floor((F.col("_rn") - 1) / (base + 1)) + 1).otherwise(
        extra + F.floor((F.col("_rn") - fat - 1) / F.greatest(base, F.lit(1))) + 1)
    return numbered.withColumn(name, tile.cast("long")).select(*df.columns, name)


def reset_totals(df: DataFrame, keys: list[str], order: list[str], value: str, threshold: float, segment: str = "segment", total: str = "total") -> DataFrame:
    """Running total that starts anew after every row at which it reaches ``threshold``.

    Values are decimals or integers (sums must be exact), not negative and not null; ``order`` is total within a key.
    Where a segment ends depends on where it began, but the end follows from the running sum alone: it is the first
    row whose running sum reaches the sum before the segment plus the threshold. All rows look that row up at once, in
    one pass ordered by running sum. The chain of segments from each key's first row is then followed by pointer
    doubling, so the number of rounds is the logarithm of the longest chain, and no key is walked by one task.
    """
    checked = F.when(F.col(value) >= 0, F.col(value)).otherwise(F.raise_error(F.lit(f"{value} is negative or null")).cast(df.schema[value].dataType))
    rows = durable(scan(row_numbers(df.withColumn("_value", checked), keys, order), keys, order, _upto=("sum", "_value")), "sums")
    before = F.col("_upto") - F.col("_value")
    at = rows.select(*keys, F.col("_upto").alias("_x"), F.lit(0).alias("_kind"), F.col("rn").alias("_end"), F.lit(None).cast("long").alias("_from"))
    asked = rows.select(*keys, (before + F.lit(threshold).cast(rows.schema["_upto"].dataType)).alias("_x"), F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_end"), F.col("rn").alias("_from"))
    both = scan(at.unionByName(asked), keys, ["-_x", "_kind"], _first=("min", "_end"))
    jump = durable(both.filter("_kind = 1 and _first is not null").select(*keys, F.col("_from"), (F.col("_first") + 1).alias("_to")), "jumps")
    reached = durable(rows.filter("rn = 1").select(*keys, F.col("rn").alias("_at")), "reached")
    while not jump.isEmpty():
        more = reached.join(_prefixed(jump, keys, "_key_"), _same(keys, "_key_") & (F.col("_at") == F.col("_from"))).select(*keys, F.col("_to").alias("_at"))
        grown = durable(reached.unionByName(more).distinct(), "reached")
        second = _prefixed(jump.withColumnsRenamed({"_from": "_mid", "_to": "_then"}), keys, "_key_")
        longer = durable(jump.join(second, _same(keys, "_key_") & (F.col("_to") == F.col("_mid"))).select(*keys, "_from", F.col("_then").alias("_to")), "jumps")
        discard(reached, jump)
        reached, jump = grown, longer
    starts = _prefixed(reached, keys, "_key_")
    marked = rows.join(starts, _same(keys, "_key_") & (F.col("rn") == F.col("_at")), "left").withColumn("_new", F.col("_at").isNotNull())
    marked = marked.select(*rows.columns, F.col("_new").cast("int").alias("_new"), F.when(F.col("_new"), before).alias("_base"))
    out = scan(marked, keys, order, **{segment: ("sum", "_new"), "_since": ("max", "_base")})
    return out.withColumn(total, F.col("_upto") - F.col("_since")).select(*df.columns, segment, total)

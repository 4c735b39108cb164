"""Sales, basket and stock operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.columns import growth
from tidewater.operators.ordered import reach_back, scan
from tidewater.operators.pairs import in_rounds, paired
from tidewater.operators.rel import attach
from tidewater.sources.durable import discard, durable, freed_shuffles

PAIR_ROWS = 1 << 20           # pairs that one task makes or counts


def pair_counts(df: DataFrame, group: str, item: str, min_support: int = 1, big: int = 1000) -> DataFrame:
    """Unordered item pairs that share at least ``min_support`` groups: item_a, item_b, support.

    Items below the support are removed first. Groups of up to ``big`` items are paired
    directly. Larger groups never list their pairs while ``min_support`` exceeds their number:
    a frequent pair then occurs in some small group too, so it is only looked up in them. With a
    lower support their pairs are results themselves and are made in blocks over many tasks.
    More pairs than one round has are made and counted in rounds (``operators/pairs.py``).
    """
    with freed_shuffles(df.sparkSession):
        rows = durable(df.select(group, item).distinct(), "items")
    return counted_pairs(rows, group, item, min_support, big, last=True)


def counted_pairs(rows: DataFrame, group: str, item: str, min_support: int, big: int = 1000, last: bool = False) -> DataFrame:
    """``pair_counts`` of stored rows that are distinct; ``last``: nothing reads them after."""
    spark, kept = rows.sparkSession, rows
    with freed_shuffles(spark):
        if min_support > 1:
            enough = rows.groupBy(item).agg(F.count("*").alias("_rows")).filter(F.col("_rows") >= min_support)
            rows = attach(rows, enough, [item], spread=[group])
        sizes = rows.groupBy(group).agg(F.count("*").alias("_rows"))
        sized = durable(attach(rows, sizes.withColumn("_size", F.col("_rows")), [group], spread=[item]), "baskets")
        discard(kept if last else None)
        of_rows = lambda which: F.coalesce(F.sum(F.when(which, (F.col("_size") - 1) / 2)), F.lit(0))        # noqa: E731
        made, more, items, largest, n = sized.agg(of_rows(F.col("_size") <= big), of_rows(F.col("_size") > big), F.approx_count_distinct(item), F.max("_size"), F.count("*")).first()
        large_groups = sized.filter(F.col("_size") > big).select(group).distinct().count()
    looked_up = min_support > large_groups > 0
    fewest = min_support - large_groups if looked_up else min_support
    known = None
    if in_rounds(int(made if looked_up else made + more), items):
        meet = sized.filter(F.col("_size") <= big) if looked_up else sized
        with freed_shuffles(spark):
            held = meet.groupBy(item).agg(F.count("*").alias("_rows")).withColumn("_held", F.col("_rows"))
            meet = attach(meet, held, [item], spread=[group])
            known = paired(meet, group, item, int(made if looked_up else made + more), n, {"support": F.count("*")}, F.col("support") >= fewest, big=big, largest=big if looked_up else largest)
    if known is not None and not looked_up:
        discard(sized)
        return known
    small = sized.filter(F.col("_size") <= big).select(group, item)
    # Baskets and then pairs are dealt over as many tasks as there are pairs for, unless few items make pairs repeat.
    parts = int(made // PAIR_ROWS)
    many = parts > 1 and items * items / 2 > made / 8
    small = small.repartition(parts, group) if many else small
    pairs = (small.withColumnRenamed(item, "item_a").join(small.withColumnRenamed(item, "item_b"), group)
             .filter("item_a < item_b"))
    pairs = pairs.select("item_a", "item_b").repartition(parts, "item_a", "item_b") if many else pairs
    if large_groups == 0:
        return pairs.groupBy("item_a", "item_b").agg(F.count("*").alias("support")).filter(F.col("support") >= min_support)
    large = sized.filter(F.col("_size") > big)
    if looked_up:
        if known is None:
            known = pairs.groupBy("item_a", "item_b").agg(F.count("*").alias("support")).filter(F.col("support") >= fewest)
        known = known.withColumnRenamed("support", "_cold")
        held = large.select(group, item)
        extra = (known.join(held.withColumnRenamed(item, "item_a"), "item_a")
                 .join(held.withColumnRenamed(item, "item_b"), [group, "item_b"])
                 .groupBy("item_a", "item_b").agg(F.count("*").alias("_hot")))
        return (known.join(extra, ["item_a", "item_b"], "left")
                .select("item_a", "item_b", (F.col("_cold") + F.coalesce("_hot", F.lit(0))).alias("support"))
                .filter(F.col("support") >= min_support))
    blocks = F.ceil(F.col("_size") / big).cast("int")
    placed = large.withColumn("_blocks", blocks).withColumn("_b", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
    left = placed.select(group, F.col(item).alias("_x"), F.col("_b").alias("_i"), F.explode(F.sequence(F.col("_b"), F.col("_blocks") - 1)).alias("_j"))
    right = placed.select(group, F.col(item).alias("_y"), F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_i"), F.col("_b").alias("_j"))
    met = left.join(right, [group, "_i", "_j"]).filter((F.col("_i") < F.col("_j")) | (F.col("_x") < F.col("_y")))
    listed = met.select(F.least("_x", "_y").alias("item_a"), F.greatest("_x", "_y").alias("item_b"))
    return (pairs.select("item_a", "item_b").unionByName(listed).groupBy("item_a", "item_b")
            .agg(F.count("*").alias("support")).filter(F.col("support") >= min_support))


def next_items(df: DataFrame, keys: list[str], order: list[str], item: str) -> DataFrame:
    """How often one item directly follows another."""
    back = [o[1:] if o.startswith("-") else f"-{o}" for o in order]
    rows = reach_back(df, keys, back, 1, _next=lambda w: F.lag(item).over(w)).filter(F.col("_next").isNotNull())
    return rows.groupBy(item, F.col("_next").alias("next_item")).agg(F.count("*").alias("n"))


def score(value: Column, edges: list[float], ascending: bool = True) -> Column:
    """1..n+1 by ascending edges; reversed when a lower value is better."""
    points = F.lit(1)
    for e in edges:
        points = points + F.when(value > e, 1).otherwise(0)
    return points if ascending else len(edges) + 2 - points


def rfm(df: DataFrame, customer: str, time: str, amount: str, as_of: Column, recency: list[float],
        frequency: list[float], money: list[float], segments: list[tuple[int, str]], other: str) -> DataFrame:
    """Recency, frequency and money scores (1–5), their sum and a segment label."""
    base = df.groupBy(customer).agg(F.datediff(as_of, F.to_date(F.max(time))).alias("recency"),
                                    F.count("*").alias("frequency"), F.sum(amount).alias("monetary"))
    scored = base.withColumns({"r": score(F.col("recency"), recency, False), "f": score(F.col("frequency"), frequency),
                               "m": score(F.col("monetary"), money)})
    total = F.col("r") + F.col("f") + F.col("m")
    label = None
    for least, name in segments:
        label = F.when(total >= least, name) if label is None else label.when(total >= least, name)
    return scored.withColumn("rfm", total).withColumn("segment", label.otherwise(other))


def lifetime_value(df: DataFrame, customer: str, time: str, amount: str) -> DataFrame:
    """Total, orders, mean order, tenure in days and value per active month."""
    days = F.datediff(F.max(F.to_date(time)), F.min(F.to_date(time)))
    return (df.groupBy(customer).agg(F.sum(amount).alias("total"), F.count("*").alias("orders"),
                                     F.avg(amount).alias("avg_order"), days.alias("tenure_days"))
            .withColumn("monthly_value", F.col("total") / F.greatest(F.col("tenure_days") / 30.0, F.lit(1.0))))


def period_growth(df: DataFrame, period: Column, measure: Column, keys: list[str] | None = None, back: int = 1) -> DataFrame:
    """Sum per period and its change against ``back`` periods earlier; aggregated before ordering."""
    keys = keys or []
    sums = df.groupBy(*keys, period.alias("period")).agg(F.sum(measure).alias("value"))
    w = Window.partitionBy(*keys).orderBy("period") if keys else Window.partitionBy(F.lit(0)).orderBy("period")
    before = F.lag("value", back).over(w)
    return sums.withColumn("previous", before).withColumn("growth_pct", growth(F.col("value"), F.col("previous")))


def first_is_new(df: DataFrame, customer: str, time: str, period: Column) -> DataFrame:
    """Customers per period split into new (first period) and returning."""
    seen = df.select(customer, period.alias("period")).distinct()
    first = seen.groupBy(customer).agg(F.min("period").alias("_first"))
    both = seen.join(first, customer)
    return both.groupBy("period").agg(F.count_if(F.col("period") == F.col("_first")).alias("new"),
                                      F.count_if(F.col("period") > F.col("_first")).alias("returning"))


def max_concurrency(df: DataFrame, keys: list[str], start: str, end: str, closed: bool = False) -> DataFrame:
    """Highest number of open intervals per key.

    Half-open intervals count an end before a start at the same time; ``closed`` the other way.
    """
    open_first = 0 if closed else 1
    steps = (df.select(*keys, F.col(start).alias("_t"), F.lit(1).alias("_step"), F.lit(open_first).alias("_o"))
             .unionByName(df.select(*keys, F.col(end).alias("_t"), F.lit(-1).alias("_step"), F.lit(1 - open_first).alias("_o")))
             .groupBy(*keys, "_t", "_o").agg(F.sum("_step").alias("_step")))
    return scan(steps, keys, ["_t", "_o"], _open=("sum", "_step")).groupBy(*keys).agg(F.max("_open").alias("peak"))


def fill_in_order(df: DataFrame, keys: list[str], order: list[str], size: str, capacity: Column | float) -> DataFrame:
    """Rows that fit while the running total of ``size`` stays within the capacity."""
    limit = capacity if isinstance(capacity, Column) else F.lit(capacity)
    return scan(df, keys, order, used=("sum", size)).filter(F.col("used") <= limit)

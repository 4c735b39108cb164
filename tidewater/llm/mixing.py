"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share ``share`` times all
words. No source gives more than ``repeats`` times its words; what it cannot give goes to the others by
weight until none is above, that is target = min(repeats * size, level * weight).

Curriculum: each class of sources has a weight schedule over training time 0..1, straight between
knots. Its integral, scaled to the target, is the cumulative demand D(t). Documents of a source stand in
a fixed random order; the words before a document, c, put it at training time t with D(t) = c. A second
pass over the source follows when the target exceeds its words. Range-sorting all uses by t gives the training order.

Running sums are taken inside slices of a source (by hash, ``SLICE_ROWS`` rows on average) and slice
totals are summed per source, so a source with a third of all rows is spread over many tasks.

Nulls, empties, ties: null texts have no words; a null source is a source; null ids are ordered
by their text. Documents without words take nothing. Rows that repeat an id are separate documents, in
an order fixed by their size. Reruns agree. Empty tables give empty results, tables without words targets
of 0. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.shared import SPACE_CLASS, carried, parts_for, pick, restored
from tidewater.operators import ordered
from tidewater.sources.durable import durable

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2
SLICE_ROWS = 1 << 16
LEAST_SLICES = 32
#: Knots (time, weight) by weight class: broad sources fade, rare ones come late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 0.75), (1.0, 2.0)))


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, rf"{SPACE_CLASS}+"))).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, kind, source_size, target) of every source in ``sizes`` (source, size); kind is its place in ``weights``."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("unnamed", F.col("source").isNull().cast("int"))
    ranked = ordered.row_numbers(totals, [], ["unnamed", "source"], "rank")
    kind = ((F.col("rank") - 1) % len(weights)).cast("int")
    sources = durable(ranked.select("source", "source_size", kind.alias("kind"), F.element_at(F.array(*map(F.lit, weights)), kind + 1).alias("weight")), "sources")
    cap, level = F.col("source_size") * repeats, 0.0
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        total, given, open_weight = sources.agg(F.sum("source_size"), F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not total or not open_weight:
            break
        new = (share * total - given) / open_weight
        if new <= level:
            break
        level = new
    return sources.select("source", "kind", "source_size", F.least(cap.cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def training_time(share: Column, kind: Column, schedules=SCHEDULES) -> Column:
    """Time at which the integral of a source's schedule reaches ``share`` (0..1) of its whole."""
    out = None
    for k, knots in enumerate(schedules):
        areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
        whole, before, own = sum(areas), 0.0, F.lit(knots[-1][0])
        pieces = []
        for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas, strict=False):
            q, slope = share * whole - before, (w1 - w0) / (t1 - t0)
            x = q / w0 if slope == 0 else (F.sqrt(F.greatest(w0 * w0 + 2 * slope * q, F.lit(0.0))) - w0) / slope
            before += area
            pieces.append((before / whole, t0 + x))
        for end, time in reversed(pieces):
            own = F.when(share < end, time).otherwise(own)
        out = F.when(kind == k, own) if out is None else out.when(kind == k, own)
    return out


def shares(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS,
        share: float = SHARE, repeats: int = REPEATS, schedules=SCHEDULES) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, position, order_key, kind, c), one row per row of ``docs``.

    ``taken`` counts the words the mix takes of a document over all passes; ``position`` is the training
    time of its first pass, null when nothing is taken.
    """
    base = pick(docs, doc_id=doc_id, text=text, source=source)
    order = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce("text", F.lit(""))))), 1, 8), 16, 10).cast("long")
    sizes = durable(base.select("doc_id", "source", word_count(F.col("text")).alias("size"), order.alias("order_key")), "sizes")
    slices = max(LEAST_SLICES, parts_for(sizes.count(), SLICE_ROWS))
    sizes = sizes.withColumn("slice", F.shiftright(F.col("order_key") * slices, 32))
    by_slice = sizes.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = by_slice.select(F.col("source").alias("s"), F.col("slice").alias("sl"), F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.sum("size").over(Window.partitionBy("source", "slice").orderBy("order_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    running = sizes.withColumn("inside", inside).join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("sl")))
    goals = targets(sizes, weights, share, repeats).withColumnRenamed("source", "g")
    # One row per source; a shuffled join is split where a source is large.
    whole = running.join(goals, F.col("source").eqNullSafe(F.col("g")))
    c, goal = F.col("start") + F.col("inside"), F.round("target").cast("long")
    taken = sum((F.least(F.greatest(goal - c - p * F.col("source_size"), F.lit(0)), F.col("size")) for p in range(repeats)), F.lit(0))
    time = F.when(F.col("taken") > 0, training_time(c / F.col("target"), F.col("kind"), schedules))
    return whole.withColumn("taken", taken.cast("long")).select("doc_id", "source", "size", "source_size", "target", "taken", time.alias("position"), "order_key",
                                                                 "kind", c.alias("c"))


def uses(mixed: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """Every use of a document in ``mixed``, one row each, with its training time ``at``, ``pass`` and ``words``."""
    each = mixed.filter("taken > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.expr("(taken - 1) div size"))))
    words = F.least(F.col("size"), F.col("taken") - F.col("pass") * F.col("size"))
    at = training_time((F.col("c") + F.col("pass") * F.col("source_size")) / F.col("target"), F.col("kind"), schedules)
    return each.withColumn("words", words).withColumn("at", at)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS,
        share: float = SHARE, repeats: int = REPEATS, schedules=SCHEDULES) -> DataFrame:
    """``shares`` with ``start``: the words that the whole training order has before the document's first use, else null.

    All uses are range-sorted by training time; running sums are taken inside the ranges and carried over.
    """
    mixed = durable(shares(docs, doc_id, text, source, weights, share, repeats, schedules).withColumn("row", F.monotonically_increasing_id()), "mixed")
    order = ["at", "doc_id", "pass", "size", "row"]
    placed = ordered.slice_rows(uses(mixed, schedules).select(*order, "words"), [], order)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(ordered.SLICE).agg(F.sum("words").alias("whole"))
    ranges = ranges.select(F.col(ordered.SLICE).alias("range"), F.coalesce(F.sum("whole").over(before.orderBy(ordered.SLICE)), F.lit(0)).alias("earlier"))     # one row per range
    inside = F.coalesce(F.sum("words").over(before.partitionBy(ordered.SLICE).orderBy(*order)), F.lit(0))
    begun = placed.withColumn("inside", inside).filter("pass = 0").join(F.broadcast(ranges), F.col(ordered.SLICE) == F.col("range"))
    begun = begun.select(F.col("row").alias("used"), (F.col("earlier") + F.col("inside")).alias("start"))
    return mixed.join(begun, F.col("row") == F.col("used"), "left").drop("row", "used")


def training_order(docs: DataFrame, schedules=SCHEDULES, **options) -> DataFrame:
    """(position, doc_id, pass, words): every use of a document, range-sorted by training time."""
    every = uses(shares(docs, schedules=schedules, **options), schedules)
    return every.select(F.col("at").alias("position"), "doc_id", "pass", "words").orderBy("position", "doc_id", "pass")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (all columns), each as often as the mix begins it: never, once or again."""
    uses = shares(docs).groupBy(F.col("doc_id").alias("used")).agg(F.max(F.when(F.col("taken") > 0, F.expr("(taken - 1) div size + 1")).otherwise(0)).cast("int").alias("uses")).filter("uses > 0")
    both = carried(docs, doc_id="doc_id").join(uses, F.col("doc_id").eqNullSafe(F.col("used")))
    return restored(both.withColumn("_use", F.explode(F.sequence(F.lit(1), F.col("uses")))), docs)

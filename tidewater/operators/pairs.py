"""Pairs of items that meet in groups, made and added up in rounds.

All pairs at once are many times the rows they are made of, and Spark keeps them on disk between making and adding them
up. A round makes the pairs of some items only, adds them up and keeps what passes; its shuffle files are deleted before
the next one. Every pair belongs to the rarer of its two items and travels in a list beside it, so a task that adds up
an item's pairs meets few rows, and an item held by all owns no long lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.sources.durable import discard, durable, durable_rounds, freed_shuffles

ROUND_PAIRS = 1 << 26         # pairs of a round, or twice the rows if these are more
TASK_PAIRS = 1 << 20          # pairs that one task adds up


def in_rounds(made: int, items: int) -> bool:
    """True for more pairs than a round has, unless so few items make them that a task adds up most of what it makes."""
    return made > ROUND_PAIRS and items * items > 8 * TASK_PAIRS


def paired(rows: DataFrame, group: str, item: str, made: int, count: int, totals: dict[str, Column], keep: Column,
           values: tuple[str, ...] = (), big: int = 1000, largest: int = 0) -> DataFrame:
    """(item_a, item_b, totals) of the pairs that pass ``keep``, item_a < item_b; written.

    ``rows`` has every (group, item) once, ``_held``, the rows of the item, and ``_size``, those of the group, and makes
    ``made`` pairs out of ``count`` rows. ``totals`` are aggregates of ``_x_`` and ``_y_`` before a name in ``values``, for
    either item of a pair in any order. Groups of more than ``big`` items meet in blocks of about that many; ``largest`` is
    the size of the largest group. Null groups and items are left out.
    """
    entry = F.struct("_held", F.col(item).alias("_i"), *values)
    rows = rows.filter(F.col(group).isNotNull() & F.col(item).isNotNull())
    rounds = max(-(-made // max(ROUND_PAIRS, 2 * count)), 1)
    parts = max(made // rounds // TASK_PAIRS, 1)
    with freed_shuffles(rows.sparkSession):
        lists = durable(rows.filter(F.col("_size") <= big).groupBy(group).agg(F.sort_array(F.collect_list(entry)).alias("_l"))
                        .select(F.col("_l._i").alias("_items"), *[F.col(f"_l.{v}").alias(v) for v in values]), "lists")
        hot, large, blocks = largest > big, None, None
        if hot:
            cut = F.ceil(F.col("_size") / big).cast("int")
            large = rows.filter(F.col("_size") > big).withColumn("_blocks", cut).withColumn("_b", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
            large = durable(large, "large")
            blocks = durable(large.groupBy(group, "_b").agg(F.collect_list(entry).alias("_l")), "blocks")

        def owned(k: int) -> DataFrame:
            """Items of this round and, in each group, what meets them there: more frequent items, or later ones as frequent."""
            mine = F.pmod(F.xxhash64("item_a"), F.lit(rounds)) == k
            places = lists.select("_items", *values, F.posexplode("_items").alias("_p", "item_a")).filter(mine & (F.col("_p") < F.size("_items") - 1))
            rest = lambda c: F.slice(c, F.col("_p") + 2, F.size("_items"))      # noqa: E731
            small = places.select("item_a", rest("_items").alias("_b"), *[F.element_at(v, F.col("_p") + 1).alias(f"_x_{v}") for v in values], *[rest(v).alias(f"_y_{v}") for v in values])
            if not hot:
                return small
            here = large.select(group, F.col(item).alias("item_a"), F.col("_held").alias("_held_a"), *[F.col(v).alias(f"_x_{v}") for v in values], "_blocks").filter(mine)
            met = here.withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).join(blocks, [group, "_b"])
            after = F.filter("_l", lambda e: (e["_held"] > F.col("_held_a")) | ((e["_held"] == F.col("_held_a")) & (e["_i"] > F.col("item_a"))))
            met = met.withColumn("_l", after).filter(F.size("_l") > 0)
            return small.unionByName(met.select("item_a", F.col("_l._i").alias("_b"), *[f"_x_{v}" for v in values], *[F.col(f"_l.{v}").alias(f"_y_{v}") for v in values]))

        def added(k: int) -> DataFrame:
            dealt = owned(k).repartition(parts, "item_a")
            others = F.arrays_zip("_b", *[f"_y_{v}" for v in values]) if values else F.col("_b")
            one = dealt.select("item_a", *[f"_x_{v}" for v in values], (F.inline(others).alias("_b", *[f"_y_{v}" for v in values]) if values else F.explode(others).alias("_b")))
            sums = one.groupBy("item_a", "_b").agg(*[c.alias(n) for n, c in totals.items()]).filter(keep)
            return sums.select(F.least("item_a", "_b").alias("item_a"), F.greatest("item_a", "_b").alias("item_b"), *totals)

        out = durable_rounds(added, rounds, "pairs")
        discard(lists, large, blocks)
    return out

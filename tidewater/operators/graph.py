"""Edge-table operators: hierarchies, reciprocal links, two-hop neighbours, routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.commerce import pair_counts
from tidewater.sources.durable import durable


def ancestors(df: DataFrame, child: str, parent: str) -> DataFrame:
    """All (child, ancestor, depth) pairs of a hierarchy; direct parents have depth 1.

    One join per level, each level written to the shared folder. A pair already seen is not
    extended, so cycles end and the levels are as many as the hierarchy has.
    """
    edges = df.select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).filter(
        F.col("ancestor").isNotNull() & (F.col("node") != F.col("ancestor"))).distinct()
    step = edges.withColumnsRenamed({"node": "_mid", "ancestor": "_next"})
    front = durable(edges.withColumn("depth", F.lit(1)), "level")
    known, depth = front, 1
    while not front.isEmpty():
        depth += 1
        grown = (front.join(step, front["ancestor"] == step["_mid"])
                 .select("node", F.col("_next").alias("ancestor")).filter("node <> ancestor").distinct()
                 .join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti"))
        front = durable(grown.withColumn("depth", F.lit(depth)), "level")
        known = known.unionByName(front)
    return known


def mutual(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Unordered pairs linked in both directions; one aggregate, no self join."""
    low, high = F.least(source, target), F.greatest(source, target)
    return (edges.filter(F.col(source) != F.col(target)).select(source, target).distinct()
            .groupBy(low.alias("a"), high.alias("b")).agg(F.count("*").alias("_n")).filter("_n = 2").drop("_n"))


def friends_of_friends(edges: DataFrame, source: str, target: str, min_common: int = 1) -> DataFrame:
    """Pairs not linked themselves, with the number of common friends (undirected)."""
    both = edges.select(F.col(source).alias("u"), F.col(target).alias("v")).filter("u <> v")
    links = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    common = pair_counts(links, "v", "u", min_common)
    direct = links.filter("u < v").select(F.col("u").alias("item_a"), F.col("v").alias("item_b"))
    return common.join(direct, ["item_a", "item_b"], "left_anti").select("item_a", "item_b", F.col("support").alias("common"))


def two_leg_routes(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Distinct A -> B -> C connections with A <> C."""
    legs = edges.select(source, target).distinct()
    first = legs.select(F.col(source).alias("origin"), F.col(target).alias("via"))
    second = legs.select(F.col(source).alias("via"), F.col(target).alias("destination"))
    return first.join(second, "via").filter("origin <> destination").select("origin", "via", "destination").distinct()

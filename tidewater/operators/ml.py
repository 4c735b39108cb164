"""Spark ML jobs."""

from __future__ import annotations

import math

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.commerce import counted_pairs
from tidewater.operators.ordered import scan
from tidewater.operators.pairs import in_rounds, paired
from tidewater.operators.rel import attach, small_side
from tidewater.sources.durable import discard, durable, freed_shuffles


def association_rules(baskets: DataFrame, items: str, min_support: float = 0.01, min_confidence: float = 0.5, longest: int | None = None) -> DataFrame:
    """Frequent-itemset rules (antecedent, consequent, confidence, lift, support) by parallel FP-growth.

    FP-growth sends every item's share of every basket to one tree, so with many items at a low support its trees hold
    most of the baskets' pairs. With ``longest``, 1 or 2 items before the arrow, itemsets are counted level by level
    instead: the same rules of that length, in joins and sums spread over all tasks.
    """
    if longest is None:
        model = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence).fit(baskets)
        return model.associationRules
    if longest not in (1, 2):
        raise ValueError("longest must be 1 or 2")
    listed = baskets.filter(F.col(items).isNotNull()).select(F.monotonically_increasing_id().alias("_basket"), F.col(items).alias("_items"))
    with freed_shuffles(baskets.sparkSession):
        listed = durable(listed, "baskets")
        n = listed.count()
        least = max(math.ceil(min_support * n), 1)
        rows = durable(listed.select("_basket", F.explode("_items").alias("_item")).dropna().distinct(), "rows")
        discard(listed)
        singles = durable(rows.groupBy("_item").agg(F.count("*").alias("_held")).filter(F.col("_held") >= least), "singles")
        pairs = durable(counted_pairs(rows, "_basket", "_item", least), "pairs")
        triples = durable(_triple_counts(rows, pairs, least), "triples") if longest == 2 else None
        discard(rows)
    arrows = pairs.select("item_a", "item_b", "support").unionByName(pairs.select(F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b"), "support"))
    held = singles.withColumnRenamed("_item", "item_a")
    rules = arrows.join(held, "item_a").select(F.array("item_a").alias("antecedent"), F.col("item_b").alias("_then"), F.col("support").alias("_both"), "_held")
    if longest == 2:
        a, b, c = "item_a", "item_b", "item_c"
        turned = [triples.select(F.col(x).alias(a), F.col(y).alias(b), F.col(z).alias("_then"), F.col("support").alias("_both")) for x, y, z in ((a, b, c), (a, c, b), (b, c, a))]
        known = pairs.select(a, b, F.col("support").alias("_held"))
        longer = turned[0].unionByName(turned[1]).unionByName(turned[2]).join(known, [a, b])
        rules = rules.unionByName(longer.select(F.array(a, b).alias("antecedent"), "_then", "_both", "_held"))
    share = singles.select(F.col("_item").alias("_then"), F.col("_held").alias("_alone"))
    confidence = F.col("_both") / F.col("_held")
    return (rules.withColumn("confidence", confidence).filter(F.col("confidence") >= min_confidence).join(share, "_then")
            .select("antecedent", F.array("_then").alias("consequent"), "confidence", (F.col("confidence") / (F.col("_alone") / n)).alias("lift"), (F.col("_both") / n).alias("support")))


def _triple_counts(rows: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """(item_a, item_b, item_c, support) of item triples in ``least`` baskets at least; ``pairs`` holds all pairs that are.

    Only triples of three frequent pairs are looked up in the baskets, by a frequent pair of theirs.
    """
    ab = pairs.select("item_a", "item_b")
    ac, bc = ab.withColumnRenamed("item_b", "item_c"), ab.select(F.col("item_a").alias("item_b"), F.col("item_b").alias("item_c"))
    wanted = ab.join(ac, "item_a").filter(F.col("item_b") < F.col("item_c")).join(bc, ["item_b", "item_c"])
    wanted = durable(wanted.select("item_a", "item_b", "item_c"), "wanted")
    doubles = wanted.select("item_a", "item_b").distinct()
    looked = durable(wanted.select(F.explode(F.array("item_a", "item_b", "item_c")).alias("_item")).distinct(), "looked")
    rows = durable(rows.join(small_side(looked), "_item", "left_semi").select("_basket", "_item"), "held")
    a, b, c = (rows.withColumnRenamed("_item", f"item_{x}") for x in "abc")
    met = doubles.join(a, "item_a").join(b, ["_basket", "item_b"]).join(wanted, ["item_a", "item_b"]).join(c, ["_basket", "item_c"])
    return met.groupBy("item_a", "item_b", "item_c").agg(F.count("*").alias("support")).filter(F.col("support") >= least)


def recommend(ratings: DataFrame, user: str, item: str, rating: str, top: int = 10, iterations: int = 10, seed: int = 42) -> DataFrame:
    """Implicit-rating matrix factorization; ``top`` items per user, one row each."""
    als = ALS(userCol=user, itemCol=item, ratingCol=rating, maxIter=iterations, regParam=0.01, coldStartStrategy="drop", seed=seed)
    recs = als.fit(ratings).recommendForAllUsers(top)
    return recs.select(user, F.explode("recommendations").alias("_r")).select(user, f"_r.{item}", F.col("_r.rating").alias("score"))


def segments(df: DataFrame, features: list[str], k: int = 5, seed: int = 42) -> DataFrame:
    """Standardized k-means; the input with a ``cluster`` column."""
    packed = VectorAssembler(inputCols=features, outputCol="_raw").transform(df)
    scaled = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(packed).transform(packed)
    model = KMeans(k=k, seed=seed, featuresCol="_scaled", predictionCol="cluster").fit(scaled)
    return model.transform(scaled).drop("_raw", "_scaled")


def series_features(df: DataFrame, series: list[str], time: str, value: str, lags: tuple[int, ...] = (1, 7), windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Lags, trailing means and calendar flags for a daily table (one row per series and date)."""
    w = Window.partitionBy(*series).orderBy(time)
    cols: dict[str, Column] = {f"lag_{n}": F.lag(value, n).over(w) for n in lags}
    cols |= {f"mean_{n}": F.avg(value).over(w.rowsBetween(-(n - 1), 0)) for n in windows}
    cols |= {"dow": F.dayofweek(time), "is_weekend": F.dayofweek(time).isin(1, 7), "month": F.month(time), "quarter": F.quarter(time)}
    return df.withColumns(cols)


def forecast(df: DataFrame, series: str, time: str, value: str, cut: str, trees: int = 20, seed: int = 42) -> DataFrame:
    """One random forest over all series: trained before ``cut``, predicting from it on."""
    rows = series_features(df, [series], time, value).dropna()
    inputs = ["lag_1", "lag_7", "mean_prev", "dow", "month", "_level"]
    level = rows.filter(F.col(time) < cut).groupBy(series).agg(F.avg(value).alias("_mean"))       # stands for the series
    rows = rows.join(level, series, "left")
    prepared = rows.withColumns({"mean_prev": (F.col("mean_7") * 7 - F.col(value)) / 6, "_level": F.coalesce("_mean", "mean_7")})
    packed = durable(prepared.select(series, time, value, *inputs), "features")
    ready = VectorAssembler(inputCols=inputs, outputCol="_x").transform(packed)
    model = RandomForestRegressor(featuresCol="_x", labelCol=value, numTrees=trees, seed=seed, predictionCol="forecast")
    return model.fit(ready.filter(F.col(time) < cut)).transform(ready.filter(F.col(time) >= cut)).select(series, time, value, "forecast")


def cosine_items(ratings: DataFrame, user: str, item: str, rating: str, least: float | None = None, block: int = 1000) -> DataFrame:
    """Cosine similarity of item pairs rated by one user at least; norms use all of an item's ratings.

    Items of a user with more than ``block`` are paired in blocks, so one user's pairs spread over many tasks.
    With ``least`` only pairs of at least that similarity (less 1e-9 for rounding) are returned, and most others are never
    formed: an item's ratings are read from users with few items to users with many, until the norm of the rest is below
    ``least``. Two items that meet only in their rests cannot be similar enough, so pairs are made of the first ratings
    alone. What they add up to there, and at most one rest's norm, bounds their similarity; the pairs whose bound reaches
    ``least`` are then computed on all ratings. More first pairs than one round has are made and bounded in rounds
    (``operators/pairs.py``). Null users, items and ratings are ignored; repeated ratings add up. Items whose norm is 0 are
    similar to nothing (null; left out with ``least``).
    """
    r = ratings.select(F.col(user).alias("_u"), F.col(item).alias("_i"), F.col(rating).cast("double").alias("_r")).dropna()
    if least is not None and not least > 0:
        raise ValueError("least must be above 0")
    with freed_shuffles(ratings.sparkSession):
        r = durable(r.groupBy("_u", "_i").agg(F.sum("_r").alias("_r")), "ratings")
    norms = r.groupBy("_i").agg(F.sqrt(F.sum(F.col("_r") * F.col("_r"))).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    if least is None:
        dots = _met(r, "_r", block).groupBy("item_a", "item_b").agg(F.sum(F.col("_x") * F.col("_y")).alias("_dot"))
        na, nb = (norms.select(F.col("_i").alias(f"item_{x}"), F.col("_n").alias(f"_n{x}")) for x in "ab")
        return dots.join(na, "item_a").join(nb, "item_b").select("item_a", "item_b", F.try_divide("_dot", F.col("_na") * F.col("_nb")).alias("similarity"))
    bar = least - 1e-9
    with freed_shuffles(ratings.sparkSession):
        unit = attach(r, norms.filter("_n > 0"), ["_i"], spread=["_u"]).select("_u", "_i", (F.col("_r") / F.col("_n")).alias("_w"))
        sizes = unit.groupBy("_u").agg(F.count(F.lit(1)).alias("_rows"))
        sized = durable(attach(unit, sizes.withColumn("_size", F.col("_rows")), ["_u"], spread=["_i"]).select("_u", "_i", "_w", "_size"), "units")
        discard(r)
        # Read from the end: the norm of the rest is a running sum over users with most items first.
        rests = scan(sized, ["_i"], ["-_size", "_u"], _rest=("sum", F.col("_w") * F.col("_w")))
        first = durable(rests.filter(F.col("_rest") >= bar * bar - 1e-9).select("_u", "_i", "_w", (F.col("_rest") - F.col("_w") * F.col("_w")).alias("_after")), "first")
        close = _close(first, bar, block)
        discard(first)
        looked = durable(close.select(F.explode(F.array("item_a", "item_b")).alias("_i")).distinct(), "looked")
        held = durable(sized.join(small_side(looked), "_i", "left_semi").select("_u", "_i", "_w"), "held")
        discard(sized)
    left, right = (held.select("_u", F.col("_i").alias(f"item_{x}"), F.col("_w").alias(f"_w{x}")) for x in "ab")
    dots = close.join(left, "item_a").join(right, ["_u", "item_b"]).groupBy("item_a", "item_b").agg(F.sum(F.col("_wa") * F.col("_wb")).alias("similarity"))
    return dots.filter(F.col("similarity") >= bar)


def _close(first: DataFrame, bar: float, block: int) -> DataFrame:
    """(item_a, item_b), written, of the pairs of first ratings that ``bar`` does not rule out; many are made in rounds."""
    left_over = first.groupBy("_i").agg(F.sqrt(F.greatest(F.min("_after"), F.lit(0.0))).alias("_left"), F.count(F.lit(1)).alias("_rows"))
    # Past the nearer end of the two first parts only the rest of one item is met, so its norm bounds what is missing.
    sizes = durable(first.groupBy("_u").agg(F.count(F.lit(1)).alias("_rows")), "sizes")
    made, largest, n = sizes.agg(F.sum(F.col("_rows") * (F.col("_rows") - 1) / 2), F.max("_rows"), F.sum("_rows")).first()
    left_over = durable(left_over.withColumn("_held", F.col("_rows")), "left_over")
    first = attach(first, left_over, ["_i"], spread=["_u"])
    if in_rounds(int(made or 0), left_over.count()):
        # Single precision in the lists: its rounding is far below the 1e-6 that the bound leaves.
        rows = attach(first, sizes.withColumn("_size", F.col("_rows")), ["_u"], spread=["_i"])
        rows = rows.select("_u", "_i", "_held", "_size", F.col("_w").cast("float").alias("_w"), F.col("_left").cast("float").alias("_left"))
        most = F.sum(F.col("_x__w").cast("double") * F.col("_y__w")) + F.max(F.greatest("_x__left", "_y__left"))
        pairs = paired(rows, "_u", "_i", int(made), n, {"_most": most}, F.col("_most") >= bar - 2e-6, ("_w", "_left"), block, largest)
        discard(sizes, left_over)
        return pairs.select("item_a", "item_b")
    first = first.select("_u", "_i", F.struct("_w", "_left").alias("_v"))
    most = F.sum(F.col("_x._w") * F.col("_y._w")) + F.max(F.greatest("_x._left", "_y._left"))
    return durable(_met(first, "_v", block).groupBy("item_a", "item_b").agg(most.alias("_most")).filter(F.col("_most") >= bar - 1e-6).select("item_a", "item_b"), "pairs")


def _met(rows: DataFrame, value: str, block: int) -> DataFrame:
    """(item_a, item_b, _x, _y): values of every two items of a user, item_a < item_b.

    A user with k blocks of items has k * (k + 1) / 2 pairs of blocks, each a join key of its own.
    """
    sizes = rows.groupBy("_u").agg(F.count(F.lit(1)).alias("_rows"))
    blocks = F.ceil(F.col("_size") / block).cast("int").alias("_blocks")
    placed = attach(rows, sizes.withColumn("_size", F.col("_rows")), ["_u"], spread=["_i"]).select("_u", "_i", value, blocks).withColumn("_b", F.pmod(F.xxhash64("_i"), F.col("_blocks")).cast("int"))
    left = placed.select("_u", F.col("_i").alias("_p"), F.col(value).alias("_vp"), F.col("_b").alias("_lo"), F.explode(F.sequence(F.col("_b"), F.col("_blocks") - 1)).alias("_hi"))
    right = placed.select("_u", F.col("_i").alias("_q"), F.col(value).alias("_vq"), F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_lo"), F.col("_b").alias("_hi"))
    both = left.join(right, ["_u", "_lo", "_hi"]).filter((F.col("_lo") < F.col("_hi")) & (F.col("_p") != F.col("_q")) | (F.col("_p") < F.col("_q")))
    ordered = F.col("_p") < F.col("_q")
    return both.select(F.least("_p", "_q").alias("item_a"), F.greatest("_p", "_q").alias("item_b"),
                       F.when(ordered, F.col("_vp")).otherwise(F.col("_vq")).alias("_x"), F.when(ordered, F.col("_vq")).otherwise(F.col("_vp")).alias("_y"))


def line_fits(df: DataFrame, series: str, x: str, y: str) -> DataFrame:
    """Least-squares line per series in a grouped pandas function; pass data already reduced to one row per x."""
    import numpy as np
    import pandas as pd

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        xs, ys = rows[x].to_numpy(float), rows[y].to_numpy(float)
        centered = xs - xs.mean()
        spread = float(np.dot(centered, centered))
        slope = float(np.dot(centered, ys) / spread) if spread else float("nan")
        return pd.DataFrame({series: [rows[series].iloc[0]], "slope": [slope], "points": [len(rows)]})

    return df.select(series, x, y).groupBy(series).applyInPandas(fit, f"{series} {df.schema[series].dataType.simpleString()}, slope double, points long")

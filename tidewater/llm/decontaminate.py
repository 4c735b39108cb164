"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

Texts become words (runs of letters and digits, lower-cased). A seed is a fixed mask over at most 8
consecutive words: words under it are hashed, the others ignored, so a replaced word in a gap does not
hide a hit. ``MASKS`` together hit every run of 8 or more matches that make up 70 % of it, wherever the
changes are; looser limits are served by one mask of so many neighbours as any run must have in a row. Items of
fewer than ``min_words`` words are looked up by the hash of all their words. Hashes of all positions of the training documents meet those of all positions
of the benchmark items. A hit fixes an alignment (item, document, shift); along it every word is
compared. A run is a leak when at least ``min_words`` of its words match (or the whole item, if it is
shorter) and matches make up ``min_share`` of it. Alignments of one document and item that see the same words are compared once. Of the runs with so many matches the best one is kept, where a
match counts ``1 - min_share`` and a difference ``-min_share``: its score is negative only if no run is a leak.

The index of the items is sent to every executor in blocks of at most ``BLOCK_KEYS`` keys, one pass over
the hashed documents each, so a larger benchmark costs passes and not memory.

Nulls, empties, ties: texts that are null or without words have no seed and no leak. Rows of equal id and text count once; the same item text under several ids reports all ids.
Of equally good runs of one document and item the first is reported. Null ids stay null.
Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import carried, parts_for, pick, restored
from tidewater.sources.durable import durable

#: Masks as the places of the words that count: 11101, 10010011, 1000111.
MASKS = ((0, 1, 2, 4), (0, 3, 6, 7), (0, 4, 5, 6))
MASK_WORDS, MASK_SHARE = 8, 0.7          # runs that the masks are sure to hit
BLOCK_KEYS = 1 << 20
HIT_DOCS = 1 << 20


def word_hashes(text: Column) -> Column:
    """Hash of every word, in order."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def masks_for(min_words: int, min_share: float) -> tuple[tuple[int, ...], ...]:
    """Masks of which one at least hits every run of ``min_words`` matches and share ``min_share``."""
    if min_words >= MASK_WORDS and min_share >= MASK_SHARE:
        return MASKS
    changes = (1 - min_share) / min_share
    row = min(-(-m // (int(m * changes + 1e-9) + 1)) for m in range(min_words, min_words + 1000))
    return (tuple(range(row)),)


def _positions(df: DataFrame, masks: tuple[tuple[int, ...], ...], *keep: str) -> DataFrame:
    """One row per position and mask: (keep..., pos, mask, key).

    Keys that would reach beyond the text hash fewer words, so they equal no key of a whole mask.
    """
    def keys(mask: tuple[int, ...]) -> Column:
        label = F.lit(zlib.crc32(repr(mask).encode()))
        return F.transform("h", lambda x, i: F.xxhash64(label, x, *[F.get("h", i + at) for at in mask[1:]]))

    # The keys are a column before they are exploded: a generator with lambdas copies the text's hashes into every row.
    # The outer form keeps the optimizer from testing the keys for emptiness below, where it would split the text anew for each word.
    ready = df.select(*keep, F.size("h").alias("n"), F.concat(*map(keys, masks)).alias("keys"))
    spots = ready.select(*keep, "n", F.posexplode_outer("keys").alias("at", "key")).filter("key is not null")
    return spots.select(*keep, F.expr("at % n").alias("pos"), F.expr("at div n").alias("mask"), "n", "key")


def _best_run(at: Column, least: Column, min_share: float) -> Column:
    """Best run of ``least`` or more matches: struct(score, matched, start, stop), stop exclusive.

    ``at``: places of the matches, at least ``least`` of them. A run goes from one match to another; its score is the
    difference of ``gain`` at both, so every last match meets the lowest ``gain`` of those far enough before it.
    """
    share = round(min_share * 1_000_000)

    def gain(i: Column) -> Column:
        return i.cast("long") * 1_000_000 - F.get(at, i).cast("long") * share

    none = F.lit(None).cast("long")
    start = F.struct(none.alias("low"), none.alias("since"), F.struct(none.alias("score"), none.alias("matched"), none.alias("start"), none.alias("stop")).alias("best"))

    def step(s: Column, last: Column) -> Column:
        first = last - least + 1
        fresh = s["low"].isNull() | (gain(first) < s["low"])
        low, since = F.when(fresh, gain(first)).otherwise(s["low"]), F.when(fresh, first.cast("long")).otherwise(s["since"])
        run = F.struct((gain(last) - low + 1_000_000 - share).alias("score"), (last - since + 1).alias("matched"),
                       F.get(at, since.cast("int")).cast("long").alias("start"), (F.get(at, last).cast("long") + 1).alias("stop"))
        old = s["best"]
        better = old["score"].isNull() | (run["score"] > old["score"]) | (run["score"] == old["score"]) & (run["matched"] > old["matched"])
        return F.struct(low.alias("low"), since.alias("since"), F.when(better, run).otherwise(old).alias("best"))

    return F.aggregate(F.sequence(least - 1, F.size(at) - 1), start, step, lambda s: s["best"])


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
          min_words: int = 8, min_share: float = 0.7, block_keys: int = BLOCK_KEYS) -> DataFrame:
    """(doc_id, item_id, start, stop, matched, share): documents that repeat benchmark items, words [start, stop) of the document."""
    items = durable(pick(benchmark, item_id=item_id, text=item_text).select("item_id", word_hashes(F.col("text")).alias("h"))
                    .filter(F.size("h") > 0).withColumn("item", F.xxhash64("item_id", "h")).dropDuplicates(["item"]), "items")
    masks = masks_for(min_words, min_share)
    reach = F.get(F.array(*[F.lit(m[-1]) for m in masks]), F.col("mask").cast("int"))
    long = _positions(items.filter(F.size("h") >= min_words), masks, "item").filter(F.col("pos") + reach < F.col("n")).select("item", "key", F.col("pos").alias("item_pos"), F.col("n").alias("words"))
    # Shorter items are found whole: one mask for each of their lengths, at their first word.
    lengths = [r[0] for r in items.select(F.size("h").alias("n")).filter(F.col("n") < min_words).distinct().sort("n").collect()]
    whole = [_positions(items.filter(F.size("h") == n), (tuple(range(n)),), "item").filter("pos = 0").select("item", "key", F.col("pos").alias("item_pos"), F.col("n").alias("words")) for n in lengths]
    index = durable(reduce(DataFrame.union, whole, long).distinct(), "index")
    masks += tuple(tuple(range(n)) for n in lengths if tuple(range(n)) not in masks)
    blocks = parts_for(index.count(), block_keys)
    base = pick(docs, doc_id=doc_id, text=text).withColumn("th", F.xxhash64("text"))
    hits = []
    for b in range(blocks):
        block = index if blocks == 1 else index.filter(F.pmod("key", F.lit(blocks)) == b)
        spots = _positions(base.select("doc_id", "th", word_hashes(F.col("text")).alias("h")), masks, "doc_id", "th")
        hits.append(spots.join(F.broadcast(block), "key").select("doc_id", "th", "item", "words", (F.col("pos") - F.col("item_pos")).alias("shift")))
    hits = durable(reduce(DataFrame.union, hits).distinct(), "hits")

    hit_docs = durable(hits.select("doc_id", "th").distinct(), "hit-docs")
    small = hit_docs.count() <= HIT_DOCS
    hit_docs = hit_docs.toDF("hit_id", "hit_th")
    own = base.join(F.broadcast(hit_docs) if small else hit_docs, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th")), "left_semi")
    own = own.dropDuplicates(["doc_id", "th"]).select(F.col("doc_id").alias("own_id"), F.col("th").alias("own_th"), word_hashes(F.col("text")).alias("dh"))
    lined = hits.join(own, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("th") == F.col("own_th")))
    start, stop = F.greatest("shift", F.lit(0)), F.least(F.col("words") + F.col("shift"), F.size("dh"))
    low = F.greatest(-F.col("shift"), F.lit(0)).alias("low")
    # Equal words under an item give equal runs, of which the first is reported; a repeating text has few that differ.
    windows = lined.select("doc_id", "th", "item", "shift", low, F.slice("dh", start + 1, stop - start).alias("win"))
    both = windows.groupBy("doc_id", "th", "item", "low", "win").agg(F.min("shift").alias("shift")).join(items, "item")
    same = F.filter(F.sequence("low", F.col("low") + F.size("win") - 1), lambda i: F.get("h", i) == F.get("win", i - F.col("low")))
    least = F.least(F.lit(min_words), F.size("h"))
    places = both.select("doc_id", "th", "item_id", "shift", least.alias("least"), same.alias("at")).filter(F.size("at") >= F.col("least"))
    run = places.select("doc_id", "th", "item_id", "shift", _best_run(F.col("at"), F.col("least"), min_share).alias("run"))
    found = run.select("doc_id", "th", "item_id", (F.col("run.start") + F.col("shift")).alias("start"), (F.col("run.stop") + F.col("shift")).alias("stop"), "run.matched")
    found = found.withColumn("share", F.col("matched") / (F.col("stop") - F.col("start"))).filter(F.col("share") >= min_share)
    best = found.groupBy("doc_id", "th", "item_id").agg(F.max(F.struct("matched", "share", (-F.col("start")).alias("first"), "stop")).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.first")).cast("long").alias("start"), F.col("best.stop").cast("long").alias("stop"),
                       F.col("best.matched").cast("long").alias("matched"), F.col("best.share").alias("share"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` (all columns) whose document repeats no item."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("leaky")).distinct()
    return restored(carried(docs, doc_id="doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("leaky")), "left_anti"), docs)

"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds its distinct word shingles (words lie between ASCII white space, A-Z
lower-cased; 64-bit hashes stand for shingles). Documents with equal sets form a class; only one
representative of a class goes on. Every representative has ``VALUES`` MinHash values. Tree t of
the forest orders representatives by the signature rotated by ``BASE * t`` values; two of them
are candidates in a tree when they share the prefix that defines their region. Regions adapt: a
prefix of ``BASE`` values is the region unless more than ``LEAF`` representatives share it, then
the prefix grows along ``DEPTHS`` until few do.

Copies never yield all their pairs: every member is compared with the head of its region, and only regions that
still hold different components go on. Of those, small ones are compared across components, large ones are descended
further. Members of large regions that are still mixed after that are settled in rounds: in every round a few other
trees draw two new heads a region, one among its rows and one among its components, and rows of other components are
compared with them; the work of a round is linear in the rows outside the regions' main components. Rounds end
when ``QUIET`` of them in a row have joined nothing, or before an exact comparison when one has joined little. Every candidate is confirmed on full sets:
100 * |A and B| >= percent * |A or B|. At exactly 80 % similarity a pair shares some four-value prefix of the 32 trees
with probability 1 - 5e-8. What such crowds still hold apart after the rounds is compared exactly: shingles are ordered
by their number of rows, rarest first, and pairs of different components are looked at if they share one of the first
n - ceil(percent * n) + 1 and if enough shingles are left after it. ``exact=False`` leaves that out; it then misses links that
are the only ones between parts of a crowd of texts that are all about as similar.

Nulls, empties, ties: texts that are null or without words have an empty set and no links. Fewer
words than a shingle has make one shingle. Rows with the same id are one document (their sets all
count); rows with a null id are linked with nothing. Extra columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import carried, parts_for, pick, restored, texts
from tidewater.sources.durable import discard, durable

VALUES = 128
BASE = 4
TREES = VALUES // BASE
LEAF = 16                                # representatives in a region that are compared with one another
HEADS = 8
DEPTHS = (5, 6, 8, 12, 24, VALUES)       # prefix lengths of smaller regions
BROADCAST_IDS = 1 << 20                  # so many ids (8 MB) may be sent to every executor
BROADCAST_ROWS = 1 << 18                 # so many pairs of ids may be
PART_ROWS = 1 << 13                      # rows from which a task makes a file, where their number is known
LEAST_PARTS = 12
ROUND_TREES = 16                         # trees that a round looks at
ROUND_DEPTHS = (BASE, 2 * BASE)          # their prefix lengths, in turn
QUIET = 2                                # rounds without a new link that end the search
FRUITFUL = 64                            # before the exact comparison, one is the last that links less than a row in so many

_rng = np.random.default_rng(20240917)
_MUL = _rng.integers(1, 1 << 63, VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, VALUES, np.uint64)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    own = text.lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = (out ^ h[i:len(h) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(own: np.ndarray) -> np.ndarray:
    """Least value of each hash function over a set, long sets in pieces."""
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(own), 2048):
        seen = own[at:at + 2048, None] * _MUL + _ADD
        np.minimum(least, (seen >> np.uint64(32)).min(axis=0).astype(np.uint32), out=least)
    return least.astype(np.uint16)           # the low half: equal values stay equal, others rarely become so


def signed(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(doc_id, n, k1, k2, sig) of every row: set size, set hash, signature."""
    base = pick(docs, doc_id=doc_id, text=text)
    id_type = base.schema["doc_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, sigs = [], [], []
            for t in texts(batch):
                own = shingles(t, words)
                n.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                sigs.append(signature(own).tobytes() if len(own) else b"")
            k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(k[:, 0].copy()), pa.array(k[:, 1].copy()),
                                              pa.array(sigs, pa.binary())], ["doc_id", "n", "k1", "k2", "sig"])

    return base.mapInArrow(emit, f"doc_id {id_type}, n long, k1 long, k2 long, sig binary")


def _prefix(tree: Column, depth: int) -> Column:
    """Hash of the first ``depth`` values in the order of a tree."""
    return F.xxhash64(tree, F.substring(F.concat("sig", "sig"), tree * (2 * BASE) + 1, F.lit(2 * depth)))


def _regions(rows: DataFrame) -> DataFrame:
    """Rows (key, tree, node, n) whose region has others, with its size and its head.

    The head is the least node; in a crowd it is drawn, in HEADS ways by tree, so its members meet several heads.
    """
    drawn = F.xxhash64("node", F.col("tree") % HEADS)
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("first"), F.min_by("n", "node").alias("first_n"),
                                    F.min_by("node", drawn).alias("any"), F.min_by("n", drawn).alias("any_n")).filter("size > 1")
    few = F.col("size") <= LEAF
    return rows.join(sizes.select("key", "size", F.when(few, F.col("first")).otherwise(F.col("any")).alias("head"), F.when(few, F.col("first_n")).otherwise(F.col("any_n")).alias("head_n")), "key")


def _within(leaves: DataFrame, *extra: str) -> DataFrame:
    """Pairs inside regions of at most LEAF rows."""
    inside = leaves.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "n", *extra))).alias("own"))
    one = inside.select("own", F.posexplode("own").alias("i", "x")).select("x", F.explode(F.slice("own", F.col("i") + 2, F.lit(LEAF))).alias("y"))
    return one.filter(" and ".join(f"x.{c} <> y.{c}" for c in extra) or "true").select(F.col("x.node").alias("a"), F.col("x.n").alias("na"), F.col("y.node").alias("b"), F.col("y.n").alias("nb"))


def _to_head(regions: DataFrame) -> DataFrame:
    """Each row of a region against the region's head."""
    return regions.filter("node <> head").select(F.least("head", "node").alias("a"), F.col("head_n").alias("na"), F.greatest("head", "node").alias("b"), F.col("n").alias("nb"))


def confirmed(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    close = durable(_near_sized(pairs, percent), "candidates")
    needed = durable(_few(close.select(F.col("a").alias("doc_id")).union(close.select("b")).distinct(), close.count()), "compared")
    sets = _sets(needed, docs, doc_id, text, words)
    links = durable(_similar(close, sets, percent), "links")
    discard(close, needed, sets)
    return links


def _near_sized(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) whose sizes allow the similarity."""
    return pairs.filter(F.col("a") != F.col("b")).filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b").distinct()


def _similar(close: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of ``close``, a written table, whose sets (doc_id, own) are similar enough; ids with several sets may repeat theirs."""
    left, right = (sets.select(F.col("doc_id").alias(x), F.col("own").alias(f"s{x}")) for x in "ab")
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    every = F.size("sa") + F.size("sb") - both
    n = close.count()
    found = _sent(close, n <= BROADCAST_ROWS).join(left, "a")
    return _few(found.join(right, "b").filter(both * 100 >= every * percent).select("a", "b"), n, PART_ROWS // 8)


def _sets(needed: DataFrame, docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(doc_id, own) of every row whose id is needed: its full set."""
    base = pick(docs, doc_id=doc_id, text=text)
    id_type = base.schema["doc_id"].dataType.simpleString()
    own = base.join(F.broadcast(needed) if needed.count() <= BROADCAST_IDS else needed, "doc_id", "left_semi")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words).view(np.int64) for t in texts(batch)]
            ends = np.cumsum([0, *map(len, sets)])
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["doc_id", "own"])

    return durable(own.mapInArrow(emit, f"doc_id {id_type}, own array<long>"), "sets")


def _across(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components of ``crowd`` (node, n, component) that two similar sets could be.

    Shingles are ordered by their number of rows. Two similar sets share one among the first n - ceil(percent * n) + 1
    of each, and from the places of the first one shared, enough others must be left.
    """
    every = sets.join(_sent(crowd.withColumnRenamed("node", "doc_id"), crowd.count() <= BROADCAST_ROWS), "doc_id").select("doc_id", "n", "component", F.explode("own").alias("token"))
    held = durable(every.groupBy("token").agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), "shingles")
    # A shingle of one row is first in order and meets nobody; it still takes a place.
    shared = every.join(held, "token").groupBy("doc_id", "n", "component").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("own"))
    alone = F.col("n") - F.size("own")
    place = F.posexplode(F.expr(f"slice(own, 1, greatest(0, cast(n - ceil(n * {percent} / 100.0) + 1 as int) - cast(n - size(own) as int)))")).alias("at", "x")
    rows = durable(shared.select("doc_id", "n", "component", alone.alias("alone"), place).select("doc_id", "n", "component", (F.col("at") + F.col("alone")).alias("at"), "x.token"), "rare")
    x, y = rows.alias("x"), rows.alias("y")
    fits = F.expr(f"least(x.n, y.n) * 100 >= greatest(x.n, y.n) * {percent}"
                  f" and 1 + least(x.n - x.at - 1, y.n - y.at - 1) >= (x.n + y.n) * {percent} / (100.0 + {percent}) - 1e-6")
    near = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") < F.col("y.component")) & fits)
    out = durable(near.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct(), "candidates")
    discard(held, rows)
    return out


def _round(crowd: DataFrame, found: DataFrame, number: int, percent: int) -> DataFrame:
    """Candidates of one round: rows of ``crowd`` (node, n, sig) against two heads of their regions."""
    first, depth = number * ROUND_TREES % TREES, ROUND_DEPTHS[number * ROUND_TREES // TREES % len(ROUND_DEPTHS)]
    tree = F.explode(F.sequence(F.lit(first), F.lit(first + ROUND_TREES - 1))).alias("tree")
    rows = _placed(crowd, found).select("node", "n", "component", "sig", tree).select("node", "n", "component", _prefix(F.col("tree"), depth).alias("key"))
    one = F.struct("node", "n", "component")
    heads = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min_by(one, F.xxhash64("node", F.lit(number))).alias("any"),
                                    F.min_by(one, F.xxhash64("component", F.lit(number))).alias("rare")).filter("lo <> hi")
    met = rows.join(heads, "key").filter(F.col("component") != F.col("any.component")).select("node", "n", "component", F.explode(F.array("any", "rare")).alias("head"))
    met = met.filter(F.col("component") != F.col("head.component"))
    left = F.col("node") < F.col("head.node")
    return _near_sized(met.select(F.least("node", "head.node").alias("a"), F.when(left, F.col("n")).otherwise(F.col("head.n")).alias("na"),
                                  F.greatest("node", "head.node").alias("b"), F.when(left, F.col("head.n")).otherwise(F.col("n")).alias("nb")), percent)


def _settle(crowd: DataFrame, found: DataFrame, docs: DataFrame, doc_id: str, text: str, words: int, percent: int, exact: bool) -> DataFrame:
    """The components ``found`` after what else joins rows of ``crowd`` (node, n, sig)."""
    sets = _sets(crowd.select(F.col("node").alias("doc_id")), docs, doc_id, text, words)
    number, quiet, rows = 0, 0, crowd.count()

    def joined(new: DataFrame) -> DataFrame:
        after = components(_stars(found).union(new))
        discard(found, new)
        return after

    while quiet < QUIET:
        close = durable(_few(_round(crowd, found, number, percent), ROUND_TREES * rows), "candidates")
        new = durable(_similar(close, sets, percent), "links")
        discard(close)
        n = new.count()
        quiet, number = (0 if n else quiet + 1), number + 1
        if n:
            found = joined(new)
        if exact and n * FRUITFUL < rows:
            break
    if exact:
        close = _across(_placed(crowd, found).select("node", "n", "component"), sets, percent)
        new = durable(_similar(close, sets, percent), "links")
        discard(close)
        found = joined(new)
    discard(sets)
    return found


def _stars(found: DataFrame) -> DataFrame:
    """Components as links again: one for each node, however many links joined them."""
    return found.select(F.col("component").alias("a"), F.col("node").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): least node reachable, for every node of ``links`` (a, b), by alternating stars.

    Links only move, so there are never more of them than at first. They are stars, and done, when every node with a
    lesser neighbour has no other one.
    """
    edges = durable(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    n = edges.count()
    while True:
        both = edges.union(edges.select("v", "u"))
        least = durable(_few(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), (F.min("v") != F.max("v")).alias("several")), n), "least")
        if least.filter("several and m < u").isEmpty():
            out = durable(least.select(F.col("u").alias("node"), F.col("m").alias("component")), "components")
            discard(edges, least)
            return out
        small = least.count() <= BROADCAST_ROWS
        wide = both.filter("v > u").join(_sent(least.select("u", "m"), small), "u")
        down = durable(wide.select(F.col("v").alias("u"), F.col("m").alias("v")), "edges")
        discard(edges, least)
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        least = _few(least, n) if small else least
        narrow = down.join(_sent(least, small), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = durable(_few(narrow.union(least), n), "edges")
        discard(down)


def _few(rows: DataFrame, of: int, each: int = PART_ROWS) -> DataFrame:
    """``rows``, the last step of which runs in as many tasks as the ``of`` rows it is made from need, if those are fewer."""
    return rows.coalesce(max(LEAST_PARTS, parts_for(of, each)))


def _sent(rows: DataFrame, small: bool) -> DataFrame:
    """``rows``, sent to every executor where they are few."""
    return F.broadcast(rows) if small else rows


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, exact: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    rows = durable(signed(docs, doc_id, text, words), "signatures")
    sets = rows.filter("n > 0 and doc_id is not null")
    classes = sets.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("last"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = durable(_few(classes, rows.count()), "classes")

    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    all_rows = classes.select("node", "n", "sig", tree).select(_prefix(F.col("tree"), BASE).alias("key"), "tree", "node", "n")
    regions = durable(_few(_regions(all_rows), classes.count(), PART_ROWS // 4), "regions")
    links = confirmed(_to_head(regions), docs, doc_id, text, words, percent)

    found, more = components(links), []
    rest = durable(_few(_mixed(regions.select("tree", "node", "n", "key", "size"), found), regions.count()), "rest")
    leaf = ("key", "node", "n", "component")
    leaves = [rest.filter(F.col("size") <= LEAF).select(*leaf)]
    crowd = _descended(rest.filter(F.col("size") > LEAF), classes)
    levels = []
    for depth in DEPTHS:
        if not (n := crowd.count()):
            break
        deeper = crowd.select(_prefix(F.col("tree"), depth).alias("key"), "tree", "node", "n", "sig")
        levels.append(durable(_few(_mixed(_regions(deeper), found), n), "parts"))
        large = levels[-1].filter(F.col("size") > LEAF)
        leaves.append(levels[-1].filter(F.col("size") <= LEAF).select(*leaf))
        more.append(_to_head(large))
        crowd = large.select("tree", "node", "n", "sig")
    more.append(_within(reduce(DataFrame.union, leaves), "component"))      # keys of different depths differ
    across = confirmed(reduce(DataFrame.union, more), docs, doc_id, text, words, percent)
    first, found = found, components(_stars(found).union(across))
    discard(rest, first, links, across, *levels)

    apart = _mixed(regions.filter(F.col("size") > LEAF), found).select("node").distinct()
    apart = durable(_few(classes.select("node", "n", "sig").join(apart, "node", "left_semi"), classes.count()), "apart")
    discard(regions)
    if not apart.isEmpty():
        found = _settle(apart, found, docs, doc_id, text, words, percent, exact)
    discard(apart)

    # An id that occurs with several texts joins their classes.
    key = F.struct("k1", "k2")
    twice = sets.groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).filter("lo <> hi").select("doc_id")
    copies = classes.filter("node <> last").select("k1", "k2", "node")
    member = rows.join(_sent(copies, copies.count() <= BROADCAST_ROWS), ["k1", "k2"], "left").select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")).otherwise(F.col("doc_id")).alias("node"))
    again = member.join(twice, "doc_id", "left_semi").filter("node <> doc_id").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    if not again.isEmpty():
        found = components(_stars(found).union(again))
    found = found.withColumnRenamed("node", "at")
    whole = member.join(_sent(found, found.count() <= BROADCAST_ROWS), F.col("node") == F.col("at"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))
    return whole.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (node, ...) with their components; a node without links is its own."""
    own = rows.join(_sent(found, found.count() <= BROADCAST_ROWS), "node", "left")
    return own.withColumn("component", F.coalesce("component", "node"))


def _mixed(regions: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of regions that hold several components, with theirs."""
    own = _placed(regions, found)
    several = own.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    return own.join(several, "key", "left_semi")


def _descended(large: DataFrame, classes: DataFrame) -> DataFrame:
    """(tree, node, n, sig) of the classes whose nodes lie in regions ``large`` (tree, node).

    A node meets its classes once, with all its trees, so the join gives no more rows than there are classes, also
    where an id has several texts and is the node of several classes.
    """
    trees = large.groupBy("node").agg(F.collect_set("tree").alias("trees"))
    return classes.select("node", "n", "sig").join(trees, "node").select(F.explode("trees").alias("tree"), "node", "n", "sig")


def first_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` (all columns) whose document is the first of its component."""
    gone = near_duplicates(docs, words=words, percent=percent).filter("not kept").select("doc_id").distinct()
    return restored(carried(docs, doc_id="doc_id").join(gone, "doc_id", "left_anti"), docs)

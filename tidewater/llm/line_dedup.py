"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. The
reference-count table says, for every key (128-bit hash), in how many documents it occurs. Keys
with at least ``min_docs`` references are *frequent*; their lines go. The cuckoo filters hold the
frequent keys in shards of bounded size. Cleaning probes the filters first, which settles nearly
all lines without a join, and asks the exact table about the rest, so a false positive never costs
a line.

Counts are sums, so they can be taken back: ``change_counts`` adds inserted documents and subtracts
deleted ones, ``change_filters`` inserts keys that became frequent and deletes those that no longer
are. The result equals a build from scratch over the remaining documents.

Nulls, empties, repeats: a null or empty text is one empty line, which has no key and stays. Every
row is one document, repeated rows count as often as they occur; a key counts once per document.
Null ids are ids. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import SPACE, parts_for, pick, texts
from tidewater.sources.durable import durable

SHARD_KEYS = 1 << 16         # frequent keys in one filter shard, on average
SLOTS = 4
FILTER_BYTES = 64 << 20      # largest filters (and exact keys) that are sent to every executor


def keys_of(text: bytes, min_chars: int) -> list[bytes]:
    """Key of every line, ``b""`` for lines without one."""
    keys = [line.strip(SPACE).lower() for line in text.split(b"\n")]
    return keys if min_chars <= 1 else [k if len(k.decode("utf-8", "replace")) >= min_chars else b"" for k in keys]


def digests(keys: list[bytes]) -> np.ndarray:
    """Two signed 64-bit numbers per key."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(k) for k in keys]), "<i8").reshape(-1, 2)


def reference_counts(docs: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """(h1, h2, refs): in how many documents each key occurs."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes] = []
            for t in texts(batch):
                own = set(keys_of(t, min_chars))
                own.discard(b"")
                found.extend(own)
            both = digests(found)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["h1", "h2"])

    return pick(docs, text=text).mapInArrow(emit, "h1 long, h2 long").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("refs"))


def change_counts(counts: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None,
                  text: str = "text", min_chars: int = 1) -> DataFrame:
    """Counts after documents came and went; keys nobody refers to any more disappear."""
    every = counts.select("h1", "h2", "refs")
    if inserted is not None:
        every = every.unionByName(reference_counts(inserted, text, min_chars))
    if deleted is not None:
        every = every.unionByName(reference_counts(deleted, text, min_chars).withColumn("refs", -F.col("refs")))
    return every.groupBy("h1", "h2").agg(F.sum("refs").alias("refs")).filter("refs > 0")


class Cuckoo:
    """Cuckoo filter: 16-bit fingerprints, four to a bucket, two buckets a key."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @staticmethod
    def places(h1: np.ndarray, h2: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (h2.astype(np.uint64) >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (h2.astype(np.uint64) & np.uint64(buckets - 1)).astype(np.int64)
        return mark, first, first ^ Cuckoo.jump(mark, buckets)

    @staticmethod
    def jump(mark, buckets: int):
        return (mark.astype(np.int64) * 0x5BD1E995 >> 7) & (buckets - 1)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> Cuckoo:
        """With all keys in; grows (which needs the keys again) only through ``build``."""
        t, n = self.table, len(self.table)
        for mark, a, b in zip(*self.places(h1, h2, n), strict=True):
            at = a
            for place in (a, b):
                free = np.flatnonzero(t[place] == 0)
                if len(free):
                    t[place, free[0]] = mark
                    break
            else:
                for step in range(500):
                    slot = step % SLOTS
                    mark, t[at, slot] = t[at, slot], mark
                    at = int(at ^ self.jump(np.uint16(mark), n))
                    free = np.flatnonzero(t[at] == 0)
                    if len(free):
                        t[at, free[0]] = mark
                        break
                else:
                    raise OverflowError("filter full")
        return self

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> Cuckoo:
        """Take out keys that are in."""
        for mark, a, b in zip(*self.places(h1, h2, len(self.table)), strict=True):
            for place in (a, b):
                held = np.flatnonzero(self.table[place] == mark)
                if len(held):
                    self.table[place, held[0]] = 0
                    break
        return self

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        mark, a, b = self.places(h1, h2, len(self.table))
        return ((self.table[a] == mark[:, None]) | (self.table[b] == mark[:, None])).any(axis=1)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> Cuckoo:
        room = len(h1)
        while True:
            try:
                return cls.sized(room).insert(h1, h2)
            except OverflowError:
                room *= 2


def build_filters(frequent: DataFrame, shards: int) -> DataFrame:
    """(shard, buckets, body): one filter for each shard of the frequent keys, built on the executors."""

    def one(key, part: pd.DataFrame) -> pd.DataFrame:
        table = Cuckoo.build(part["h1"].to_numpy(), part["h2"].to_numpy()).table
        return pd.DataFrame({"shard": [key[0]], "buckets": [len(table)], "body": [table.tobytes()]})

    parts = frequent.select("h1", "h2", F.pmod("h1", F.lit(shards)).alias("shard"))
    return parts.groupBy("shard").applyInPandas(one, "shard long, buckets long, body binary")


def change_filters(filters: DataFrame, added: DataFrame, removed: DataFrame, shards: int) -> DataFrame:
    """Filters after keys became frequent (``added``) or stopped being so (``removed``). A full shard raises: rebuild then."""

    def one(key, old: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
        here = Cuckoo(np.frombuffer(old["body"].iloc[0], np.uint16).reshape(-1, SLOTS).copy()) if len(old) else Cuckoo.sized(SHARD_KEYS)
        for new in (False, True):
            own = change[change["new"] == new]
            getattr(here, "insert" if new else "delete")(own["h1"].to_numpy(), own["h2"].to_numpy())
        return pd.DataFrame({"shard": [key[0]], "buckets": [len(here.table)], "body": [here.table.tobytes()]})

    change = added.select("h1", "h2", F.lit(True).alias("new")).unionByName(removed.select("h1", "h2", F.lit(False).alias("new")))
    change = change.withColumn("shard", F.pmod("h1", F.lit(shards)))
    return filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(one, "shard long, buckets long, body binary")


def _probe(h: np.ndarray, tables: dict[int, np.ndarray], shards: int) -> np.ndarray:
    """Which keys the filters may hold."""
    hit, shard = np.zeros(len(h), bool), h[:, 0] % shards
    for s in np.unique(shard):
        if (table := tables.get(int(s))) is not None:
            at = np.flatnonzero(shard == s)
            hit[at] = Cuckoo(table).holds(h[at, 0], h[at, 1])
    return hit


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which rows of ``h`` are rows of ``known``, which is sorted."""
    hit, at = np.zeros(len(h), bool), np.searchsorted(known[:, 0], h[:, 0])
    while True:
        same = (at < len(known)) & ~hit
        same[same] = known[at[same], 0] == h[same, 0]
        if not same.any():
            return hit
        hit[same] = known[at[same], 1] == h[same, 1]
        at = at + 1


def clean_lines(docs: DataFrame, counts: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 10,
                min_chars: int = 1, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(doc_id, kept, n_lines, n_dropped): documents without their frequent lines, one row per row of ``docs``.

    Filters and frequent keys that fit ``filter_bytes`` are sent to the executors and the text is read once.
    Otherwise all line keys meet the exact table in a shuffled join. Both ways return the same rows.
    """
    spark = docs.sparkSession
    frequent = durable(counts.filter(F.col("refs") >= min_docs).select("h1", "h2"), "frequent")
    n = frequent.count()
    base = pick(docs, doc_id=doc_id, text=text)
    id_type = base.schema["doc_id"].dataType.simpleString()
    if n * 20 > filter_bytes:
        return _clean_by_join(base, frequent, min_chars)
    shards = parts_for(n, SHARD_KEYS)
    filters = {int(r.shard): np.frombuffer(r.body, np.uint16).reshape(-1, SLOTS) for r in build_filters(frequent, shards).toLocalIterator()}
    exact = frequent.toPandas().sort_values(["h1", "h2"]).to_numpy("<i8")
    sent = spark.sparkContext.broadcast((filters, exact))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, known = sent.value
        for batch in batches:
            bodies = texts(batch)
            keys = [keys_of(t, min_chars) for t in bodies]
            flat = [k for own in keys for k in own]
            h = digests(flat)
            drop = _probe(h, tables, shards) & np.fromiter(map(len, flat), np.int64, len(flat)).astype(bool)
            maybe = np.flatnonzero(drop)
            if len(maybe):
                drop[maybe] = _among(h[maybe], known)
            kept, lines, dropped, at = [], [], [], 0
            for body, own in zip(bodies, keys, strict=True):
                gone = drop[at:at + len(own)]
                at += len(own)
                if gone.any():
                    body = b"\n".join([line for line, g in zip(body.split(b"\n"), gone.tolist(), strict=True) if not g])
                kept.append(body)
                lines.append(len(own))
                dropped.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()),
                                              pa.array(dropped, pa.int64())], ["doc_id", "kept", "n_lines", "n_dropped"])

    return base.mapInArrow(run, f"doc_id {id_type}, kept string, n_lines long, n_dropped long")


def _clean_by_join(base: DataFrame, frequent: DataFrame, min_chars: int) -> DataFrame:
    """The same by joins: rows of equal id and text share their lines, so (id, text hash) names them."""
    id_type = base.schema["doc_id"].dataType.simpleString()
    base = base.withColumn("th", F.xxhash64("text"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, flat = [], [], []
            for i, t in enumerate(texts(batch)):
                for p, k in enumerate(keys_of(t, min_chars)):
                    if k:
                        row.append(i)
                        pos.append(p)
                        flat.append(k)
            h = digests(flat)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("th").take(take), pa.array(pos, pa.int32()),
                                              pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], ["doc_id", "th", "pos", "h1", "h2"])

    lines = base.mapInArrow(emit, f"doc_id {id_type}, th long, pos int, h1 long, h2 long")
    gone = lines.join(frequent, ["h1", "h2"]).groupBy("doc_id", "th").agg(F.collect_set("pos").alias("gone"))
    both = base.alias("b").join(gone.alias("g"), F.col("b.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("b.th") == F.col("g.th")), "left")
    every = F.split(F.coalesce("b.text", F.lit("")), "\n", -1)
    kept = F.filter(every, lambda _, i: ~F.array_contains(F.coalesce("g.gone", F.array().cast("array<int>")), i))
    return both.select("b.doc_id", F.array_join(kept, "\n").alias("kept"), F.size(every).cast("long").alias("n_lines"),
                       (F.size(every) - F.size(kept)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Counts and cleaning in one go, see ``clean_lines``."""
    return clean_lines(docs, durable(reference_counts(docs, text, min_chars), "line-refs"), doc_id, text, min_docs, min_chars)

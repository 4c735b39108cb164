"""Helpers the training-data operators share."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: ASCII white space, as text bodies and contracts define it.
SPACE = b" \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Columns ``wanted`` (new name = old name), found by exact spelling.

    Other columns are left behind, also those whose names differ only in case or occur twice.
    """
    names = df.columns
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_{names.index(old)}").alias(new) for new, old in wanted.items()])


def carried(df: DataFrame, **wanted: str) -> DataFrame:
    """``pick``, and all columns as ``_row``, a struct whose fields are named by their places, so no name can clash."""
    names = df.columns
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    return plain.select(F.struct(*plain.columns).alias("_row"), *[F.col(f"_{names.index(old)}").alias(new) for new, old in wanted.items()])


def restored(rows: DataFrame, df: DataFrame) -> DataFrame:
    """The columns of ``df`` again, from ``_row``."""
    return rows.select(*[F.col("_row").getField(f"_{i}") for i in range(len(df.columns))]).toDF(*df.columns)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null reads as empty."""
    return [b or b"" for b in batch.column(name).cast(pa.binary()).to_pylist()]


def parts_for(rows: int, per_part: int) -> int:
    """How many parts keep each at about ``per_part`` rows."""
    return max(1, math.ceil(rows / per_part))


def blocks_of(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """[from, to) of consecutive items that together hold about ``most`` (one item at least)."""
    first = held = at = 0
    for at, size in enumerate(sizes, 1):
        held += size
        if held >= most:
            yield first, at
            first, held = at, 0
    if at > first:
        yield first, at


class LevelFilter:
    """Bloom filter of (64-bit key, level) with a level of one byte: a key of level n is a member at levels 1 to n.

    Keys are dealt to segments, each with its own number of bits (a power of two), so segments are built apart.
    """

    PROBES = 4

    def __init__(self, bodies: list[bytes]):
        self.bits = np.array([len(b) * 8 for b in bodies], np.uint64)
        self.first = np.cumsum([0, *map(len, bodies)]).astype(np.int64)[:-1]
        self.body = np.frombuffer(b"".join(bodies), np.uint8)

    @staticmethod
    def mixed(keys: np.ndarray, salt) -> np.ndarray:
        h = (keys ^ np.asarray(salt, np.uint64) * np.uint64(0xA0761D6478BD642F)) * np.uint64(0xE7037ED1A0B428DB)
        h ^= h >> np.uint64(32)
        h = h * np.uint64(0x8EBC6AF09C88C6E3)
        return h ^ h >> np.uint64(29)

    @classmethod
    def places(cls, keys: np.ndarray, levels, bits) -> Iterator[np.ndarray]:
        """Bit numbers of the probes of (key, level) in a segment of ``bits`` bits."""
        h = cls.mixed(keys, levels)
        step = h >> np.uint64(32) | np.uint64(1)
        for _ in range(cls.PROBES):
            yield h & (bits - np.uint64(1))
            h = h + step

    @classmethod
    def segment(cls, keys: np.ndarray, levels: np.ndarray, bits_per_entry: float, most: int) -> bytes:
        """One segment of up to ``most`` bits that holds ``keys`` up to their levels."""
        wanted = math.ceil(math.log2(max(1, int(levels.sum())) * bits_per_entry))
        bits = 1 << max(6, min(wanted, int(math.log2(most))))
        body = np.zeros(bits, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            for at in cls.places(keys[levels >= level], level, np.uint64(bits)):
                body[at.astype(np.int64)] = True
        return np.packbits(body, bitorder="little").tobytes()

    def holds(self, keys: np.ndarray, level: int) -> np.ndarray:
        own = (keys >> np.uint64(40)) % np.uint64(len(self.bits))
        first, bits, hit = self.first[own.astype(np.int64)], self.bits[own.astype(np.int64)], np.ones(len(keys), bool)
        for at in self.places(keys, level, bits):
            at = at.astype(np.int64)
            hit &= (self.body[first + (at >> 3)] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return hit

    def levels(self, keys: np.ndarray, highest: int) -> np.ndarray:
        """Level of each key: probes go up until one misses."""
        out, left = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for level in range(1, highest + 1):
            left = left[self.holds(keys[left], level)]
            if not len(left):
                break
            out[left] = level
        return out

    @classmethod
    def build(cls, items: DataFrame, n: int, bounds: list[int], max_bytes: int, bits_per_entry: float = 6.0, per_segment: int = 1 << 17) -> LevelFilter:
        """From ``n`` rows (key long, count long) of distinct keys; a key's level is the number of ``bounds`` its count reaches.

        Segments are built by the executors. The filter takes at most ``max_bytes``: past that entries get fewer bits each.
        """
        segments, levels_at = max(1, -(-n // per_segment)), np.array(bounds, np.int64)
        most = max(64, max_bytes * 8 // segments)

        def one(batch: pa.Table) -> pa.Table:
            level = np.searchsorted(levels_at, batch["count"].to_numpy(), "right")
            body = cls.segment(batch["key"].to_numpy().astype(np.uint64), level, bits_per_entry, most)
            return pa.table({"segment": batch["segment"].slice(0, 1), "body": pa.array([body], pa.binary())})

        own = F.pmod(F.shiftrightunsigned("key", 40), F.lit(segments)).cast("int").alias("segment")
        made = items.select("key", "count", own).groupBy("segment").applyInArrow(one, "segment int, body binary").toArrow().to_pydict()
        bodies = dict(zip(made["segment"], made["body"], strict=True))
        return cls([bodies.get(s, bytes(8)) for s in range(segments)])

"""Phrases whose words keep together, counted in counting quotient filters.

Texts are cut at punctuation and line ends into pieces, pieces at blanks into words. Word ids are hashes of (language,
word), just wide enough that the words that matter have different ids, which is checked; a clash takes another seed.
An n-gram packs n ids. An invertible permutation of the packed bits spreads n-grams evenly; the first bits name the
shard, the next ones the quotient, everything else is the remainder, kept whole. So the counters are exact: a filter is
a sorted list of permuted n-grams that can be turned back into ids. Tasks write one small filter a shard, the filters
of a shard are merged as sorted lists, and phrases that occur often enough are read out.

Lengths are counted in turn. An n-gram can only be frequent if the two shorter ones in it are, so those that a Bloom
filter of the frequent shorter ones denies are not counted. The filter is of bounded size; its false positives cost
time, not results.

Nulls, empties, ties: null text is empty, null language reads ``und``. Repeated rows count as often as they occur; ids
are not looked at. Equal scores of cuts go to the shorter first part; phrases rank by score, count, phrase. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.shared import LevelFilter, blocks_of, parts_for, pick
from tidewater.sources.durable import durable

#: Fixed values of the contract: pieces end at these, words at blanks.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
UNKNOWN_LANG = "und"

_TO_ENDS = bytes(10 if c in PIECE_ENDS else 32 if c == 9 else c for c in range(256))
TASK_GRAMS = 1 << 21          # n-grams a task holds before it writes filters
SHARD_GRAMS = 1 << 21         # n-gram occurrences a shard is made for
PART_PHRASES = 1 << 17        # candidates of a language that one task ranks
FILTER_BYTES = 32 << 20       # largest Bloom filter that is sent to the executors
_HASHES = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def tokens(text: bytes) -> list[bytes]:
    """Lower-case words, with a line feed wherever a piece ends."""
    return [w for w in text.lower().translate(_TO_ENDS).replace(b"\n", b" \n ").split(b" ") if w]


def word_seed(lang: str, attempt: int) -> int:
    """``xxhash64(concat(lang, attempt))`` of Spark; it is the seed of the word's hash."""
    return xxhash.xxh64_intdigest(f"{lang} {attempt}".encode(), 42)


class Packing:
    """n ids of ``width`` bits each, permuted and cut into shard, quotient and remainder."""

    def __init__(self, width: int):
        self.width, self.mask = np.uint64(width), np.uint64((1 << width) - 1)
        self.bytes = -(-width // 8)

    def _mix(self, x: np.ndarray, by: np.uint64) -> np.ndarray:
        x = x * by
        x ^= x >> np.uint64(32)
        x = x * _HASHES[0]
        return (x ^ x >> np.uint64(29)) & self.mask

    def permute(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """The first column is evenly spread afterwards; ``restore`` gives the ids back."""
        first = ids[0]
        for k, other in enumerate(ids[1:], 1):
            first = first ^ self._mix(other, _HASHES[k % 3] + np.uint64(2 * k))
        return [first, *(x ^ self._mix(first, _HASHES[k % 3] ^ np.uint64(4 * k)) for k, x in enumerate(ids[1:], 1))]

    def restore(self, permuted: list[np.ndarray]) -> list[np.ndarray]:
        first = permuted[0]
        rest = [x ^ self._mix(first, _HASHES[k % 3] ^ np.uint64(4 * k)) for k, x in enumerate(permuted[1:], 1)]
        for k, other in enumerate(rest, 1):
            first = first ^ self._mix(other, _HASHES[k % 3] + np.uint64(2 * k))
        return [first, *rest]

    def shard_of(self, first: np.ndarray, bits: int) -> np.ndarray:
        return (first >> (self.width - np.uint64(bits))).astype(np.int64) if bits else np.zeros(len(first), np.int64)


def summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct n-grams with their added counts."""
    if not len(counts):
        return columns, counts
    order = np.lexsort(columns[::-1])
    columns, counts = [c[order] for c in columns], counts[order]
    new = np.ones(len(counts), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(counts, at)


class QuotientFilter:
    """Sorted permuted n-grams of one shard, with counts, as bytes.

    Layout: number of entries and quotient bits; one bit for each quotient, set if it has entries; one bit for each
    entry, set on the last one of its quotient; the remainders, in whole bytes a column; counts as one byte each,
    255 standing for a count that follows in eight bytes.
    """

    @staticmethod
    def pack(packing: Packing, columns: list[np.ndarray], counts: np.ndarray, shard_bits: int) -> bytes:
        n, free = len(counts), int(packing.width) - shard_bits
        bits = min(free, max(3, math.ceil(math.log2(max(1, n)))))
        low = np.uint64(free - bits)
        quotient = (columns[0] >> low & np.uint64((1 << bits) - 1)).astype(np.int64)
        occupied = np.zeros(1 << bits, bool)
        occupied[quotient] = True
        ends = np.ones(n, bool)
        ends[:-1] = quotient[1:] != quotient[:-1]
        parts = [np.array([n, bits], "<i8").tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
                 QuotientFilter._bytes(columns[0] & np.uint64((1 << int(low)) - 1), -(-int(low) // 8))]
        parts += [QuotientFilter._bytes(c, packing.bytes) for c in columns[1:]]
        return b"".join([*parts, np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes()])

    @staticmethod
    def _bytes(column: np.ndarray, width: int) -> bytes:
        return np.ascontiguousarray(column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()

    @staticmethod
    def unpack(packing: Packing, body: bytes, size: int, shard: int, shard_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
        n, bits = (int(x) for x in np.frombuffer(body, "<i8", 2))
        low, at = int(packing.width) - shard_bits - bits, 16

        def take(length: int) -> np.ndarray:
            nonlocal at
            at += length
            return np.frombuffer(body, np.uint8, length, at - length)

        def column(width: int) -> np.ndarray:
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :width] = take(n * width).reshape(n, width)
            return wide.view("<u8").reshape(n).astype(np.uint64)

        occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << bits) // 8)), count=1 << bits))
        ends = np.unpackbits(take(-(-n // 8)), count=n).astype(np.int64)
        quotient = occupied[np.cumsum(ends) - ends].astype(np.uint64) if n else np.zeros(0, np.uint64)
        first = column(-(-low // 8)) | quotient << np.uint64(low)
        if shard_bits:
            first |= np.uint64(shard) << np.uint64(low + bits)
        columns = [first, *(column(packing.bytes) for _ in range(size - 1))]
        counts = take(n).astype(np.int64)
        counts[counts == 255] = np.frombuffer(body, "<i8", int((counts == 255).sum()), at)
        return columns, counts


def _base(docs: DataFrame, lang: str, text: str) -> DataFrame:
    own = pick(docs, lang=lang, text=text)
    return own.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("body"))


def word_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, word binary, f): occurrences of every word."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            n = [len(own) for own in held.values()]
            langs = pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(n)), n), pa.array(list(held), pa.string())).cast(pa.string())
            return pa.RecordBatch.from_arrays([langs, pa.array([w for own in held.values() for w in own], pa.binary()),
                                               pa.array([c for own in held.values() for c in own.values()], pa.int64())], ["lang", "word", "f"])

        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(tokens(body))
            if sum(map(len, held.values())) > TASK_GRAMS // 4:
                yield rows()
                held = {}
        if held:
            yield rows()

    return _base(docs, lang, text).mapInArrow(emit, "lang string, word binary, f long").filter(F.col("word") != F.lit(b"\n")).groupBy("lang", "word").agg(F.sum("f").alias("f"))


def frequent_words(words: DataFrame, min_count: int) -> tuple[DataFrame, int, int, int]:
    """(lang, word, f, id) of words with ``min_count`` occurrences, how many they are, the seed's number, bits of an id."""
    often = durable(words.filter(F.col("f") >= min_count), "words")
    n = often.count()
    width = min(64, max(24, math.ceil(2 * math.log2(max(2, n))) + 3))
    attempt = 0
    while True:
        hashed = F.shiftrightunsigned(F.xxhash64(F.concat_ws(" ", "lang", F.lit(str(attempt))), "word"), 64 - width)
        named = durable(often.withColumn("id", hashed), "word-ids")
        if named.agg(F.count_distinct("id")).first()[0] == n:
            return named, n, attempt, width
        attempt += 1


def _key(ids: list[np.ndarray]) -> np.ndarray:
    """64-bit key of n-grams for the Bloom filter; it may clash."""
    key = np.full(len(ids[0]), len(ids), np.uint64)
    for own in ids:
        key = (key ^ own) * _HASHES[1]
        key ^= key >> np.uint64(30)
    return key


def _pruner(phrases: DataFrame, n: int, size: int) -> LevelFilter:
    """Bloom filter of the frequent phrases of one length."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("ids").flatten().to_numpy().astype(np.uint64).reshape(-1, size)
            yield pa.RecordBatch.from_arrays([pa.array(_key([flat[:, k] for k in range(size)]).view(np.int64))], ["key"])

    return LevelFilter.build(phrases.select("ids").mapInArrow(emit, "key long").withColumn("count", F.lit(1)), n, [1], FILTER_BYTES, bits_per_entry=10)


def count_phrases(docs: DataFrame, size: int, min_count: int, shorter: DataFrame, n_shorter: int, attempt: int, width: int, shards: int, lang: str = "lang", text: str = "text") -> DataFrame:
    """(ids, f) of the phrases of ``size`` words with ``min_count`` occurrences, given the shorter ones by one word."""
    packing, shard_bits = Packing(width), max(0, math.ceil(math.log2(shards)))
    sent = docs.sparkSession.sparkContext.broadcast(_pruner(shorter, n_shorter, size - 1))
    shift = np.uint64(64 - width)

    def grams(rows: list[tuple[str, bytes]]) -> list[np.ndarray]:
        own, stops, at = [], [], 0
        for language, body in rows:
            seed, words = seeds.setdefault(language, word_seed(language, attempt)), tokens(body)
            words.append(b"\n")
            own.append(np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words)))
            ends = [i for i, w in enumerate(words) if w == b"\n"]
            stops.append(np.array(ends, np.int64) + at)
            at += len(words)
        ids = np.concatenate(own) >> shift
        free = np.ones(len(ids), bool)
        free[np.concatenate(stops)] = False
        pruner, part = sent.value, size - 1
        room = max(0, len(ids) - part + 1)
        whole = free[:room].copy()
        for k in range(1, part):
            whole &= free[k:room + k]
        at = np.flatnonzero(whole)
        keys, back = np.unique(_key([ids[at + k] for k in range(part)]), return_inverse=True)
        often = np.zeros(len(ids) + 1, bool)
        often[at[pruner.holds(keys, 1)[back]]] = True
        at = np.flatnonzero(often[:-1] & often[1:])
        return packing.permute([ids[at + k] for k in range(size)])

    def written(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        columns, counts = summed(columns, np.ones(len(columns[0]), np.int64))
        shard = packing.shard_of(columns[0], shard_bits)
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)] if len(shard) else [0]
        spans = list(zip(cuts, cuts[1:]))
        bodies = [QuotientFilter.pack(packing, [c[a:b] for c in columns], counts[a:b], shard_bits) for a, b in spans]
        return pa.RecordBatch.from_arrays([pa.array([int(shard[a]) for a, _ in spans], pa.int64()), pa.array(bodies, pa.binary())], ["shard", "body"])

    seeds: dict[str, int] = {}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            bodies, langs = batch.column("body").to_pylist(), batch.column("lang").to_pylist()
            for lo, hi in blocks_of(map(len, bodies), 1 << 22):
                held.append(grams(list(zip(langs[lo:hi], bodies[lo:hi], strict=True))))
                n += len(held[-1][0])
                if n >= TASK_GRAMS:
                    yield written(held)
                    held, n = [], 0
        if n:
            yield written(held)

    def merged(part: pa.Table) -> pa.Table:
        """Frequent phrases of a shard, from its filters, a few at a time."""
        shard, total = part["shard"][0].as_py(), None
        bodies = part["body"].to_pylist()
        for lo, hi in blocks_of(map(len, bodies), 16 << 20):
            read = [QuotientFilter.unpack(packing, b, size, shard, shard_bits) for b in bodies[lo:hi]] + ([total] if total else [])
            total = summed([np.concatenate(c) for c in zip(*(r[0] for r in read), strict=True)], np.concatenate([r[1] for r in read]))
        columns, counts = total
        often = counts >= min_count
        ids = np.stack([c[often] for c in packing.restore(columns)], axis=1).astype(np.int64)
        ends = np.arange(0, ids.size + 1, size, dtype=np.int32)
        return pa.table({"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.reshape(-1))), "f": pa.array(counts[often])})

    made = _base(docs, lang, text).mapInArrow(emit, "shard long, body binary")
    return made.groupBy("shard").applyInArrow(merged, "ids array<long>, f long")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, percent: int = 50, top: int | None = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of every language.

    A phrase of 2 to ``max_words`` words that occurs a >= ``min_count`` times scores floor(1000000 * a * a / (l * r)) at
    its lowest-scoring cut. Phrases that a longer one covers in ``percent`` of 100 occurrences go.
    """
    words = durable(word_counts(docs, lang, text), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    every = words.agg(F.sum("f")).first()[0] or 0
    named, n, attempt, width = frequent_words(words, min_count)
    levels = [named.select(F.array("id").alias("ids"), "f")]
    for size in range(2, max_words + 1):
        found = count_phrases(docs, size, min_count, levels[-1], n, attempt, width, parts_for(every, SHARD_GRAMS), lang, text)
        levels.append(durable(found, "phrases"))
        n = levels[-1].count()
    phrases = reduce(DataFrame.union, levels)
    scored = durable(_scored(phrases.filter(F.size("ids") > 1), phrases, percent), "scored")
    named = named.select("id", "lang", F.decode("word", "utf-8").alias("word"))
    spelt = scored.select("*", F.posexplode("ids").alias("at", "id")).join(named, "id").groupBy("ids").agg(
        *[F.first(c).alias(c) for c in ("lang", "a", "l", "r", "score")], F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x.word), " ").alias("phrase"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        # A language's best are among the best of its parts, so no task sees more than a part of it and the parts' best.
        part = F.pmod(F.xxhash64("phrase"), F.lit(parts_for(scored.count(), PART_PHRASES)))
        within = Window.partitionBy("lang", part).orderBy(*order)
        spelt = spelt.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= top)
    ranked = spelt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _scored(candidates: DataFrame, phrases: DataFrame, percent: int) -> DataFrame:
    """(ids, a, l, r, score) of the candidates that no longer one covers."""
    part = F.col("ids")
    cuts = candidates.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    sides = cuts.select("ids", "a", "k", F.slice(part, F.lit(1), F.col("k")).alias("first"), F.slice(part, F.col("k") + 1, F.size("ids")).alias("rest"))
    first, rest = (phrases.select(F.col("ids").alias(side), F.col("f").alias(name)) for side, name in (("first", "l"), ("rest", "r")))
    wide = "decimal(15,0)"
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * cast(a as {wide}) * cast(a as {wide})) div (cast(l as {wide}) * cast(r as {wide}))")
    scored = sides.join(first, "first").join(rest, "rest").withColumn("score", score)
    lowest = scored.groupBy("ids").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("ids", "cut.a", "cut.l", "cut.r", "cut.score")
    size = F.size("ids")
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice(part, i, m)))))
    covered = candidates.filter(size > 2).select(inner.alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longer"))
    return lowest.join(covered, "ids", "left").filter(F.coalesce(F.col("longer") * 100 < F.col("a") * percent, F.lit(True))).drop("longer")

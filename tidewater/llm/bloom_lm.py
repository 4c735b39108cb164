"""Language model whose counts live in a log-frequency Bloom filter.

Words and word pairs of the training texts are counted with Spark. A count is quantised to the number of bounds it
reaches; the bounds grow by half, so the level is logarithmic. The filter holds every n-gram together with each of its
levels from 1 up, and no count: a reader probes level 1, 2, ... until a probe misses. Probabilities come from the
levels alone. The lowest count of a level stands for a word or pair, the highest one for a context, so that the
probabilities of the words seen after a context never add up to more than one:

    p(w) = (c(w) + 1) / (N + V + 1)        p(w | h) = (c(h w) + K * p(w)) / (c(h) + K), or p(w) if h has no level

The filter grows with the training text and is never in one place: n-grams are dealt to segments by their hash, and there
is one segment for each ``SEGMENT`` bytes of text. Tasks pass on the distinct n-grams of some millions of tokens, an
array a segment; a segment's task adds up counts and builds its part of the filter. For scoring, rows are dealt to
blocks of about ``BLOCK_TEXT`` bytes. The distinct n-grams of a block go to the segments, a byte of level for each and
the exact counts of words come back to the block, and there its texts are scored. Nothing of this is broadcast.

Nulls, empties, repeats: a null or empty text is its end token alone. A null mark counts as training text. Repeated
rows count and are scored as often as they occur; ids are carried along. Words and pairs are told
apart by 64-bit hashes. Extra columns are ignored. An empty table gives an empty result; without training text every base score is zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from tidewater.llm.shared import LevelFilter, blocks_of, parts_for, pick, texts
from tidewater.sources.durable import durable, settled

SEGMENT = 8 << 20            # bytes of training text for which there is one segment of the filter
BITS = 6.0                   # of the filter for each level of an n-gram, at least
BLOCK_TEXT = 8 << 20         # bytes of text scored together
TASK_GROUPS = 2              # segments or blocks of a task, about, where there are many
PROBED = 1 << 19             # n-grams looked up at once
PART_GRAMS = 1 << 17         # n-grams of one length that share a stretch of bits in a segment
EXACT_SHARE = 1 << 20        # not read any more: the exact count of every word comes with its level
STEP = 1.5                   # between the bounds of levels
SMOOTHING = 32.0             # K: weight of the word's own probability
TASK_GRAMS = 1 << 22         # tokens a task holds before it passes counts on
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))


def bounds_from(least: int) -> list[int]:
    """Least counts of the levels."""
    out = [max(1, least)]
    while out[-1] < 1 << 60:
        out.append(max(out[-1] + 1, int(out[-1] * STEP)))
    return out


def stream(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed tokens of texts one after another, each closed by END, and where texts start."""
    own = [b.lower().split() for b in bodies]
    ends = np.cumsum([len(w) + 1 for w in own])
    out = np.full(ends[-1] if len(ends) else 0, END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[inner] = np.fromiter((xxhash.xxh3_64_intdigest(w) for words in own for w in words), np.uint64, len(out) - len(own))
    return out, np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else np.zeros(0, np.int64)


def contexts(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The token before each one; texts begin after an end."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = END
    return before


def pairs(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    key = (before ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
    key = (key ^ key >> np.uint64(31) ^ tokens) * np.uint64(0x165667B19E3779F9)
    return key ^ key >> np.uint64(29)


def _streams(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``stream`` of texts of any size, a few million bytes at a time."""
    tokens, starts, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for lo, hi in blocks_of(map(len, bodies), 1 << 22):
        own, first = stream(bodies[lo:hi])
        tokens.append(own)
        starts.append(first + n)
        n += len(own)
    return np.concatenate(tokens), np.concatenate(starts)


def _dealt(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by their segment, and where each segment begins in it; the end is last."""
    own = (keys >> np.uint64(40)) % np.uint64(segments)
    order = np.argsort(own.astype(np.uint16 if segments <= 1 << 16 else np.uint32), kind="stable")
    return order, np.searchsorted(own[order], np.arange(segments + 1))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte of their places, so that shuffles compress them."""
    return np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.uint8).reshape(8, -1).T.copy().reshape(-1).view("<u8")


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _keys_of(bodies: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.cumsum(_unpacked(b), dtype=np.uint64) for b in bodies.to_pylist()]


def _by(rows: DataFrame, groups: int, *keys: str) -> GroupedData:
    """``rows`` by keys that have so many groups; many groups take more shuffle partitions than are set, so that a task has few."""
    wanted = parts_for(groups, TASK_GROUPS)
    more = wanted > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(wanted, *keys) if more else rows).groupBy(*keys)


def _size(docs: DataFrame) -> int:
    """Bytes of all texts, and one for each row."""
    return docs.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1).cast("long")), F.lit(0))).first()[0]


def gram_counts(docs: DataFrame, segments: int) -> DataFrame:
    """(segment, words, times, pairs, pair_times): ascending keys and their counts in some of the texts, packed."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            columns = []
            for parts in held:
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                order, at = _dealt(keys, segments)
                columns += [[f(x[a:b]) for a, b in zip(at, at[1:])] for f, x in ((_packed_keys, keys[order]), (_packed, counts[order]))]
            filled = [i for i in range(segments) if columns[0][i] or columns[2][i]]
            return pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), *[pa.array([c[i] for i in filled], pa.binary()) for c in columns]],
                                              ["segment", "words", "times", "pairs", "pair_times"])

        held, n = ([], []), 0
        for batch in batches:
            bodies = texts(batch)
            for lo, hi in blocks_of(map(len, bodies), 1 << 22):
                own, starts = stream(bodies[lo:hi])
                held[0].append(own)
                held[1].append(pairs(contexts(own, starts), own))
                n += len(own)
                if n >= TASK_GRAMS:
                    yield rows()
                    held, n = ([], []), 0
        if n:
            yield rows()

    return docs.mapInArrow(emit, "segment int, words binary, times binary, pairs binary, pair_times binary")


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their summed counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first) if len(keys) else np.zeros(0, np.int64)


def _filled(keys: np.ndarray, counts: np.ndarray, bounds: list[int]) -> pa.Array:
    """The bodies of a ``LevelFilter`` of ``keys``, as one row."""
    number = parts_for(len(keys), PART_GRAMS)
    level, own = np.searchsorted(bounds, counts, "right"), (keys >> np.uint64(40)) % np.uint64(number)
    return pa.array([[LevelFilter.segment(keys[own == s], level[own == s], BITS, 1 << 62) for s in range(number)]], pa.list_(pa.binary()))


@dataclass
class _Segments:
    """Filters of all segments in one place."""

    own: list[LevelFilter]

    def levels(self, keys: np.ndarray, highest: int) -> np.ndarray:
        out, order = np.zeros(len(keys), np.int64), _dealt(keys, len(self.own))
        for held, a, b in zip(self.own, order[1], order[1][1:]):
            out[order[0][a:b]] = held.levels(keys[order[0][a:b]], highest)
        return out


@dataclass
class Model:
    """``segments`` (segment, words, pairs, keys, counts) is a table: filters of both lengths, and the words with their counts, packed."""

    segments: DataFrame
    number: int
    n: int
    v: int
    bounds: list[int]

    @property
    def filters(self) -> list[_Segments]:
        """The filters of words and of pairs, for a look at small models: ``score`` leaves them in their segments."""
        held = {r.segment: r for r in self.segments.select("segment", "words", "pairs").collect()}
        return [_Segments([LevelFilter([bytes(b) for b in held[s][name]] if s in held else [bytes(8)]) for s in range(self.number)]) for name in ("words", "pairs")]


def train(docs: DataFrame, text: str = "text") -> Model:
    """Counts of every text of ``docs``, and the filter."""
    base = pick(docs, text=text)
    number, bounds = parts_for(_size(base), SEGMENT), bounds_from(1)

    def build(rows: pa.Table) -> pa.Table:
        words, times = _added(_joined(_keys_of(rows["words"])), _joined([_unpacked(b) for b in rows["times"].to_pylist()]))
        both, pair_times = _added(_joined(_keys_of(rows["pairs"])), _joined([_unpacked(b) for b in rows["pair_times"].to_pylist()]))
        return pa.table({"segment": rows["segment"].slice(0, 1), "words": _filled(words, times, bounds), "pairs": _filled(both, pair_times, bounds),
                         "keys": pa.array([_packed_keys(words)], pa.binary()), "counts": pa.array([_packed(times)], pa.binary()), "n": [int(times.sum())], "v": [len(words)]})

    made = _by(gram_counts(base, number), number, "segment").applyInArrow(
        build, "segment int, words array<binary>, pairs array<binary>, keys binary, counts binary, n long, v long")
    segments = durable(made, "segments")
    n, v = segments.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    return Model(segments.drop("n", "v"), number, n, v, bounds)


def log_probabilities(tokens: np.ndarray, starts: np.ndarray, filters: list[LevelFilter], bounds: np.ndarray, n: int, v: int) -> np.ndarray:
    """log10 p of every token, from levels alone."""
    words, at = np.unique(tokens, return_inverse=True)
    both, pair_at = np.unique(pairs(contexts(tokens, starts), tokens), return_inverse=True)
    return _from_levels(filters[0].levels(words, len(bounds)), at, np.searchsorted(words, END), starts, filters[1].levels(both, len(bounds))[pair_at], bounds, n, v)


def _from_levels(level: np.ndarray, at: np.ndarray, end: int, starts: np.ndarray, pair_level: np.ndarray, bounds: np.ndarray, n: int, v: int) -> np.ndarray:
    """log10 p of every token from the levels of words, the word of each token, the word that is END, and the level of each token's pair."""
    low, high = np.append([0], bounds).astype(float), np.append(bounds, bounds[-1] * 2).astype(float) - 1
    p = ((low[level] + 1) / (n + v + 1))[at]
    previous = np.empty_like(at)
    previous[1:] = at[:-1]
    previous[starts] = end
    held = high[level][previous]
    return np.log10(np.where(held > 0, (np.minimum(low[pair_level], held) + SMOOTHING * p) / (held + SMOOTHING), p))


def _blocks(docs: DataFrame, size: int) -> GroupedData:
    """``docs`` (doc_id, text) of ``size`` bytes by block: rows are dealt by their number, so repeated ones do not meet in one."""
    number = parts_for(size, BLOCK_TEXT)
    return _by(docs.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(number))), number, "block")


def _asked(blocks: GroupedData, segments: int) -> DataFrame:
    """(segment, block, words, pairs): the distinct n-grams of each block, by segment, packed."""

    def ask(rows: pa.Table) -> pa.Table:
        tokens, starts = _streams(texts(rows))
        columns = []
        for keys in (np.unique(tokens), np.unique(pairs(contexts(tokens, starts), tokens))):
            order, at = _dealt(keys, segments)
            keys = keys[order]
            columns.append([_packed_keys(keys[a:b]) for a, b in zip(at, at[1:])])
        filled = [i for i in range(segments) if columns[0][i] or columns[1][i]]
        return pa.table({"segment": pa.array(filled, pa.int32()), "block": pa.array([rows["block"][0].as_py()] * len(filled), pa.int64()),
                         **{name: pa.array([c[i] for i in filled], pa.binary()) for name, c in zip(("words", "pairs"), columns, strict=True)}})

    return blocks.applyInArrow(ask, "segment int, block long, words binary, pairs binary")


def _answered(asked: DataFrame, model: Model, parts: int) -> DataFrame:
    """(block, segment, levels, counts, pair_levels) in the order of ``asked``, from the segments, each of which is sent to ``parts`` tasks."""
    highest = len(model.bounds)

    def answer(rows: pa.Table, own: pa.Table) -> pa.Table:
        word_filter, pair_filter = (LevelFilter(own[name][0].as_py() if own.num_rows else [bytes(8)]) for name in ("word_filter", "pair_filter"))
        known, times = (_joined(x) for x in (_keys_of(own["keys"]), [_unpacked(b) for b in own["counts"].to_pylist()]))

        def levels(held: LevelFilter, keys: np.ndarray) -> np.ndarray:
            found = [held.levels(keys[at:at + PROBED], highest).astype(np.uint8) for at in range(0, len(keys), PROBED)]
            return np.concatenate([np.zeros(0, np.uint8), *found])

        def counts(keys: np.ndarray) -> np.ndarray:
            if not len(known):
                return np.zeros(len(keys), np.uint64)
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            return np.where(known[at] == keys, times[at], np.uint64(0))

        def parted(every: np.ndarray, parts: list[np.ndarray], pack: Callable[[np.ndarray], bytes]) -> pa.Array:
            ends = np.cumsum([0, *map(len, parts)])
            return pa.array([pack(every[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())

        words, both = _keys_of(rows["words"]), _keys_of(rows["pairs"])
        every = _joined(words)
        return pa.table({"block": rows["block"], "segment": rows["segment"], "levels": parted(levels(word_filter, every), words, np.ndarray.tobytes),
                         "counts": parted(counts(every), words, _packed), "pair_levels": parted(levels(pair_filter, _joined(both)), both, np.ndarray.tobytes)})

    dealt = asked.withColumn("part", F.pmod("block", F.lit(parts)).cast("int"))
    bodies = model.segments.withColumnsRenamed({"words": "word_filter", "pairs": "pair_filter"}).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return _by(dealt, model.number * parts, "segment", "part").cogroup(bodies.groupBy("segment", "part")).applyInArrow(
        answer, "block long, segment int, levels binary, counts binary, pair_levels binary")


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``base_score`` sums log10((c + 1) / (N + V + 1)) over the tokens, c exact; ``n_known`` counts tokens with c > 0;
    ``score`` is the model's log10 probability of the text.
    """
    base = settled(pick(docs, doc_id=doc_id, text=text), "scored")
    id_type, size = base.schema["doc_id"].dataType.simpleString(), _size(base)
    bounds, n, v, segments = np.array(model.bounds), model.n, model.v, model.number
    blocks = _blocks(base, size)
    answers = _answered(_asked(blocks, segments), model, parts_for(size, 2 * SEGMENT * segments))

    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("segment")
        tokens, starts = _streams(texts(rows))
        words, at = np.unique(tokens, return_inverse=True)
        both, pair_at = np.unique(pairs(contexts(tokens, starts), tokens), return_inverse=True)
        level, count, pair_level = np.zeros(len(words), np.uint8), np.zeros(len(words)), np.zeros(len(both), np.uint8)
        order = _dealt(words, segments)[0]
        level[order] = np.frombuffer(b"".join(answers["levels"].to_pylist()), np.uint8)
        count[order] = _joined([_unpacked(b) for b in answers["counts"].to_pylist()])
        pair_level[_dealt(both, segments)[0]] = np.frombuffer(b"".join(answers["pair_levels"].to_pylist()), np.uint8)
        each = _from_levels(level, at, np.searchsorted(words, END), starts, pair_level[pair_at], bounds, n, v)
        return pa.table({
            "doc_id": rows["doc_id"], "n_tokens": np.diff(np.append(starts, len(tokens))), "n_known": np.add.reduceat((count > 0).astype(np.int64)[at], starts),
            "train_tokens": np.full(len(starts), n), "base_score": np.add.reduceat(np.log10((count + 1) / (n + v + 1))[at], starts), "score": np.add.reduceat(each, starts)})

    return blocks.cogroup(answers.groupBy("block")).applyInArrow(
        scored, f"doc_id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double")

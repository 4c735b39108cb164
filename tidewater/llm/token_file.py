"""Token ids of documents in range-coded files, and back.

Writing: documents are range-sorted by id, every whole text is encoded by the tokenizer and followed by the end id,
and consecutive documents fill frames of about ``FRAME`` ids. A frame is one row of a Parquet file: shard (range
partition), frame number, document ids, ids per document, and the body of ``range_coder`` blocks, each reset and
checksummed on its own. Spark's writer commits the files, so a lost executor costs a retry and nothing else.

Reading: any task can decode any frame. Starts of frames are sums over shards, then inside a shard.

Words between ASCII white space are encoded once for ``SLICE`` documents: the tokenizer drops white space and never
joins across it, so a text's ids are its words' ids in a row. Where the tokenizer is known to lower-case and to part
letters from signs (``PARTED``), a word of Latin letters and signs after them is the ids of both. These parts are
remembered (about ``CACHED`` at a time in a worker), and new ones go to the tokenizer's model itself.

Nulls, empties, ties: a null or empty text has the end id alone. Documents with the same id are ordered by the hash
of their text; null ids come first. Repeated rows are written as often as they occur. An empty table gives an
empty file set and result. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm import range_coder
from tidewater.llm.shared import pick

FRAME = 16_384
GROUP = 1 << 22                                     # ids that a task codes at once
CACHED = 250_000
SLICE = 2048                                        # documents tokenized at once
FRAMES = range_coder.LANES // 5                     # frames decoded at once; most have four full blocks and a rest
PIECE = 1 << 16                                     # stretches of ids copied at once
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"          # ASCII without letters, digits and the apostrophe, which may begin an ending
LOWER = "a-z\u00df-\u00f6\u00f8-\u00ff"
LETTERS = "A-Z\u00c0-\u00d6\u00d8-\u00de" + LOWER
ALPHABET = "".join(filter(str.isalpha, map(chr, [*range(0x80), *range(0xC0, 0x100)])))          # LETTERS, one by one
#: A tokenizer with these settings gives a word of LETTERS and SIGNS after them the ids of the lower-cased letters and then of the signs.
PARTED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}


def _gathered(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches ``at`` of ``flat``, one after another."""
    own = sizes.take(at)
    ends = np.cumsum(own)
    out = np.empty(int(ends[-1]) if len(ends) else 0, flat.dtype)
    for lo in range(0, len(at), PIECE):                  # places are 64-bit numbers
        part, size, start = at[lo:lo + PIECE], own[lo:lo + PIECE], int(ends[lo] - own[lo])
        places = np.repeat(first.take(part) - (ends[lo:lo + PIECE] - size - start), size)
        places += np.arange(len(places))
        flat.take(places, out=out[start:start + len(places)], mode="clip")
    return out


class _Ids:
    """Ids of strings that were seen, in a row."""

    def __init__(self):
        self.known, self.flat, self.sizes, self.first = {}, np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, new: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat.astype(np.uint32)])
        self.first = np.cumsum(self.sizes) - self.sizes

    def places(self, own: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, own), np.int64, len(own))


class _Words:
    """Ids of words between white space, each tokenized by itself or as two parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.words, self.parts, self.model = Tokenizer.from_file(path), _Ids(), _Ids(), None
        settings = json.loads(self.tokenizer.to_str())
        model = settings["model"]
        if all(settings.get(k) == v for k, v in PARTED.items()) and model["type"] == "BPE" and model["end_of_word_suffix"] and not model["ignore_merges"] and not model["dropout"]:
            self.model, level = self.tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.spelt = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100))})

    def whole(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each string, and how many; small letters alone and signs alone are what the model gets in any case."""
        plain = np.zeros(len(new), bool)
        if self.model:
            plain = pc.match_substring_regex(pa.array(new, pa.string()), f"^([{LOWER}]+|[{re.escape(SIGNS)}]+)$").to_numpy(zero_copy_only=False)
        flat, sizes = array("I"), np.zeros(len(new), np.int64)
        tokenize, own = getattr(self.model, "tokenize", None), []
        for word in compress(new, plain):
            tokens = tokenize(word if word.isascii() else word.translate(self.spelt))
            own.append(len(tokens))
            flat.extend([t.id for t in tokens])
        rest = [e.ids for e in self.tokenizer.encode_batch_fast(list(compress(new, ~plain)), add_special_tokens=False)]
        sizes[plain], sizes[~plain] = own, list(map(len, rest))
        flat.extend(chain.from_iterable(rest))
        # plain ones are listed first
        order = np.argsort(~plain, kind="stable")
        first = np.empty(len(new), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        return _gathered(np.array(flat, np.uint32), first, sizes, np.arange(len(new))), sizes

    def learn(self, new: list[str]) -> None:
        """Hold the ids of these words."""
        self.words = _Ids()
        if self.model:
            names = pa.array(new, pa.string())
            fits = pc.match_substring_regex(names, f"^[{LETTERS}]+[{re.escape(SIGNS)}]*$")
            two = names.filter(fits)
            heads = pc.ascii_rtrim(two, SIGNS)
            tails = pc.utf8_ltrim(two, ALPHABET)
            codes = pa.chunked_array([pc.utf8_lower(heads), tails]).combine_chunks().dictionary_encode()
            own = codes.dictionary.to_numpy(zero_copy_only=False).tolist()
            if not self.parts.known or len(self.parts.known) > CACHED:
                self.parts = _Ids()
                self.parts.add([""], np.zeros(0, np.uint32), np.zeros(1, np.int64))
            if fresh := [x for x in own if x not in self.parts.known]:
                self.parts.add(fresh, *self.whole(fresh))
            at = self.parts.places(own)[codes.indices.to_numpy()].reshape(2, -1)
            fits = fits.to_numpy(zero_copy_only=False)
            self.words.add(list(compress(new, fits)), _gathered(self.parts.flat, self.parts.first, self.parts.sizes, at.T.reshape(-1)), self.parts.sizes[at].sum(axis=0))
            new = list(compress(new, ~fits))
        if new:
            self.words.add(new, *self.whole(new))


def word_ids(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Function from a text column to all its ids and their number per text; tokenizer and words stay with the worker."""
    held = sys.modules.setdefault("_tidewater_tokens", types.ModuleType("_tidewater_tokens"))
    if getattr(held, "path", None) != path:
        held.path, held.own = path, _Words(path)

    def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.ascii_split_whitespace(column.fill_null(""))
        codes = words.flatten().dictionary_encode()
        own = codes.dictionary.to_numpy(zero_copy_only=False).tolist()
        held.own.learn(own)
        seen = held.own.words
        at = seen.places(own)[codes.indices.to_numpy()]
        ends = np.concatenate([[0], np.cumsum(seen.sizes[at])]).astype(np.int64)
        return _gathered(seen.flat, seen.first, seen.sizes, at), np.diff(ends[np.cumsum(words.value_lengths().to_numpy())], prepend=0)

    return encode


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode ``docs`` into frames below ``path``."""
    base = pick(docs, doc_id=doc_id, text=text)
    id_type = base.schema["doc_id"].dataType.simpleString()
    ordered = base.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, number = word_ids(tokenizer), TaskContext.get().partitionId(), 0
        frames: list[tuple[list, list[int], list[np.ndarray]]] = []
        held, filled, kind = 0, 0, None

        def flush() -> pa.RecordBatch:
            nonlocal frames, held, number
            arrays = [np.concatenate(parts) for _, _, parts in frames]
            columns = [pa.array([shard] * len(frames), pa.int32()), pa.array(range(number, number + len(frames)), pa.int32()), pa.array([f[0] for f in frames], pa.list_(kind)),
                       pa.array([f[1] for f in frames], pa.list_(pa.int32())), pa.array([len(a) for a in arrays], pa.int64()), pa.array(range_coder.encode(arrays), pa.binary())]
            number += len(frames)
            frames, held = [], 0
            return pa.RecordBatch.from_arrays(columns, ["shard", "frame", "ids", "counts", "n", "body"])

        for batch in batches:
            kind = batch.column("doc_id").type
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids, counts = encode(part.column("text"))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)                       # after each document
                ends += np.arange(1, len(ends) + 1)
                start = 0
                for i, end in zip(part.column("doc_id").to_pylist(), ends.tolist(), strict=True):
                    if not frames or filled >= FRAME:
                        if held >= GROUP:
                            yield flush()
                        frames.append(([], [], []))
                        filled = 0
                    frames[-1][0].append(i)
                    frames[-1][1].append(end - start)
                    frames[-1][2].append(ids[start:end])
                    filled += end - start
                    held += end - start
                    start = end
        if frames:
            yield flush()

    ordered.mapInArrow(run, f"shard int, frame int, ids array<{id_type}>, counts array<int>, n long, body binary").write.parquet(path)


def starts(frames: DataFrame) -> DataFrame:
    """(shard, frame, first): ids before every frame."""
    sizes = frames.select("shard", "frame", "n")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("whole"))
    shards = shards.select("shard", F.coalesce(F.sum("whole").over(earlier.orderBy("shard")), F.lit(0)).alias("before"))     # one row per file
    inside = F.coalesce(F.sum("n").over(earlier.partitionBy("shard").orderBy("frame")), F.lit(0))
    return sizes.withColumn("inside", inside).join(shards, "shard").select("shard", "frame", (F.col("before") + F.col("inside")).alias("first"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    frames = spark.read.parquet(path)
    id_type = frames.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, FRAMES):
                part = batch.slice(at, FRAMES)
                rows = []
                for shard, frame, counts, ids in zip(part.column("shard").to_pylist(), part.column("frame").to_pylist(), part.column("counts").to_pylist(),
                                                     range_coder.decode(part.column("body").to_pylist()), strict=True):
                    body, offset = ids.tobytes(), 0
                    for n in counts:
                        rows.append((shard, frame, offset, n, zlib.crc32(body[4 * offset:4 * (offset + n)])))
                        offset += n
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("ids").flatten(), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                                                 ["doc_id", "shard", "frame", "offset", "n_tokens", "ids_crc32"])

    found = frames.mapInArrow(run, f"doc_id {id_type}, shard int, frame int, offset long, n_tokens long, ids_crc32 long")
    return found.join(starts(frames), ["shard", "frame"]).select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")

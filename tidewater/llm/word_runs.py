"""Runs of repeated words: a suffix automaton whose link tree is a link-cut tree.

A run is a stretch of consecutive words with smallest period q, at least ``max(min_length, 2 * q)`` words long, that
no neighbouring word extends. Words are appended to a suffix automaton one at a time. Every state remembers where its
words last ended; states on a path of the link tree that share that place form one segment, which is one splay tree.
Appending word i accesses the path from its state to the root: each segment met there gives the place p where its
longest member, of L words, ended last. If d = i - p is at most L, the last 2 * d words are a square, and the stretch
with period d starts at p - L + 1; it is extended to the right once. The path then becomes one segment of place i.
Accesses change O(n log n) segments over n words.

Before that, words that no run can hold are cut away, for all texts of a batch at once: a run repeats at least
``min_length / 2`` words in a row at the distance of its period, inside itself, so each of its words lies in a group
of that many words which occurs twice in the same stretch. Stretches between words without such a group are cut again
until nothing changes. The cut looks at hashes, so a collision keeps more, never less.

Nulls, empties, repeats: a null or empty text has no words and no runs, and an empty collapsed text. Each row is one
document, whatever its id. Extra columns are ignored. An empty table gives an empty result. Memory grows with the
longest stretch that repeats (about 500 bytes a word), not with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidewater.llm.shared import blocks_of, pick, texts

BYTES_AT_ONCE = 1 << 22      # so much text is cut in one go


class Automaton:
    """Suffix automaton; its links are kept as a forest of splay trees, one for each segment."""

    def __init__(self):
        self.length, self.link, self.go = [0, 0], [0, 0], [{}, {}]       # state 1 is the root, 0 is nothing
        self.up, self.left, self.right, self.place = [0, 0], [0, 0], [0, 0], [0, -1]
        self.last = 1

    def _state(self, length: int, go: dict) -> int:
        for column, value in ((self.length, length), (self.link, 0), (self.go, go), (self.up, 0), (self.left, 0), (self.right, 0), (self.place, -1)):
            column.append(value)
        return len(self.length) - 1

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[z] == y:
            left[z] = x
        elif right[z] == y:
            right[z] = x
        else:
            self.place[x] = self.place[y]        # the place is kept at the top
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            up[b] = y
        up[y], up[x] = x, z

    def _splay(self, x: int) -> None:
        """Bring ``x`` to the top of its segment, the segment's place with it."""
        up, left, right = self.up, self.left, self.right
        while (y := up[x]) and (left[y] == x or right[y] == x):
            if (z := up[y]) and (left[z] == y or right[z] == y):
                self._rotate(y if (left[y] == x) == (left[z] == y) else x)
            self._rotate(x)

    def append(self, word: int) -> int:
        """State of the whole text after one more word."""
        length, link, go = self.length, self.link, self.go
        new, p = self._state(length[self.last] + 1, {}), self.last
        while p and word not in go[p]:
            go[p][word] = new
            p = link[p]
        if not p:
            parent = 1
        elif length[q := go[p][word]] == length[p] + 1:
            parent = q
        else:
            parent = self._state(length[p] + 1, dict(go[q]))
            self._insert_above(q, parent)
            while p and go[p].get(word) == q:
                go[p][word] = parent
                p = link[p]
        link[new] = self.up[new] = parent
        self.last = new
        return new

    def _insert_above(self, q: int, clone: int) -> None:
        """``clone`` becomes the parent of ``q``, in the same segment: both last ended at the same place."""
        self.link[clone], self.link[q] = self.link[q], clone
        self._splay(q)
        above = self.left[q]
        self.left[q], self.up[clone], self.left[clone] = clone, q, above
        if above:
            self.up[above] = clone

    def access(self, state: int, at: int) -> list[tuple[int, int]]:
        """(place, length) of each segment from ``state`` to the root, nearest first; all of it now ends at ``at``."""
        met, below, x = [], 0, state
        while x:
            self._splay(x)
            if (deeper := self.right[x]):
                self.place[deeper] = self.place[x]
            if x != state and x != 1:
                met.append((self.place[x], self.length[x]))
            self.right[x] = below
            below, x = x, self.up[x]
        self.place[below] = at
        return met


def runs_of(words: list[int], min_length: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, sorted by start, then period."""
    automaton, n = Automaton(), len(words)
    reached: dict[int, int] = {}             # period -> end of its latest run
    found = []
    for i, word in enumerate(words):
        for place, length in automaton.access(automaton.append(word), i):
            d = i - place
            if 0 < d <= length and reached.get(d, -1) < i:
                end = i + 1
                while end < n and words[end] == words[end - d]:
                    end += 1
                reached[d] = end - 1
                start = place - length + 1
                if end - start >= min_length:
                    found.append((start, end - start, d))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _bounds(kept: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches [from, to) of kept words that do not cross ``starts``."""
    opens = kept.copy()
    opens[1:] &= ~kept[:-1]
    inner = starts[(starts > 0) & (starts < len(kept))]
    opens[inner] = kept[inner]
    closes = np.zeros(len(kept) + 1, bool)
    closes[1:] = kept
    closes[1:-1] &= ~kept[1:] | opens[1:]
    return np.flatnonzero(opens), np.flatnonzero(closes)


def stretches(words: np.ndarray, starts: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs may lie: [from, to) among hashed words of texts that begin at ``starts``."""
    width = max(1, min_length // 2)
    lo = np.asarray(starts, np.int64)
    hi = np.append(lo[1:], len(words))
    while True:
        long = hi - lo >= min_length
        lo, hi = lo[long], hi[long]
        sizes = hi - lo
        if not len(lo):
            return lo, hi
        base = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(lo - base, sizes)        # places of the words still there
        own, part = words[at], np.repeat(np.arange(len(lo)), sizes)
        key = part.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(width):
            key[:len(own) - k] = (key[:len(own) - k] ^ own[k:]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        whole = np.arange(len(own)) <= np.repeat(base + sizes - width, sizes)
        first = np.flatnonzero(whole)
        order = first[np.argsort(key[first], kind="stable")]
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(own) + width, np.int64)
        again = np.zeros(len(own), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        twice[:len(own)] += again
        twice[width:] -= again
        kept = np.cumsum(twice)[:len(own)] > 0
        if kept.all():
            return lo, hi
        a, b = _bounds(kept, base)
        lo, hi = at[a], at[b - 1] + 1


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Rows in slices of bounded text (or one row)."""
    for batch in batches:
        bodies = texts(batch)
        for lo, hi in blocks_of(map(len, bodies), BYTES_AT_ONCE):
            yield batch.slice(lo, hi - lo), [t.split() for t in bodies[lo:hi]]


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 12) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    ``runs`` holds (start, length, period) by start, then period. ``collapsed`` holds the words, one space between
    them, without those that a run contains after its first ``period`` words.
    """
    base = pick(docs, doc_id=doc_id, text=text)
    id_type = base.schema["doc_id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _batches(batches):
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            starts = np.cumsum(sizes) - sizes
            hashed = np.concatenate([np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)) for w in words])
            runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
            rows = np.searchsorted(starts, (lo_hi := stretches(hashed, starts, min_length))[0], "right") - 1
            for row, lo, hi in zip(rows.tolist(), *(x.tolist() for x in lo_hi), strict=True):
                at, ids = lo - int(starts[row]), {}
                own = [ids.setdefault(w, len(ids)) for w in words[row][at:at + hi - lo]]
                runs[row] += [(at + s, n, p) for s, n, p in runs_of(own, min_length)]
            collapsed = [b" ".join(_without(w, r)) for w, r in zip(words, runs, strict=True)]
            ends = np.cumsum([0, *map(len, runs)])
            flat = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], fields=list(run_type))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts), pa.array(collapsed, pa.binary()).cast(pa.string())],
                                             ["doc_id", "n_words", "runs", "collapsed"])

    return base.mapInArrow(emit, f"doc_id {id_type}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def _without(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words outside the repeats of every run."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def with_periodic_tails(docs: DataFrame, number: str = "crc", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with the words of some texts repeated by rule, as a run detector's known answer.

    ``number`` names a long column h, g = h // 10. Where h % 10 = 0 and there are n > 0 words, each word i >= a becomes
    word a + (i - a) % p, with a = g % n and p = 1 + (n - a) // (3 + g % 8); words are then joined by one space.
    Other rows, and those whose number is null, keep their text.
    """
    base = pick(docs, doc_id=doc_id, text=text, h=number)
    id_type = base.schema["doc_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.column("text").cast(pa.binary()).to_pylist()
            for i, h in enumerate(batch.column("h").to_pylist()):
                if h is not None and h % 10 == 0 and (words := (out[i] or b"").split()):
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    tail = words[a:a + p]
                    out[i] = b" ".join(words[:a] + (tail * -(-(n - a) // p))[:n - a])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return base.mapInArrow(emit, f"doc_id {id_type}, text string")

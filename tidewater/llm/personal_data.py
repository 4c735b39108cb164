"""Personal data: fixed patterns seed a contextual extractor that finds further identifiers.

Base spans (``base_spans``) are leftmost and non-overlapping for each kind: email, ip, card, phone. They always
stay. Bootstrapping then learns from where they stand:

1. One pass over the whole texts lists base spans and other identifier-like strings (*candidates*), each with its
   contexts: the two words before, and the word before with the word after. Words are whole, however long; of a word
   that holds spans, the part up to the next span counts.
2. Contexts and instances form a bipartite graph. A seed has score 1 for its kind. Rounds of joins and sums score
   a context by the mean score of its different instances, and a candidate by the chance that one of its contexts
   is right: 1 - product(1 - context score).
3. Contexts with at least ``MIN_SEEDS`` different seeds of a kind and a score of ``MIN_SCORE`` or more are trusted.
   Candidates that stand in one and score ``HIGH`` or more are promoted: they become seeds of their best kind, and
   steps 2 and 3 are repeated with them until none is promoted any more.
4. Candidates in a context trusted in the end, and of a form that suits the kind, become spans of that kind.

Contexts without a seed say nothing, and those with fewer than ``MIN_SEEDS`` different instances can never be trusted.

All statistics cover all documents; only hashes of instances and contexts are shuffled.

Nulls, empties, ties: a null text is an empty one and has no spans. Every row gets one row; rows of equal id and
text get equal spans. Null ids stay null. A candidate that suits several kinds takes the best scored, then the
first kind. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import pick
from tidewater.sources.durable import durable

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_SEEDS = 5
MIN_SCORE = 0.8
HIGH = 0.9
SMOOTH = 1.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"\(?[0-9](?:[ ().:/-]{0,2}[0-9]){5,}+")
_ADDRESS = re.compile(r"(?<![^\s@])[^\s@]+(?:@|[(\[]at[)\]])[^\s@]+")
_WORD = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; end exclusive, in code points. Linear in the length of the text."""
    out, last = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = at = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((0, start, m.end()))
                last = m.end()
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def suits(body: str) -> list[int]:
    """Kinds that an identifier-like string may be."""
    digits = sum(map(str.isdigit, body))
    kinds = []
    if re.search(r"@|[(\[]at[)\]]", body):
        return [0]
    if 3 <= body.count(".") <= 5 and digits <= 12 or body.count(":") >= 4:
        kinds.append(1)
    if 13 <= digits <= 19:
        kinds.append(2)
    if 7 <= digits <= 15 and body.count(".") < 3 and ":" not in body:
        kinds.append(3)
    return kinds


class Around:
    """Words of a text around its spans. Every word is hashed once, so the work is linear in the text, however long words are."""

    def __init__(self, text: str, spans: list[tuple[int, int]]):
        self.text, self.hashes = text, {}
        places = [m.span() for m in _WORD.finditer(text)] if spans else []
        self.starts, self.ends = [a for a, _ in places], [b for _, b in places]
        self.span_starts, self.span_ends = sorted(a for a, _ in spans), sorted(b for _, b in spans)

    def word(self, i: int) -> bytes:
        if i not in self.hashes:
            self.hashes[i] = self.piece(self.starts[i], self.ends[i])
        return self.hashes[i]

    def piece(self, a: int, b: int) -> bytes:
        return xxhash.xxh3_64_digest(self.text[a:b].lower())

    def contexts(self, start: int, end: int) -> list[int]:
        """Hashes of the contexts of a span. Of a word that holds the span only the parts between spans count."""
        i, before = bisect_left(self.starts, start), []
        if i and self.ends[i - 1] > start:
            i -= 1
            at = bisect_right(self.span_ends, start)
            since = max(self.starts[i], self.span_ends[at - 1] if at else 0)
            if since < start:
                before.append(self.piece(since, start))
        while i and len(before) < 2:
            i -= 1
            before.append(self.word(i))
        i, after = bisect_right(self.ends, end), None
        if i < len(self.ends) and self.starts[i] < end:
            at = bisect_left(self.span_starts, end)
            until = min(self.ends[i], self.span_starts[at] if at < len(self.span_starts) else len(self.text))
            after, i = self.piece(end, until) if until > end else None, i + 1
        if after is None and i < len(self.ends):
            after = self.word(i)
        out = []
        if len(before) == 2:
            out.append(b"2" + before[1] + before[0])
        if before and after:
            out.append(b"1" + before[0] + after)
        return [_signed(xxhash.xxh3_64_intdigest(c)) for c in out]


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def found_in(text: str) -> tuple[list, list, list]:
    """(base, seeds, candidates) of a text, as rows of the table of ``read``."""
    base = base_spans(text)
    busy = sorted((a, b) for _, a, b in base)
    others, at = [], 0
    spots = sorted((m.start(), m.end()) for p in (_NUMBER, *([_ADDRESS] if "@" in text or "at)" in text or "at]" in text else [])) for m in p.finditer(text))
    for a, b in spots:
        while at < len(busy) and busy[at][1] <= a:
            at += 1
        if at < len(busy) and busy[at][0] < b or others and others[-1][1] > a:
            continue
        if suits(text[a:b]):
            others.append((a, b))
    around = Around(text, busy + others)
    seeds = [(kind, _signed(xxhash.xxh3_64_intdigest(text[a:b])), around.contexts(a, b)) for kind, a, b in base]
    candidates = [(a, b, suits(text[a:b]), _signed(xxhash.xxh3_64_intdigest(text[a:b])), around.contexts(a, b)) for a, b in others]
    return base, seeds, candidates


_SPAN = "struct<kind:int,start:long,end:long>"
_FOUND = f"th long, base array<{_SPAN}>, seeds array<struct<kind:int,inst:long,ctx:array<long>>>, cands array<struct<start:long,end:long,kinds:array<int>,inst:long,ctx:array<long>>>"


def read(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, th, base, seeds, cands) of every row: what the first pass over the texts finds."""
    base = pick(docs, doc_id=doc_id, text=text).withColumn("th", F.xxhash64("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    i32, i64 = pa.int32(), pa.int64()
    kinds = (pa.list_(pa.struct([("kind", i32), ("start", i64), ("end", i64)])), pa.list_(pa.struct([("kind", i32), ("inst", i64), ("ctx", pa.list_(i64))])),
             pa.list_(pa.struct([("start", i64), ("end", i64), ("kinds", pa.list_(i32)), ("inst", i64), ("ctx", pa.list_(i64))])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [found_in(t or "") for t in batch.column("text").to_pylist()]
            columns = [pa.array([[dict(zip((f.name for f in kind.value_type), x, strict=True)) for x in row[i]] for row in got], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), *columns], ["doc_id", "th", "base", "seeds", "cands"])

    return base.mapInArrow(run, f"doc_id {id_type}, {_FOUND}")


def learn_contexts(found: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE, high: float = HIGH) -> DataFrame:
    """(ctx, kind, score) of the contexts that may be trusted."""
    seeds = found.select(F.explode("seeds").alias("s")).select(F.explode("s.ctx").alias("ctx"), "s.inst", F.array("s.kind").alias("kinds"), F.lit(True).alias("seed"))
    cands = found.select(F.explode("cands").alias("s")).select(F.explode("s.ctx").alias("ctx"), "s.inst", "s.kinds", F.lit(False).alias("seed"))
    edges = seeds.union(cands).select("ctx", "inst", "seed", F.explode("kinds").alias("kind")).groupBy("ctx", "inst", "kind").agg(F.max("seed").alias("seed"))
    edges = durable(edges, "all-edges")
    size = edges.groupBy("ctx").agg(F.count_distinct("inst").alias("size")).filter(F.col("size") >= min_seeds)
    edges = durable(edges.join(size, "ctx"), "edges")
    scores = edges.groupBy("inst", "kind").agg(F.max("seed").alias("seed")).withColumn("score", F.col("seed").cast("double"))
    edges = edges.drop("seed")
    trusted = (F.col("seeds") >= min_seeds) & (F.col("trust") >= min_score)
    doubt = F.exp(F.sum(F.log(1 - F.least(F.coalesce("trust", F.lit(0.0)), F.lit(0.999)))))
    while True:
        for _ in range(rounds):
            own = edges.join(scores, ["inst", "kind"])
            patterns = own.groupBy("ctx", "kind").agg((F.sum("score") / (F.max("size") + SMOOTH)).alias("trust"), F.sum(F.col("seed").cast("int")).alias("seeds"))
            patterns = durable(patterns.filter(F.col("seeds") > 0).withColumn("trusted", trusted), "contexts")
            scores = own.select("ctx", "inst", "kind", "seed").join(patterns.select("ctx", "kind", "trust", "trusted"), ["ctx", "kind"], "left").groupBy("inst", "kind").agg(
                F.max("seed").alias("seed"), F.when(F.max("seed"), 1.0).otherwise(1 - doubt).alias("score"), F.coalesce(F.max("trusted"), F.lit(False)).alias("placed"))
            scores = durable(scores, "scores")
        new = scores.filter(~F.col("seed") & F.col("placed") & (F.col("score") >= high)).groupBy("inst").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
        taken = scores.filter("seed").select("inst").distinct()
        new = durable(new.join(taken, "inst", "left_anti").select("inst", (-F.col("best.k")).alias("kind"), F.lit(True).alias("new")), "promoted")
        if new.isEmpty():
            return patterns.filter("trusted").select("ctx", "kind", F.col("trust").alias("score"))
        seed = F.col("seed") | F.coalesce("new", F.lit(False))
        scores = scores.join(new, ["inst", "kind"], "left").select("inst", "kind", seed.alias("seed"), F.when(seed, 1.0).otherwise(F.col("score")).alias("score"))


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, spans) of every row: base spans, and all spans by kind and start."""
    found = durable(read(docs, doc_id, text), "personal")
    trusted = learn_contexts(found)
    cands = found.select("doc_id", "th", F.explode("cands").alias("c")).select("doc_id", "th", "c.start", "c.end", "c.kinds", F.explode("c.ctx").alias("ctx"))
    hits = cands.join(trusted, "ctx").filter(F.array_contains("kinds", F.col("kind")))
    one = hits.groupBy("doc_id", "th", "start", "end").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
    added = one.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t")).agg(F.collect_set(F.struct((-F.col("best.k")).alias("kind"), "start", "end")).alias("added"))
    both = found.join(added, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>"))))
    return both.select("doc_id", "base", every.alias("spans"))


def listed(spans: str):
    """Column: kind:start:end of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s["end"])), ",")

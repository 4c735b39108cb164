"""Exact top-k by inner product over a vector-approximation file.

A vector component x becomes the integer floor(256 * x). The approximation file holds, for every vector and
dimension, the number of its cell: ``2 ** BITS`` cells of equal width between the least and the greatest value of
the dimension. Exact vectors are another table. Two scans read cells only: the first gives the k-th greatest lower bound of every
query's products over the whole file, the second the vectors whose upper bound reaches it. Exact vectors of these are
read in order of their upper bound, a few for each query and eight times as many in every further round, until the k-th
score of a query is no less than its next bound.

Queries are packed in blocks of about ``QUERY_BLOCK`` vectors and the file in chunks of ``CHUNK``; every block meets every
chunk in some task. Neither passes through the driver. Rows of a query are cut to the needed ones before each shuffle.

Nulls, empties, ties: vectors that are null or empty or hold null, NaN or infinite components take no part, nor do
rows without an id; nor do vectors whose length differs from the most common one (ties to the longer). Equal
scores go to the smaller id. An id that occurs again stands for its least vector. Fewer than k candidates give
fewer rows. Empty tables give empty results. Extra columns are ignored. Scores are sums of 64-bit integers; bounds are widened
where doubles would round them, and a score beyond 64 bits raises Spark's overflow error (in its ANSI mode, the default).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.shared import parts_for, pick
from tidewater.sources.durable import discard, durable

BITS = 5
QUERY_BLOCK = 2048
STEP = 4                     # exact vectors of a query read in the first round, in units of k
GROWTH = 8                   # how many times more in each further round
CHUNK = 4096                 # vectors scanned at once

_EXACT = 2.0**53             # integers up to here are exact in doubles


def integral(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", factor: int = 256) -> DataFrame:
    """(vec_id, v): integer vectors that take part, one for each id."""
    base = pick(vectors, vec_id=vec_id, e=embedding).filter("vec_id is not null and size(e) > 0")
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = base.filter(sound).select("vec_id", F.transform("e", lambda x: F.floor(x.cast("double") * factor).cast("long")).alias("v"))
    return scaled.groupBy("vec_id").agg(F.min("v").alias("v"))


def write_file(vectors: DataFrame) -> tuple[DataFrame, DataFrame, np.ndarray, np.ndarray]:
    """Exact vectors (vec_id, v) and chunks (ids, cells) as stored tables, the least value and the cell width of every dimension."""
    sizes = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0
    exact = durable(vectors.filter(F.size("v") == d), "vectors")
    ends = exact.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).sort("i").toPandas()
    low = ends["lo"].to_numpy(np.float64)
    width = np.maximum(1, np.ceil((ends["hi"].to_numpy(np.float64) - low + 1) / 2**BITS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                body = np.clip((_matrix(part.column("v"), d) - low) // width, 0, 2**BITS - 1).astype(np.uint8)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("vec_id"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([body.tobytes()], pa.binary())], ["ids", "cells"])

    id_type = exact.schema["vec_id"].dataType.simpleString()
    return exact, durable(exact.mapInArrow(pack, f"ids array<{id_type}>, cells binary"), "vector-file"), low, width


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def bounds(q: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of every query with every vector, as known from the vector's cells."""
    first, last = cells * width + low, cells * width + low + width - 1
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    least, most = up @ first.T + down @ last.T, up @ last.T + down @ first.T
    size = np.maximum(np.abs(first), np.abs(last))
    if q.shape[1] * np.abs(q).max(initial=0) * size.max(initial=0) >= _EXACT:
        slack = np.abs(q) @ size.T * (4 * q.shape[1] / _EXACT)
        least, most = least - slack, most + slack
    return least, most


def _scanned(chunks: DataFrame, blocks: DataFrame, low: np.ndarray, width: np.ndarray, k: int, id_type: str) -> DataFrame:
    """Every chunk against every block (ids, vectors and, in the second scan, bars of queries), by their bounds alone.

    Without bars: (query_id, bound), the k greatest lower bounds of a chunk for each query. With bars: (query_id, vec_id, bound),
    the upper bounds that reach the query's bar.
    """
    d, second = len(low), "bars" in blocks.columns
    schema = f"query_id {id_type}, vec_id {id_type}, bound long" if second else f"query_id {id_type}, bound long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, q_ids = batch.column("ids")[r].values, batch.column("q_ids")[r].values
                cells = np.frombuffer(batch.column("cells")[r].as_py(), np.uint8).reshape(-1, d).astype(np.float64)
                least, most = bounds(_matrix(batch.column("q")[r].values, d), cells, low, width)
                place = {x: i for i, x in enumerate(ids.to_pylist())}
                own = [(i, place[x]) for i, x in enumerate(q_ids.to_pylist()) if x in place]
                for i, j in own:
                    least[i, j] = most[i, j] = -np.inf
                if second:
                    at_q, at_v = np.nonzero(most >= batch.column("bars")[r].values.to_numpy(zero_copy_only=False)[:, None])
                    reached = most[at_q, at_v]
                    kept = reached > -np.inf
                    yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(at_q[kept])), ids.take(pa.array(at_v[kept])), _longs(np.ceil(reached[kept]))], ["query_id", "vec_id", "bound"])
                else:
                    best = least if least.shape[1] <= k else np.partition(least, least.shape[1] - k, axis=1)[:, -k:]
                    at_q, at_v = np.nonzero(best > -np.inf)
                    yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(at_q)), _longs(np.floor(best[at_q, at_v]))], ["query_id", "bound"])

    # A stated set of queries meets all rows, block by chunk: rows of this join are packed, one for each pair of them.
    return chunks.crossJoin(blocks).mapInArrow(scan, schema)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.clip(x, -(2.0**63) + 1024, 2.0**63 - 1024).astype(np.int64))


def _first(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of every query with their ``rank``; Spark cuts to them before the shuffle, too."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= n)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for every vector that ``is_query`` (a condition on vec_id) picks, its k best others."""
    exact, chunks, low, width = write_file(integral(vectors, vec_id, embedding))
    id_type = exact.schema["vec_id"].dataType.simpleString()
    queries = durable(exact.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "queries")
    block = F.pmod(F.xxhash64("query_id"), F.lit(parts_for(queries.count(), query_block))).alias("block")

    def packed(rows: DataFrame, *more: str) -> DataFrame:
        own = rows.groupBy(block).agg(F.collect_list(F.struct("query_id", "q", *more)).alias("own"))
        return own.select(F.col("own.query_id").alias("q_ids"), F.col("own.q").alias("q"), *[F.col(f"own.{m}").alias(f"{m}s") for m in more])

    tops = _first(_scanned(chunks, durable(packed(queries), "blocks"), low, width, k, id_type), k, F.desc("bound"))
    bars = tops.groupBy("query_id").agg(F.min("bound").alias("bar"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k).select("query_id", "bar")
    barred = queries.join(bars, "query_id", "left").withColumn("bar", F.coalesce(F.col("bar").cast("double"), F.lit(float("-inf"))))
    left = durable(_scanned(chunks, durable(packed(barred, "bar"), "blocks"), low, width, k, id_type), "reaching")

    best, n = None, STEP * k
    while best is None or not left.isEmpty():
        taken = durable(_first(left, n, F.desc("bound"), F.col("vec_id")), "taken")
        score = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
        scored = taken.join(exact, "vec_id").join(queries, "query_id").select("query_id", "vec_id", score.alias("score"))
        every = scored if best is None else scored.unionByName(best.drop("rank"))
        before, best = best, durable(_first(every, k, F.desc("score"), F.col("vec_id")), "best")
        last = taken.groupBy("query_id").agg(F.max(F.struct((-F.col("bound")).alias("down"), F.col("vec_id").alias("id"))).alias("last"))
        kth = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("at_k"), F.col("vec_id").alias("id_k"))
        # What lies behind the last one read and could still be among the k best.
        rest = left.join(last, "query_id").filter(F.struct((-F.col("bound")).alias("down"), F.col("vec_id").alias("id")) > F.col("last")).drop("last").join(kth, "query_id", "left")
        rest = durable(rest.filter("at_k is null or bound > at_k or bound = at_k and vec_id < id_k").select("query_id", "vec_id", "bound"), "reaching")
        discard(left, taken, before)
        left, n = rest, n * GROWTH
    discard(left, chunks, exact, queries)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

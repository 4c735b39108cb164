"""Language model, word runs and phrases: brute force, awkward rows, filters and automata on their own."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from check import table
from tests.conftest import SF
from tidewater.llm import bloom_lm, collocations, word_runs
from tidewater.llm.queries import ORACLES, QUERIES
from tidewater.llm.shared import LevelFilter, pick

SCHEMA = "doc_id long, text string, lang string, source string, DOC_ID string, Text int, runs string, score double, key long, row long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "x", 1, "r", 0.5, 7, 8) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def awkward(spark):
    long = " ".join(f"w{i % 4001}" for i in range(30_000))
    return docs_of(spark, [(1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "one", "und"), (5, "one", None), (5, "one", None), (None, "one two", "fr"), (None, None, None), (6, long, "en"), (7, "la " * 5000, "en")])


# 11
def brute_lm(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    words = [(t or "").encode().lower().split() + [b"\n"] for _, t in rows]
    counts = Counter(w for own, h in zip(words, held) if not h for w in own)
    n, v = sum(counts.values()), len(counts)
    return sorted((repr(i), h, len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), 6)) for (i, _), h, own in zip(rows, held, words))


def test_base_scores_against_brute_force(spark, monkeypatch, tmp_path, awkward):
    def run(df, name):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        return QUERIES["op11_bloom_lm"](spark, f"{tmp_path}/{name}").collect()

    sample = spark.read.parquet(f"{SF}/documents.parquet")
    for share in (1 << 20, 4, 0):            # most words sent with exact counts, few, none
        monkeypatch.setattr(bloom_lm, "EXACT_SHARE", share)
        for name, df in (("sample", sample), ("awkward", pick(awkward, doc_id="doc_id", text="text", score="score", key="key", row="row"))):
            got = run(df, f"{name}{share}")
            want = brute_lm([(r[0], r[1]) for r in df.select("doc_id", "text").collect()])
            assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
            assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert run(sample.limit(0), "none") == []
    held = [r for r in run(sample, "again") if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_without_training_text_and_null_texts(spark):
    model = bloom_lm.train(docs_of(spark, []))
    got = bloom_lm.score(docs_of(spark, [(1, "a b", None), (None, None, None)]), model).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]


def test_level_filter_holds_levels(spark):
    rng = np.random.default_rng(5)
    keys, counts = np.unique(rng.integers(-2**62, 2**62, 40_000)), None
    counts = rng.zipf(1.4, len(keys)).clip(1, 10**9)
    bounds = bloom_lm.bounds_from(1)
    made = LevelFilter.build(spark.createDataFrame(list(zip(keys.tolist(), counts.tolist())), "key long, count long"), len(keys), bounds, 1 << 20, per_segment=5000)
    want, got = np.searchsorted(bounds, counts, "right"), made.levels(keys.astype(np.uint64), len(bounds))
    assert (got >= want).all() and (got == want).mean() > 0.9
    other = rng.integers(0, 2**62, 40_000).astype(np.uint64)
    assert (made.levels(other, len(bounds)) > 0).mean() < 0.1
    assert len(LevelFilter.build(spark.createDataFrame([(k, 1) for k in keys.tolist()], "key long, count long"), len(keys), [1], 4096).body) <= 4096


def test_probabilities_after_a_context_add_up_to_at_most_one(spark):
    docs = docs_of(spark, [(1, "a b a c a b b", "en"), (2, "a a b c d", "en")])
    model = bloom_lm.train(docs)
    seen = np.array([xxhash.xxh3_64_intdigest(w) for w in (b"a", b"b", b"c", b"d", b"\n")], np.uint64)
    for h in seen:
        tokens = np.array([t for w in seen for t in (h, w)], np.uint64)
        p = 10 ** bloom_lm.log_probabilities(tokens, np.arange(0, len(tokens), 2), model.filters, np.array(model.bounds), model.n, model.v)
        assert 0.3 < p[1::2].sum() <= 1.0


def test_rare_words_and_pairs_stay_beyond_2_25_tokens(spark):
    many = spark.range(4300).select(F.lit(None).cast("long").alias("doc_id"), F.expr("repeat('la ', 8000)").alias("text"))
    model = bloom_lm.train(many.union(spark.createDataFrame([(1, "one two")], "doc_id long, text string")))
    assert model.n > 1 << 25
    one, two = (np.uint64(xxhash.xxh3_64_intdigest(w)) for w in (b"one", b"two"))
    pair = bloom_lm.pairs(np.array([one]), np.array([two]))
    assert model.filters[0].levels(np.array([one, two]), 9).min() > 0 and model.filters[1].levels(pair, 9)[0] > 0


def test_segments_and_blocks_give_the_scores_of_one_filter(spark, monkeypatch):
    """Texts in many blocks, n-grams in many segments and lists, filters sent twice; against the filter in one place."""
    sample = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = sample.union(spark.createDataFrame([(None, None), (None, ""), (5, "one"), (5, "one")], "doc_id long, text string"))
    for name, value in (("SEGMENT", 10_000), ("BLOCK_TEXT", 30_000), ("TASK_GRAMS", 5_000), ("PROBED", 100)):
        monkeypatch.setattr(bloom_lm, name, value)
    model = bloom_lm.train(sample.limit(40))
    assert model.number > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = []
    for i, t in docs.collect():
        tokens, starts = bloom_lm.stream([(t or "").encode()])
        want.append((repr(i), len(tokens), round(bloom_lm.log_probabilities(tokens, starts, model.filters, np.array(model.bounds), model.n, model.v).sum(), 6)))
    assert sorted((repr(r.doc_id), r.n_tokens, round(r.score, 6)) for r in bloom_lm.score(docs, model).collect()) == sorted(want)


# 12
def brute_runs(w, least):
    found, n = set(), len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, 2 * q) and not any(all(w[x] == w[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                found.add((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(400):
        w = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(70))]
        if len(w) > 4 and rng.random() < 0.5:
            a, p = rng.randrange(len(w)), rng.randrange(1, 9)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        for least in (2, 5, 12):
            assert word_runs.runs_of(w, least) == brute_runs(w, least)


def test_cut_keeps_every_run():
    rng = random.Random(2)
    texts = [[rng.randrange(rng.choice([2, 3, 40])) for _ in range(rng.randrange(90))] for _ in range(300)]
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    hashed = np.array([xxhash.xxh3_64_intdigest(str(x)) for w in texts for x in w], np.uint64)
    got = [[] for _ in texts]
    for lo, hi in zip(*word_runs.stretches(hashed, starts, 12)):
        row = max(i for i, s in enumerate(starts) if s <= lo)
        at = int(lo - starts[row])
        got[row] += [(at + s, n, p) for s, n, p in word_runs.runs_of(texts[row][at:at + int(hi - lo)], 12)]
    assert [sorted(g, key=lambda r: (r[0], r[2])) for g in got] == [brute_runs(w, 12) for w in texts]


def test_run_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_word_runs"](spark, SF).collect()}
    seen = 0
    for r in docs:
        w, h = (r.text or "").encode().split(), zlib.crc32(str(r.doc_id).encode())
        if len(w) > 800:
            continue
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w, 12)
        seen += len(runs)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert got[r.doc_id] == (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join("%d,%d,%d\n" % x for x in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))
    assert seen > 10 and len(got) == len(docs)


def test_runs_of_awkward_texts(spark, awkward):
    rows = word_runs.find_runs(awkward).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows if r.doc_id in (1, 2, 3, 4, 6, 7)}
    assert all(by[i].n_words == 0 and by[i].runs == [] and by[i].collapsed == "" for i in (1, 2, 3))
    assert [tuple(x) for x in by[6].runs] == [(0, 30_000, 4001)] and len(by[6].collapsed.split()) == 4001
    assert [tuple(x) for x in by[7].runs] == [(0, 5000, 1)] and by[7].collapsed == "la"
    assert word_runs.find_runs(awkward.limit(0)).count() == 0


# 13
def test_phrases_agree_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df, cur = QUERIES["op13_collocations"](spark, SF), con.execute(ORACLES["op13_collocations"])
    assert table([tuple(r) for r in df.collect()], df.columns) == table(cur.fetchall(), [d[0] for d in cur.description])


def test_phrases_of_awkward_texts(spark, awkward, monkeypatch):
    monkeypatch.setattr(collocations, "TASK_GRAMS", 5)        # many filters a shard
    monkeypatch.setattr(collocations, "SHARD_GRAMS", 50)
    monkeypatch.setattr(collocations, "PART_PHRASES", 1)
    rows = [(i, "Big, red red dog! the Red Dog\tbarks.\nred\x0bdog", lang) for i, lang in enumerate([None, "und", "en"] * 5)]
    got = {(r.lang, r.phrase): (r.rank, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(docs_of(spark, rows), min_count=5).collect()}
    assert got == {(lang, p): (k, m, x * m, y * m, 10 * m, 1_000_000 // (x * y)) for lang, m in (("und", 10), ("en", 5))
                   for k, p, x, y in ((1, "the red dog", 1, 3), (2, "red dog barks", 4, 1), (3, "red red dog", 4, 2))}
    assert collocations.collocations(awkward.limit(0)).collect() == []
    many = {r.phrase: (r.lang, r.a) for r in collocations.collocations(awkward, min_count=3, top=None).collect()}
    assert many["la la la"] == ("en", 4998)


def test_quotient_filter_is_lossless_and_merges():
    rng = np.random.default_rng(3)
    for width, shard_bits in ((24, 0), (40, 3), (64, 2)):
        packing = collocations.Packing(width)
        ids = [rng.integers(0, 1 << min(width, 63), 3000).astype(np.uint64) for _ in range(3)]
        permuted = packing.permute(ids)
        assert all(np.array_equal(a, b) for a, b in zip(packing.restore(permuted), ids))
        columns, counts = collocations.summed(permuted, rng.choice([1, 2, 254, 255, 10**12], 3000))
        shard = packing.shard_of(columns[0], shard_bits)
        for s in range(1 << shard_bits):
            own, n = [c[shard == s] for c in columns], counts[shard == s]
            read, back = collocations.QuotientFilter.unpack(packing, collocations.QuotientFilter.pack(packing, own, n, shard_bits), 3, s, shard_bits)
            assert all(np.array_equal(a, b) for a, b in zip(read, own)) and np.array_equal(back, n)
        twice, doubled = collocations.summed([np.concatenate([c, c]) for c in columns], np.concatenate([counts, counts]))
        assert all(np.array_equal(a, b) for a, b in zip(twice, columns)) and np.array_equal(doubled, 2 * counts)


def test_word_ids_take_another_seed_on_a_clash(spark):
    words = spark.createDataFrame([("en", f"w{i}".encode(), 10) for i in range(3000)], "lang string, word binary, f long")
    named, n, attempt, width = collocations.frequent_words(words, 10)
    ids = {(r.lang, bytes(r.word)): r.id for r in named.collect()}
    assert n == len(set(ids.values())) == 3000
    assert all(i == xxhash.xxh64_intdigest(w, collocations.word_seed(lang, attempt)) >> 64 - width for (lang, w), i in ids.items())

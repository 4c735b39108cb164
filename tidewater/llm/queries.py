"""The registered queries of the training-data operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bloom_lm, collocations, decontaminate, licenses, line_dedup, mixing, near_dup, personal_data, quality, token_file, url_filter, vector_file, word_runs
from tidewater.sources.durable import scratch
from tidewater.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query(r"""
with docs as (select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
lines as (select r, generate_subscripts(string_split(text, chr(10)), 1) as i, unnest(string_split(text, chr(10))) as line from docs),
keyed as (select r, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
often as (select k from keyed where k <> '' group by k having count(distinct r) >= 10),
marked as (select r, i, line, k in (select k from often) as gone from keyed)
select d.doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from docs d join marked m using (r) group by d.r, d.doc_id""")
def op10_line_dedup(t: Tables) -> DataFrame:
    """Lines that ten or more documents share, dropped everywhere."""
    return line_dedup.dedup_lines(t.documents, min_docs=10).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op8_pairwise_quality(t: Tables) -> DataFrame:
    """Quality score of every document from preference pairs; a quarter of the ids is held out of learning."""
    scored = quality.score(t.documents, quality.main_fold(t.documents, t.labels))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.SCORE_AT_CUT).cast("int").alias("predicted"))


@query()
def op6_lsh_forest(t: Tables) -> DataFrame:
    """Components of near-duplicate documents on two-word shingles."""
    return near_dup.near_duplicates(t.documents, words=2, percent=80)


@query()
def op2_spaced_seeds(t: Tables) -> DataFrame:
    """Documents that repeat benchmark items, with the words they repeat."""
    return decontaminate.leaks(t.documents, t.benchmark)


@query()
def op5_curriculum_mix(t: Tables) -> DataFrame:
    """Words the mix takes of every document, and when and after how many words training meets it first."""
    return mixing.mix(t.documents).select("doc_id", "size", "source_size", "target", "taken", "position", "start")


def _is(kind: int):
    return lambda s: s.kind == kind


#: Fixed values of the contract.
URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


@query()
def op9_url_ngrams(t: Tables) -> DataFrame:
    """Verdict on every page's url."""
    return url_filter.judge(t.pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("""
with ok as (select vec_id, [floor(256 * x::double)::bigint::double for x in embedding] as v from embeddings
            where len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
           from ok q join ok c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5""")
def op4_vector_file(t: Tables) -> DataFrame:
    """Five greatest inner products for every fiftieth vector."""
    return vector_file.top_k(t.embeddings, F.col("vec_id") % 50 == 0, k=5)


@query()
def op3_license_scan(t: Tables) -> DataFrame:
    """Where documents state a licence, with the covered share of the notice."""
    return licenses.scan(t.documents)


@query()
def op7_context_bootstrap(t: Tables) -> DataFrame:
    """Personal data in every document; counts and digest of the base spans, and all spans."""
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(personal_data.KINDS)]
    return personal_data.detect(t.documents).select("doc_id", *counts, F.sha2(personal_data.listed("base"), 256).alias("base_sha256"), personal_data.listed("spans").alias("spans"))


@query()
def op1_range_coded_ids(t: Tables) -> DataFrame:
    """Token ids of all documents, written to range-coded files and read back."""
    import public_tokenizers

    path = scratch(t.spark, "token-file")
    token_file.write(t.documents, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_file.read(t.spark, path)


@query()
def op12_word_runs(t: Tables) -> DataFrame:
    """Runs of repeated words, in documents of which a tenth repeat their tail by rule."""
    numbered = t.documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("crc"))
    found = word_runs.find_runs(word_runs.with_periodic_tails(numbered))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query(r"""
with docs as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
pieces as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from docs),
words as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
f1 as (select lang, p, count(*) as f from (select lang, unnest(w) as p from words) group by all),
f2 as (select lang, a, b, count(*) as f from (select lang, unnest(w[:-2]) as a, unnest(w[2:]) as b from words where len(w) > 1) group by all having count(*) >= 10),
f3 as (select lang, a, b, c, count(*) as f from (select lang, unnest(w[:-3]) as a, unnest(w[2:-2]) as b, unnest(w[3:]) as c from words where len(w) > 2) group by all having count(*) >= 10),
cuts as (select f2.lang, f2.a || ' ' || f2.b as phrase, 1 as k, f2.f as a, x.f as l, y.f as r from f2 join f1 x on x.lang = f2.lang and x.p = f2.a join f1 y on y.lang = f2.lang and y.p = f2.b
         union all select f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, 1, f3.f, x.f, y.f from f3 join f1 x on x.lang = f3.lang and x.p = f3.a join f2 y on y.lang = f3.lang and y.a = f3.b and y.b = f3.c
         union all select f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, 2, f3.f, x.f, y.f from f3 join f2 x on x.lang = f3.lang and x.a = f3.a and x.b = f3.b join f1 y on y.lang = f3.lang and y.p = f3.c),
scored as (select *, 1000000::hugeint * a * a // (l::hugeint * r) as score from cuts),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (select lang, a || ' ' || b as phrase, f from f3 union all select lang, b || ' ' || c, f from f3),
left_over as (select * from lowest x where not exists (select 1 from inside i where i.lang = x.lang and i.phrase = x.phrase and 100 * i.f >= 50 * x.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from left_over),
totals as (select lang, sum(f) as n from f1 group by lang)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked join totals using (lang) where rank <= 2000""")
def op13_collocations(t: Tables) -> DataFrame:
    """Phrases of two and three words that keep together, best 2000 of each language."""
    return collocations.collocations(t.documents)


@query()
def op11_bloom_lm(t: Tables) -> DataFrame:
    """log10 probability of every document; a seventh of the ids is held out of training."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    model = bloom_lm.train(t.documents.filter(~held_out))
    return bloom_lm.score(t.documents, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

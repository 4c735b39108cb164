"""From raw documents to token files: five stages, each over all rows that the one before kept.

1. quality: documents whose pairwise quality score lies below the cut go.
2. near_duplicates: of every component of near-duplicates (five-word shingles, similarity 0.8) the document with
   the least id stays. Rows with a null id stay.
3. decontamination: documents that repeat a benchmark item go.
4. mixing: rows appear as often as the curriculum mix begins them, up to twice; documents that it does not reach,
   or without words, go. A document at the border of a source's target enters whole.
5. token_ids: the remaining rows are written as range-coded ids and read back.

Each stage's rows are written as Parquet below the shared folder and read again. Empty tables pass through.
Extra columns pass the first four stages untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontaminate, mixing, near_dup, quality, token_file
from tidewater.sources.durable import durable, scratch

#: SQL cannot express a fitted score; ``tests/llm`` compare the stages with brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.main_fold(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.first_of_each(docs, words=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-file")
    token_file.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_file.read(spark, path)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_ids", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns what the last one returns."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Language identification drops what it cannot place, the shingle join keeps one
document of each group of near copies, decontamination drops documents that
hold a benchmark item, the mix takes each source to its target, and the last
stage writes token ids and returns what it reads back from the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import decontamination, jaccard_join, language_id, mixing, queries, token_shards
from gleaner.sources.scratch import scratch_path, stage

# Below this share of agreement with the nearest profile a text is no language that was learned.
LEAST_AGREEMENT = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and those far from every profile learned from ``docs``; a null text goes."""
    profiles = language_id.learn_profiles(docs.filter(queries.remainder(4) != 2))
    names = {"lang_pred": "_had_lang_pred", "score": "_had_score"}
    given = docs.withColumnsRenamed(names)
    known = language_id.identify(given, profiles)
    kept = known.filter((known["lang_pred"] != language_id.UNKNOWN) & (known["score"] >= LEAST_AGREEMENT)).drop("lang_pred", "score")
    return kept.withColumnsRenamed({v: k for k, v in names.items()}).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by four fifths of their five-word shingles, the one with the smallest id."""
    return jaccard_join.keep_one(docs, width=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of ``benchmark``, edited by up to a tenth."""
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a repeated document is a repeated row."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Files of token ids with their index; doc_id, start, n_tokens and ids_crc32 as read from them."""
    folder = scratch_path(spark, "pipeline-shards")
    token_shards.write_shards(docs, folder, queries.tokenizer(), queries.END_ID)
    return token_shards.digests(docs, folder)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_shards", write_token_ids),
]

# Profiles, edit distances and tokenizers are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

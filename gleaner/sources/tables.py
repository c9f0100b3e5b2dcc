"""Stores for chunks and vectors, and the delta between a corpus and a store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.common import require_rows


def write_chunks(chunks: DataFrame, path: str, mode: str = "overwrite") -> None:
    chunks.write.mode(mode).parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Stored chunks; a missing or an empty store is an error."""
    return require_rows(spark.read.parquet(path), f"chunk store {path}")


def write_vectors(vectors: DataFrame, path: str, collection: str | None = None, mode: str = "append") -> None:
    """Append vectors to a store partitioned by ``collection``."""
    named = vectors if collection is None else vectors.withColumn("collection", F.lit(collection))
    named.write.mode(mode).partitionBy("collection").parquet(path)


def read_vectors(spark: SparkSession, path: str, collection: str | None = None) -> DataFrame:
    """Vectors of one collection, read from its own folder only, or all of them."""
    stored = spark.read.parquet(path)
    return stored if collection is None else stored.filter(F.col("collection") == collection).drop("collection")


def vector_counts(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("collection").agg(F.count(F.lit(1)).alias("n_vectors"))


def ingest_delta(chunks: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Chunks whose ``content_hash`` is not stored yet; all of them without a store."""
    if stored is None:
        return chunks
    return chunks.join(stored.select("content_hash"), "content_hash", "left_anti")


def ingest_report(documents: DataFrame, chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row per stage: documents, chunks and vectors with their counts."""

    def counted(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), "n")

    return counted(documents, "documents").union(counted(chunks, "chunks")).union(counted(vectors, "vectors"))

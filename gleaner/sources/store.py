"""A chunk store in which a changed document replaces its chunks.

Every ingested batch is a version: a folder of chunks and, written after it, a
folder of manifest rows that say which documents it holds. The newest manifest
row of a document is the one that counts; a removed document has a tombstone.
Both are kept in folders by a prefix of the name's hash, and a batch reads the
prefixes of its own documents only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.chunking import with_content_hash
from gleaner.sources.scratch import stage

# Hex digits of a name's hash that name its folder; one store keeps to one number.
PREFIX_DIGITS = 1
MANIFEST = "file_name string, doc_hash string, removed boolean, seq bigint, version string, prefix string"


def prefix_of(name: Column, digits: int = PREFIX_DIGITS) -> Column:
    return F.substring(F.sha2(name, 256), 1, digits)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All manifest rows of the store; none where there is no store yet.

    Only a folder that is not there counts as no store, any other failure is
    one.
    """
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def live_documents(manifest: DataFrame) -> DataFrame:
    """``(prefix, file_name, doc_hash, version)`` of the documents that the store holds now."""
    newest = manifest.groupBy("prefix", "file_name").agg(F.max(F.struct("seq", "version", "doc_hash", "removed")).alias("last"))
    return newest.filter(~F.col("last.removed")).select("prefix", "file_name", "last.doc_hash", "last.version")


def _prefixes(rows: DataFrame) -> list[str]:
    """The prefixes of a batch: no more than there are."""
    return sorted(r["prefix"] for r in rows.select("prefix").distinct().collect())


def changed_documents(documents: DataFrame, manifest: DataFrame, digits: int = PREFIX_DIGITS) -> DataFrame:
    """Rows of ``documents(file_name, text, ...)`` that the store lacks or holds in another form, with ``doc_hash`` and ``prefix``.

    Manifest rows of other prefixes are not read.
    """
    hashed = documents.withColumn("doc_hash", F.sha2(F.coalesce("text", F.lit("")), 256)).withColumn("prefix", prefix_of(F.col("file_name"), digits))
    near = manifest.filter(F.col("prefix").isin(_prefixes(hashed)))
    return hashed.join(live_documents(near).select("prefix", "file_name", "doc_hash"), ["prefix", "file_name", "doc_hash"], "left_anti")


def _commit(spark: SparkSession, rows: DataFrame, path: str, version: str) -> None:
    """Write the manifest rows of ``version``; they come after all versions but itself."""
    last = read_manifest(spark, path).filter(F.col("version") != version).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
    placed = rows.withColumn("seq", F.lit(last + 1).cast("bigint")).select("file_name", "doc_hash", "removed", "seq", "prefix")
    placed.hint("rebalance", "prefix").write.mode("overwrite").partitionBy("prefix").parquet(f"{path}/manifest/version={version}")


def ingest_documents(documents: DataFrame, chunker: Callable[[DataFrame], DataFrame], path: str, version: str, digits: int = PREFIX_DIGITS) -> None:
    """Chunk the new and changed ones of ``documents(doc_id, file_name, text)`` into the store.

    A document that comes twice in one batch counts once. A batch that is
    repeated under its ``version`` overwrites itself; another version must
    have another name. Chunks become visible with the manifest, which is
    written last.
    """
    spark = documents.sparkSession
    earlier = read_manifest(spark, path).filter(F.col("version") != version)
    batch = stage(changed_documents(documents.dropDuplicates(["file_name"]), earlier, digits), "changed-documents")
    chunks = with_content_hash(chunker(batch.drop("doc_hash", "prefix"))).withColumn("prefix", prefix_of(F.col("file_name"), digits))
    # a folder's rows meet in few files, and a large folder in as many as it needs
    chunks.hint("rebalance", "prefix").write.mode("overwrite").partitionBy("prefix").parquet(f"{path}/chunks/version={version}")
    _commit(spark, batch.select("file_name", "doc_hash", "prefix", F.lit(False).alias("removed")), path, version)


def remove_documents(names: DataFrame, path: str, version: str, digits: int = PREFIX_DIGITS) -> None:
    """Tombstones for ``names(file_name)``."""
    rows = names.select("file_name").distinct().select("file_name", F.lit(None).cast("string").alias("doc_hash"), prefix_of(F.col("file_name"), digits).alias("prefix"), F.lit(True).alias("removed"))
    _commit(names.sparkSession, rows, path, version)


def read_store(spark: SparkSession, path: str, names: DataFrame | None = None, digits: int = PREFIX_DIGITS) -> DataFrame:
    """Chunks of the documents that the store holds now, of ``names(file_name)`` only where given.

    Asked for by name, only the prefixes of these names are read.
    """
    manifest, chunks = read_manifest(spark, path), spark.read.option("basePath", f"{path}/chunks").parquet(f"{path}/chunks")
    live = live_documents(manifest)
    if names is not None:
        wanted = names.select("file_name").distinct().withColumn("prefix", prefix_of(F.col("file_name"), digits))
        near = _prefixes(wanted)
        manifest, chunks = manifest.filter(F.col("prefix").isin(near)), chunks.filter(F.col("prefix").isin(near))
        live = live_documents(manifest).join(wanted, ["prefix", "file_name"], "left_semi")
    chunks = chunks.withColumn("prefix", F.col("prefix").cast("string")).withColumn("version", F.col("version").cast("string"))
    return chunks.join(live.select("prefix", "file_name", "version"), ["prefix", "file_name", "version"], "left_semi").drop("prefix", "version")

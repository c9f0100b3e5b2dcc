"""Exact deduplication by sorting contents.

Texts are compared without white space. Sampled splitters deal the normalised
texts out by range, each task sorts its range externally, and neighbours are
compared in full. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.sources.scratch import stage

BLANKS = " \t\n\x0b\x0c\r"
# Of a text, the sampled splitters hold so many characters and a hash, so that the sample on the driver stays small.
SPLITTER_CHARS = 32
# A hot group is known to the driver's broadcast by its digest alone; there are at most this many.
MAX_HOT = 100_000


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = 512) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their texts are after deleting blanks. Of equal rows
    the one with the longest original text, then the smallest id stays; a null
    id comes last, and of rows alike in both any one stays. A null text is an
    empty one, and all empty texts form one group. Other columns of ``docs``
    are ignored; an empty table gives an empty one.

    A group of more than ``slice_rows`` rows is cut into slices by id. Each
    slice is sorted on its own, and only the slices' winners, again compared
    in full, meet. The digests of such groups are broadcast: at most
    ``MAX_HOT`` of 32 bytes, since slices grow with the table.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    slice_rows = max(slice_rows, -(-docs.count() // MAX_HOT))
    norm = normalised(F.col("_text"))
    sha = F.unhex(F.sha2(norm, 256))
    counts = source.groupBy(sha.alias("sha")).agg(F.count(F.lit(1)).alias("n"))
    hot = stage(counts.filter(F.col("n") > slice_rows).select("sha", F.ceil(F.col("n") / slice_rows).alias("slices")), "hot-copies")

    rows = (
        source.select(
            "doc_id", norm.alias("norm"), sha.alias("sha"),
            F.coalesce(F.char_length("_text"), F.lit(0)).alias("chars"),
        )
        .join(F.broadcast(hot), "sha", "left")
        .withColumn("slice", F.when(F.col("slices").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("slices"))).otherwise(0))
        .select("doc_id", "norm", "sha", "chars", "slice", F.col("slices").isNotNull().alias("is_hot"),
                F.substring("norm", 1, SPLITTER_CHARS).alias("head"), F.xxhash64("norm").alias("hash"))
    )
    ranged = rows.repartitionByRange("head", "hash", "slice")
    equal = Window.partitionBy("head", "hash", "slice", "norm")
    best_first = equal.orderBy(F.desc("chars"), F.asc_nulls_last("doc_id"))
    compared = ranged.select(
        "doc_id", "sha", "slice", "is_hot", "chars", "norm",
        F.row_number().over(best_first).alias("place"),
        F.first("doc_id").over(best_first).alias("keep_id"),
        F.count(F.lit(1)).over(equal).alias("group_size"),
    ).withColumn("norm", F.when(F.col("is_hot") & (F.col("place") == 1), F.col("norm")))
    slices = stage(compared, "slices")

    whole = Window.partitionBy("norm")
    winner_first = whole.orderBy(F.desc("chars"), F.asc_nulls_last("doc_id"), "slice")
    merged = (
        slices.filter(F.col("is_hot") & (F.col("place") == 1))
        .select(
            "sha", F.col("doc_id").alias("_keep"), F.col("slice").alias("_slice"),
            F.row_number().over(winner_first).alias("_place"),
            F.sum("group_size").over(whole).alias("_size"),
        )
        .filter(F.col("_place") == 1)
        .drop("_place")
    )
    return slices.join(F.broadcast(merged), "sha", "left").select(
        "doc_id",
        F.when(F.col("is_hot"), F.col("_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("_size", "group_size").alias("group_size"),
        ((F.col("place") == 1) & (~F.col("is_hot") | (F.col("slice") == F.col("_slice")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )

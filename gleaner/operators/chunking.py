"""Cutting documents into chunks. Both cutters work row by row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as tx

CHUNK_SIZE = 1024
CHUNK_OVERLAP = 204

# A sentence with the white space that ends it, or the rest of the text.
SENTENCE = rf"[\s\S]+?(?:{tx.SENTENCE_BREAK}|\z)"


def chunk_windows(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Fixed windows of ``size`` words, each sharing ``overlap`` words with the one before.

    Documents without a word give no chunk.
    """
    stride = size - overlap
    word = F.col("_words")
    starts = F.sequence(F.lit(0), F.greatest(F.size(word) - overlap - 1, F.lit(0)), F.lit(stride))
    windows = F.transform(starts, lambda i: F.slice(word, i + 1, size))
    return (
        documents.withColumn("_words", tx.spaced_words(F.col("text")))
        .select("doc_id", "file_name", F.posexplode(windows).alias("chunk_no", "_window"))
        .select(
            F.concat_ws("#", F.col("doc_id"), F.col("chunk_no")).alias("chunk_id"),
            "doc_id",
            "file_name",
            F.col("chunk_no").cast("bigint").alias("chunk_no"),
            tx.strip_end(F.array_join("_window", "")).alias("text"),
            F.size("_window").cast("bigint").alias("n_words"),
        )
        .filter(F.col("n_words") > 0)
    )


def _units(text: Column, size: int, overlap: int) -> Column:
    """Sentences with their word counts; one above ``size`` words becomes windows.

    Every unit keeps the white space after it.
    """

    def cut(sentence: Column) -> Column:
        found = tx.spaced_words(sentence)
        starts = F.sequence(F.lit(0), F.greatest(F.size(found) - overlap - 1, F.lit(0)), F.lit(size - overlap))
        windows = F.transform(starts, lambda i: F.slice(found, i + 1, size))
        long = F.transform(windows, lambda w: F.struct(F.array_join(w, "").alias("text"), F.size(w).alias("n")))
        short = F.array(F.struct(F.array_join(found, "").alias("text"), F.size(found).alias("n")))
        return F.when(F.size(found) > size, long).otherwise(short)

    sentences = F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))
    return F.filter(F.flatten(F.transform(sentences, cut)), lambda unit: unit["n"] > 0)


def _borders(units: Column, size: int, overlap: int) -> Column:
    """Half-open unit ranges of the chunks, as an array of (first, last).

    A fold over the units: a chunk takes units while they fit. The next one
    reopens with the longest run of closing units that stays within
    ``overlap`` words and leaves room for the first new unit. The state holds
    the lengths of the open chunk's units only.
    """
    number = lambda value: F.lit(value).cast("int")
    total = lambda lengths: F.aggregate(lengths, number(0), lambda n, x: n + x)

    def step(state: Column, unit: Column) -> Column:
        n, held = unit["n"], state["held"]
        limit = F.least(number(overlap), number(size) - n)
        # how many closing units fit into the limit, never all of the chunk
        run = F.aggregate(
            F.reverse(held), F.struct(number(0).alias("sum"), number(0).alias("count"), F.lit(True).alias("open")),
            lambda r, x: F.struct(
                F.when(r["open"] & (r["sum"] + x <= limit), r["sum"] + x).otherwise(r["sum"]).alias("sum"),
                F.when(r["open"] & (r["sum"] + x <= limit), r["count"] + 1).otherwise(r["count"]).alias("count"),
                (r["open"] & (r["sum"] + x <= limit)).alias("open"),
            ),
        )
        kept = F.least(run["count"], F.size(held) - 1)
        fits = total(held) + n <= size
        return F.struct(
            (state["next"] + 1).alias("next"),
            F.when(fits, state["first"]).otherwise(state["next"] - kept).alias("first"),
            F.concat(F.when(fits, held).otherwise(F.slice(held, F.size(held) - kept + 1, F.greatest(kept, number(0)))), F.array(n)).alias("held"),
            F.when(fits, state["out"]).otherwise(F.concat(state["out"], F.array(F.struct(state["first"].alias("first"), state["next"].alias("last"))))).alias("out"),
        )

    start = F.struct(
        number(0).alias("next"), number(0).alias("first"), F.array().cast("array<int>").alias("held"),
        F.array().cast("array<struct<first: int, last: int>>").alias("out"),
    )
    closing = lambda state: F.concat(state["out"], F.array(F.struct(state["first"].alias("first"), state["next"].alias("last"))))
    return F.when(F.size(units) > 0, F.aggregate(units, start, step, closing)).otherwise(F.array().cast("array<struct<first: int, last: int>>"))


def chunk_sentences(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Chunks of whole sentences up to ``size`` words, overlapping by whole sentences.

    Packing is a running decision over the sentences of one document, made by
    a fold inside the row: no shuffle, and no Python.
    """
    units = documents.select("doc_id", "file_name", _units(F.col("text"), size, overlap).alias("_units"))
    cut = units.select("doc_id", "file_name", "_units", F.posexplode(_borders(F.col("_units"), size, overlap)).alias("_no", "_border"))
    held = F.slice("_units", F.col("_border.first") + 1, F.col("_border.last") - F.col("_border.first"))
    return cut.select("doc_id", "file_name", F.col("_no").cast("bigint").alias("chunk_no"), held.alias("_held")).select(
        F.concat_ws("#", F.col("doc_id"), F.col("chunk_no")).alias("chunk_id"), "doc_id", "file_name", "chunk_no",
        tx.strip_end(F.array_join("_held.text", "")).alias("text"),
        F.aggregate("_held.n", F.lit(0).cast("bigint"), lambda n, x: n + x).alias("n_words"),
    )


def with_content_hash(chunks: DataFrame) -> DataFrame:
    """Adds ``content_hash``, stable across runs for the same file, position and text."""
    return chunks.withColumn("content_hash", tx.content_hash(F.col("file_name"), F.col("chunk_no"), F.col("text")))

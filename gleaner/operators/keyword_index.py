"""The keyword index: postings, chunk lengths and document frequencies as tables.

Postings are laid out by chunk, not by term. A frequent term then spreads over
all partitions, every term of a chunk sits in one place, and the scores of a
chunk add up without moving postings.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import text as tx
from gleaner.operators.common import require_rows
from gleaner.sources.scratch import stage


@dataclass(frozen=True)
class KeywordIndex:
    """``postings(chunk_id, term, tf, dl)``, ``chunk_stats(chunk_id, dl)``, ``term_stats(term, df)``."""

    postings: DataFrame
    chunk_stats: DataFrame
    term_stats: DataFrame
    partitions: int | None = None
    # The same postings, one row per chunk, with the number of its texts and their lengths:
    # ``lists(chunk_id, found, n_texts, lengths)``, where they are at hand.
    lists: DataFrame | None = None

    def by_chunk(self) -> DataFrame:
        """``(chunk_id, found)``, all postings of a chunk in one row."""
        if self.lists is not None:
            return self.lists
        return self.postings.groupBy("chunk_id").agg(F.collect_list(F.struct("term", "tf", "dl")).alias("found"))

    def size_and_mean(self) -> tuple[Column, Column]:
        """Number of chunks and mean chunk length, as one scalar subquery."""
        both = self.chunk_stats.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("mean"))).scalar()
        return both["n"], both["mean"]


def term_counts(term_lists: Column) -> Column:
    """``array<struct<term, tf, dl>>``: the distinct terms of a chunk's term lists, ``dl`` the size of the longest list with the term.

    The terms are sorted inside the row and their runs measured, so that no
    table of (chunk, term) groups is held.
    """
    tagged = F.flatten(F.transform(term_lists, lambda ts: F.transform(ts, lambda t: F.struct(t.alias("term"), F.size(ts).cast("bigint").alias("dl")))))

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        last = lambda i: (i == n) | (F.get(ordered, i)["term"] != F.get(ordered, i - 1)["term"])
        return F.when(n > 0, F.filter(F.sequence(F.lit(1), n), last)).otherwise(F.array().cast("array<int>"))

    def counted(ordered: Column, ends: Column) -> Column:
        def one(end: Column, at: Column) -> Column:
            row = F.get(ordered, end - 1)
            return F.struct(row["term"].alias("term"), (end - F.coalesce(F.get(ends, at - 1), F.lit(0))).cast("bigint").alias("tf"), row["dl"].alias("dl"))

        return F.transform(ends, one)

    # arrays of one element bind what is used more than once
    bound = F.transform(F.array(F.sort_array(tagged)), lambda s: F.struct(s.alias("s"), runs(s).alias("e")))
    return F.get(F.transform(bound, lambda x: counted(x["s"], x["e"])), F.lit(0))


def build_index(chunks: DataFrame, stop_words: list[str] | None = None, partitions: int | None = None) -> KeywordIndex:
    """Index over ``chunks(chunk_id, text)``; texts of the same id make one chunk.

    The tables of postings share one exchange on ``chunk_id``; Spark reuses it when
    they meet in one query. It moves texts: they are smaller than their terms,
    which are counted behind it, inside the row of their chunk. Chunk lengths
    need no exchange, unless ``partitions`` is set to the bucket count of a
    later ``save_index``; nothing is exchanged a second time to be saved then.
    """

    def found(text: Column) -> Column:
        return F.filter(tx.terms(text), lambda t: ~t.isin(stop_words)) if stop_words else tx.terms(text)

    texts = chunks.select("chunk_id", "text")
    placed = texts.repartition("chunk_id") if partitions is None else texts.repartition(partitions, "chunk_id")
    chunk_stats = (texts if partitions is None else placed).select("chunk_id", F.size(found(F.col("text"))).cast("bigint").alias("dl"))
    gathered = placed.groupBy("chunk_id").agg(F.collect_list("text").alias("texts"), F.count(F.lit(1)).alias("n_texts"))
    # bound once: the terms are asked for their counts and for their number
    cut = F.transform(F.array(F.transform("texts", found)), lambda ts: F.struct(
        term_counts(ts).alias("found"), F.transform(ts, lambda t: F.size(t).cast("bigint")).alias("lengths")
    ))
    lists = gathered.select("chunk_id", F.get(cut, F.lit(0)).alias("cut"), "n_texts")
    return _of_lists(lists.select("chunk_id", "cut.found", "n_texts", "cut.lengths"), chunk_stats, partitions)


def _of_lists(lists: DataFrame, chunk_stats: DataFrame, partitions: int | None = None) -> KeywordIndex:
    postings = lists.select("chunk_id", F.inline("found")).select("chunk_id", "term", "tf", "dl")
    term_stats = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return KeywordIndex(postings, chunk_stats, term_stats, partitions, lists)


def staged_index(index: KeywordIndex) -> KeywordIndex:
    """The index with its tables staged, for work that reads it several times: the texts are cut into terms once."""
    staged = _of_lists(stage(index.by_chunk(), "index-lists", "zstd"), stage(index.chunk_stats, "index-chunks"))
    return replace(staged, term_stats=stage(staged.term_stats, "index-terms"))


def save_index(index: KeywordIndex, name: str, path: str, buckets: int = 64) -> None:
    """Persist the index as tables ``{name}_postings``, ``{name}_chunks`` and ``{name}_terms``.

    Postings and chunk lengths are bucketed by chunk, so that a search needs no
    exchange of postings; it reads all of them. An index that is read in part
    is written by ``pruned_index.save_pruned``.
    """
    for table, frame, key, order in (
        ("postings", index.postings, "chunk_id", "term"),
        ("chunks", index.chunk_stats, "chunk_id", "chunk_id"),
        ("terms", index.term_stats, "term", "term"),
    ):
        placed = key == "chunk_id" and index.partitions == buckets
        (
            (frame if placed else frame.repartition(buckets, key))
            .write.bucketBy(buckets, key)
            .sortBy(order)
            .mode("overwrite")
            .option("path", f"{path}/{table}")
            .saveAsTable(f"{name}_{table}")
        )


def load_index(spark: SparkSession, name: str) -> KeywordIndex:
    """Index saved under ``name``; an index without chunks is an error."""
    chunk_stats = require_rows(spark.table(f"{name}_chunks"), f"keyword index {name}")
    return KeywordIndex(spark.table(f"{name}_postings"), chunk_stats, spark.table(f"{name}_terms"))

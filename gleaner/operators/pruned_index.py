"""A stored keyword index that a batch of questions reads only in part.

Chunks are dealt into ranges by hash. The postings of one term in one range are
a block, one row, and beside them the block keeps what bounds its scores. A
search adds up the bounds of its terms per range, scores the most promising
ranges first, and then only those that can still reach the k-th score found.
Blocks lie in folders named by a hash of term and range, so that both choices
reach the files: what was not asked for is not opened. A range is scored by one
task for some thousand queries at a time, so that pairs of query and chunk are
never rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import text as tx
from gleaner.operators.common import require_rows, top_k
from gleaner.operators.keyword_index import KeywordIndex
from gleaner.operators.retrieval import BM25_B, BM25_K1, CHUNK_BLOCK, QUERY_BLOCK, SCORE_DIGITS, TOP_K, _bag_matrix, _Best, _plain_ids, _score_block, _sortable_ids
from gleaner.sources.scratch import stage

BUCKETS = 256
RANGE_CHUNKS = 4096
# So many ranges of a term share a folder; a term with more of them spreads over several.
RANGES_PER_FOLDER = 64
# Ranges that give a query its first k hits and with them the score to beat.
FIRST_RANGES = 2
# Postings that one task groups into blocks when the index is written, and queries that meet one range in one task.
TASK_POSTINGS = 1 << 19
PART_QUERIES = 4096


@dataclass(frozen=True)
class PrunedIndex:
    """``blocks(bucket, term, range, max_tf, min_dl, n, chunk_ids, tfs, dls)``, ``terms(bucket, term, df)``."""

    blocks: DataFrame
    terms: DataFrame
    n_chunks: int
    mean_dl: float
    buckets: int
    ranges: int


def _folder(buckets: int, *keys: str | Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _block_folder(buckets: int) -> Column:
    return _folder(buckets, "term", F.floor(F.col("range") / RANGES_PER_FOLDER))


def save_pruned(index: KeywordIndex, path: str, buckets: int = BUCKETS, range_chunks: int = RANGE_CHUNKS) -> None:
    """Write ``index`` under ``path``; an index without chunks is an error.

    The number of ranges follows the number of chunks. A frequent term has
    a block in every range and spreads over the folders, 64 ranges each; a
    rare one lies in a single folder. The postings are moved once, and a
    folder is written by as many tasks as its postings need.
    """
    stats = index.chunk_stats.agg(F.count(F.lit(1)).alias("n_chunks"), F.avg("dl").alias("mean_dl")).first()
    if not stats["n_chunks"]:
        raise ValueError("keyword index is empty or missing")
    spark = index.postings.sparkSession
    ranges = math.ceil(stats["n_chunks"] / range_chunks)

    slices = max(1, math.ceil(stats["n_chunks"] * (stats["mean_dl"] or 0) / (buckets * TASK_POSTINGS)))

    def write(placed: DataFrame, name: str, *order: str) -> None:
        # sorted by term, so that a file's statistics tell its terms apart
        placed.sortWithinPartitions("bucket", *order).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{name}")

    ranged = index.postings.withColumn("range", F.pmod(F.xxhash64("chunk_id"), F.lit(ranges)))
    sliced = ranged.withColumns({"bucket": _block_folder(buckets), "slice": F.pmod(F.hash("term", "range"), F.lit(slices))})
    blocks = sliced.repartition(buckets * slices, "bucket", "slice").groupBy("bucket", "slice", "term", "range").agg(
        F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"), F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("chunk_id", "tf", "dl")).alias("found"),
    )
    lists = [F.col("found.chunk_id").alias("chunk_ids"), F.col("found.tf").alias("tfs"), F.col("found.dl").alias("dls")]
    write(blocks.select("bucket", "term", "range", "max_tf", "min_dl", "n", *lists), "blocks", "term", "range")
    terms = spark.read.parquet(f"{path}/blocks").groupBy("term").agg(F.sum("n").alias("df"))
    write(terms.withColumn("bucket", _folder(buckets, "term")).repartition(buckets, "bucket"), "terms", "term")
    meta = spark.createDataFrame([(stats["n_chunks"], stats["mean_dl"] or 0.0, buckets, ranges)], "n_chunks bigint, mean_dl double, buckets int, ranges bigint")
    # written last: an index that was not finished has none
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def open_pruned(spark: SparkSession, path: str) -> PrunedIndex:
    """The index stored under ``path``."""
    meta = require_rows(spark.read.parquet(f"{path}/meta"), f"keyword index {path}").first()
    table = lambda name: spark.read.parquet(f"{path}/{name}")
    return PrunedIndex(table("blocks"), table("terms"), meta["n_chunks"], meta["mean_dl"], meta["buckets"], meta["ranges"])


def _folders(wanted: DataFrame) -> list[int]:
    """The folders that ``wanted`` names: at most one number per folder of the index."""
    return sorted(row["bucket"] for row in wanted.select("bucket").distinct().collect())


def _only(df: DataFrame, folders: list[int]) -> DataFrame:
    """Rows of ``df`` in these folders; the others are not listed, let alone opened."""
    return df.filter(F.col("bucket").isin(folders)) if folders else df.filter(F.lit(False))


def pruned_topk(index: PrunedIndex, queries: DataFrame, k: int = TOP_K, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Best ``k`` chunks per query of ``queries(query_id, text)``: the hits of :func:`bm25_topk`, exactly.

    A block's highest term frequency and smallest chunk length bound every
    score in it, whatever ``k1`` and ``b``. No chunk of a range scores above
    the sum of its blocks' bounds, so a range below the k-th score of the
    first ranges holds no hit.
    """
    query_terms = (
        queries.select("query_id", F.explode_outer(tx.terms(F.col("text"))).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
        .withColumn("bucket", _folder(index.buckets, "term"))
    )
    folders = _folders(query_terms)
    idf = F.log(1 + (F.lit(index.n_chunks) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = query_terms.join(_only(index.terms, folders), ["bucket", "term"]).select("bucket", "query_id", "term", (F.col("qtf") * idf).alias("weight"))

    mean_dl = index.mean_dl

    def impact(tf, dl):
        return tf / (tf + k1 * (1 - b + b * dl / mean_dl))

    weights = stage(weights.drop("bucket"), "asked-weights")
    asked_terms = stage(weights.select("term").distinct(), "asked-terms")
    groups = F.sequence(F.lit(0), F.lit((index.ranges - 1) // RANGES_PER_FOLDER)).cast("array<bigint>")
    named = asked_terms.select("term", F.explode(groups).alias("group")).select("term", (F.col("group") * RANGES_PER_FOLDER).alias("range"))
    asked_blocks = _only(index.blocks, _folders(named.select(_block_folder(index.buckets).alias("bucket"))))
    bounded = asked_blocks.join(weights, "term").select("query_id", "range", (F.col("weight") * impact(F.col("max_tf"), F.col("min_dl"))).alias("bound"))
    ranges = stage(bounded.groupBy("query_id", "range").agg(F.sum("bound").alias("bound")), "asked-ranges")
    bags = stage(weights.groupBy("query_id").agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights")), "asked-bags")
    parts = max(1, -(-2 * bags.count() // PART_QUERIES))

    def score(chosen: DataFrame) -> DataFrame:
        """The best k of the chosen ranges; of the others nothing is moved but blocks in which a term of another query was asked for."""
        asked = chosen.select("query_id", "range").join(bags, "query_id")
        named = stage(asked.select("range", F.explode("terms").alias("term")).select("term", (F.floor(F.col("range") / RANGES_PER_FOLDER) * RANGES_PER_FOLDER).alias("range")).distinct(), "chosen-folders")
        chosen_ranges = stage(chosen.select("range").distinct(), "chosen-ranges")
        blocks = (
            _only(index.blocks, _folders(named.select(_block_folder(index.buckets).alias("bucket"))))
            .join(chosen_ranges, "range", "left_semi").join(asked_terms, "term", "left_semi")
        )
        return top_k(_scored_ranges(blocks, asked, k, parts, impact), ["query_id"], [F.desc("score"), F.asc("chunk_id")], k)

    first = top_k(ranges, ["query_id"], [F.desc("bound"), F.asc("range")], FIRST_RANGES, "place").drop("place")
    first = stage(first, "first-ranges")
    found = stage(score(first), "first-hits")
    to_beat = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    # a rounded score may lie half a digit above the bound
    reachable = (
        ranges.join(first.select("query_id", "range"), ["query_id", "range"], "left_anti")
        .join(to_beat, "query_id", "left")
        .filter(F.col("least").isNull() | (F.col("bound") >= F.col("least") - 10.0**-SCORE_DIGITS))
    )
    reachable = stage(reachable.select("query_id", "range"), "reachable-ranges")
    both = found.drop("rank").unionByName(score(reachable).drop("rank"))
    return top_k(both, ["query_id"], [F.desc("score"), F.asc("chunk_id")], k).select("query_id", "rank", "chunk_id", "score")


def _scored_ranges(blocks: DataFrame, asked: DataFrame, k: int, parts: int, impact) -> DataFrame:
    """``(query_id, chunk_id, score)``: the best ``k`` of each range for each query of ``asked(query_id, range, terms, weights)``.

    A range meets its queries in ``parts`` tasks. ``impact`` gives the weight of term frequencies and chunk lengths.
    """
    id_type = blocks.schema["chunk_ids"].dataType.elementType
    numeric = isinstance(id_type, T.IntegralType)
    schema = T.StructType([asked.schema["query_id"], T.StructField("chunk_id", T.LongType() if numeric else T.StringType()), T.StructField("score", T.DoubleType())])
    id_kind = pa.int64() if numeric else pa.string()
    numbers = F.sequence(F.lit(0), F.lit(parts - 1))
    left = blocks.select("range", F.explode(numbers).alias("part"), "term", F.col("chunk_ids").cast("array<bigint>" if numeric else "array<string>").alias("chunk_ids"), "tfs", "dls")
    right = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))

    def flat(table: pa.Table, name: str) -> pa.Array:
        return table.column(name).combine_chunks().flatten() if table.num_rows else pa.array([], table.schema.field(name).type.value_type)

    def score(found: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "chunk_id", "score"]
        if not found.num_rows or not queries.num_rows:
            return pa.table([pa.array([], queries.schema.field("query_id").type), pa.array([], id_kind), pa.array([], pa.float64())], names)
        counts = lambda table, column: pc.list_value_length(table.column(column)).to_numpy()
        bag = np.repeat(np.arange(queries.num_rows), counts(queries, "terms"))
        terms, bag_ids, starts, ends, bags, weights = _bag_matrix(pa.table([flat(queries, "terms"), bag, flat(queries, "weights")], ["term", "bag_id", "weight"]))
        ids, row = np.unique(_sortable_ids(flat(found, "chunk_ids")), return_inverse=True)
        tf, dl = (flat(found, name).to_numpy(zero_copy_only=False).astype(np.float64) for name in ("tfs", "dls"))
        term = np.repeat(pc.index_in(found.column("term"), terms).fill_null(-1).to_numpy(), counts(found, "tfs"))
        order = np.flatnonzero(term >= 0)
        order = order[np.argsort(term[order], kind="stable")]
        term, weight, row = term[order], impact(tf, dl)[order], row[order]
        made = []
        for number in range(len(starts)):
            best = _Best(k)
            for at in range(0, len(ids), CHUNK_BLOCK):
                own = (row >= at) & (row < at + CHUNK_BLOCK)
                _score_block(best, ids[at : at + CHUNK_BLOCK], term[own], weight[own], row[own] - at, starts[number], ends[number], bags[number], weights[number], min(QUERY_BLOCK, len(bag_ids) - number * QUERY_BLOCK))
            if best.vec is not None and best.query.size:
                chosen = bag_ids.take(pa.array(best.query + number * QUERY_BLOCK))
                made.append(pa.table([queries.column("query_id").take(chosen), _plain_ids(best.vec, id_kind), pa.array(best.score)], names))
        return pa.concat_tables(made) if made else score(found[:0], queries)

    scored = left.groupBy("range", "part").cogroup(right.groupBy("range", "part")).applyInArrow(score, schema)
    return scored.withColumn("chunk_id", F.col("chunk_id").cast(id_type))

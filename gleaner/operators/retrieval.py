"""Top-k retrieval for batches of questions: keyword, dense, approximate and fused."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import text as tx
from gleaner.operators.common import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_batches, hinted, measured_size, top_k, union_all
from gleaner.operators.keyword_index import KeywordIndex
from gleaner.sources.scratch import stage

TOP_K = 5
SCORE_DIGITS = 6

# The usual BM25 constants and the rank offset of reciprocal-rank fusion.
BM25_K1 = 1.5
BM25_B = 0.75
RRF_OFFSET = 60

Retriever = Callable[[DataFrame, int], DataFrame]
"""Plug-in point: ``(queries, k) -> hits(query_id, rank, chunk_id, score)``."""


def bm25_topk(index: KeywordIndex, queries: DataFrame, k: int = TOP_K, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Best ``k`` chunks per query of ``queries(query_id, text)`` by BM25.

    Only chunks with at least one query term are returned; a term repeated in
    the query counts once per occurrence. Queries with the same terms are
    searched once. The postings that some query asks for stay in the row of
    their chunk and are staged; a term is in as many chunks as it has
    postings. The query side travels to the tasks in
    measured batches; a task scores block by block and hands on k rows per
    query, so neither postings nor pairs of query and chunk are ever rows.
    """
    query_terms = (
        queries.select("query_id", F.explode_outer(tx.terms(F.col("text"))).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )
    bags = query_terms.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "qtf"))).alias("bag"))
    asked = stage(bags.select("query_id", F.sha2(F.to_json(F.struct("bag")), 256).alias("bag_id"), "bag"), "asked")
    bag_terms = asked.groupBy("bag_id").agg(F.first("bag").alias("bag")).select("bag_id", F.inline("bag"))
    terms = stage(bag_terms.select("term").distinct(), "asked-terms")
    met, n_chunks, mean_dl = _asked_lists(index, terms)
    saturation = lambda tf, dl: tf / (tf + k1 * (1 - b + b * dl / F.lit(mean_dl)))
    lists = met.select("chunk_id", "terms", F.zip_with("tfs", "dls", saturation).alias("impacts"))
    known = lists.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = known.select("term", F.log(1 + (n_chunks - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    weights = stage(bag_terms.join(idf, "term").select("bag_id", "term", (F.col("qtf") * F.col("idf")).alias("weight")), "asked-weights")

    def score(batch: DataFrame, small: bool) -> DataFrame:
        if small:
            return _scan_postings(lists, batch, k)
        # one query of very many terms: a plain join
        met_terms = lists.select("chunk_id", F.explode(F.arrays_zip("terms", "impacts")).alias("p")).select("chunk_id", F.col("p.terms").alias("term"), F.col("p.impacts").alias("impact"))
        return met_terms.join(batch, "term").groupBy("bag_id", "chunk_id").agg(F.round(F.sum(F.col("weight") * F.col("impact")), SCORE_DIGITS).alias("score"))

    batches = broadcast_batches(weights, "bag_id")
    best = top_k(union_all([score(batch, small) for batch, small in batches]), ["bag_id"], [F.desc("score"), F.asc("chunk_id")], k)
    return asked.select("query_id", "bag_id").join(best, "bag_id").select("query_id", "rank", "chunk_id", "score")


def _asked_lists(index: KeywordIndex, terms: DataFrame) -> tuple[DataFrame, int, float | None]:
    """``(chunk_id, terms, tfs, dls)``, staged, with the postings of ``terms(term)``; then the number of chunks and their mean length.

    Lists are thinned out inside their rows by terms that travel to the tasks;
    more terms than may travel thin out nothing, which costs room only. An
    index without lists has its postings gathered by chunk.
    """
    if index.lists is None:
        n, mean = index.size_and_mean()
        found = F.collect_list(F.struct("term", "tf", "dl")).alias("found")
        gathered = index.postings.join(terms, "term", "left_semi").groupBy("chunk_id").agg(found)
        size = index.postings.sparkSession.range(1).select(n.alias("n"), mean.alias("mean")).first()
        return stage(gathered.select("chunk_id", *_list_columns()), "asked-postings"), size["n"], size["mean"]
    lists = index.lists.select("chunk_id", *_list_columns(), "n_texts", "lengths")
    if all(size <= bound for size, bound in zip(measured_size(terms), (BROADCAST_ROWS, BROADCAST_BYTES))):
        lists = _thinned_lists(lists, terms)
    lists = stage(lists, "asked-postings")
    total = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda n, x: n + F.coalesce(x, F.lit(0)))
    known = F.size(F.filter("lengths", lambda x: x.isNotNull()))
    size = lists.agg(F.coalesce(F.sum("n_texts"), F.lit(0)).alias("n"), F.sum(total).alias("total"), F.sum(known).alias("known")).first()
    mean = size["total"] / size["known"] if size["known"] else None
    return lists.filter(F.size("terms") > 0).select("chunk_id", "terms", "tfs", "dls"), size["n"], mean


def _list_columns() -> list[Column]:
    return [F.col(f"found.{field}").alias(f"{field}s") for field in ("term", "tf", "dl")]


def _thinned_lists(lists: DataFrame, terms: DataFrame) -> DataFrame:
    """``lists`` with the postings of ``terms`` only, row by row."""
    wanted = lists.sparkSession.sparkContext.broadcast(terms.select("term").toArrow().column("term").combine_chunks())

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("terms")
            found = pc.is_in(column.flatten(), wanted.value)
            kept = np.concatenate([[0], np.cumsum(found.to_numpy(zero_copy_only=False))])
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False))])
            offsets = pa.array(kept[ends].astype(np.int32))
            thinned = {name: pa.ListArray.from_arrays(offsets, batch.column(name).flatten().filter(found)) for name in ("terms", "tfs", "dls")}
            yield pa.RecordBatch.from_arrays([thinned.get(name, batch.column(name)) for name in batch.schema.names], batch.schema.names)

    return lists.mapInArrow(thin, lists.schema)


# Pairs of query and chunk that are scored at once.
SCORED_PAIRS = 1 << 21


def _scan_postings(lists: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """``(bag_id, chunk_id, score)``: of each task's ``lists(chunk_id, terms, impacts)`` the best ``k`` per bag of ``weights(bag_id, term, weight)``."""
    id_type = lists.schema["chunk_id"].dataType
    schema = T.StructType([T.StructField("bag_id", T.StringType()), T.StructField("chunk_id", id_type), T.StructField("score", T.DoubleType())])
    numeric = isinstance(id_type, T.IntegralType)
    arrow_schema = pa.schema([("bag_id", pa.string()), ("chunk_id", pa.int64() if numeric else pa.string()), ("score", pa.float64())])
    ordered = lists.withColumn("chunk_id", F.col("chunk_id").cast("bigint" if numeric else "string"))
    rows = weights.select("bag_id", "term", "weight").toArrow()
    sent = lists.sparkSession.sparkContext.broadcast(_bag_matrix(rows))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, bag_ids, starts, ends, bags, bag_weights = sent.value
        best = [_Best(k) for _ in range(0, len(bag_ids), QUERY_BLOCK)]
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_BLOCK):
                block = batch.slice(at, CHUNK_BLOCK)
                ids = _sortable_ids(block.column("chunk_id"))
                term = pc.index_in(block.column("terms").flatten(), terms).fill_null(-1).to_numpy(zero_copy_only=False)
                impact = block.column("impacts").flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(block.num_rows), pc.list_value_length(block.column("terms")).to_numpy(zero_copy_only=False))
                order = np.flatnonzero(term >= 0)
                order = order[np.argsort(term[order], kind="stable")]
                term, impact, row = term[order], impact[order], row[order]
                for number, kept in enumerate(best):
                    _score_block(kept, ids, term, impact, row, starts[number], ends[number], bags[number], bag_weights[number], min(QUERY_BLOCK, len(bag_ids) - number * QUERY_BLOCK))
        for number, kept in enumerate(best):
            if kept.vec is not None and kept.query.size:
                chosen = bag_ids.take(pa.array(kept.query + number * QUERY_BLOCK))
                yield pa.RecordBatch.from_arrays([chosen, _plain_ids(kept.vec, arrow_schema[1].type), pa.array(kept.score)], schema=arrow_schema)

    return ordered.mapInArrow(scan, T.StructType([schema[0], T.StructField("chunk_id", T.LongType() if numeric else T.StringType()), schema[2]])).select(
        "bag_id", F.col("chunk_id").cast(id_type).alias("chunk_id"), "score"
    )


QUERY_BLOCK = 1024
CHUNK_BLOCK = SCORED_PAIRS // QUERY_BLOCK


def _bag_matrix(rows: pa.Table) -> tuple:
    """Terms and bags of weights as arrays, per block of bags in the order of the terms."""
    terms, bag_ids = pc.unique(rows.column("term")), pc.unique(rows.column("bag_id"))
    term = pc.index_in(rows.column("term"), terms).to_numpy(zero_copy_only=False)
    bag = pc.index_in(rows.column("bag_id"), bag_ids).to_numpy(zero_copy_only=False)
    weight = rows.column("weight").to_numpy()
    starts, ends, bags, weights = [], [], [], []
    for at in range(0, len(bag_ids), QUERY_BLOCK):
        own = np.flatnonzero((bag >= at) & (bag < at + QUERY_BLOCK))
        own = own[np.argsort(term[own], kind="stable")]
        used, first, n = np.unique(term[own], return_index=True, return_counts=True)
        starts.append(used)
        ends.append(np.stack([first, n]))
        bags.append(bag[own] - at)
        weights.append(weight[own])
    return terms, bag_ids, starts, ends, bags, weights


def _score_block(best: _Best, ids: np.ndarray, term: np.ndarray, impact: np.ndarray, row: np.ndarray, used: np.ndarray, places: np.ndarray, bags: np.ndarray, weights: np.ndarray, n_bags: int) -> None:
    """Scores of one block of chunks for one block of bags; postings and weights are in the order of their terms."""
    low, high = np.searchsorted(term, used, "left"), np.searchsorted(term, used, "right")
    scores = np.zeros((n_bags, len(ids)))
    for t in np.flatnonzero(high > low):
        of_term, of_bags = slice(low[t], high[t]), slice(places[0, t], places[0, t] + places[1, t])
        # a term is once in a bag and once in a chunk
        scores[np.ix_(bags[of_bags], row[of_term])] += np.outer(weights[of_bags], impact[of_term])
    live = np.flatnonzero(scores.any(1))
    if len(live):
        scores = scores[live]
        best.add(ids, np.where(scores > 0, np.round(scores, SCORE_DIGITS), -np.inf).T, live)


def _sortable_ids(column: pa.Array) -> np.ndarray:
    """Ids as an array that sorts as Spark does, null first."""
    if pa.types.is_integer(column.type):
        return column.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
    return np.array(["" if v is None else "+" + v for v in column.to_pylist()], dtype=np.str_)


def _plain_ids(ids: np.ndarray, kind: pa.DataType) -> pa.Array:
    if pa.types.is_integer(kind):
        return pa.array(ids, pa.int64(), mask=ids == -(1 << 63))
    return pa.array([v[1:] if v else None for v in ids.tolist()], kind)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """List column as a (rows, dim) matrix in double precision; lists of another length are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if (pc.list_value_length(column).to_numpy(zero_copy_only=False) != dim).any():
        raise ValueError(f"vectors of another length than {dim}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.to_pylist())


class _Best:
    """The best k vectors per query seen so far, ties broken by id."""

    def __init__(self, k: int):
        self.k = k
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.vec = None

    def add(self, vec_ids: np.ndarray, scores: np.ndarray, queries: np.ndarray | None = None) -> None:
        """``scores`` is (vectors, queries), the latter numbered from 0 or as ``queries`` says."""
        rows = scores.shape[0]
        scores = np.where(np.isnan(scores), -np.inf, scores)  # no score, no hit
        kth = np.partition(scores, rows - self.k, axis=0)[rows - self.k] if rows > self.k else scores.min(axis=0)
        row, column = np.nonzero((scores >= kth) & (scores > -np.inf))
        query = np.concatenate([self.query, column if queries is None else queries[column]])
        score = np.concatenate([self.score, scores[row, column]])
        vec = vec_ids[row] if self.vec is None else np.concatenate([self.vec, vec_ids[row]])
        order = np.lexsort((vec, -score, query))
        query, score, vec = query[order], score[order], vec[order]
        first = np.searchsorted(query, query, side="left")
        keep = np.arange(query.size) - first < self.k
        self.query, self.score, self.vec = query[keep], score[keep], vec[keep]


def _hits_schema(vectors: DataFrame, queries: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("chunk_id", vectors.schema["vec_id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _hit_rows(best: _Best, query_ids: np.ndarray) -> dict[str, list]:
    return {
        "query_id": [query_ids[q].item() if isinstance(query_ids[q], np.generic) else query_ids[q] for q in best.query],
        "chunk_id": best.vec.tolist(),
        "score": best.score.tolist(),
    }


def sort_out_vectors(vectors: DataFrame, dim: int, key: str = "vec_id") -> tuple[DataFrame, DataFrame]:
    """Vectors that a search takes, and ``(key, reason)`` of those it would fail on.

    Reasons are ``null``, ``length n`` and ``not finite`` (a null, NaN or
    infinite entry), the first that holds. Both frames read ``vectors`` once each and move nothing.
    """
    size = F.size("embedding")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    reason = F.when(F.col("embedding").isNull(), "null").when(size != dim, F.concat(F.lit("length "), size)).when(bad, "not finite")
    return vectors.filter(reason.isNull()), vectors.select(key, reason.alias("reason")).filter(F.col("reason").isNotNull())


def dense_topk(
    vectors: DataFrame, queries: DataFrame, k: int = TOP_K, max_broadcast_queries: int = 4096, block_rows: int = 100_000
) -> DataFrame:
    """Exact best ``k`` of ``vectors(vec_id, embedding)`` per ``queries(query_id, embedding)`` by dot product.

    Up to ``max_broadcast_queries`` query vectors travel to the tasks, each
    task multiplies its vectors with them block by block and hands on k rows
    per query; the vectors themselves are not shuffled. Above the bound both
    sides are cut into blocks by id hash and every block pair is multiplied in
    one task, which also yields only k rows per query.
    """
    vectors = vectors.select("vec_id", "embedding").filter(F.col("embedding").isNotNull())
    queries = queries.select("query_id", "embedding").filter(F.col("embedding").isNotNull())
    schema = _hits_schema(vectors, queries)
    arrow_schema = pa.schema([
        ("query_id", pa.int64() if isinstance(schema[0].dataType, T.LongType) else pa.string()),
        ("chunk_id", pa.int64() if isinstance(schema[1].dataType, T.LongType) else pa.string()),
        ("score", pa.float64()),
    ])
    few = queries.limit(max_broadcast_queries + 1).toArrow()
    if few.num_rows <= max_broadcast_queries:
        partial = _dense_broadcast(vectors, few, k, schema, arrow_schema)
    else:
        partial = _dense_blocks(vectors, queries, k, max_broadcast_queries, block_rows, schema, arrow_schema)
    return top_k(partial, ["query_id"], [F.desc("score"), F.asc("chunk_id")], k).select("query_id", "rank", "chunk_id", "score")


def _dense_broadcast(
    vectors: DataFrame, queries: pa.Table, k: int, schema: T.StructType, arrow_schema: pa.Schema
) -> DataFrame:
    dim = len(queries.column("embedding")[0]) if queries.num_rows else 0
    query_ids = _ids(queries.column("query_id"))
    sent = vectors.sparkSession.sparkContext.broadcast(_matrix(queries.column("embedding"), dim).T if dim else None)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for batch in batches:
            if batch.num_rows and sent.value is not None:
                scores = _matrix(batch.column("embedding"), dim) @ sent.value
                best.add(_ids(batch.column("vec_id")), np.round(scores, SCORE_DIGITS))
        if best.vec is not None:
            yield pa.RecordBatch.from_pydict(_hit_rows(best, query_ids), schema=arrow_schema)

    return vectors.mapInArrow(scan, schema)


def _dense_blocks(
    vectors: DataFrame, queries: DataFrame, k: int, query_rows: int, vector_rows: int,
    schema: T.StructType, arrow_schema: pa.Schema,
) -> DataFrame:
    query_blocks = max(1, -(-2 * queries.count() // query_rows))
    vector_blocks = max(1, -(-2 * vectors.count() // vector_rows))
    spread_queries = (
        queries.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)))
        .withColumn("vb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(vector_blocks - 1).cast("bigint"))))
    )
    spread_vectors = (
        vectors.withColumn("vb", F.pmod(F.xxhash64("vec_id"), F.lit(vector_blocks)))
        .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint"))))
    )

    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        best = _Best(k)
        if left.num_rows and right.num_rows:
            dim = len(left.column("embedding")[0])
            turned = _matrix(left.column("embedding"), dim).T
            for piece in right.to_batches(max_chunksize=2000):
                scores = _matrix(piece.column("embedding"), dim) @ turned
                best.add(_ids(piece.column("vec_id")), np.round(scores, SCORE_DIGITS))
        if best.vec is None:
            return arrow_schema.empty_table()
        return pa.Table.from_pydict(_hit_rows(best, _ids(left.column("query_id"))), schema=arrow_schema)

    return (
        spread_queries.groupBy("qb", "vb")
        .cogroup(spread_vectors.groupBy("qb", "vb"))
        .applyInArrow(multiply, schema)
    )


def dot(left: str, right: str) -> Column:
    """Dot product of two float array columns, summed in double precision."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def projection_buckets(vectors: DataFrame, dim: int, tables: int, bucket_length: float, seed: int) -> DataFrame:
    """Adds ``buckets``: per hash table the bucket of the vector on a random line."""
    lines = np.random.default_rng(seed).standard_normal((dim, tables))
    lines /= np.linalg.norm(lines, axis=0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.floor(_matrix(batch.column("embedding"), dim) @ lines / bucket_length).astype(np.int64)
            offsets = pa.array(np.arange(0, numbers.size + 1, tables), pa.int32())
            buckets = pa.ListArray.from_arrays(offsets, pa.array(numbers.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, buckets], names=[*batch.schema.names, "buckets"])

    return vectors.mapInArrow(project, T.StructType([*vectors.schema.fields, T.StructField("buckets", T.ArrayType(T.LongType()))]))


def dense_topk_lsh(
    vectors: DataFrame, queries: DataFrame, k: int = TOP_K, dim: int | None = None, tables: int = 16,
    bucket_length: float = 0.25, seed: int = 42,
) -> DataFrame:
    """Approximate form of :func:`dense_topk` by random projections.

    A vector is scored for a query when both fall into the same bucket of at
    least one table. A pair that meets in several tables is kept only in the
    first of them, which is decided inside the row, without a distinct.
    ``dim`` is the length of the vectors, by default that of the first one;
    vectors of another length are an error.
    """
    if dim is None:
        first = vectors.filter(F.size("embedding") > 0).select(F.size("embedding")).first()
        dim = first[0] if first else 1

    def exploded(df: DataFrame, key: str, side: str) -> DataFrame:
        usable = df.select(key, "embedding").filter(F.col("embedding").isNotNull())
        return projection_buckets(usable, dim, tables, bucket_length, seed).select(
            key,
            F.col("embedding").alias(f"{side}_embedding"),
            F.col("buckets").alias(f"{side}_buckets"),
            F.posexplode("buckets").alias("table_no", "bucket"),
        )

    meets = F.array_position(F.zip_with("q_buckets", "v_buckets", lambda x, y: x == y), True)

    def score(batch: DataFrame, small: bool) -> DataFrame:
        return (
            exploded(vectors, "vec_id", "v")
            .join(hinted(batch, small), ["table_no", "bucket"])
            .filter(meets == F.col("table_no") + 1)
            .select("query_id", F.col("vec_id").alias("chunk_id"), F.round(dot("q_embedding", "v_embedding"), SCORE_DIGITS).alias("score"))
        )

    scored = union_all([score(*batch) for batch in broadcast_batches(exploded(queries, "query_id", "q"), "query_id")])
    return top_k(scored, ["query_id"], [F.desc("score"), F.asc("chunk_id")], k).select("query_id", "rank", "chunk_id", "score")


def reciprocal_rank_fusion(ranked: Sequence[DataFrame], k: int = TOP_K, offset: int = RRF_OFFSET) -> DataFrame:
    """Fuse any number of ``(query_id, rank, chunk_id)`` lists; ranks count from 1."""
    union = union_all([hits.select("query_id", "chunk_id", "rank") for hits in ranked])
    fused = union.groupBy("query_id", "chunk_id").agg(
        F.round(F.sum(1.0 / (offset + F.col("rank") - 1)), SCORE_DIGITS).alias("score")
    )
    return top_k(fused, ["query_id"], [F.desc("score"), F.asc("chunk_id")], k).select("query_id", "rank", "chunk_id", "score")


def retrieve_variants(retrieve: Retriever, variants: DataFrame, k: int = TOP_K) -> DataFrame:
    """Retrieve for every ``(query_id, variant, text)`` and fuse the lists per query."""
    keyed = variants.select(F.struct("query_id", "variant").alias("query_id"), "text")
    hits = retrieve(keyed, k).withColumn("query_id", F.col("query_id.query_id"))
    return reciprocal_rank_fusion([hits], k)


def bm25_retriever(index: KeywordIndex) -> Retriever:
    """:func:`bm25_topk` over one index as a plug-in."""
    return lambda queries, k: bm25_topk(index, queries, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that ``found`` contains, as one row."""
    marked = exact.select("query_id", "chunk_id").join(
        found.select("query_id", "chunk_id").withColumn("hit", F.lit(1.0)), ["query_id", "chunk_id"], "left"
    )
    return marked.agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("recall"))

"""A stored vector index in cells, of which a query reads a few.

Centroids are fitted on a bounded sample, every vector goes to the cell of its
nearest centroid, and cells are folders. A query is compared with the centroids
and probes the cells most like it. How many that takes for a wanted recall is
measured when the index is built, against exact neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.common import require_rows, top_k, union_all
from gleaner.operators.retrieval import SCORE_DIGITS, TOP_K, dense_topk
from gleaner.sources.scratch import stage

# The sample that centroids are fitted on has so many vectors per cell, and no more bytes than this.
SAMPLE_PER_CELL = 64
SAMPLE_BYTES = 64 << 20
MAX_CELLS = 4096
# Vectors whose exact neighbours decide how many cells to probe.
TRIALS = 256
RECALL = 0.95
# A cell with more vectors than this is written and read in several parts.
PART_ROWS = 200_000
# Query vectors travel to the tasks in blocks of at most so many bytes.
QUERY_BYTES = 32 << 20


@dataclass(frozen=True)
class VectorIndex:
    """``vectors(vec_id, embedding, cell)`` in folders by cell, the centroids in order of cell, and the cells to probe."""

    vectors: DataFrame
    centroids: np.ndarray
    probes: int


def rejected_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    """``(vec_id, reason)`` of vectors that no index takes: missing, of another length than ``dim``, or with a value that is no number."""
    bad_value = F.exists("embedding", lambda x: x.isNull() | F.isnan(x))
    reason = (
        F.when(F.col("embedding").isNull(), F.lit("missing"))
        .when(F.size("embedding") != dim, F.format_string("length %d", F.size("embedding")))
        .when(bad_value, F.lit("not a number"))
    )
    return vectors.select("vec_id", reason.alias("reason")).filter(F.col("reason").isNotNull())


def accepted_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    """The vectors that :func:`rejected_vectors` does not list."""
    fits = F.col("embedding").isNotNull() & (F.size("embedding") == dim) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x))
    return vectors.select("vec_id", "embedding").filter(F.coalesce(fits, F.lit(False)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def fit_centroids(vectors: DataFrame, dim: int, cells: int, seed: int = 42) -> np.ndarray:
    """Centroids of a sample chosen by id hash: ``SAMPLE_PER_CELL`` vectors per cell, within ``SAMPLE_BYTES``."""
    rows = max(cells, min(SAMPLE_PER_CELL * cells, SAMPLE_BYTES // (8 * dim)))
    sample = stage(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows), "centroid-sample")
    if cells == 1:
        return _matrix(sample.toArrow().column("embedding").combine_chunks(), dim).mean(axis=0, keepdims=True)
    fitted = KMeans(k=cells, maxIter=10, seed=seed, featuresCol="features").fit(sample.select(array_to_vector("embedding").alias("features")))
    return np.array(fitted.clusterCenters())


def assign_cells(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cell``, the number of the nearest centroid, to every row of ``vectors(vec_id, embedding)``."""
    dim = centroids.shape[1]
    turned, offset = centroids.T, (centroids**2).sum(axis=1) / 2

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = (_matrix(batch.column(1), dim) @ turned - offset).argmax(axis=1) if batch.num_rows else np.empty(0, int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], ["vec_id", "embedding", "cell"])

    return vectors.select("vec_id", "embedding").mapInArrow(assign, T.StructType([*vectors.select("vec_id", "embedding").schema.fields, T.StructField("cell", T.IntegerType())]))


def nearest_cells(queries: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Cells per query, the nearest centroid first."""
    return np.argsort((centroids**2).sum(axis=1) / 2 - queries @ centroids.T, axis=1, kind="stable")


def _probes_for(recall: float, vectors: DataFrame, placed: DataFrame, centroids: np.ndarray, k: int) -> int:
    """Cells that ``TRIALS`` vectors of the table have to probe until they meet that share of their exact neighbours."""
    trials = vectors.orderBy(F.desc(F.xxhash64("vec_id")), "vec_id").limit(TRIALS).select(F.col("vec_id").alias("query_id"), "embedding")
    trials = stage(trials, "probe-trials")
    # a vector is its own nearest neighbour, which would flatter the recall
    near = dense_topk(vectors, trials, k + 1).filter(F.col("query_id") != F.col("chunk_id"))
    where = near.join(placed.select(F.col("vec_id").alias("chunk_id"), "cell"), "chunk_id").select("query_id", "cell").toPandas()
    if not len(where):
        return len(centroids)
    table = trials.toArrow()
    ids = table.column("query_id").to_pylist()
    order = nearest_cells(_matrix(table.column("embedding").combine_chunks(), centroids.shape[1]), centroids)
    place = {q: np.argsort(cells) for q, cells in zip(ids, order)}
    needed = np.sort([place[q][c] + 1 for q, c in zip(where["query_id"], where["cell"])])
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)])


def save_vectors_in_cells(
    vectors: DataFrame, path: str, dim: int, cells: int | None = None, recall: float = RECALL, k: int = TOP_K, seed: int = 42, part_rows: int = PART_ROWS,
) -> None:
    """Write ``vectors(vec_id, embedding)`` in cells under ``path``.

    By default there are about as many cells as the root of the number of
    vectors, ``MAX_CELLS`` at most. Vectors that :func:`rejected_vectors`
    lists are left out; none at all is an error. A cell above ``part_rows``
    vectors is split over several tasks and files. The number of cells to
    probe is the one that finds the share ``recall`` of the ``k`` exact
    neighbours of ``TRIALS`` vectors.
    """
    spark = vectors.sparkSession
    usable = stage(accepted_vectors(vectors, dim), "cell-vectors")
    n = usable.count()
    if not n:
        raise ValueError("no vector to index")
    cells = min(n, MAX_CELLS, cells or max(1, round(math.sqrt(n))))
    centroids = fit_centroids(usable, dim, cells, seed)
    placed = stage(assign_cells(usable, centroids), "vector-cells")
    # at most one row per cell
    counts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    tasks = max(2, math.ceil(2 * n / part_rows))
    placed.join(F.broadcast(counts), "cell").repartition(tasks, "cell", part).drop("parts").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    probes = _probes_for(recall, usable, placed, centroids, k)
    rows = [(i, [float(x) for x in c], probes) for i, c in enumerate(centroids)]
    spark.createDataFrame(rows, "cell int, centroid array<double>, probes int").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")


def open_cells(spark: SparkSession, path: str) -> VectorIndex:
    """The index stored under ``path``."""
    stored = require_rows(spark.read.parquet(f"{path}/centroids"), f"vector index {path}").orderBy("cell").toArrow()
    centroids = np.array(stored.column("centroid").to_pylist())
    return VectorIndex(spark.read.parquet(f"{path}/vectors"), centroids, stored.column("probes")[0].as_py())


def _kept(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows per query, ties by id."""
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query, side="left") < k
    return query[keep], vec[keep], score[keep]


def probed_topk(index: VectorIndex, queries: DataFrame, k: int = TOP_K, probes: int | None = None) -> DataFrame:
    """Best ``k`` vectors per query of ``queries(query_id, embedding)`` among the cells that it probes.

    Only folders that some query probes are read, and a vector is multiplied
    with the queries that probe its cell, no others. Vectors are not shuffled;
    k rows per query leave each task. Query vectors that do not fit the index
    get no hit.
    """
    dim = index.centroids.shape[1]
    usable = accepted_vectors(queries.select(F.col("query_id").alias("vec_id"), "embedding"), dim)
    usable = stage(usable.withColumnRenamed("vec_id", "query_id"), "probing-queries")
    blocks = max(1, math.ceil(usable.count() * 8 * dim / QUERY_BYTES))
    number = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    found = union_all([_probe(index, usable.filter(number == block), k, min(probes or index.probes, len(index.centroids))) for block in range(blocks)])
    return top_k(found, ["query_id"], [F.desc("score"), F.asc("chunk_id")], k).select("query_id", "rank", "chunk_id", "score")


def _probe(index: VectorIndex, queries: DataFrame, k: int, probes: int) -> DataFrame:
    table, dim = queries.toArrow(), index.centroids.shape[1]
    ids = np.array(table.column("query_id").to_pylist())
    asked = _matrix(table.column("embedding").combine_chunks(), dim) if table.num_rows else np.empty((0, dim))
    order = nearest_cells(asked, index.centroids)[:, :probes]
    cells = np.unique(order)
    by_cell = {int(c): np.flatnonzero((order == c).any(axis=1)) for c in cells}
    sent = index.vectors.sparkSession.sparkContext.broadcast((asked, by_cell))
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("chunk_id", index.vectors.schema["vec_id"].dataType), T.StructField("score", T.DoubleType()),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, by_cell = sent.value
        best, kinds = None, None
        for batch in batches:
            kinds = batch.column(0).type
            vec = np.array(batch.column(0).to_pylist())
            held, cell = _matrix(batch.column(1), dim), batch.column(2).to_numpy()
            parts = [] if best is None else [best]
            for c in np.unique(cell):
                rows, mine = np.flatnonzero(cell == c), by_cell[int(c)]
                scores = np.round(held[rows] @ asked[mine].T, SCORE_DIGITS)
                row, query = np.nonzero(scores >= (np.partition(scores, -k, axis=0)[-k] if len(rows) > k else -np.inf))
                parts.append((mine[query], vec[rows[row]], scores[row, query]))
            if parts:
                best = _kept(*(np.concatenate([p[i] for p in parts]) for i in range(3)), k)
        if best is not None:
            named = pa.array(ids[best[0]].tolist())
            yield pa.RecordBatch.from_arrays([named, pa.array(best[1].tolist(), kinds), pa.array(best[2])], ["query_id", "chunk_id", "score"])

    wanted = [int(c) for c in cells]
    near = index.vectors.filter(F.col("cell").isin(wanted)) if wanted else index.vectors.filter(F.lit(False))
    return near.select("vec_id", "embedding", F.col("cell").cast("int").alias("cell")).mapInArrow(scan, schema)


def scored_share(index: VectorIndex, queries: DataFrame, probes: int | None = None) -> float:
    """Share of all (query, vector) pairs that :func:`probed_topk` scores."""
    sizes = {row["cell"]: row["n"] for row in index.vectors.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = accepted_vectors(queries.select(F.col("query_id").alias("vec_id"), "embedding"), index.centroids.shape[1]).select("embedding").toArrow()
    order = nearest_cells(_matrix(table.column(0).combine_chunks(), index.centroids.shape[1]), index.centroids)[:, : probes or index.probes]
    return float(np.vectorize(lambda c: sizes.get(int(c), 0))(order).sum() / (len(order) * sum(sizes.values())))

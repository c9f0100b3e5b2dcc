import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import retrieval as r
from gleaner.operators import vector_index as vx
from tests.conftest import rows


def table(spark, matrix, name="vec_id"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], f"{name} bigint, embedding array<float>")


def clusters(n, rng, centers):
    picked = centers[rng.integers(len(centers), size=n)] + 0.15 * rng.standard_normal((n, centers.shape[1]))
    return picked / np.linalg.norm(picked, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def centers():
    return np.random.default_rng(1).standard_normal((60, 24))


def recall_of(spark, path, vectors, queries):
    vx.save_vectors_in_cells(vectors, str(path), 24)
    index = vx.open_cells(spark, str(path))
    found, exact = vx.probed_topk(index, queries), r.dense_topk(vectors, queries)
    return index, r.recall(found, exact).first()["recall"], vx.scored_share(index, queries)


def test_recall_is_reached_and_the_share_falls(spark, tmp_path, centers):
    rng = np.random.default_rng(2)
    queries = table(spark, clusters(100, rng, centers), "query_id")
    shares = []
    for n in (500, 8000):
        _, recall, share = recall_of(spark, tmp_path / str(n), table(spark, clusters(n, rng, centers)), queries)
        assert recall >= 0.9
        shares.append(share)
    assert shares[1] < shares[0] / 2 and shares[1] < 0.2


def test_vectors_without_structure_keep_their_recall(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((1500, 24))
    assert recall_of(spark, tmp_path / "v", table(spark, vectors), table(spark, rng.standard_normal((60, 24)), "query_id"))[1] >= 0.9


def test_all_cells_give_the_exact_hits(spark, tmp_path, centers):
    rng = np.random.default_rng(4)
    vectors = clusters(700, rng, centers)
    vectors[100:140] = vectors[100]  # ties
    vectors, queries = table(spark, vectors), table(spark, clusters(30, rng, centers), "query_id")
    index, *_ = recall_of(spark, tmp_path / "v", vectors, queries)
    assert rows(vx.probed_topk(index, queries, 5, probes=10_000), "query_id", "rank") == rows(r.dense_topk(vectors, queries), "query_id", "rank")


def test_unprobed_folders_are_not_read(spark, tmp_path, centers):
    rng = np.random.default_rng(5)
    vectors = table(spark, clusters(1000, rng, centers))
    index, *_ = recall_of(spark, tmp_path / "v", vectors, table(spark, clusters(20, rng, centers), "query_id"))
    one = vx.probed_topk(index, table(spark, clusters(1, rng, centers), "query_id"), probes=2)
    plan = one._jdf.queryExecution().toString()
    (cells,) = re.findall(r"PartitionFilters: \[cell#\d+ IN \(([\d,]+)\)", plan)
    assert len(cells.split(",")) == 2 < len(index.centroids) / 10


def test_misfits_are_listed_not_fatal(spark, tmp_path):
    rows_ = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0]), (4, None), (5, [float("nan"), 1.0]), (6, [])]
    vectors = spark.createDataFrame(rows_, "vec_id bigint, embedding array<double>")
    assert rows(vx.rejected_vectors(vectors, 2), "vec_id") == [(3, "length 1"), (4, "missing"), (5, "not a number"), (6, "length 0")]
    vx.save_vectors_in_cells(vectors, str(tmp_path / "v"), 2)
    index = vx.open_cells(spark, str(tmp_path / "v"))
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "query_id bigint, embedding array<double>")
    assert rows(vx.probed_topk(index, queries, 1)) == [(1, 1, 1, 1.0)]
    assert vx.probed_topk(index, queries.filter(F.lit(False))).collect() == []
    with pytest.raises(ValueError, match="no vector"):
        vx.save_vectors_in_cells(vectors.filter("vec_id = 4"), str(tmp_path / "w"), 2)


def test_a_crowded_cell_is_split(spark, tmp_path):
    same = table(spark, np.ones((500, 4)) + 1e-4 * np.arange(500)[:, None])
    vx.save_vectors_in_cells(same, str(tmp_path / "v"), 4, cells=2, part_rows=100)
    index = vx.open_cells(spark, str(tmp_path / "v"))
    assert index.vectors.count() == 500 and len(index.vectors.inputFiles()) > 3

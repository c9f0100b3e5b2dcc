"""Rows that once vanished, or changed, without a word."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.sources.store import read_store
from gleaner.operators import chunking, evaluation, metrics, quantiles, retrieval, travel
from gleaner.sources import results
from gleaner.streaming import jobs
from tests.conftest import rows


def test_short_passages_are_found(spark):
    documents = spark.createDataFrame([(1, "1.md", "see the red fox here"), (2, "2.md", "bored foxes")], "doc_id bigint, file_name string, text string")
    passages = spark.createDataFrame([(1, "red fox"), (2, "fox"), (3, "ed fo"), (4, "the red fox"), (5, " "), (6, "x")], "query_id bigint, text string")
    got = rows(evaluation.golden_sources(passages, documents).select("query_id", "doc_id"), "query_id", "doc_id")
    assert got == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (4, 1), (6, 1), (6, 2)]


def test_vectors_without_a_score_cost_no_hits(spark):
    vectors = spark.createDataFrame([(i, [math.nan, 1.0] if i > 5 else [float(i), 1.0]) for i in range(11)], "vec_id bigint, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<double>")
    assert [r["chunk_id"] for r in retrieval.dense_topk(vectors, queries, 5).orderBy("rank").collect()] == [5, 4, 3, 2, 1]


@pytest.mark.parametrize("search", [retrieval.dense_topk, retrieval.dense_topk_lsh])
def test_vectors_of_several_lengths_are_an_error(spark, search):
    vectors = spark.createDataFrame([(1, [1.0]), (2, [0.0]), (3, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="another length"):
        search(vectors, queries, 2).collect()


def test_long_vectors_are_searched(spark):
    vectors = spark.createDataFrame([(i, [float(i == j) for j in range(128)]) for i in range(128)], "vec_id bigint, embedding array<double>")
    queries = spark.createDataFrame([(7, [float(j == 9) for j in range(128)])], "query_id bigint, embedding array<double>")
    assert retrieval.dense_topk_lsh(vectors, queries, 1).first()["chunk_id"] == 9


def test_a_wide_histogram_keeps_its_bins(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 9e14), ("a", 4.5e14)], "provider string, latency_ms double")
    assert [r["bin_start"] for r in metrics.latency_hist(df).orderBy("bin_start").collect()] == [0.0, 4.5e14, 9e14]


def test_infinite_values_have_quantiles(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, math.inf, -math.inf, math.nan, 3.0)], "k string, v double")
    got = quantiles.exact_quantiles(df, ["k"], "v", [0.0, 0.5, 1.0]).first()
    assert got["count"] == 5 and got["q"] == [-math.inf, 2.0, math.inf]


def test_broken_files_and_payloads_are_told(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"results": {"prompts": [], "resu')
    with pytest.raises(Exception):
        results.flat_results(results.read_eval(spark, str(tmp_path))).collect()
    payloads = spark.createDataFrame([('{"events": [{"name": "x"}]}',), ('{"events": [',), (None,)], "value string")
    assert results.parse_events(payloads).count() == 1 and results.rejected_payloads(payloads).count() == 2


def test_nested_gaps_are_not_valid(spark):
    pair = T.StructType().add("question", "string").add("answer", "string")
    schema = T.StructType().add("pairs", T.ArrayType(pair))
    texts = ['{"pairs":[{"question":"x"}]}', '{"pairs":[{"question":"x","answer":"y"}]}', '{"pairs":[]}', "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r["valid"] for r in evaluation.check_structure(df, "t", schema).orderBy("i").collect()] == [False, True, True, False]


def test_only_iso_texts_are_dates(spark):
    texts = ["2025", "2025-1-5", "T10:00", "20251230", "2025-12-30", "2025-12-30T10:30", "2025-12-30 10:30:15.5", "soon"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["d"] for r in df.select("i", travel.iso_time(F.col("t")).cast("string").alias("d")).orderBy("i").collect()]
    assert got == [None, None, None, "2025-12-30 00:00:00", "2025-12-30 00:00:00", "2025-12-30 10:30:00", "2025-12-30 10:30:15.5", None]


def test_sentence_chunks_keep_a_no_break_space(spark):
    df = spark.createDataFrame([(1, "a.md", "One.\xa0"), (2, "b.md", "\xa0")], "doc_id bigint, file_name string, text string")
    assert [r["text"] for r in chunking.chunk_sentences(df).orderBy("doc_id").collect()] == ["One.\xa0", "\xa0"]


def test_a_new_checkpoint_keeps_the_store(spark, tmp_path):
    schema = "doc_id bigint, file_name string, text string"
    for number, name in enumerate(["a.md", "b.md"]):
        spark.createDataFrame([(number, name, f"Text of {name}.")], schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        jobs.ingest_stream(stream, chunking.chunk_windows, str(tmp_path / "store"), str(tmp_path / f"check{number}"))
    stored = read_store(spark, str(tmp_path / "store"))
    assert sorted(r["file_name"] for r in stored.collect()) == ["a.md", "b.md"]

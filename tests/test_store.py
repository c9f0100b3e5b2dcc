import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from gleaner.operators import chunking, evaluation, models
from gleaner.sources import store
from tests.conftest import rows

SCHEMA = "doc_id bigint, file_name string, text string"


def docs(spark, **texts):
    return spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(texts.items())], SCHEMA)


def held(spark, path):
    return {(r["file_name"], r["text"]) for r in store.read_store(spark, path).collect()}


def test_changed_documents_replace_their_chunks(spark, tmp_path):
    path = str(tmp_path / "s")
    long = " ".join(f"w{i}" for i in range(2500))
    store.ingest_documents(docs(spark, a="one", b="two", c=long), chunking.chunk_windows, path, "v1")
    assert len(held(spark, path)) == 2 + 3
    store.ingest_documents(docs(spark, a="one", b="two, new", d="four"), chunking.chunk_windows, path, "v2")
    assert {x for x in held(spark, path) if x[0] != "c"} == {("a", "one"), ("b", "two, new"), ("d", "four")}
    # the unchanged document was not stored again
    assert spark.read.parquet(f"{path}/manifest").filter("file_name = 'a'").count() == 1
    # a shorter form leaves no old chunk behind, and a document comes back in its first form
    store.ingest_documents(docs(spark, c="short", b="two"), chunking.chunk_windows, path, "v3")
    assert held(spark, path) == {("a", "one"), ("b", "two"), ("c", "short"), ("d", "four")}


def test_tombstones_and_repeated_batches(spark, tmp_path):
    path = str(tmp_path / "s")
    for _ in range(2):
        store.ingest_documents(docs(spark, a="one", b="two", e=None), chunking.chunk_windows, path, "v1")
    for _ in range(2):
        store.remove_documents(docs(spark, b=""), path, "v2")
    assert held(spark, path) == {("a", "one")}
    store.ingest_documents(docs(spark, b="two"), chunking.chunk_windows, path, "v3")
    assert held(spark, path) == {("a", "one"), ("b", "two")}
    assert rows(store.live_documents(store.read_manifest(spark, path)).select("file_name"), "file_name") == [("a",), ("b",), ("e",)]


def test_only_the_prefixes_of_a_batch_are_read(spark, tmp_path):
    path = str(tmp_path / "s")
    store.ingest_documents(docs(spark, **{f"f{i}": f"text {i}" for i in range(60)}), chunking.chunk_windows, path, "v1")
    one = docs(spark, f7="other")
    for frame in (store.changed_documents(one, store.read_manifest(spark, path)), store.read_store(spark, path, one)):
        plan = frame._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(prefix" in plan or "PartitionFilters: [(prefix" in plan, plan[-3000:]
    assert rows(store.read_store(spark, path, one).select("text")) == [("text 7",)]


def test_a_broken_store_is_no_empty_store(spark, tmp_path):
    assert store.read_manifest(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "s" / "manifest").mkdir(parents=True)
    (tmp_path / "s" / "manifest" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception) as failure:
        store.ingest_documents(docs(spark, a="x"), chunking.chunk_windows, str(tmp_path / "s"), "v1")
    assert not (isinstance(failure.value, AnalysisException) and failure.value.getCondition() == "PATH_NOT_FOUND")


def test_all_assertions_of_a_case_count(spark):
    cases = spark.createDataFrame(
        [(1, "contains: A.md", "llm-rubric: the red cat"), (2, "regex: ^B.*z$", "not-contains: x: y"), (3, "icontains: a.MD", " "), (4, "A.md", "equals: A.md"), (5, "not-equals: q", None)],
        "case_id bigint, __expected1 string, __expected2 string",
    )
    outputs = spark.createDataFrame([(1, "the red dog A.md"), (2, "B to z"), (3, "see A.md"), (4, "A.md")], "case_id bigint, output string")
    listed = evaluation.case_assertions(cases)
    assert rows(listed.filter("case_id > 3"), "case_id", "assertion_no") == [(4, 0, "contains", "A.md"), (4, 1, "equals", "A.md"), (5, 0, "not-equals", "q")]
    assert rows(evaluation.case_verdicts(evaluation.grade(listed, outputs)), "case_id") == [
        (1, 2, 0, 0.785715, True), (2, 2, 0, 1.0, True), (3, 1, 0, 1.0, True), (4, 2, 0, 1.0, True), (5, 1, 1, 0.0, False)
    ]

    def strict(asked):
        return asked.selectExpr("id", "0.0D AS score", "false AS pass")

    assert rows(evaluation.case_verdicts(evaluation.grade(listed, outputs, strict)).filter("case_id = 1")) == [(1, 2, 1, 0.5, False)]


def test_a_model_run_keeps_columns_as_they_are(spark):
    big = 9007199254740993
    table = spark.createDataFrame([(1, big, math.inf, [1, None], "x"), (2, None, math.nan, None, None)], "id int, n bigint, d double, a array<int>, t string")
    out = models.map_model(table, lambda batch: [r["t"] for r in batch], ["t"], "out", T.StringType())
    assert out.schema.fields[:5] == table.schema.fields
    (first, second) = out.orderBy("id").collect()
    assert (first["n"], first["a"], first["out"]) == (big, [1, None], "x") and (second["n"], second["a"], second["out"]) == (None, None, None)
    assert out.rdd.getNumPartitions() == table.rdd.getNumPartitions()

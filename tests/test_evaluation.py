from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators import answers, evaluation, models
from tests.conftest import rows


def test_assertions(spark):
    df = spark.createDataFrame([("contains: A b: c.md",), ("llm-rubric: x\ny",), ("nothing",)], "e string")
    kind, needle = evaluation.parse_assertion(F.col("e"))
    assert rows(df.select(kind, needle)) == [("contains", "A b: c.md"), ("llm-rubric", "x\ny"), ("", "")]


def test_contains_is_case_sensitive(spark):
    df = spark.createDataFrame([("a.md\nB.md", "B.md"), ("a.md", "A.md"), (None, "a")], "o string, n string")
    assert [r[0] for r in df.select(evaluation.check_contains(F.col("o"), F.col("n"))).collect()] == [True, False, False]


def test_accuracy_counts_any_source_and_missing_outputs(spark):
    outputs = spark.createDataFrame([("p", 1, "A.md\nB.md"), ("p", 2, None)], "provider string, query_id bigint, output string")
    golden = spark.createDataFrame([(1, "X.md"), (1, "B.md"), (2, "A.md")], "query_id bigint, expected string")
    assert rows(evaluation.topk_accuracy(outputs, golden)) == [("p", 2, 1, 0.5)]


def test_golden_sources_by_brute_force(spark):
    passages = [(1, "aa bb cc dd ee"), (2, "bb cc dd"), (3, "xx yy"), (4, "a bb cc d"), (5, "zz zz zz zz zz"), (6, "no such words here now")]
    texts = ["aa bb cc dd ee ff", "prefix bb cc ddsuffix", "xaa bb cc dd eex", "zz zz zz zz zz zz zz zz", "aa  bb cc dd ee", "bb cc", "", "xx yy"]
    documents = spark.createDataFrame([(i, f"{i}.md", t) for i, t in enumerate(texts)], "doc_id bigint, file_name string, text string")
    got = rows(evaluation.golden_sources(spark.createDataFrame(passages, "query_id bigint, text string"), documents), "query_id", "doc_id")
    wanted = sorted((q, i, f"{i}.md") for q, p in passages for i, t in enumerate(texts) if p in t)
    assert got == wanted and len(wanted) >= 6


def test_cases_from_pairs(spark):
    pairs = spark.createDataFrame([("A.md", [("q1", "a1"), ("q2", "a2")]), ("B.md", [])], "file_name string, pairs array<struct<question:string,answer:string>>")
    assert rows(evaluation.qa_cases(pairs), "input") == [
        ("q1", "llm-rubric: a1", "contains: [file=A.md]"), ("q2", "llm-rubric: a2", "contains: [file=A.md]")
    ]


def test_f1(spark):
    df = spark.createDataFrame(
        [("same", "The cat", "the CAT"), ("half", "cat cat dog", "cat bird"), ("none", "aa", "bb"), ("empty", "", "")], "id string, answer string, expected string"
    )
    assert rows(evaluation.answer_f1(df), "id") == [("empty", 0.0, False), ("half", 0.4, False), ("none", 0.0, False), ("same", 1.0, True)]


def test_structure_check(spark):
    schema = T.StructType([T.StructField("pairs", T.ArrayType(T.StructType([T.StructField("question", T.StringType())])))])
    df = spark.createDataFrame([('{"pairs":[{"question":"q"}]}',), ("{oops",), ('{"other":1}',), (None,)], "r string")
    assert [r["valid"] for r in evaluation.check_structure(df, "r", schema).collect()] == [True, False, False, False]


def test_guard_and_question(spark):
    df = spark.createDataFrame([("llm-rubric", "x"), ("top", "x"), (None, "x")], "label string, o string")
    assert [r[0] for r in df.select(answers.grader_guard(F.col("label"), F.col("o"))).collect()] == [answers.GRADER_ERROR, "x", "x"]


def test_bad_rows_do_not_stop_a_model_run(spark):
    def model(batch):
        if any(row["v"] == 13 for row in batch):
            raise RuntimeError("no thirteen")
        assert len(batch) <= 4
        return [row["v"] * 2 for row in batch]

    df = models.map_model(spark.range(40).withColumnRenamed("id", "v"), model, ["v"], "out", T.LongType(), batch_size=4, attempts=2)
    good, bad = models.split_failures(df)
    assert rows(good, "v") == [(v, v * 2) for v in range(40) if v != 13]
    assert rows(bad, "v") == [(13, None, "RuntimeError: no thirteen")]


def test_encoder_gives_unit_vectors(spark):
    chunks = spark.createDataFrame([("a", "red cat runs"), ("b", "red cat runs"), ("c", "blue dog sleeps"), ("d", "")], "chunk_id string, text string")
    encode = models.fit_encoder(chunks, dim=64)
    got = {r["chunk_id"]: r["embedding"] for r in encode(chunks).collect()}
    assert got["a"] == got["b"] != got["c"] and len(got["a"]) == 64
    assert abs(sum(x * x for x in got["a"]) - 1) < 1e-6 and sum(map(abs, got["d"])) == 0
    query = chunks.select(models.as_query(F.col("text")).alias("text")).first()["text"]
    assert query.startswith("Instruct: ") and query.endswith("Query:red cat runs")


def test_tokenizer_hook(spark):
    count = models.tokenizer_count(lambda text: list(text))
    df = spark.createDataFrame([("abc",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(count("t")).collect()] == [3, None, 0]

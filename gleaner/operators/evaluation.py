"""Retrieval evaluation: golden cases, assertions, accuracy, generated cases, grading."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import text as tx
from gleaner.operators.common import broadcast_batches, hinted, union_all
from gleaner.sources.scratch import stage

ANCHOR_WORDS = 3
SHORT_KEY = 3
F1_THRESHOLD = 0.5
# The kinds of assertion.
RUBRIC = "llm-rubric"
KINDS = ("contains", "icontains", "equals", "regex", RUBRIC)


def eval_matrix(cases: DataFrame, providers: Sequence[str]) -> DataFrame:
    """Every case once per provider of a configured list."""
    return cases.withColumn("provider", F.explode(F.array(*[F.lit(p) for p in providers])))


def parse_assertion(column: Column) -> tuple[Column, Column]:
    """Kind and needle of an assertion such as ``contains: report.md``."""
    pattern = r"^([^\s:]+):\s*([\s\S]*)$"
    return F.regexp_extract(column, pattern, 1), F.regexp_extract(column, pattern, 2)


def check_contains(output: Column, needle: Column) -> Column:
    """Case-sensitive substring test; a missing output fails."""
    return F.coalesce(F.contains(output, needle), F.lit(False))


def topk_accuracy(outputs: DataFrame, golden: DataFrame) -> DataFrame:
    """Share of questions per provider whose output names an expected file.

    ``outputs(provider, query_id, output)``, ``golden(query_id, expected)``.
    Where a question has several expected files, any one counts; questions
    without an output fail.
    """
    verdicts = (
        golden.join(outputs, "query_id")
        .groupBy("provider", "query_id")
        .agg(F.max(check_contains(F.col("output"), F.col("expected")).cast("int")).alias("passed"))
    )
    return verdicts.groupBy("provider").agg(
        F.count(F.lit(1)).alias("questions"),
        F.sum(F.col("passed").cast("bigint")).alias("passed"),
        F.round(F.avg("passed"), 6).alias("accuracy"),
    )


def golden_sources(passages: DataFrame, documents: DataFrame, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """``(query_id, doc_id, file_name)``: documents whose text holds the passage exactly.

    The words between the first and the last of a passage appear in the
    document as whole words, so a run of them serves as join key; only documents
    that meet a passage there are compared in full. A passage of one or two words
    lies within one word or two neighbouring ones; there the first letters of
    its first word are the key, met by the letter runs of the documents' words.
    A blank passage matches nothing.
    """
    found = tx.words(F.col("text"))
    inner = F.size("words") - 2
    keyed = (
        passages.select("query_id", F.col("text").alias("passage"), found.alias("words"))
        .filter(inner >= 1)
        .withColumn("length", F.least(inner, F.lit(anchor)))
        .withColumn("anchor", F.array_join(F.slice("words", F.lit(2), F.col("length")), " "))
        .select("query_id", "passage", "length", "anchor")
    )
    lengths = [row["length"] for row in keyed.select("length").distinct().collect()]

    def runs(n: int) -> Column:
        joined = F.col("words")
        for shift in range(1, n):
            following = F.slice("words", F.lit(shift + 1), F.size("words"))
            joined = F.zip_with(joined, following, lambda head, word: F.concat(head, F.lit(" "), word))
        return joined

    in_documents = union_all([
        documents.select("doc_id", found.alias("words")).select("doc_id", F.explode_outer(runs(n)).alias("anchor"))
        .filter(F.col("anchor").isNotNull()).withColumn("length", F.lit(n))
        for n in sorted(lengths) or [anchor]
    ])
    short = (
        passages.select("query_id", F.col("text").alias("passage"), found.alias("words"))
        .filter(inner.between(-1, 0))
        .withColumn("length", F.least(F.char_length(F.col("words")[0]), F.lit(SHORT_KEY)))
        .withColumn("anchor", F.concat(F.lit("~"), F.substring(F.col("words")[0], F.lit(1), F.col("length"))))
        .select("query_id", "passage", "length", "anchor")
    )
    short_lengths = sorted(row["length"] for row in short.select("length").distinct().collect())

    def letter_runs(n: int) -> Column:
        long_enough = F.filter(F.array_distinct("words"), lambda w: F.char_length(w) >= n)
        return F.array_distinct(F.flatten(F.transform(long_enough, lambda w: F.transform(
            F.sequence(F.lit(1), F.char_length(w) - n + 1), lambda i: F.concat(F.lit("~"), F.substring(w, i, F.lit(n)))
        ))))

    if short_lengths:
        keyed = keyed.unionByName(short)
        in_documents = union_all([in_documents, *(
            documents.select("doc_id", found.alias("words")).select("doc_id", F.explode(letter_runs(n)).alias("anchor")).withColumn("length", F.lit(n))
            for n in short_lengths
        )])
    candidates = union_all([
        in_documents.join(hinted(batch, small), ["length", "anchor"]).select("doc_id", "query_id", "passage")
        for batch, small in broadcast_batches(keyed, "query_id")
    ])
    return (
        documents.select("doc_id", "file_name", "text")
        .join(stage(candidates.dropDuplicates(["doc_id", "query_id"]), "anchored-passages"), "doc_id")
        .filter(F.contains("text", "passage"))
        .select("query_id", "doc_id", "file_name")
    )


def qa_cases(pairs: DataFrame) -> DataFrame:
    """Two assertions per question-answer pair of ``(file_name, pairs)``."""
    return pairs.select("file_name", F.explode("pairs").alias("pair")).select(
        F.col("pair.question").alias("input"),
        F.concat(F.lit("llm-rubric: "), F.col("pair.answer")).alias("__expected1"),
        F.concat(F.lit("contains: [file="), F.col("file_name"), F.lit("]")).alias("__expected2"),
    )


def answer_f1(answers: DataFrame, threshold: float = F1_THRESHOLD) -> DataFrame:
    """Token-overlap F1 of ``answer`` against ``expected`` per ``id``, with a verdict."""
    sides = F.array(
        F.struct(F.lit(1).alias("given"), F.lit(0).alias("wanted"), tx.terms(F.col("answer")).alias("terms")),
        F.struct(F.lit(0).alias("given"), F.lit(1).alias("wanted"), tx.terms(F.col("expected")).alias("terms")),
    )
    counts = (
        answers.select("id", F.inline(sides))
        .select("id", "given", "wanted", F.explode_outer("terms").alias("term"))
        .groupBy("id", "term")
        .agg(F.sum("given").alias("given"), F.sum("wanted").alias("wanted"))
    )
    present = F.col("term").isNotNull()
    totals = counts.groupBy("id").agg(
        F.sum(F.when(present, F.least("given", "wanted")).otherwise(0)).alias("shared"),
        F.sum(F.when(present, F.col("given") + F.col("wanted")).otherwise(0)).alias("all"),
    )
    score = F.round(F.coalesce(F.try_divide(2 * F.col("shared"), F.col("all")), F.lit(0.0)), 6)
    return totals.select("id", score.alias("score")).withColumn("pass", F.col("score") >= threshold)


Judge = Callable[[DataFrame], DataFrame]
"""Plug-in point: ``(id, answer, expected)`` to ``(id, score, pass)``."""


def case_assertions(cases: DataFrame) -> DataFrame:
    """``(case_id, assertion_no, kind, needle)``: the assertions of each case, from its columns ``__expected``, ``__expected1`` and so on.

    Blank ones are none. A text without a kind is one to be found in the output.
    """
    named = sorted((c for c in cases.columns if c.startswith("__expected")), key=lambda c: (len(c), c))
    listed = cases.select("case_id", F.posexplode(F.array(*[F.col(c) for c in named])).alias("assertion_no", "assertion")).filter(tx.is_nonblank(F.col("assertion")))
    kind, needle = parse_assertion(F.col("assertion"))
    known = F.regexp_replace(kind, "^not-", "").isin(*KINDS)
    return listed.select(
        "case_id", F.col("assertion_no").cast("bigint").alias("assertion_no"),
        F.when(known, kind).otherwise(F.lit("contains")).alias("kind"), F.when(known, needle).otherwise(F.col("assertion")).alias("needle"),
    )


def grade(assertions: DataFrame, outputs: DataFrame, judge: Judge | None = None) -> DataFrame:
    """``(case_id, assertion_no, kind, needle, score, pass)`` of ``assertions`` against ``outputs(case_id, output)``.

    Each kind has its check: a needle in the output, whatever its case with
    ``icontains``, the whole output with ``equals``, a pattern with ``regex``;
    ``llm-rubric`` goes to the judge, by default the overlap of
    :func:`answer_f1`. ``not-`` before a kind turns it round. A case without
    an output fails, also what should not be in it.
    """
    plain = F.regexp_replace("kind", "^not-", "")
    rows = assertions.join(outputs.select("case_id", "output"), "case_id", "left").withColumn("_plain", plain)
    checks = {
        "contains": F.contains("output", F.col("needle")), "icontains": F.contains(F.lower("output"), F.lower("needle")),
        "equals": F.col("output") == F.col("needle"), "regex": F.regexp_like("output", F.col("needle")),
    }
    passed = F.lit(None).cast("boolean")
    for kind, check in checks.items():
        passed = F.when(F.col("_plain") == kind, check).otherwise(passed)
    key = F.struct("case_id", "assertion_no")
    rubric = rows.filter(F.col("_plain") == RUBRIC).select(key.alias("id"), F.col("output").alias("answer"), F.col("needle").alias("expected"))
    judged = (judge or answer_f1)(rubric).select(F.col("id.case_id").alias("case_id"), F.col("id.assertion_no").alias("assertion_no"), F.col("score").alias("_score"), F.col("pass").alias("_pass"))
    met = rows.join(judged, ["case_id", "assertion_no"], "left").withColumn("_met", F.when(F.col("_plain") == RUBRIC, F.col("_pass")).otherwise(passed))
    turned = F.when(F.col("kind").startswith("not-"), ~F.col("_met")).otherwise(F.col("_met"))
    verdict = F.col("output").isNotNull() & F.coalesce(turned, F.lit(False))
    score = F.when(F.col("kind") == RUBRIC, F.coalesce("_score", F.lit(0.0))).otherwise(verdict.cast("double"))
    return met.select("case_id", "assertion_no", "kind", "needle", score.alias("score"), verdict.alias("pass"))


def case_verdicts(graded: DataFrame) -> DataFrame:
    """``(case_id, assertions, failed, score, pass)``: a case passes when all its assertions do."""
    return graded.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("assertions"), F.count(F.when(~F.col("pass"), F.lit(1))).alias("failed"),
        F.round(F.avg("score"), 6).alias("score"), F.min("pass").alias("pass"),
    )


def check_structure(responses: DataFrame, column: str, schema: T.StructType | T.ArrayType) -> DataFrame:
    """Adds ``parsed`` and ``valid``: whether the JSON text fits the schema with no field missing at any depth."""

    def complete(value: Column, kind: T.DataType) -> Column:
        whole = value.isNotNull()
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                whole &= F.coalesce(complete(value[field.name], field.dataType), F.lit(False))
        elif isinstance(kind, T.ArrayType):
            whole &= F.coalesce(F.forall(value, lambda item: complete(item, kind.elementType)), F.lit(False))
        return whole

    parsed = F.from_json(column, schema, {"mode": "PERMISSIVE"})
    return responses.withColumn("parsed", parsed).withColumn("valid", complete(F.col("parsed"), schema))

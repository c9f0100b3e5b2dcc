"""Golden cases, accuracy, generated cases and grading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators import answers, chunking, enrich, evaluation, keyword_index, models
from gleaner.operators import retrieval as r
from gleaner.plans import views as v
from gleaner.plans.ingest import CLOZE, longest_word
from gleaner.plans.registry import query
from gleaner.plans.retrieval import ANSWER, CHUNK_HITS, FILES, TEXT_LISTS, WHOLE_LISTS, chunk_hits, text_ranked_lists, whole_ranked_lists
from gleaner.plans.standins import Tables
from gleaner.sources import results as rs
from gleaner.sources.scratch import scratch_path

PROVIDERS = ["rag/naive", "rag/bm25"]


def golden(t: Tables) -> DataFrame:
    return evaluation.golden_sources(t.questions(), t.corpus())


def golden_file(t: Tables) -> DataFrame:
    """Golden cases written as CSV and read back."""
    path = scratch_path(t.spark, "golden-cases")
    cases = golden(t).join(t.questions(), "query_id").select(
        F.col("text").alias("input"), F.concat(F.lit("contains: "), F.col("file_name")).alias("__expected")
    )
    rs.write_cases(cases, path)
    return rs.read_cases(t.spark, path)


CASES = """cases AS (
  SELECT b.text AS input, concat('contains: ', g.file_name) AS __expected FROM golden g JOIN benchmark b ON b.item_id = g.query_id)"""


@query("golden_sources", v.with_(v.GOLDEN, select="SELECT query_id, doc_id, file_name FROM golden"))
def golden_sources(t: Tables) -> DataFrame:
    return golden(t)


@query("golden_cases", v.with_(v.GOLDEN, CASES, select="SELECT input, __expected FROM cases"))
def golden_cases(t: Tables) -> DataFrame:
    return golden_file(t)


@query(
    "parse_assertions",
    v.with_(v.GOLDEN, CASES, select="SELECT input, 'contains' AS kind, substring(__expected, 11) AS needle FROM cases"),
)
def parse_assertions(t: Tables) -> DataFrame:
    kind, needle = evaluation.parse_assertion(F.col("__expected"))
    return golden_file(t).select("input", kind.alias("kind"), needle.alias("needle"))


@query(
    "eval_matrix",
    "SELECT item_id AS query_id, provider FROM benchmark, (VALUES ('rag/naive'), ('rag/bm25')) p(provider)",
)
def eval_matrix(t: Tables) -> DataFrame:
    return evaluation.eval_matrix(t.questions().select("query_id"), PROVIDERS)


def _outputs(hits: DataFrame, provider: str) -> DataFrame:
    named = hits.withColumn("file_name", F.concat(F.lit("doc-"), F.col("chunk_id"), F.lit(".md")))
    return answers.retrieved_files(named).withColumn("provider", F.lit(provider))


ACCURACY = """ranked AS (
          SELECT 'rag/keyword' AS provider, query_id, chunk_id FROM hits
          UNION ALL SELECT 'rag/naive', query_id, chunk_id FROM dense
          UNION ALL SELECT 'rag/bm25', query_id, chunk_id FROM hybrid),
        verdicts AS (
          SELECT p.provider, g.query_id, max(CASE WHEN r.chunk_id IS NULL THEN 0 ELSE 1 END) AS passed
          FROM golden g CROSS JOIN (VALUES ('rag/keyword'), ('rag/naive'), ('rag/bm25')) p(provider)
          LEFT JOIN ranked r ON r.provider = p.provider AND r.query_id = g.query_id AND r.chunk_id = g.doc_id
          GROUP BY ALL)"""
ACCURACY_ROWS = "SELECT provider, count(*) AS questions, CAST(sum(passed) AS BIGINT) AS passed, round(avg(passed), 6) AS accuracy FROM verdicts GROUP BY provider"


@query("topk_accuracy", v.with_(*TEXT_LISTS, v.GOLDEN, ACCURACY, select=ACCURACY_ROWS))
def topk_accuracy(t: Tables) -> DataFrame:
    return _accuracy_of(t, *text_ranked_lists(t))


@query("topk_accuracy_whole", v.with_(*WHOLE_LISTS, v.GOLDEN, ACCURACY, select=ACCURACY_ROWS))
def topk_accuracy_whole(t: Tables) -> DataFrame:
    return _accuracy_of(t, *whole_ranked_lists(t))


def _accuracy_of(t: Tables, dense: DataFrame, keyword: DataFrame) -> DataFrame:
    lists = {"rag/keyword": keyword, "rag/naive": dense, "rag/bm25": r.reciprocal_rank_fusion([dense, keyword])}
    matrix = evaluation.eval_matrix(t.questions().select("query_id"), list(lists))
    outputs = None
    for provider, hits in lists.items():
        named = _outputs(hits, provider)
        outputs = named if outputs is None else outputs.unionByName(named)
    complete = matrix.join(outputs, ["query_id", "provider"], "left")
    return evaluation.topk_accuracy(complete, golden(t).select("query_id", F.col("file_name").alias("expected")))


GOLDEN_ACCURACY = v.with_(
    *CHUNK_HITS, v.GOLDEN,
    """verdicts AS (
      SELECT g.query_id, max(CASE WHEN f.file_name IS NULL THEN 0 ELSE 1 END) AS passed
      FROM golden g LEFT JOIN found f ON f.query_id = g.query_id AND f.file_name = g.file_name GROUP BY g.query_id)""",
    select="SELECT 'keyword' AS provider, count(*) AS questions, CAST(sum(passed) AS BIGINT) AS passed, round(avg(passed), 6) AS accuracy FROM verdicts",
)


@query("golden_accuracy", GOLDEN_ACCURACY)
def golden_accuracy(t: Tables) -> DataFrame:
    """Documents to chunks to postings to top-5 to file lists to accuracy: the whole evaluation."""
    outputs = answers.retrieved_files(chunk_hits(t))
    every = t.questions().select("query_id").join(outputs, "query_id", "left").withColumn("provider", F.lit("keyword"))
    return evaluation.topk_accuracy(every, golden(t).select("query_id", F.col("file_name").alias("expected")))


def document_questions(t: Tables) -> DataFrame:
    """Three cloze questions per Markdown document, with the file name."""
    units = t.documents_as_chunks().filter(F.lower("file_name").endswith(".md"))
    keywords = enrich.top_keywords(keyword_index.build_index(units), enrich.QUESTIONS)
    names = F.concat(F.lit("doc-"), F.col("chunk_id"), F.lit(".md"))
    return enrich.cloze_questions(units, keywords).withColumn("file_name", names)


PAIRS = (v.DOC_UNITS, v.INDEX, v.KEYWORDS, CLOZE)


@query(
    "qa_pairs",
    v.with_(*PAIRS, select="SELECT concat('doc-', chunk_id, '.md') AS file_name, question_no, question, answer FROM questions_made"),
)
def qa_pairs(t: Tables) -> DataFrame:
    return document_questions(t).select("file_name", "question_no", "question", "answer")


CASE_SELECT = """
SELECT question AS input, 'llm-rubric: ' || answer AS __expected1, concat('contains: [file=doc-', chunk_id, '.md]') AS __expected2
FROM questions_made"""


def generated_cases(t: Tables) -> DataFrame:
    pairs = document_questions(t).groupBy("file_name").agg(F.collect_list(F.struct("question", "answer")).alias("pairs"))
    return evaluation.qa_cases(pairs)


@query("qa_cases", v.with_(*PAIRS, select=CASE_SELECT))
def qa_cases(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "generated-cases")
    rs.write_cases(generated_cases(t), path)
    return rs.read_cases(t.spark, path, rs.GENERATED_CASE_SCHEMA)


@query(
    "cases_union",
    v.with_(
        *PAIRS, v.GOLDEN, CASES,
        f"made AS ({CASE_SELECT})",
        select="SELECT input, __expected, NULL::VARCHAR AS __expected1, NULL::VARCHAR AS __expected2 FROM cases UNION ALL SELECT input, NULL, __expected1, __expected2 FROM made",
    ),
)
def cases_union(t: Tables) -> DataFrame:
    hand_made = golden(t).join(t.questions(), "query_id").select(
        F.col("text").alias("input"), F.concat(F.lit("contains: "), F.col("file_name")).alias("__expected")
    )
    return rs.union_cases(hand_made, generated_cases(t))


TURN_PAIRS = """turn_pairs AS (
  SELECT concat_ws('-', a.conv_id, a.turn) AS id, a.text AS answer, b.text AS expected
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1)"""


@query(
    "answer_f1",
    v.with_(
        TURN_PAIRS,
        f"""given AS (SELECT id, term, count(*) AS n FROM (SELECT id, unnest({v.terms("answer")}) AS term FROM turn_pairs) GROUP BY ALL),
        wanted AS (SELECT id, term, count(*) AS n FROM (SELECT id, unnest({v.terms("expected")}) AS term FROM turn_pairs) GROUP BY ALL),
        shared AS (SELECT id, sum(least(g.n, w.n)) AS s FROM given g JOIN wanted w USING (id, term) GROUP BY id),
        graded AS (
          SELECT id, round(coalesce(2.0::DOUBLE * coalesce(s, 0) / nullif(len({v.terms("answer")}) + len({v.terms("expected")}), 0), 0), 6) AS score
          FROM turn_pairs LEFT JOIN shared USING (id))""",
        select="SELECT id, score, score >= 0.5 AS pass FROM graded",
    ),
)
def answer_f1(t: Tables) -> DataFrame:
    turns = t.read("conversations")
    earlier = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("expected"))
    pairs = turns.join(earlier, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("text").alias("answer"), "expected"
    )
    return evaluation.answer_f1(pairs)


GRADED = f"""
asserted AS (
  SELECT query_id AS case_id, 0 AS assertion_no, 'contains' AS kind, '[file=' || file_name || ']' AS needle FROM golden
  UNION ALL SELECT query_id, 1, 'llm-rubric', text FROM questions WHERE query_id IN (SELECT query_id FROM golden)
  UNION ALL SELECT query_id, 2, 'not-icontains', 'FILE=DOC-1' FROM golden),
overlap AS (
  SELECT case_id, needle, list_transform(list_distinct({v.terms("needle")}), lambda x: {{'n': least(len(list_filter({v.terms("needle")}, lambda y: y = x)), len(list_filter({v.terms("answer")}, lambda y: y = x)))}}.n) AS ns,
         len({v.terms("needle")}) + len({v.terms("answer")}) AS size
  FROM asserted JOIN answered ON query_id = case_id WHERE kind = 'llm-rubric'),
rubrics AS (SELECT case_id, round(coalesce(2.0::DOUBLE * list_sum(ns) / nullif(size, 0), 0), 6) AS f1 FROM overlap),
graded AS (
  SELECT a.case_id, a.assertion_no,
         CASE kind WHEN 'contains' THEN contains(answer, needle) WHEN 'not-icontains' THEN NOT contains(lower(answer), lower(needle)) ELSE f1 >= 0.5 END AS pass, f1, kind
  FROM asserted a JOIN answered ON query_id = a.case_id LEFT JOIN rubrics r ON r.case_id = a.case_id)"""


@query(
    "graded_cases",
    v.with_(
        *CHUNK_HITS, ANSWER, v.GOLDEN.replace("SELECT b.item_id AS query_id, d.doc_id, concat('doc-', d.doc_id, '.md') AS file_name", "SELECT b.item_id AS query_id, concat('doc-', min(d.doc_id), '.md') AS file_name")
        .replace("contains(d.text, b.text))", "contains(d.text, b.text) GROUP BY b.item_id)"), GRADED,
        select="""
        SELECT case_id, count(*) AS assertions, count(*) FILTER (WHERE NOT pass) AS failed,
               round(avg(CASE WHEN kind = 'llm-rubric' THEN f1 ELSE CAST(pass AS INTEGER) END), 6) AS score, bool_and(pass) AS pass
        FROM graded GROUP BY case_id
        """,
    ),
)
def graded_cases(t: Tables) -> DataFrame:
    """Cases with three assertions each, graded together on the cited answers."""
    first = golden(t).groupBy("query_id").agg(F.concat(F.lit("doc-"), F.min("doc_id"), F.lit(".md")).alias("file_name"))
    cases = t.questions().join(first, "query_id").select(
        F.col("query_id").alias("case_id"), F.concat(F.lit("contains: [file="), "file_name", F.lit("]")).alias("__expected1"),
        F.concat(F.lit("llm-rubric: "), "text").alias("__expected2"), F.lit("not-icontains: FILE=DOC-1").alias("__expected3"),
    )
    outputs = answers.extractive_answer(chunk_hits(t), t.questions()).select(F.col("query_id").alias("case_id"), F.col("answer").alias("output"))
    return evaluation.case_verdicts(evaluation.grade(evaluation.case_assertions(cases), outputs))


@query(
    "failed_rows",
    r"SELECT doc_id, 'ValueError: text is too short' AS error FROM documents WHERE len(regexp_extract_all(text, '\S+')) < 2",
)
def failed_rows(t: Tables) -> DataFrame:
    answered = models.map_model(t.corpus(), longest_word, ["text"], "answer", T.StringType(), attempts=2, workers=None)
    return models.split_failures(answered)[1].select("doc_id", "error")


RESPONSE = T.StructType([T.StructField("k", T.LongType())])


@query(
    "valid_responses",
    r"""
    SELECT event_id, event_type <> 'error' AS valid, CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '\d+') AS BIGINT) END AS k
    FROM events
    """,
)
def valid_responses(t: Tables) -> DataFrame:
    """Event properties as model responses; those of error events are cut short."""
    text = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(F.col("props"))
    return evaluation.check_structure(t.read("events").withColumn("response", text), "response", RESPONSE).select(
        "event_id", "valid", F.col("parsed.k").alias("k")
    )

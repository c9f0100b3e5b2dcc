"""From hits to context, prompts, file lists and cited answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions import text as tx
from gleaner.operators.common import top_k
from gleaner.sources.scratch import stage

# Texts that callers see.
NO_HITS = "No hits. Try a different query."
NO_VALID = "No valid nodes retrieved. Try a different query."
DONT_KNOW = "I don't know."
GRADER_LABEL = "llm-rubric"
GRADER_ERROR = "Error: RAG provider was used as a grader; llm-rubric should use a different provider."
UNKNOWN_FILE = "unknown"
UNTITLED = "Untitled"
PROMPT_HEAD = "You are a helpful assistant answering questions based only on the context."
PROMPT_TAIL = (
    "Answer clearly and concisely. If the answer is not in the context, say you don't know. "
    "If there are multiple answers in the context then it's OK to provide two different answers for the user to read.\n"
    "Always include the values for `file` as inline citations like so: "
    "[file=Source-File-Name1.md] and [file=Source-File-Name2.md]."
)


def attach_chunks(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Hits joined with the text and metadata of their chunks.

    Hits are staged first: with their true size known, Catalyst broadcasts a
    small hit table and leaves the chunk table unshuffled.
    """
    return chunks.join(stage(hits, "hits"), "chunk_id")


def drop_blank_hits(hits: DataFrame, visible: Column | None = None) -> DataFrame:
    """Hits whose text has a visible character; ranks close up.

    ``visible`` is that judgement where the chunks were judged before they met
    their hits, so that no text is repeated for each hit.
    """
    position = F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))
    return hits.filter(tx.is_nonblank(F.col("text")) if visible is None else visible).withColumn("rank", position.cast("bigint"))


def question_text(input_: Column, query: Column, prompt: Column) -> Column:
    """The question: the structured input, else the query, else the rendered prompt."""
    return tx.first_nonempty(input_, query, prompt)


def grader_guard(label: Column, output: Column) -> Column:
    """A fixed error in place of ``output`` when the provider is called as a grader."""
    return F.when(label == GRADER_LABEL, F.lit(GRADER_ERROR)).otherwise(output)


def _in_rank_order(value: Column) -> Column:
    """Values of a query's hits in rank order; a query has at most k of them."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("rank").alias("rank"), value.alias("value"))))
    return F.transform(pairs, lambda p: p["value"])


def file_name(column: Column) -> Column:
    return F.coalesce(column, F.lit(UNKNOWN_FILE))


def build_context(hits: DataFrame) -> DataFrame:
    """``(query_id, context)`` from ``hits(query_id, rank, score, file_name, title, text)``."""
    part = F.format_string(
        "[%d] score=%.3f, file=%s, title=%s\n%s\n",
        F.col("rank"), F.col("score"), file_name(F.col("file_name")), F.coalesce("title", F.lit(UNTITLED)), F.col("text"),
    )
    return hits.groupBy("query_id").agg(F.array_join(_in_rank_order(part), "\n---\n").alias("context"))


def build_prompt(contexts: DataFrame, queries: DataFrame) -> DataFrame:
    """``(query_id, prompt)``: instruction, context, question and citation rule."""
    prompt = F.concat(
        F.lit(PROMPT_HEAD + "\n\nContext:\n"), F.col("context"),
        F.lit("\n\nQuestion: "), F.col("text"), F.lit("\n\n" + PROMPT_TAIL),
    )
    return queries.join(contexts, "query_id").select("query_id", prompt.alias("prompt"))


def retrieved_files(hits: DataFrame) -> DataFrame:
    """``(query_id, output)``: file names in rank order, one per line, repeats kept."""
    names = F.array_join(_in_rank_order(file_name(F.col("file_name"))), "\n")
    return hits.groupBy("query_id").agg(names.alias("output"))


def with_fallback(
    queries: DataFrame, outputs: DataFrame, column: str = "output", message: str = NO_HITS, hits: DataFrame | None = None, blank_message: str = NO_VALID,
) -> DataFrame:
    """Every query of ``queries``; ``message`` and an empty file list where there was no hit.

    With ``hits``, those before blank ones were dropped, a query all of whose
    hits were blank gets ``blank_message``.
    """
    every = queries.select("query_id").join(outputs, "query_id", "left")
    instead = F.lit(message)
    if hits is not None:
        every = every.join(hits.select("query_id").distinct().withColumn("_met", F.lit(True)), "query_id", "left")
        instead = F.when(F.col("_met"), F.lit(blank_message)).otherwise(instead)
    return every.select("query_id", F.coalesce(column, instead).alias(column), F.col(column).isNotNull().alias("has_hits"))


def coverage(query_terms: Column, text_terms: Column) -> Column:
    """Share of the distinct query terms that occur in the text."""
    wanted = F.array_distinct(query_terms)
    return F.when(F.size(wanted) > 0, F.size(F.array_intersect(wanted, text_terms)) / F.size(wanted)).otherwise(F.lit(0.0))


def rerank(hits: DataFrame, queries: DataFrame, k: int = 5, score: Column | None = None) -> DataFrame:
    """The ``k`` best hits by a second score, default query-term coverage; ties keep the old rank.

    ``score`` may use ``query_text`` and the columns of ``hits``; a model score
    comes in as a column that ``map_model`` added to the hits.
    """
    joined = hits.withColumnRenamed("rank", "first_rank").join(
        queries.select("query_id", F.col("text").alias("query_text")), "query_id"
    )
    value = coverage(tx.terms(F.col("query_text")), tx.terms(F.col("text"))) if score is None else score
    scored = joined.withColumn("rerank_score", F.round(value, 6))
    return top_k(scored, ["query_id"], [F.desc("rerank_score"), F.asc("first_rank")], k).drop("query_text")


def extractive_answer(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """``(query_id, answer)``: the sentence of the hits that covers most query terms, cited.

    Ties go to the better rank, then the earlier sentence. Without any covered
    term, and without any hit, the answer is that it is not known.
    """
    asked = queries.select("query_id", F.array_distinct(tx.terms(F.col("text"))).alias("asked"))
    sentences = hits.join(asked, "query_id").select(
        "query_id", "rank", "asked", file_name(F.col("file_name")).alias("file_name"),
        F.posexplode(tx.sentences(F.col("text"))).alias("position", "sentence"),
    )
    covered = F.size(F.array_intersect("asked", tx.terms(F.col("sentence"))))
    best = (
        sentences.withColumn("covered", covered)
        .filter(F.col("covered") > 0)
        .groupBy("query_id")
        .agg(F.min_by(F.struct("sentence", "file_name"), F.struct(-F.col("covered"), "rank", "position")).alias("best"))
    )
    cited = F.concat(tx.strip(F.col("best.sentence")), F.lit(" [file="), F.col("best.file_name"), F.lit("]"))
    return queries.select("query_id").join(best, "query_id", "left").select(
        "query_id", F.coalesce(cited, F.lit(DONT_KNOW)).alias("answer")
    )


def cited_files(answers: DataFrame) -> DataFrame:
    """``(query_id, position, file_name)``: one row per inline citation."""
    return answers.select("query_id", F.posexplode(tx.citations(F.col("answer"))).alias("position", "file_name")).withColumn(
        "position", (F.col("position") + 1).cast("bigint")
    )

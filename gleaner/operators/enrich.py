"""Deterministic enrichment of chunks: titles, keywords, questions and summaries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as tx
from gleaner.operators.common import PART_ROWS, counted_join, top_k
from gleaner.operators.keyword_index import KeywordIndex
from gleaner.sources.scratch import release, stage

TITLE_CHUNKS = 5
QUESTIONS = 3
KEYWORDS = 10
SCORE_DIGITS = 6


def extract_title(chunks: DataFrame, first: int = TITLE_CHUNKS) -> DataFrame:
    """``(doc_id, title)`` from the first chunks: first heading, else first visible line."""
    head = chunks.filter(F.col("chunk_no") < first).select(
        "doc_id", "chunk_no",
        tx.first_heading(F.col("text")).alias("heading"),
        tx.first_line(F.col("text")).alias("line"),
    )

    def earliest(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("chunk_no")))

    return head.groupBy("doc_id").agg(F.coalesce(earliest("heading"), earliest("line")).alias("title"))


def join_term_stats(rows: DataFrame, index: KeywordIndex, spread_by: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Attach ``df`` to rows with a ``term``.

    How many chunks have a term is known, so that a term in more than
    ``part_rows`` of them is spread over the parts that this takes.
    """
    counts = index.term_stats.select("term", F.col("df").alias("n"))
    return counted_join(rows, index.term_stats, ["term"], [spread_by], counts, part_rows)


# Terms whose frequencies travel to all tasks, the characters of the longest of them, and the rows that look theirs up at once.
COMMON_TERMS = 1 << 19
TERM_CHARS = 64
LOOKUP_ROWS = 1 << 11


class CommonTerms:
    """The frequencies of the most frequent terms, at most ``limit``, in every task.

    ``total`` is the number of chunks, ``most_left`` the highest frequency of
    the terms left out; these meet theirs in a join.
    """

    def __init__(self, index: KeywordIndex, limit: int):
        self.total = max(index.chunk_stats.count(), 1)
        stats = index.term_stats
        short = F.char_length("term") <= TERM_CHARS
        levels = [F.count(F.when(short & (F.col("df") >= 1 << k), F.lit(1))).alias(f"l{k}") for k in range(48)]
        sizes = stats.agg(*levels).first()
        common = short & (F.col("df") >= next(1 << k for k in range(48) if sizes[f"l{k}"] <= limit))
        self.most_left = stats.filter(~common).agg(F.coalesce(F.max("df"), F.lit(1))).first()[0]
        found = stats.filter(common).select("term", "df").toArrow()
        self.table = stats.sparkSession.sparkContext.broadcast((found.column("term").combine_chunks().cast(pa.string()), found.column("df").to_numpy()))

    def dfs(self, terms: pa.Array) -> np.ndarray:
        """Frequencies of ``terms``, 0 for one that is left out or not known at all."""
        known, dfs = self.table.value
        return np.append(dfs, 0)[pc.index_in(terms, known).fill_null(len(known)).to_numpy(zero_copy_only=False)]


def _with_own_stats(index: KeywordIndex) -> KeywordIndex:
    """``index`` with its term statistics as a staged table, as they are read several times."""
    return index if hasattr(index.term_stats, "staged_at") else replace(index, term_stats=stage(index.term_stats, "index-terms"))


def _in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, LOOKUP_ROWS):
            yield batch.slice(at, LOOKUP_ROWS)


def top_keywords(index: KeywordIndex, k: int = KEYWORDS, common_terms: int = COMMON_TERMS) -> DataFrame:
    """``(chunk_id, rank, term, score)``: the ``k`` terms of a chunk with the highest tf-idf.

    A chunk's terms stay in its row, where the frequencies of common terms are
    at hand and the others are bounded; only terms that may be among the best
    leave it, and only those without a frequency meet it in a join.
    """
    index = _with_own_stats(index)
    n_chunks, _ = index.size_and_mean()
    common = CommonTerms(index, common_terms)
    total, most_left = common.total, common.most_left

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Terms that may be among the best ``k`` of their chunk once the scores are rounded."""
        for rows in _in_slices(batches):
            lengths = pc.list_value_length(rows.column("terms")).fill_null(0).to_numpy(zero_copy_only=False)
            terms = rows.column("terms").flatten()
            tfs = rows.column("tfs").flatten().to_numpy(zero_copy_only=False)
            dfs = common.dfs(terms)
            least = tfs * np.log(total / np.where(dfs > 0, dfs, most_left))
            most = np.where(dfs > 0, least, tfs * np.log(total))
            chunk = np.repeat(np.arange(len(lengths)), lengths)
            order = np.lexsort((-least, chunk))
            starts = np.cumsum(lengths) - lengths
            kth = np.full(len(lengths), -np.inf)
            full = lengths >= k
            kth[full] = least[order[starts[full] + k - 1]]
            kept = np.flatnonzero(most >= kth[chunk] - 2 * 10.0**-SCORE_DIGITS)
            df = pa.array(dfs[kept], pa.int64(), mask=dfs[kept] == 0)
            yield pa.RecordBatch.from_arrays([rows.column("chunk_id").take(pa.array(chunk[kept])), terms.take(pa.array(kept)), pa.array(tfs[kept]), df], ["chunk_id", "term", "tf", "df"])

    listed = index.by_chunk().select("chunk_id", F.col("found.term").alias("terms"), F.col("found.tf").alias("tfs"))
    id_type = listed.schema["chunk_id"].dataType.simpleString()
    found = stage(listed.mapInArrow(candidates, f"chunk_id {id_type}, term string, tf bigint, df bigint"), "keyword-candidates")
    rare = join_term_stats(found.filter("df IS NULL").drop("df"), index, "chunk_id").select("chunk_id", "term", "tf", "df")
    weighted = found.filter("df IS NOT NULL").unionAll(rare).select("chunk_id", "term", F.round(F.col("tf") * F.log(n_chunks / F.col("df")), SCORE_DIGITS).alias("score"))
    return top_k(weighted, ["chunk_id"], [F.desc("score"), F.asc("term")], k)


def cloze_questions(chunks: DataFrame, keywords: DataFrame, k: int = QUESTIONS) -> DataFrame:
    """``(chunk_id, question_no, question, answer)`` from the top ``k`` keywords of each chunk.

    The question is the first sentence that has the keyword, with the keyword
    blanked; the keyword is the answer.
    """
    chosen = (
        keywords.filter(F.col("rank") <= k)
        .groupBy("chunk_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("keywords"))
    )
    candidates = (
        chunks.select("chunk_id", "text")
        .join(chosen, "chunk_id")
        .select("chunk_id", tx.sentences(F.col("text")).alias("sentences"), "keywords")
        .select("chunk_id", "sentences", F.explode("keywords").alias("keyword"))
    )
    holds = lambda s: F.lower(s).contains(F.col("keyword.term")) & F.array_contains(tx.terms(s), F.col("keyword.term"))
    return candidates.withColumn("sentence", F.get(F.filter("sentences", holds), F.lit(0))).select(
        "chunk_id",
        F.col("keyword.rank").alias("question_no"),
        tx.blank_out(F.col("sentence"), F.col("keyword.term")).alias("question"),
        F.col("keyword.term").alias("answer"),
    )


def summarize(chunks: DataFrame, index: KeywordIndex, common_terms: int = COMMON_TERMS) -> DataFrame:
    """``(chunk_id, doc_id, chunk_no, summary)``: the sentence with the rarest words on average.

    Ties go to the earlier sentence. Chunks without a term have no summary.
    Sums over the common terms are made in the row of the chunk; the other
    terms meet their frequencies in a join.
    """
    index = _with_own_stats(index)
    common = CommonTerms(index, common_terms)
    total = common.total
    spoken = chunks.select("chunk_id", F.transform(tx.sentences(F.col("text")), tx.terms).alias("spoken"))
    listed = spoken.select("chunk_id", F.flatten("spoken").alias("terms"), F.transform("spoken", F.size).alias("sizes")).filter(F.size("terms") > 0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each sentence how many common terms it has, and the sum of the logarithms of their frequencies; then its other terms."""
        for rows in _in_slices(batches):
            own = pc.list_value_length(rows.column("sizes")).to_numpy(zero_copy_only=False)
            sizes = rows.column("sizes").flatten().to_numpy(zero_copy_only=False)
            chunk, number = np.repeat(np.arange(len(own)), own), np.arange(len(sizes)) - np.repeat(np.cumsum(own) - own, own)
            sentence = np.repeat(np.arange(len(sizes)), sizes)
            terms = rows.column("terms").flatten()
            dfs = common.dfs(terms)
            n = np.bincount(sentence, dfs > 0, len(sizes)).astype(np.int64)
            logs = np.bincount(sentence, np.where(dfs > 0, np.log(total / np.maximum(dfs, 1)), 0.0), len(sizes))
            summed, other = np.flatnonzero(n), np.flatnonzero(dfs == 0)

            def lists(of: np.ndarray, values: pa.Array) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=len(own)))), pa.int32()), values)

            by, of = chunk[summed], chunk[sentence[other]]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("chunk_id"), lists(by, pa.array(number[summed], pa.int32())), lists(by, pa.array(logs[summed])), lists(by, pa.array(n[summed])),
                    lists(of, pa.array(number[sentence[other]], pa.int32())), lists(of, terms.take(pa.array(other))),
                ],
                ["chunk_id", "sentence_no", "total", "n", "other_no", "other"],
            )

    id_type = listed.schema["chunk_id"].dataType.simpleString()
    packed = stage(listed.mapInArrow(sums, f"chunk_id {id_type}, sentence_no array<int>, total array<double>, n array<bigint>, other_no array<int>, other array<string>"), "sentence-sums")
    others = packed.select("chunk_id", F.inline(F.arrays_zip("other_no", "other"))).select("chunk_id", F.col("other_no").alias("sentence_no"), F.col("other").alias("term"))
    met = join_term_stats(others, index, "chunk_id").select("chunk_id", F.array("sentence_no").alias("sentence_no"), F.array(F.log(total / F.col("df"))).alias("total"), F.array(F.lit(1).cast("bigint")).alias("n"))
    # lists move, and become rows where all of a chunk's meet
    gathered = packed.select("chunk_id", "sentence_no", "total", "n").unionAll(met).repartition("chunk_id")
    rarity = (
        gathered.select("chunk_id", F.inline(F.arrays_zip("sentence_no", "total", "n")))
        .groupBy("chunk_id", "sentence_no")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .select("chunk_id", "sentence_no", F.round(F.col("total") / F.col("n"), SCORE_DIGITS).alias("rarity"))
    )
    # staged, so that the exchange of the sums goes before that of the texts
    best = stage(rarity.groupBy("chunk_id").agg(F.min_by("sentence_no", F.struct(-F.col("rarity"), "sentence_no")).alias("best")), "best-sentences")
    release(packed)
    return chunks.join(best, "chunk_id").select(
        "chunk_id", "doc_id", "chunk_no", F.get(tx.sentences(F.col("text")), F.col("best")).alias("summary")
    )


def with_previous(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the value of ``column`` at the previous ``chunk_no`` of the same document.

    Each row is sent to its own position and to the next one, and the two meet
    in one aggregation: positions are unique, so a long document does not
    gather in one task.
    """
    others = [c for c in df.columns if c not in ("doc_id", "chunk_no", column)]
    own = F.struct(F.col("chunk_no").alias("chunk_no"), F.struct(*others, column).alias("own"), F.lit(None).cast("string").alias("previous"))
    ahead = F.struct(
        (F.col("chunk_no") + 1).alias("chunk_no"),
        F.lit(None).cast(df.select(F.struct(*others, column)).schema[0].dataType).alias("own"),
        F.col(column).alias("previous"),
    )
    return (
        df.select("doc_id", F.inline(F.array(own, ahead)))
        .groupBy("doc_id", "chunk_no")
        .agg(F.max("own").alias("own"), F.max("previous").alias(name))
        .filter(F.col("own").isNotNull())
        .select("doc_id", "chunk_no", "own.*", name)
    )


def run_transformations(df: DataFrame, steps) -> DataFrame:
    """Apply a list of ``DataFrame -> DataFrame`` functions in order."""
    for step in steps:
        df = df.transform(step)
    return df


def metadata_steps(index: KeywordIndex, keywords: int = KEYWORDS, questions: int = QUESTIONS, texts: DataFrame | None = None) -> list:
    """The enrichments as a list for :func:`run_transformations` over ``chunks(chunk_id, doc_id, chunk_no, text, ...)``.

    They add ``title``, ``keywords`` (best first), ``questions`` (one a line),
    ``summary`` and ``prev_summary``, null where a chunk has none. Every chunk
    stays, and ``index`` is the one over the plain chunks. Rows of a document with very many
    chunks are joined with its title by Spark's skew join.

    With ``texts``, a table of the same chunks, texts are read from there, and
    the chunks that the enrichments are added to may come without theirs, so
    that no text moves along.
    """

    def read(chunks: DataFrame) -> DataFrame:
        return chunks if texts is None else texts

    def listed(rows: DataFrame, rank: str, column: str, name: str, separator: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct(rank, column)))
        return rows.groupBy("chunk_id").agg(F.array_join(F.transform(ordered, lambda r: r[column]), separator).alias(name))

    def titles(chunks: DataFrame) -> DataFrame:
        return chunks.join(extract_title(read(chunks)), "doc_id", "left")

    def terms(chunks: DataFrame) -> DataFrame:
        best = stage(top_keywords(index, max(keywords, questions)), "keywords")
        # staged, so that the exchange of the texts goes before the next one
        asked = stage(listed(cloze_questions(read(chunks), best, questions), "question_no", "question", "questions", "\n"), "questions")
        named = listed(best.filter(F.col("rank") <= keywords), "rank", "term", "keywords", ", ")
        return chunks.join(named, "chunk_id", "left").join(asked, "chunk_id", "left")

    def summaries(chunks: DataFrame) -> DataFrame:
        made = stage(summarize(read(chunks), index).select("chunk_id", "summary"), "summaries")
        return with_previous(chunks.join(made, "chunk_id", "left"), "summary", "prev_summary")

    return [titles, terms, summaries]


def metadata_text(chunks: DataFrame) -> DataFrame:
    """``chunks`` with their metadata, one line each, in front of ``text``, as they are indexed and embedded."""
    ahead = [F.col(name) for name in ("title", "keywords", "questions", "prev_summary", "summary") if name in chunks.columns]
    return chunks.withColumn("text", F.concat_ws("\n", *ahead, "text"))

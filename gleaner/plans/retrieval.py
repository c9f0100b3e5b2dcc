"""Retrieval, context and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as tx
from gleaner.operators import answers, chunking, encoder, enrich, keyword_index, models, pruned_index, vector_index
from gleaner.operators import retrieval as r
from gleaner.plans import views as v
from gleaner.plans.ingest import chunk_index
from gleaner.plans.registry import query
from gleaner.plans.standins import Tables
from gleaner.sources.scratch import scratch_path, stage

LSH_BUCKET = 0.04
HIT_COLUMNS = ["query_id", "rank", "chunk_id", "score"]
HITS = "SELECT query_id, rank, chunk_id, score FROM "


@query("dense_topk", v.with_(v.DENSE, select=HITS + "dense"))
def dense_topk(t: Tables) -> DataFrame:
    return r.dense_topk(t.vectors(), t.query_vectors())


@query("dense_topk_lsh")
def dense_topk_lsh(t: Tables) -> DataFrame:
    return r.dense_topk_lsh(t.vectors(), t.query_vectors(), bucket_length=LSH_BUCKET)


@query("dense_lsh_recall")
def dense_lsh_recall(t: Tables) -> DataFrame:
    approximate = r.dense_topk_lsh(t.vectors(), t.query_vectors(), bucket_length=LSH_BUCKET)
    return r.recall(approximate, r.dense_topk(t.vectors(), t.query_vectors()))


@query("bm25_topk", v.with_(v.CHUNK_UNITS, v.QUESTIONS, v.INDEX, v.bm25(), select=HITS + "hits"))
def bm25_topk(t: Tables) -> DataFrame:
    return r.bm25_topk(chunk_index(t)[1], t.questions())


HYBRID = f"""
both_lists AS (SELECT query_id, chunk_id, rank FROM hits UNION ALL SELECT query_id, chunk_id, rank FROM dense),
fused AS (SELECT query_id, chunk_id, round(sum(1.0::DOUBLE / (60 + rank - 1)), 6) AS score FROM both_lists GROUP BY ALL),
hybrid AS {v.top("fused", "query_id", "score DESC, chunk_id", 5)}"""


def text_ranked_lists(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Dense and keyword hits of the questions' texts over all documents.

    Documents and questions are encoded by one saved table of weights. Its
    bag of terms would read an instruction as terms, so there is none.
    """
    units = t.documents_as_chunks()
    weights = fitted_encoder(t, units)
    vectors = encoder.encode(units, weights).select(F.col("chunk_id").alias("vec_id"), "embedding")
    dense = r.dense_topk(vectors, encoder.encode_queries(t.questions(), weights, instruct=False))
    return dense, r.bm25_topk(keyword_index.build_index(units), t.questions())


def fitted_encoder(t: Tables, units: DataFrame) -> DataFrame:
    """The encoder of ``units``, saved and loaded."""
    path = scratch_path(t.spark, "encoder")
    encoder.save_encoder(encoder.fit_table(units, v.ENCODER_DIM), path)
    return encoder.load_encoder(t.spark, path)


TEXT_LISTS = (v.DOC_UNITS, v.QUESTIONS, v.INDEX, v.bm25(), v.WEIGHTS, v.text_dense(), HYBRID)


def whole_ranked_lists(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Dense hits over all vectors and keyword hits over all documents; fusion needs no common ids."""
    return r.dense_topk(t.vectors(), t.query_vectors()), r.bm25_topk(keyword_index.build_index(t.documents_as_chunks()), t.questions())


WHOLE_LISTS = (v.DOC_UNITS, v.QUESTIONS, v.INDEX, v.bm25(), v.DENSE, HYBRID)


@query("hybrid_rrf", v.with_(*TEXT_LISTS, select=HITS + "hybrid"))
def hybrid_rrf(t: Tables) -> DataFrame:
    """Questions against all documents, by keyword and by encoded text, fused."""
    return r.reciprocal_rank_fusion(list(text_ranked_lists(t)))


@query(
    "dense_text_topk",
    v.with_(
        v.DOC_UNITS, v.QUESTIONS, f"instructed AS (SELECT query_id, '{models.QUERY_INSTRUCTION}' || text AS text FROM questions)".replace("\n", "' || chr(10) || '"),
        v.WEIGHTS, v.text_dense(asked="instructed"), select=HITS + "dense",
    ),
)
def dense_text_topk(t: Tables) -> DataFrame:
    """Questions as an instruction-tuned encoder takes them, against all documents."""
    units = t.documents_as_chunks()
    weights = fitted_encoder(t, units)
    vectors = encoder.encode(units, weights).select(F.col("chunk_id").alias("vec_id"), "embedding")
    return r.dense_topk(vectors, encoder.encode_queries(t.questions(), weights))


@query("bm25_saved", v.with_(v.DOC_UNITS, v.QUESTIONS, v.INDEX, v.bm25(), select=HITS + "hits"))
def bm25_saved(t: Tables) -> DataFrame:
    """The index saved as tables, loaded and searched."""
    path = scratch_path(t.spark, "saved-index")
    name = "saved_" + path[-32:]
    keyword_index.save_index(keyword_index.build_index(t.documents_as_chunks()), name, path, buckets=16)
    return r.bm25_topk(keyword_index.load_index(t.spark, name), t.questions())


@query("bm25_pruned", v.with_(v.CHUNK_UNITS, v.QUESTIONS, v.INDEX, v.bm25(), select=HITS + "hits"))
def bm25_pruned(t: Tables) -> DataFrame:
    """The index saved in blocks with bounds, of which only what can reach the hits is read."""
    path = scratch_path(t.spark, "pruned-index")
    pruned_index.save_pruned(chunk_index(t)[1], path, buckets=16, range_chunks=256)
    return pruned_index.pruned_topk(pruned_index.open_pruned(t.spark, path), t.questions())


def cell_index(t: Tables) -> vector_index.VectorIndex:
    """All vectors in cells, saved and opened."""
    path = scratch_path(t.spark, "vector-cells")
    vectors = t.vectors()
    first = vectors.filter(F.size("embedding") > 0).select(F.size("embedding").alias("dim")).first()
    vector_index.save_vectors_in_cells(vectors, path, first["dim"])
    return vector_index.open_cells(t.spark, path)


@query("dense_topk_cells")
def dense_topk_cells(t: Tables) -> DataFrame:
    return vector_index.probed_topk(cell_index(t), t.query_vectors())


@query("dense_cells_recall")
def dense_cells_recall(t: Tables) -> DataFrame:
    """Recall against the exact hits, and the share of all pairs that was scored."""
    index = cell_index(t)
    found = r.recall(vector_index.probed_topk(index, t.query_vectors()), r.dense_topk(t.vectors(), t.query_vectors()))
    return found.withColumn("scored_share", F.lit(vector_index.scored_share(index, t.query_vectors())))


@query("rejected_vectors", """
SELECT vec_id, CASE WHEN embedding IS NULL THEN 'missing' WHEN len(embedding) <> 64 THEN 'length ' || len(embedding) ELSE 'not a number' END AS reason
FROM (SELECT vec_id, CASE WHEN label = 0 THEN NULL WHEN label = 1 THEN embedding[1:3] WHEN label = 2 THEN list_concat(embedding[1:63], ['NaN'::FLOAT]) ELSE embedding END AS embedding FROM embeddings)
WHERE embedding IS NULL OR len(embedding) <> 64 OR len(list_filter(embedding, lambda x: isnan(x))) > 0
""")
def rejected_vectors(t: Tables) -> DataFrame:
    """Vectors that no index takes, told by reason; some are spoilt for the purpose."""
    label, whole = F.col("label"), F.col("embedding")
    spoilt = (
        F.when(label == 1, F.slice(whole, 1, 3))
        .when(label == 2, F.concat(F.slice(whole, 1, 63), F.array(F.lit(float("nan")).cast("float"))))
        .when((label != 0) | label.isNull(), whole)
    )
    return vector_index.rejected_vectors(t.read("embeddings").select("vec_id", spoilt.alias("embedding")), 64)


@query("hybrid_rrf_whole", v.with_(*WHOLE_LISTS, select=HITS + "hybrid"))
def hybrid_rrf_whole(t: Tables) -> DataFrame:
    return r.reciprocal_rank_fusion(list(whole_ranked_lists(t)))


@query(
    "query_variants",
    v.with_(
        v.DOC_UNITS, v.QUESTIONS,
        r"leads AS (SELECT query_id, regexp_extract(text, '(\S[^\n]*)', 1) AS text FROM questions)",
        v.INDEX, v.bm25("whole"), v.bm25("lead", asked="leads"),
        """both_lists AS (SELECT query_id, chunk_id, rank FROM whole UNION ALL SELECT query_id, chunk_id, rank FROM lead),
        fused AS (SELECT query_id, chunk_id, round(sum(1.0::DOUBLE / (60 + rank - 1)), 6) AS score FROM both_lists GROUP BY ALL)""",
        select=HITS + v.top("fused", "query_id", "score DESC, chunk_id", 5),
    ),
)
def query_variants(t: Tables) -> DataFrame:
    whole = t.questions().withColumn("variant", F.lit(0))
    lead = t.questions().select("query_id", tx.first_line(F.col("text")).alias("text"), F.lit(1).alias("variant"))
    index = keyword_index.build_index(t.documents_as_chunks())
    return r.retrieve_variants(r.bm25_retriever(index), whole.unionByName(lead))


def chunk_hits(t: Tables, k: int = r.TOP_K) -> DataFrame:
    """Keyword hits of the questions with the text of their chunks."""
    chunks, index = chunk_index(t)
    return answers.attach_chunks(r.bm25_topk(index, t.questions(), k), chunks)


CHUNK_HITS = (v.CHUNK_UNITS, v.QUESTIONS, v.INDEX, v.bm25(), "found AS (SELECT * FROM hits JOIN chunks USING (chunk_id))")


@query(
    "nonblank_hits",
    v.with_(
        *CHUNK_HITS,
        select="""
        SELECT query_id, chunk_id, score, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS rank
        FROM found WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
        """,
    ),
)
def nonblank_hits(t: Tables) -> DataFrame:
    toxic = t.read("labels").filter("toxic = 1").select("doc_id", F.lit(True).alias("toxic"))
    masked = chunk_hits(t).join(toxic, "doc_id", "left").withColumn(
        "text", F.when(F.col("toxic"), F.lit(" \t\n ")).otherwise(F.col("text"))
    )
    return answers.drop_blank_hits(masked).select(*HIT_COLUMNS)


@query(
    "rerank",
    v.with_(
        v.CHUNK_UNITS, v.QUESTIONS, v.INDEX, v.bm25(k=20), "found AS (SELECT * FROM hits JOIN chunks USING (chunk_id))",
        f"""terms_of AS (
          SELECT f.query_id, f.rank AS first_rank, f.chunk_id, list_distinct({v.terms("q.text")}) AS wanted, {v.terms("f.text")} AS present
          FROM found f JOIN questions q USING (query_id)),
        covered AS (
          SELECT query_id, first_rank, chunk_id, round(len(list_filter(wanted, lambda x: list_contains(present, x))) / len(wanted), 6) AS rerank_score
          FROM terms_of)""",
        select="SELECT query_id, rank, first_rank, chunk_id, rerank_score FROM " + v.top("covered", "query_id", "rerank_score DESC, first_rank", 5),
    ),
)
def rerank(t: Tables) -> DataFrame:
    return answers.rerank(chunk_hits(t, 20), t.questions()).select("query_id", "rank", "first_rank", "chunk_id", "rerank_score")


TITLES = r"""
lines AS (
  SELECT doc_id, chunk_no, nullif(regexp_extract(text, '(?m)^#{1,6}[ \t]+(\S[^\n]*)', 1), '') AS heading,
         nullif(regexp_extract(text, '(\S[^\n]*)', 1), '') AS line
  FROM chunks WHERE chunk_no < 5),
titles AS (
  SELECT doc_id, coalesce(arg_min(heading, chunk_no) FILTER (WHERE heading IS NOT NULL),
                          arg_min(line, chunk_no) FILTER (WHERE line IS NOT NULL)) AS title
  FROM lines WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) GROUP BY doc_id)"""
CONTEXT = """
contexts AS (
  SELECT query_id, string_agg(concat('[', rank, '] score=', CAST(CAST(CAST(score AS DECIMAL(18, 6)) AS DECIMAL(18, 3)) AS VARCHAR), ', file=', file_name,
           ', title=', coalesce(title, 'Untitled'), chr(10), text, chr(10)), chr(10) || '---' || chr(10) ORDER BY rank) AS context
  FROM found LEFT JOIN titles USING (doc_id) GROUP BY query_id)"""


def contexts(t: Tables) -> DataFrame:
    """Contexts of the questions; only documents with a hit are read for their titles."""
    hits = stage(chunk_hits(t), "hit-chunks")
    low = t.read("labels").filter("quality = 0").select("doc_id")
    hit_documents = t.corpus().join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    titles = enrich.extract_title(chunking.chunk_windows(hit_documents)).join(low, "doc_id", "left_anti")
    return answers.build_context(hits.join(titles, "doc_id", "left"))


@query("rag_context", v.with_(*CHUNK_HITS, TITLES, CONTEXT, select="SELECT query_id, context FROM contexts"))
def rag_context(t: Tables) -> DataFrame:
    return contexts(t)


@query(
    "rag_prompt",
    v.with_(
        *CHUNK_HITS, TITLES, CONTEXT,
        select=f"""
        SELECT query_id, concat('{answers.PROMPT_HEAD}', chr(10), chr(10), 'Context:', chr(10), context, chr(10), chr(10), 'Question: ', text,
               chr(10), chr(10), '{answers.PROMPT_TAIL.replace("'", "''")}') AS prompt
        FROM contexts JOIN questions USING (query_id)
        """,
    ),
)
def rag_prompt(t: Tables) -> DataFrame:
    return answers.build_prompt(contexts(t), t.questions())


FILES = "outputs AS (SELECT query_id, string_agg(file_name, chr(10) ORDER BY rank) AS output FROM found GROUP BY query_id)"


@query("retrieved_files", v.with_(*CHUNK_HITS, FILES, select="SELECT query_id, output FROM outputs"))
def retrieved_files(t: Tables) -> DataFrame:
    return answers.retrieved_files(chunk_hits(t))


PART_QUESTIONS = """
questions AS (
  SELECT concat('item-', item_id) AS query_id, text FROM benchmark
  UNION ALL SELECT concat('part-', p_partkey), p_name FROM part)"""


@query(
    "no_hit_fallback",
    v.with_(
        v.DOC_UNITS, PART_QUESTIONS, v.INDEX, v.bm25(), "found AS (SELECT * FROM hits JOIN units USING (chunk_id))", FILES,
        select=f"""
        SELECT query_id, coalesce(output, '{answers.NO_HITS}') AS output, output IS NOT NULL AS has_hits
        FROM questions LEFT JOIN outputs USING (query_id)
        """,
    ),
)
def no_hit_fallback(t: Tables) -> DataFrame:
    asked = t.read("benchmark").select(F.concat(F.lit("item-"), F.col("item_id")).alias("query_id"), "text").union(
        t.read("part").select(F.concat(F.lit("part-"), F.col("p_partkey")), "p_name")
    )
    chunks = t.documents_as_chunks()
    hits = r.bm25_topk(keyword_index.build_index(chunks), asked)
    return answers.with_fallback(asked, answers.retrieved_files(answers.attach_chunks(hits, chunks)))


BLANKED = f"""
masked AS (SELECT f.*, d.doc_id % 3 <> 0 AS blank FROM hits f JOIN units d USING (chunk_id)),
shown AS (SELECT query_id, string_agg(concat('doc-', chunk_id, '.md'), chr(10) ORDER BY rank) AS output FROM masked WHERE NOT blank GROUP BY query_id)"""


@query(
    "no_valid_fallback",
    v.with_(
        v.DOC_UNITS, PART_QUESTIONS, v.INDEX, v.bm25(k=2), BLANKED,
        select=f"""
        SELECT query_id, coalesce(output, CASE WHEN query_id IN (SELECT query_id FROM masked) THEN '{answers.NO_VALID}' ELSE '{answers.NO_HITS}' END) AS output,
               output IS NOT NULL AS has_hits
        FROM questions LEFT JOIN shown USING (query_id)
        """,
    ),
)
def no_valid_fallback(t: Tables) -> DataFrame:
    """Two documents in three are blank when they are shown: some questions meet blank hits only."""
    asked = t.read("benchmark").select(F.concat(F.lit("item-"), F.col("item_id")).alias("query_id"), "text").union(
        t.read("part").select(F.concat(F.lit("part-"), F.col("p_partkey")), "p_name")
    )
    units = t.documents_as_chunks()
    shown = units.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.lit(" \n")))
    judged = shown.select("chunk_id", "file_name", tx.is_nonblank(F.col("text")).alias("visible"))
    hits = stage(answers.attach_chunks(r.bm25_topk(keyword_index.build_index(units), asked, 2), judged), "shown-hits")
    visible = answers.drop_blank_hits(hits, F.col("visible"))
    return answers.with_fallback(asked, answers.retrieved_files(visible), hits=hits)


ANSWER = f"""
spoken AS (
  SELECT f.query_id, f.rank, f.file_name, list_distinct({v.terms("q.text")}) AS wanted, {v.sentences("f.text")} AS ss
  FROM found f JOIN questions q USING (query_id)),
numbered AS (SELECT query_id, rank, file_name, wanted, generate_subscripts(ss, 1) AS no, unnest(ss) AS sentence FROM spoken),
judged AS (
  SELECT *, len(list_filter(wanted, lambda x: list_contains({v.terms("sentence")}, x))) AS covered FROM numbered),
picked AS {v.top("(SELECT * FROM judged WHERE covered > 0)", "query_id", "covered DESC, rank, no", 1, "pick")},
answered AS (
  SELECT q.query_id, coalesce(regexp_replace(p.sentence, '^\\s+|\\s+$', '', 'g') || ' [file=' || p.file_name || ']', '{answers.DONT_KNOW.replace("'", "''")}') AS answer
  FROM questions q LEFT JOIN picked p USING (query_id))"""


@query("extractive_answer", v.with_(*CHUNK_HITS, ANSWER, select="SELECT query_id, answer FROM answered"))
def extractive_answer(t: Tables) -> DataFrame:
    return answers.extractive_answer(chunk_hits(t), t.questions())


@query(
    "citations",
    v.with_(
        *CHUNK_HITS,
        "cited AS (SELECT query_id, string_agg(concat('see [file=', file_name, ']'), ' and ' ORDER BY rank) AS answer FROM found GROUP BY query_id)",
        r"listed AS (SELECT query_id, regexp_extract_all(answer, '\[file=([^\]]+)\]', 1) AS fs FROM cited)",
        select="SELECT query_id, generate_subscripts(fs, 1) AS position, unnest(fs) AS file_name FROM listed",
    ),
)
def citations(t: Tables) -> DataFrame:
    quoted = chunk_hits(t).withColumn("file_name", F.concat(F.lit("see [file="), F.col("file_name"), F.lit("]")))
    texts = answers.retrieved_files(quoted).select("query_id", F.replace("output", F.lit("\n"), F.lit(" and ")).alias("answer"))
    return answers.cited_files(texts)


@query(
    "question_coalesce",
    f"""
    WITH asked AS (
      SELECT conv_id, turn, CASE WHEN turn = 0 THEN '' ELSE text END AS input, CASE WHEN role = 'assistant' THEN '' ELSE role END AS query,
             concat('prompt ', conv_id) AS prompt, CASE WHEN role = 'system' THEN 'llm-rubric' ELSE 'top-k' END AS label
      FROM conversations)
    SELECT conv_id, turn, coalesce(nullif(input, ''), nullif(query, ''), prompt) AS question,
           CASE WHEN label = 'llm-rubric' THEN '{answers.GRADER_ERROR}' ELSE 'ok' END AS output
    FROM asked
    """,
)
def question_coalesce(t: Tables) -> DataFrame:
    first, label = F.col("turn") == 0, F.when(F.col("role") == "system", F.lit("llm-rubric")).otherwise(F.lit("top-k"))
    return t.read("conversations").select(
        "conv_id", "turn",
        answers.question_text(
            F.when(first, F.lit("")).otherwise(F.col("text")),
            F.when(F.col("role") == "assistant", F.lit("")).otherwise(F.col("role")),
            F.concat(F.lit("prompt "), F.col("conv_id")),
        ).alias("question"),
        answers.grader_guard(label, F.lit("ok")).alias("output"),
    )

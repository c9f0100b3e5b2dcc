"""Sources, chunking, enrichment and stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import text as tx
from gleaner.operators import chunking, encoder, enrich, keyword_index, models
from gleaner.plans import views as v
from gleaner.plans.registry import query
from gleaner.plans.standins import Tables
from gleaner.sources import corpus, files, store, tables
from gleaner.sources.scratch import release, scratch_path, stage

NL = "chr(10)"


@query("scan_corpus", v.with_(v.CORPUS, select="SELECT doc_id, file_name, text FROM corpus"))
def scan_corpus(t: Tables) -> DataFrame:
    return t.corpus()


@query("convert_pages")
def convert_pages(t: Tables) -> DataFrame:
    return corpus.convert_pages(t.spread(t.read("pages"), "page_id"))


@query(
    "convert_pending",
    "SELECT page_id, url FROM pages WHERE page_id NOT IN (SELECT conv_id FROM conversations)",
)
def convert_pending(t: Tables) -> DataFrame:
    done = t.read("conversations").select(F.col("conv_id").alias("page_id"))
    return corpus.pending(t.read("pages").select("page_id", "url"), done, "page_id")


SYNCED = """
WITH marks AS (SELECT doc_id, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels GROUP BY doc_id),
lines AS (SELECT concat('docs-', doc_id // 8) AS name, doc_id, coalesce(text, '') AS text, toxic FROM documents LEFT JOIN marks USING (doc_id)),
landed AS (
  SELECT 1 AS round, name, 'new' AS change, string_agg(text || chr(10), '' ORDER BY doc_id) AS body FROM lines GROUP BY name
  UNION ALL
  SELECT 2, name, CASE WHEN bool_or(coalesce(toxic, FALSE)) THEN 'changed' ELSE 'touched' END,
         string_agg(text || CASE WHEN toxic THEN ' Revised.' ELSE '' END || chr(10), '' ORDER BY doc_id)
  FROM lines GROUP BY name HAVING count(toxic) > 0)
SELECT round, name, change, sha256(body) AS hash FROM landed
"""


def land(landing: DataFrame, folder: str, shelves: int) -> None:
    """``landing(file, doc_id, text)`` as files, each in a folder of its own; a written file replaces the earlier one of its name.

    The folders stand on shelves, which are written one after another, so that
    the driver commits the files of one shelf at a time.
    """
    spark = landing.sparkSession
    shelf = F.pmod(F.xxhash64("file"), F.lit(shelves)).cast("int")
    path = scratch_path(spark, "landing")
    landing.select("file", "doc_id", "text", shelf.alias("shelf")).write.option("compression", "zstd").partitionBy("shelf").parquet(path)
    staged = spark.read.schema(landing.select("file", "doc_id", "text", shelf.alias("shelf")).schema).parquet(path)
    staged.staged_at = path
    for row in staged.select("shelf").distinct().orderBy("shelf").collect():
        placed = staged.filter(F.col("shelf") == row["shelf"]).repartition("file").sortWithinPartitions("file", "doc_id").select("file", "text")
        placed.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("file").text(f"{folder}/shelf={row['shelf']}")
    release(staged)


@query("sync_files", SYNCED)
def sync_files(t: Tables) -> DataFrame:
    """Files of eight documents, read in three rounds: all of them, those with a labelled document written again and its toxic texts revised, nothing."""
    folder, memory = scratch_path(t.spark, "files"), scratch_path(t.spark, "file-memory")
    marks = t.read("labels").groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    documents = t.corpus().join(marks, "doc_id", "left").select(
        F.expr("concat('docs-', doc_id div 8)").alias("file"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic"
    )
    again = documents.filter(F.col("toxic").isNotNull()).select("file").distinct()
    revised = documents.join(again, "file", "left_semi").withColumn("text", F.concat("text", F.when(F.col("toxic"), " Revised.").otherwise("")))
    shelves = max(-(-2 * documents.select("file").distinct().count() // files.PART_FILES), 1)
    told = []
    for round_no, landing in enumerate((documents, revised, None), 1):
        if landing is not None:
            land(landing, folder, shelves)
        changes = files.changed_files(t.spark, folder, memory, str(round_no), "*.txt", F.regexp_extract("path", "/file=([^/]+)/", 1))
        files.remember(changes, memory, str(round_no))
        told.append(stage(changes.select(F.lit(round_no).alias("round"), "name", "change", "hash"), "told"))
        release(changes)
    return told[0].unionAll(told[1]).unionAll(told[2])


# every fourth line of a document as a heading, every ninth as a fence
MARKED = r"""
marked AS (
  SELECT doc_id, list_transform(list_zip(ls, range(len(ls))), lambda p: CASE WHEN p[2] % 9 = 2 THEN CASE WHEN p[2] % 2 = 0 THEN '```' ELSE '~~~~ x' END
    WHEN p[2] % 4 = 0 THEN repeat('#', (1 + p[2] % 3)::INTEGER) || ' ' || p[1] ELSE p[1] END) AS ls
  FROM (SELECT doc_id, string_split(replace(text, '. ', '.' || chr(10)), chr(10)) AS ls FROM documents))"""
SECTIONS = r"""
folded AS (
  SELECT doc_id, ls, list_reduce(list_prepend({'line': 0, 'fence': '', 'path': []::STRUCT(level INTEGER, heading VARCHAR)[], 'out': []::STRUCT(line INTEGER, heading VARCHAR, path VARCHAR)[]},
    list_transform(list_zip(ls, range(len(ls))), lambda p: {'line': p[2]::INTEGER, 'fence': p[1], 'path': []::STRUCT(level INTEGER, heading VARCHAR)[], 'out': []::STRUCT(line INTEGER, heading VARCHAR, path VARCHAR)[]})),
    lambda s, x: {
      'line': x.line,
      'fence': CASE WHEN s.fence = '' THEN regexp_extract(x.fence, '^ {0,3}(`{3,}|~{3,})', 1)
                    WHEN len(regexp_extract(x.fence, '^ {0,3}(`{3,}|~{3,})[ 	]*$', 1)) >= len(s.fence) AND regexp_extract(x.fence, '^ {0,3}(`{3,}|~{3,})[ 	]*$', 1)[1] = s.fence[1] THEN ''
                    ELSE s.fence END,
      'path': CASE WHEN s.fence = '' AND regexp_matches(x.fence, '^#{1,6}[ 	]+\S')
                   THEN list_append(list_filter(s.path, lambda q: q.level < len(regexp_extract(x.fence, '^(#+)', 1))),
                                    {'level': len(regexp_extract(x.fence, '^(#+)', 1))::INTEGER, 'heading': regexp_extract(x.fence, '^#+[ 	]+(.*)$', 1)})
                   ELSE s.path END,
      'out': CASE WHEN s.fence = '' AND regexp_matches(x.fence, '^#{1,6}[ 	]+\S')
                  THEN list_append(s.out, {'line': x.line, 'heading': regexp_extract(x.fence, '^#+[ 	]+(.*)$', 1),
                       'path': array_to_string(list_append(list_transform(list_filter(s.path, lambda q: q.level < len(regexp_extract(x.fence, '^(#+)', 1))), lambda q: q.heading),
                                               regexp_extract(x.fence, '^#+[ 	]+(.*)$', 1)), ' > ')})
                  ELSE s.out END}).out AS hs
  FROM marked),
parted AS (
  SELECT doc_id, ls, list_prepend({'line': -1, 'heading': NULL::VARCHAR, 'path': ''}, hs) AS ps FROM folded),
sections AS (
  SELECT doc_id, CAST(n AS BIGINT) AS section_no, ps[n + 1].heading AS heading, ps[n + 1].path AS path,
         regexp_replace(array_to_string(ls[ps[n + 1].line + 2 : coalesce(ps[n + 2].line, len(ls))], chr(10)), '^\s+|\s+$', '', 'g') AS text
  FROM (SELECT *, unnest(range(len(ps))) AS n FROM parted))""".replace("\\\\", "\\")


@query("markdown_sections", v.with_(MARKED, SECTIONS, select="SELECT doc_id, section_no, heading, path, text FROM sections WHERE text <> '' OR heading IS NOT NULL"))
def markdown_sections(t: Tables) -> DataFrame:
    """Sections of the documents, some lines of which are made headings and fences."""
    lines = F.split(F.replace("text", F.lit(". "), F.lit(".\n")), "\n", -1)
    fence = lambda i: F.when(i % 2 == 0, F.lit("```")).otherwise(F.lit("~~~~ x"))
    mark = lambda line, i: F.when(i % 9 == 2, fence(i)).when(i % 4 == 0, F.concat(F.repeat(F.lit("#"), 1 + i % 3), F.lit(" "), line)).otherwise(line)
    marked = t.corpus().select("doc_id", F.array_join(F.transform(lines, mark), "\n").alias("text"))
    return corpus.markdown_sections(marked).select("doc_id", "section_no", "heading", F.array_join("path", " > ").alias("path"), "text")


@query(
    "vector_counts",
    """
    SELECT collection, count(*) AS n_vectors FROM (
      SELECT 'naive' AS collection FROM embeddings
      UNION ALL SELECT 'bm25' FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels))
    GROUP BY collection
    """,
)
def vector_counts(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "vectors")
    labelled = t.read("labels").select(F.col("doc_id").alias("vec_id"))
    tables.write_vectors(t.vectors(), path, "naive")
    tables.write_vectors(t.vectors().join(labelled, "vec_id", "left_semi"), path, "bm25")
    return tables.vector_counts(tables.read_vectors(t.spark, path))


@query("chunk_windows", v.with_(v.CHUNKS, select="SELECT chunk_id, doc_id, file_name, chunk_no, text, n_words FROM chunks"))
def chunk_windows(t: Tables) -> DataFrame:
    return chunking.chunk_windows(t.corpus())


@query("chunk_store", v.with_(v.CHUNKS, select="SELECT chunk_id, file_name, n_words FROM chunks"))
def chunk_store(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "chunk-store")
    tables.write_chunks(chunking.chunk_windows(t.corpus()), path)
    return tables.read_chunks(t.spark, path).select("chunk_id", "file_name", "n_words")


SENTENCE_CHUNKS = r"""
WITH RECURSIVE
corpus AS (SELECT doc_id, concat('doc-', doc_id, '.md') AS file_name, text FROM documents),
pieces AS (
  SELECT doc_id, file_name, generate_subscripts(p, 1) AS piece_no, unnest(p) AS piece
  FROM (SELECT doc_id, file_name, string_split(
          regexp_replace(regexp_replace(text, '([.!?]\s+)', '\1' || chr(2), 'g'), '(\n\s*\n)', '\1' || chr(2), 'g'), chr(2)) AS p
        FROM corpus)),
worded AS (SELECT doc_id, file_name, piece_no, regexp_extract_all(piece, '\S+\s*') AS w FROM pieces),
units AS (
  SELECT doc_id, file_name, piece_no, s, array_to_string(w[s + 1 : s + 1024], '') AS unit, len(w[s + 1 : s + 1024]) AS n
  FROM (SELECT *, unnest(range(0, greatest(len(w) - 204, 1), 820)) AS s FROM worded WHERE len(w) > 0)),
docs AS (
  SELECT doc_id, file_name, list(unit ORDER BY piece_no, s) AS units, list(n ORDER BY piece_no, s) AS ns FROM units GROUP BY ALL),
sums AS (
  SELECT doc_id, file_name, units, list_transform(range(0, len(ns) + 1), lambda i: CAST(coalesce(list_sum(ns[1:i]), 0) AS BIGINT)) AS ends, len(ns) AS m FROM docs),
walk AS (
  SELECT doc_id, file_name, units, ends, m, 0::BIGINT AS chunk_no, 0::BIGINT AS start,
         CAST(len(list_filter(ends, lambda e: e <= 1024)) - 1 AS BIGINT) AS stop
  FROM sums
  UNION ALL
  SELECT doc_id, file_name, units, ends, m, chunk_no + 1, next,
         CAST(len(list_filter(ends, lambda e: e <= ends[next + 1] + 1024)) - 1 AS BIGINT)
  FROM (
    SELECT *, greatest(start + 1, CAST(len(list_filter(ends, lambda e: e < greatest(ends[stop + 1] - 204, ends[stop + 2] - 1024))) AS BIGINT)) AS next
    FROM walk WHERE stop < m))
SELECT concat(doc_id, '#', chunk_no) AS chunk_id, doc_id, file_name, chunk_no,
       regexp_replace(array_to_string(units[start + 1 : stop], ''), '\s+$', '') AS text, ends[stop + 1] - ends[start + 1] AS n_words
FROM walk
"""


@query("chunk_sentences", SENTENCE_CHUNKS)
def chunk_sentences(t: Tables) -> DataFrame:
    return chunking.chunk_sentences(t.corpus())


HASH = "sha256(concat_ws(chr(1), file_name, chunk_no, text))"


@query("chunk_hash", v.with_(v.CHUNKS, select=f"SELECT chunk_id, {HASH} AS content_hash FROM chunks"))
def chunk_hash(t: Tables) -> DataFrame:
    return chunking.with_content_hash(chunking.chunk_windows(t.corpus())).select("chunk_id", "content_hash")


@query(
    "ingest_delta",
    v.with_(
        v.CHUNKS,
        f"hashed AS (SELECT chunk_id, doc_id, {HASH} AS content_hash FROM chunks)",
        select="""
        SELECT chunk_id, content_hash FROM hashed
        WHERE content_hash NOT IN (SELECT content_hash FROM hashed WHERE doc_id IN (SELECT doc_id FROM labels))
        """,
    ),
)
def ingest_delta(t: Tables) -> DataFrame:
    chunks = chunking.with_content_hash(chunking.chunk_windows(t.corpus()))
    stored = chunking.with_content_hash(
        chunking.chunk_windows(t.corpus().join(t.read("labels").select("doc_id"), "doc_id", "left_semi"))
    )
    return tables.ingest_delta(chunks, stored).select("chunk_id", "content_hash")


@query(
    "ingest_report",
    v.with_(
        v.CHUNKS,
        select="""
        SELECT 'documents' AS stage, count(*) AS n FROM corpus
        UNION ALL SELECT 'chunks', count(*) FROM chunks
        UNION ALL SELECT 'vectors', count(*) FROM embeddings
        """,
    ),
)
def ingest_report(t: Tables) -> DataFrame:
    return tables.ingest_report(t.corpus(), chunking.chunk_windows(t.corpus()), t.vectors())


@query("token_count", r"SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS BIGINT) AS n_tokens FROM documents")
def token_count(t: Tables) -> DataFrame:
    return t.corpus().select("doc_id", tx.token_count(F.col("text")).alias("n_tokens"))


@query(
    "truncate_long_docs",
    r"""
    SELECT doc_id, CASE WHEN len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) > 1000 THEN substring(text, 1, 1000) ELSE text END AS text
    FROM documents
    """,
)
def truncate_long_docs(t: Tables) -> DataFrame:
    return t.corpus().select("doc_id", tx.truncate_long(F.col("text"), 1000).alias("text"))


TITLES = r"""
lines AS (
  SELECT doc_id, chunk_no, nullif(regexp_extract(text, '(?m)^#{1,6}[ \t]+(\S[^\n]*)', 1), '') AS heading,
         nullif(regexp_extract(text, '(\S[^\n]*)', 1), '') AS line
  FROM chunks WHERE chunk_no < 5),
titles AS (
  SELECT doc_id, coalesce(arg_min(heading, chunk_no) FILTER (WHERE heading IS NOT NULL),
                          arg_min(line, chunk_no) FILTER (WHERE line IS NOT NULL)) AS title
  FROM lines GROUP BY doc_id)"""


@query("extract_title", v.with_(v.CHUNKS, TITLES, select="SELECT doc_id, title FROM titles"))
def extract_title(t: Tables) -> DataFrame:
    return enrich.extract_title(chunking.chunk_windows(t.corpus()))


def chunk_index(t: Tables) -> tuple[DataFrame, keyword_index.KeywordIndex]:
    chunks = chunking.chunk_windows(t.corpus())
    return chunks, keyword_index.build_index(chunks)


@query("bm25_postings", v.with_(v.CHUNK_UNITS, v.INDEX, select="SELECT chunk_id, term, tf, dl FROM postings JOIN stats USING (chunk_id)"))
def bm25_postings(t: Tables) -> DataFrame:
    return chunk_index(t)[1].postings.select("chunk_id", "term", "tf", "dl")


@query("bm25_term_stats", v.with_(v.CHUNK_UNITS, v.INDEX, select="SELECT term, df FROM dfs"))
def bm25_term_stats(t: Tables) -> DataFrame:
    return chunk_index(t)[1].term_stats


@query("top_keywords", v.with_(v.CHUNK_UNITS, v.INDEX, v.KEYWORDS, select="SELECT chunk_id, rank, term, score FROM keywords"))
def top_keywords(t: Tables) -> DataFrame:
    return enrich.top_keywords(keyword_index.staged_index(chunk_index(t)[1])).select("chunk_id", "rank", "term", "score")


CLOZE = rf"""
cloze AS (
  SELECT k.chunk_id, k.rank AS question_no, k.term AS answer,
         list_filter({v.sentences("u.text")}, lambda s: list_contains({v.terms("s")}, k.term))[1] AS sentence
  FROM keywords k JOIN units u USING (chunk_id) WHERE k.rank <= 3),
questions_made AS (
  SELECT chunk_id, question_no, answer,
         array_to_string(list_transform(regexp_extract_all(sentence, '\S+'),
           lambda w: CASE WHEN list_contains({v.terms("w")}, answer) THEN '____' ELSE w END), ' ') AS question
  FROM cloze)"""


@query(
    "chunk_questions",
    v.with_(v.CHUNK_UNITS, v.INDEX, v.KEYWORDS, CLOZE, select="SELECT chunk_id, question_no, question, answer FROM questions_made"),
)
def chunk_questions(t: Tables) -> DataFrame:
    chunks, index = chunk_index(t)
    return enrich.cloze_questions(chunks, enrich.top_keywords(keyword_index.staged_index(index), enrich.QUESTIONS))


SUMMARIES = f"""
listed AS (SELECT chunk_id, doc_id, chunk_no, {v.sentences()} AS ss FROM units),
numbered AS (SELECT chunk_id, doc_id, chunk_no, generate_subscripts(ss, 1) AS no, unnest(ss) AS sentence FROM listed),
spoken AS (SELECT chunk_id, no, unnest({v.terms("sentence")}) AS term FROM numbered),
rarity AS (SELECT chunk_id, no, round(avg(ln((SELECT count(*) FROM stats) / df)), 6) AS r FROM spoken JOIN dfs USING (term) GROUP BY ALL),
best AS {v.top("rarity", "chunk_id", "r DESC, no", 1, "pick")},
summaries AS (SELECT chunk_id, doc_id, chunk_no, sentence AS summary FROM best JOIN numbered USING (chunk_id, no))"""


@query(
    "chunk_summary_prev",
    v.with_(
        v.CHUNK_UNITS, v.INDEX, SUMMARIES,
        select="""
        SELECT s.chunk_id, s.summary, p.summary AS prev_summary
        FROM summaries s LEFT JOIN summaries p ON s.doc_id = p.doc_id AND s.chunk_no = p.chunk_no + 1
        """,
    ),
)
def chunk_summary_prev(t: Tables) -> DataFrame:
    chunks, index = chunk_index(t)
    return enrich.with_previous(enrich.summarize(chunks, keyword_index.staged_index(index)), "summary", "prev_summary").select("chunk_id", "summary", "prev_summary")


ENRICHED = """
enriched AS (
  SELECT u.chunk_id, u.text, title, k.keywords, q.questions, s.summary, p.summary AS prev_summary
  FROM units u LEFT JOIN titles USING (doc_id)
  LEFT JOIN (SELECT chunk_id, string_agg(term, ', ' ORDER BY rank) AS keywords FROM keywords GROUP BY chunk_id) k USING (chunk_id)
  LEFT JOIN (SELECT chunk_id, string_agg(question, chr(10) ORDER BY question_no) AS questions FROM questions_made GROUP BY chunk_id) q USING (chunk_id)
  LEFT JOIN summaries s ON s.chunk_id = u.chunk_id
  LEFT JOIN summaries p ON p.doc_id = u.doc_id AND p.chunk_no = u.chunk_no - 1),
told AS (SELECT chunk_id, concat_ws(chr(10), title, keywords, questions, prev_summary, summary, text) AS text FROM enriched)"""
ENRICHING = (v.CHUNK_UNITS, v.INDEX, v.KEYWORDS, CLOZE, TITLES, SUMMARIES, ENRICHED)


def enriched(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The metadata of the chunks, staged without the texts, and the staged chunks."""
    chunks = stage(chunking.chunk_windows(t.corpus()), "plain-chunks", "zstd")
    index = keyword_index.staged_index(keyword_index.build_index(chunks))
    titles, terms, summaries = enrich.metadata_steps(index, texts=chunks)
    made = enrich.run_transformations(chunks.drop("text"), [titles, terms])
    # each step has staged what it makes of the index
    release(index.lists)
    made = enrich.run_transformations(made, [summaries])
    release(index.chunk_stats, index.term_stats)
    return stage(made, "metadata", "zstd"), chunks


@query("enriched_chunks", v.with_(*ENRICHING, select="SELECT chunk_id, title, keywords, questions, summary, prev_summary FROM enriched"))
def enriched_chunks(t: Tables) -> DataFrame:
    made, chunks = enriched(t)
    release(chunks)
    return made.select("chunk_id", "title", "keywords", "questions", "summary", "prev_summary")


@query("enriched_postings", v.with_(*ENRICHING, f"said AS (SELECT chunk_id, unnest({v.terms('text')}) AS term FROM told)", select="SELECT chunk_id, term, count(*) AS tf FROM said GROUP BY ALL"))
def enriched_postings(t: Tables) -> DataFrame:
    """The keyword index over chunks with their metadata in front."""
    made, chunks = enriched(t)
    # a chunk's metadata is one row, so of texts that share an id one stays
    texts = chunks.select("chunk_id", "text").repartition("chunk_id").groupBy("chunk_id").agg(F.max("text").alias("text"))
    told = stage(enrich.metadata_text(made.join(texts, "chunk_id")).select("chunk_id", "text"), "enriched-chunks", "zstd")
    release(made, chunks)
    return keyword_index.build_index(told).postings.select("chunk_id", "term", "tf")


@query(
    "embed_chunks",
    v.with_(v.CHUNK_UNITS, v.WEIGHTS, v.encoded("vectors", "units", "chunk_id"), select="SELECT chunk_id, CAST(slot AS BIGINT) AS slot, weight FROM vectors"),
)
def embed_chunks(t: Tables) -> DataFrame:
    """Vectors of the chunks, as the entries that are not zero."""
    chunks = chunking.chunk_windows(t.corpus())
    path = scratch_path(t.spark, "chunk-encoder")
    encoder.save_encoder(encoder.fit_table(chunks, v.ENCODER_DIM), path)
    embedded = encoder.encode(chunks.select("chunk_id", "text"), encoder.load_encoder(t.spark, path))
    entries = embedded.select("chunk_id", F.posexplode("embedding").alias("slot", "weight")).filter("weight <> 0")
    return entries.select("chunk_id", F.col("slot").cast("bigint").alias("slot"), F.col("weight").cast("double").alias("weight"))


@query(
    "store_replaced",
    v.with_(
        v.CHUNKS.replace("FROM documents)", """FROM (
          SELECT doc_id, CASE WHEN quality = 0 THEN text || ' Changed.' ELSE text END AS text FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL OR toxic = 0))"""),
        select=f"SELECT chunk_id, file_name, {HASH} AS content_hash FROM chunks",
    ),
)
def store_replaced(t: Tables) -> DataFrame:
    """A store after some documents changed and others were removed."""
    path = scratch_path(t.spark, "replaced-store")
    labels = t.read("labels")
    documents = t.corpus()
    store.ingest_documents(documents, chunking.chunk_windows, path, "first")
    low, toxic = (labels.filter(condition).select("doc_id") for condition in ("quality = 0", "toxic = 1"))
    # all low ones again, in another form, and some that did not change
    again = documents.join(low, "doc_id", "left_semi").withColumn("text", F.concat("text", F.lit(" Changed.")))
    same = documents.join(low, "doc_id", "left_anti").filter("doc_id % 10 = 0")
    store.ingest_documents(again.unionByName(same), chunking.chunk_windows, path, "second")
    store.remove_documents(documents.join(toxic, "doc_id", "left_semi"), path, "third")
    return store.read_store(t.spark, path).select("chunk_id", "file_name", "content_hash")


def longest_word(rows: list[dict]) -> list[str]:
    """Model stand-in that fails on texts of fewer than two words."""
    answers = []
    for row in rows:
        found = row["text"].split()
        if len(found) < 2:
            raise ValueError("text is too short")
        answers.append(max(found, key=len))
    return answers


@query(
    "map_model",
    r"""
    WITH found AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS w FROM documents),
    sized AS (SELECT doc_id, w, list_transform(w, lambda x: length(x)) AS n FROM found)
    SELECT doc_id, CASE WHEN len(w) >= 2 THEN w[list_position(n, list_max(n))] END AS answer,
           CASE WHEN len(w) < 2 THEN 'ValueError: text is too short' END AS error
    FROM sized
    """,
)
def map_model(t: Tables) -> DataFrame:
    return models.map_model(t.corpus(), longest_word, ["text"], "answer", T.StringType(), attempts=1, workers=None).select("doc_id", "answer", "error")

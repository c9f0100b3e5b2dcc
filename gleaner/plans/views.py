"""SQL fragments for the inputs that several counterparts share."""

from __future__ import annotations

TERMS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"

CORPUS = "corpus AS (SELECT doc_id, concat('doc-', doc_id, '.md') AS file_name, text FROM documents)"
QUESTIONS = "questions AS (SELECT item_id AS query_id, text FROM benchmark)"


def terms(text: str = "text") -> str:
    return TERMS.format(text)


def sentences(text: str = "text") -> str:
    """Non-blank sentences as a list: break marks are put in, then split on."""
    marked = rf"regexp_replace(regexp_replace({text}, '([.!?])\s+', '\1' || chr(2), 'g'), '\n\s*\n', chr(2), 'g')"
    return rf"list_filter(string_split({marked}, chr(2)), lambda s: regexp_matches(s, '\S'))"


CHUNKS = CORPUS + r""",
spaced AS (SELECT doc_id, file_name, regexp_extract_all(text, '\S+\s*') AS w FROM corpus),
starts AS (SELECT doc_id, file_name, w, unnest(range(0, greatest(len(w) - 204, 1), 820)) AS s FROM spaced WHERE len(w) > 0),
chunks AS (
  SELECT concat(doc_id, '#', s // 820) AS chunk_id, doc_id, file_name, CAST(s // 820 AS BIGINT) AS chunk_no,
         regexp_replace(array_to_string(w[s + 1 : s + 1024], ''), '\s+$', '') AS text,
         CAST(len(w[s + 1 : s + 1024]) AS BIGINT) AS n_words
  FROM starts)"""

DOC_UNITS = CORPUS + ", units AS (SELECT doc_id AS chunk_id, doc_id, file_name, text FROM corpus)"
CHUNK_UNITS = CHUNKS + ", units AS (SELECT chunk_id, doc_id, file_name, chunk_no, text FROM chunks)"

INDEX = f"""
tokens AS (SELECT chunk_id, unnest({terms()}) AS term FROM units),
stats AS (SELECT chunk_id, CAST(len({terms()}) AS BIGINT) AS dl FROM units),
postings AS (SELECT chunk_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM postings GROUP BY term)"""


def top(source: str, by: str, order: str, k: int, rank: str = "rank") -> str:
    return (
        f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS {rank} FROM {source}) WHERE {rank} <= {k})"
    )


def bm25(hits: str = "hits", k: int = 5, asked: str = "questions") -> str:
    """CTEs from ``units``, ``INDEX`` and a question view to a hit view."""
    return f"""
{hits}_terms AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({terms()}) AS term FROM {asked}) GROUP BY ALL),
{hits}_scored AS (
  SELECT query_id, chunk_id,
         round(sum(qtf * ln(1 + ((SELECT count(*) FROM stats) - df + 0.5) / (df + 0.5))
             * tf / (tf + 1.5 * (0.25 + 0.75 * dl / (SELECT avg(dl) FROM stats)))), 6) AS score
  FROM {hits}_terms JOIN postings USING (term) JOIN dfs USING (term) JOIN stats USING (chunk_id)
  GROUP BY ALL),
{hits} AS {top(hits + "_scored", "query_id", "score DESC, chunk_id", k)}"""


KEYWORDS = f"""
weighted AS (
  SELECT chunk_id, term, round(tf * ln((SELECT count(*) FROM stats) / df), 6) AS score FROM postings JOIN dfs USING (term)),
keywords AS {top("weighted", "chunk_id", "score DESC, term", 10)}"""

DENSE = f"""
asked AS (SELECT e.vec_id AS query_id, e.embedding AS q FROM embeddings e JOIN benchmark b ON e.vec_id = b.item_id),
dense_scored AS (
  SELECT query_id, vec_id AS chunk_id, round(list_sum(list_transform(list_zip(q::DOUBLE[], embedding::DOUBLE[]), lambda p: p[1] * p[2])), 6) AS score
  FROM asked, embeddings),
dense AS {top("dense_scored", "query_id", "score DESC, chunk_id", 5)}"""

RESULTS = r"""
results AS (
  SELECT provider_id,
         CASE WHEN contains(provider_id, 'naive') THEN 'Naive' WHEN contains(provider_id, 'bm25') THEN 'BM25' ELSE provider_id END AS provider,
         round(value * 20, 6) AS latency_ms, pass, CASE WHEN pass THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score,
         raw_query, concat(substring(raw_query, 1, 60), '...') AS query, event_id AS test_idx, ts, user_id, round(k * 0.0001::DOUBLE, 6) AS cost
  FROM (SELECT *, k % 10 <> 0 AS pass,
               CASE WHEN event_type IN ('click', 'view') THEN 'rag/naive' WHEN event_type IN ('purchase', 'signup') THEN 'rag/bm25' ELSE 'other' END AS provider_id,
               concat('event ', event_id, ' by user ', user_id, ' of kind ', event_type, ' with properties ', props) AS raw_query
        FROM (SELECT *, CAST(regexp_extract(props, '\d+') AS INTEGER) AS k FROM events)))"""

COUNTERS = RESULTS + """,
counters AS (
  SELECT provider, count(*) FILTER (WHERE pass) AS test_pass_count, count(*) FILTER (WHERE NOT pass) AS test_fail_count,
         sum(latency_ms) AS total_latency_ms, count(*) AS num_requests
  FROM results GROUP BY provider)"""

GOLDEN = """
golden AS (
  SELECT b.item_id AS query_id, d.doc_id, concat('doc-', d.doc_id, '.md') AS file_name
  FROM benchmark b JOIN documents d ON contains(d.text, b.text))"""

MESSAGES = "messages AS (SELECT conv_id AS session_id, turn, role, text FROM conversations)"
USAGE = MESSAGES + r""",
counted AS (SELECT *, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS words FROM messages),
turns AS (
  SELECT session_id, turn, role, words,
         CAST(coalesce(sum(words) OVER (PARTITION BY session_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prompt,
         coalesce(lag(words) OVER (PARTITION BY session_id ORDER BY turn), 0) AS previous
  FROM counted),
usage AS (
  SELECT session_id, turn, prompt, prompt - previous AS cached, words AS completion,
         round(((prompt - (prompt - previous)) * 2.50::DOUBLE + (prompt - previous) * 1.25::DOUBLE + words * 10.00::DOUBLE) / 1e6, 12) AS cost
  FROM turns WHERE role = 'assistant')"""

STEPS = MESSAGES + r""",
steps AS (
  SELECT session_id, turn AS step_no, role, text AS observations,
         CASE WHEN role <> 'system' THEN CASE WHEN session_id % 3 = 0 AND turn % 2 = 1 THEN text || chr(10) || 'RESULT: success' || chr(10) ELSE text END END AS output,
         (session_id + turn) % 2 AS exit_code
  FROM messages),
last_outputs AS (SELECT session_id, arg_max(output, step_no) FILTER (WHERE output IS NOT NULL) AS output FROM steps GROUP BY session_id),
outcomes AS (
  SELECT session_id, coalesce(contains(string_split(regexp_replace(output, '[\r\n]+$', ''), chr(10))[-1], 'RESULT: success'), false) AS success
  FROM last_outputs)"""

EVENTS = """
evs AS (SELECT o_orderkey AS event_id, o_orderpriority AS location, o_totalprice AS popularity, o_orderdate AS day FROM orders),
sess AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS session_id, l_orderkey AS event_id, l_shipdate AS starts,
         l_shipdate + to_days(l_linenumber) AS ends
  FROM lineitem)"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n" + select.strip()


ENCODER_DIM = 512


def encoded(name: str, source: str, key: str, text: str = "text") -> str:
    """CTE ``name(key, slot, weight)``: the non-zero entries of the encoded texts of ``source``; ``weights`` must be there."""
    return f"""
{name}_slots AS (
  SELECT {key}, CAST('0x' || substr(md5(term), 1, 6) AS INTEGER) % {ENCODER_DIM} AS slot, 1 - 2 * (CAST('0x' || substr(md5(term), 7, 1) AS INTEGER) % 2) AS sign
  FROM (SELECT {key}, unnest({terms(text)}) AS term FROM {source})),
{name}_values AS (SELECT {key}, slot, sum(sign) * any_value(idf) AS v FROM {name}_slots JOIN weights USING (slot) GROUP BY {key}, slot),
{name} AS (
  SELECT {key}, slot, CAST(CAST(round(v / sqrt(n), 6) AS FLOAT) AS DOUBLE) AS weight
  FROM {name}_values JOIN (SELECT {key}, sum(v * v) AS n FROM {name}_values GROUP BY {key} HAVING sum(v * v) > 0) USING ({key})
  WHERE round(v / sqrt(n), 6) <> 0)"""


# the encoder's table, fitted on ``units``
WEIGHTS = f"""
weights AS (
  SELECT CAST(slot AS INTEGER) AS slot, coalesce(df, 0) AS df, ln(((SELECT count(*) FROM units) + 1) / (coalesce(df, 0) + 1)) AS idf
  FROM range({ENCODER_DIM}) r(slot) LEFT JOIN (
    SELECT CAST('0x' || substr(md5(term), 1, 6) AS INTEGER) % {ENCODER_DIM} AS slot, count(DISTINCT chunk_id) AS df
    FROM (SELECT chunk_id, unnest({terms()}) AS term FROM units) GROUP BY ALL) USING (slot))"""


def text_dense(hits: str = "dense", asked: str = "questions", text: str = "text") -> str:
    """CTEs from ``units``, ``weights`` and a question view to the dense hits of encoded texts."""
    return f"""{encoded("encoded_units", "units", "chunk_id").strip()},{encoded("encoded_questions", asked, "query_id", text)},
{hits}_scored AS (
  SELECT query_id, chunk_id, round(sum(q.weight * u.weight), 6) AS score
  FROM encoded_questions q JOIN encoded_units u USING (slot) GROUP BY ALL),
{hits} AS {top(hits + "_scored", "query_id", "score DESC, chunk_id", 5)}"""

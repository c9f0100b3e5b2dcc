"""Registered queries of the operators over ``documents``, with SQL counterparts where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import (
    conversations, decontamination, divergence, exact_dedup, jaccard_join, language_id, lm_scoring, mixing, page_text, pii, quality, token_counts, token_shards,
)
from gleaner.sources.scratch import scratch_path, stage

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under ``name``."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def tokenizer(name: str = TOKENIZER) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


OP1 = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, CASE place % 3 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 3.0::DOUBLE END AS w FROM sources),
levels AS (
  SELECT a.source, a.source_size, a.w, a.place,
         ((SELECT sum(source_size) FROM weighed)::DOUBLE - 3.0::DOUBLE * coalesce(sum(b.source_size) FILTER (WHERE b.r < a.r OR (b.r = a.r AND b.place < a.place)), 0)::DOUBLE)
         / sum(b.w) FILTER (WHERE b.r > a.r OR (b.r = a.r AND b.place >= a.place)) AS level, a.r
  FROM (SELECT *, source_size / w AS r FROM weighed) a, (SELECT *, source_size / w AS r FROM weighed) b
  GROUP BY a.source, a.source_size, a.w, a.place, a.r),
final AS (SELECT level AS top FROM levels WHERE level * w <= 3.0 * source_size ORDER BY r, place LIMIT 1),
targets AS (
  SELECT source, source_size, least(3.0 * source_size, (SELECT top FROM final) * w) AS target,
         CAST(('0x' || substr(md5(concat('mix|', coalesce(source, ''))), 1, 12)) AS BIGINT)::DOUBLE / 281474976710656.0::DOUBLE AS draw
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target, draw, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY size, md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS LAST)::DOUBLE AS p
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST((floor(p * rate + draw) - floor((p - 1) * rate + draw)) * size AS BIGINT) AS taken
FROM placed"""


@query("op1_mix_sources", OP1)
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    sizes = stage(documents(spark, folder).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "sizes")
    mixed = mixing.expected_copies(sizes, F.col("size"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.count_tokens(documents(spark, folder), tokenizer())


@query("op3_pii")
def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    docs = documents(spark, folder)
    return pii.find_pii(docs, pii.train_tagger(docs))


def remainder(divisor: int):
    """Fold of a row: crc32 of the id as text; a null id has that of an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(divisor))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document, learned from three of four folds."""
    docs = documents(spark, folder).withColumn("held_out", remainder(4) == 2)
    profiles = language_id.learn_profiles(docs.filter(~F.col("held_out")))
    return language_id.identify(docs.select("doc_id", "held_out", "text"), profiles).select("doc_id", "held_out", "lang_pred", "score")


@query("op5_quality")
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from three of four folds of the labels."""
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(remainder(4) != 2)
    machine = quality.learn_quality(docs, labels)
    scored = quality.score_quality(docs.select("doc_id", "text", "n_chars"), machine)
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", "predicted")


@query("op6_token_shards")
def op6_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as found in the written files, each key looked up through the index."""
    path = scratch_path(spark, "token-shards")
    docs = documents(spark, folder)
    token_shards.write_shards(docs, path, tokenizer(), END_ID)
    return token_shards.digests(docs, path)


OP7 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 3, 1))) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) LEFT JOIN sizes USING (doc_id)"""


@query("op7_jaccard_join", OP7)
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document under the similarity join on shingles."""
    return jaccard_join.shingle_groups(documents(spark, folder))


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in documents, exact or edited: doc_id, item_id, distance, item_chars."""
    return decontamination.find_items(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


OP9 = r"""
WITH normalised AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER best = 1 AS kept,
       sha256(norm) AS text_sha256
FROM normalised
WINDOW best AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)"""


@query("op9_exact_dedup", OP9)
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which row of every group of equal texts stays."""
    return exact_dedup.exact_dedup(documents(spark, folder))


@query("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and mixing-model log probabilities of every document, learned from four of five folds."""
    scored = lm_scoring.score_texts(documents(spark, folder), remainder(5) != 1)
    return scored.select("doc_id", (~F.col("is_training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


OP11 = r"""
WITH given AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM given),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
uses AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
vocabulary AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(sum(u.n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM given) g LEFT JOIN vocabulary USING (lang) LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source
  GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(u.n, 0) + 2)) // (g.total + 2 * g.v) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
usual AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS q FROM kept JOIN vocabulary USING (lang)),
near AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN near n ON n.lang = a.lang AND n.source = a.source AND n.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares JOIN usual USING (lang, term) WHERE n > 0 AND p > q),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM placed WHERE part = 'pair' OR rank <= 10"""


@query("op11_source_divergence", OP11)
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that set a source apart."""
    return divergence.audit_sources(documents(spark, folder))


@query("op12_page_text")
def op12_page_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return page_text.extract(spark.read.parquet(f"{folder}/pages.parquet"))


def _step(value: str, cost: str, letter: str, line: str | None = None) -> str:
    """One edit put before the repair ``value``."""
    text = f"{value}.t" if line is None else f"chr(10) || {line} || {value}.t"
    return f"{{'c': {value}.c + {cost}, 'a': '{letter}' || {value}.a, 't': {text}}}"


def _least(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))[1]"


def _row_edits(last: str) -> str:
    """Cheapest repair from row ``r`` on, where ``last`` came last, before inserts; w0, ws, wu, wa hold those from the next row on."""
    own, turn = "r.role || ':' || r.text", ("wa", "assistant") if last == "u" else ("wu", "user")
    to = {"0": {"s": "ws", "u": "wu"}, "s": {"u": "wu"}, "u": {"a": "wa"}, "a": {"u": "wu"}}[last]
    kept = [f"CASE WHEN NOT r.must AND r.role[1] = '{first}' THEN {_step(w, 'r.more', 'K', own)} END" for first, w in to.items()]
    rerole = f"CASE WHEN NOT r.must THEN {_step(turn[0], '2 + r.more', 'R', chr(39) + turn[1] + ':' + chr(39) + ' || r.text')} END"
    return _least(_step("w" + last, "3", "D"), *kept, rerole)


OP13 = rf"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''),
             lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged),
judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
         coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY i)[1] || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM ordered),
conv AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE NOT blank AND again) AS duplicate, count(*) FILTER (WHERE NOT blank AND NOT again AND cut) AS truncated,
         count(*) FILTER (WHERE illegal) AS illegal,
         list({{'role': role, 'text': text, 'must': blank OR again, 'more': CASE WHEN cut THEN 1 ELSE 0 END}} ORDER BY i) AS rs
  FROM judged GROUP BY conv_id),
steps AS (
  SELECT conv_id, len(rs) AS i, rs, {{'c': 0, 'a': '', 't': ''}} AS w0, {{'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS ws,
         {{'c': 2, 'a': 'I', 't': chr(10) || 'assistant:'}} AS wu, {{'c': 0, 'a': '', 't': ''}} AS wa
  FROM conv
  UNION ALL
  SELECT conv_id, i, rs, {_least('b0', _step('iu', '2', 'I', "'user:'"))}, {_least('bs', _step('iu', '2', 'I', "'user:'"))}, iu,
         {_least('ba', _step('bu', '2', 'I', "'user:'"))}
  FROM (SELECT *, {_least('bu', _step('ba', '2', 'I', "'assistant:'"))} AS iu
        FROM (SELECT conv_id, i - 1 AS i, rs, {', '.join(f'{_row_edits(q)} AS b{q}' for q in '0sua')} FROM (SELECT *, rs[i] AS r FROM steps WHERE i > 0))))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(CAST(w0.c AS BIGINT), 0) AS cost, coalesce(w0.a, '') AS audit, sha256(substr(coalesce(w0.t, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN conv ON conv.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN (SELECT * FROM steps WHERE i = 0) s ON s.conv_id IS NOT DISTINCT FROM o.conv_id"""


@query("op13_conversation_repair", OP13)
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of every conversation."""
    return conversations.repair(spark.read.parquet(f"{folder}/conversations.parquet"))

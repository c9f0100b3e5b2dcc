"""Streams over the test tables, replayed as files, run to the end, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators import chunking
from gleaner.plans import views as v
from gleaner.plans.ingest import HASH
from gleaner.plans.registry import ORACLES, query
from gleaner.plans.standins import Tables
from gleaner.plans.usage import last_sql
from gleaner.sources import store
from gleaner.sources.scratch import scratch_path
from gleaner.streaming import jobs

assert ORACLES  # the counterparts of the batch forms must be registered first


def _sibling(t: Tables) -> Tables:
    return Tables(jobs.streaming_session(t.spark), t.folder)


def _finished(t: Tables, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(t.spark, label)
    jobs.run_available(stream, path, scratch_path(t.spark, f"{label}-checkpoint"))
    return t.spark.read.schema(stream.schema).parquet(path)


@query(
    "stream_metrics",
    v.with_(
        v.RESULTS,
        select="""
        SELECT strftime(ts, '%Y-%m-%d') AS day, provider, count(*) AS requests, round(avg(latency_ms), 6) AS avg_latency,
               round(count(*) FILTER (WHERE pass) / count(*) * 100, 6) AS accuracy
        FROM results
        WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
        GROUP BY ALL
        """,
    ),
)
def stream_metrics(t: Tables) -> DataFrame:
    """Days that the watermark has closed; all files arrive together, so that no row is late."""
    s = _sibling(t)
    rows = s.results().select("ts", "provider", "latency_ms", "pass").repartition(8)
    metrics = jobs.windowed_metrics(jobs.replay(s.spark, rows, "result-files", files_per_trigger=1000))
    days = metrics.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), *metrics.columns[1:])
    return _finished(t, days, "stream-metrics")


@query("stream_answers", ORACLES["assemble_answers"])
def stream_answers(t: Tables) -> DataFrame:
    s = _sibling(t)
    chunks = s.stream_chunks().repartition(8, "seq")
    return _finished(t, jobs.assemble_stream(jobs.replay(s.spark, chunks, "chunk-files")), "stream-answers")


@query(
    "stream_expired_answers",
    v.with_(
        v.MESSAGES,
        r"""
spoken AS (
  SELECT session_id, turn, session_id % 3 <> 0 AS whole, w[1 : len(w) - CASE WHEN session_id % 3 = 0 THEN 1 ELSE 0 END] AS w
  FROM (SELECT session_id, turn, regexp_extract_all(text, '\S+\s*') AS w FROM messages WHERE role = 'assistant')),
timed AS (SELECT *, session_id * 60 + CASE WHEN whole THEN 0 ELSE 20 END AS sec FROM spoken WHERE len(w) > 0)""",
        select="""
        SELECT session_id, turn, array_to_string(w, '') AS answer, whole AS complete,
               CASE WHEN whole THEN CAST(len(w) * 10 AS BIGINT) END AS prompt, CASE WHEN whole THEN CAST(len(w) * 5 AS BIGINT) END AS cached,
               CASE WHEN whole THEN CAST(len(w) AS BIGINT) END AS completion
        FROM timed WHERE whole OR sec + 3600 <= (SELECT max(sec) FROM timed) - 610
        """,
    ),
)
def stream_expired_answers(t: Tables) -> DataFrame:
    """Each session a minute later; every third breaks off before its usage, and is given up an hour of event time later."""
    s = _sibling(t)
    broken = F.col("session_id") % 3 == 0
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("session_id") * 60 + F.when(broken, 20).otherwise(0))
    chunks = s.stream_chunks().filter(~broken | F.col("completion").isNull()).withColumn("ts", at).repartition(8, "seq")
    stream = jobs.assemble_expiring(jobs.replay(s.spark, chunks, "timed-chunk-files", files_per_trigger=1000), "610 seconds", 3_600_000)
    return _finished(t, stream, "stream-expired-answers")


@query("stream_memory", last_sql(3))
def stream_memory(t: Tables) -> DataFrame:
    s = _sibling(t)
    messages = s.messages().repartition(8, "turn")
    versions = _finished(t, jobs.memory_stream(jobs.replay(s.spark, messages, "message-files"), 3), "stream-memory")
    return jobs.latest_memory(versions)


@query("stream_ingest", v.with_(v.CHUNKS, select=f"SELECT chunk_id, doc_id, n_words, {HASH} AS content_hash FROM chunks"))
def stream_ingest(t: Tables) -> DataFrame:
    s = _sibling(t)
    documents = jobs.replay(s.spark, s.corpus().repartition(8, "doc_id"), "document-files")
    path = scratch_path(t.spark, "stream-ingest")
    jobs.ingest_stream(documents, chunking.chunk_windows, path, scratch_path(t.spark, "stream-ingest-checkpoint"))
    return store.read_store(t.spark, path).select("chunk_id", "doc_id", "n_words", "content_hash")

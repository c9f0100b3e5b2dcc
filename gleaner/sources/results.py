"""Evaluation cases and result files, request logs, itineraries and event payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.functions import results as rs
from gleaner.functions import text as tx
from gleaner.operators.common import require_rows

CASE_SCHEMA = "input string, __expected string"
GENERATED_CASE_SCHEMA = "input string, __expected1 string, __expected2 string"
EVAL_SCHEMA = """
    results struct<
      prompts: array<struct<provider: string, metrics: struct<
        testPassCount: bigint, testFailCount: bigint, totalLatencyMs: double, tokenUsage: struct<numRequests: bigint>>>>,
      results: array<struct<provider: struct<id: string>, latencyMs: double, gradingResult: struct<pass: boolean>,
        score: double, prompt: struct<raw: string>, testIdx: bigint>>>
"""
EVENT_SCHEMA = """
    url string, name string, description string, is_sold_out boolean, location struct<url: string, name: string>,
    sessions struct<sessions: array<struct<datetime_start: string, datetime_end: string, session_tickets: string>>>
"""


def read_cases(spark: SparkSession, path: str, schema: str = CASE_SCHEMA) -> DataFrame:
    """Golden cases from CSV with a header and quoted commas, quotes and line ends."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"')


def write_cases(cases: DataFrame, path: str) -> None:
    cases.write.csv(path, header=True, quote='"', escape='"', quoteAll=True)


def read_eval(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Result files with an explicit schema, one JSON object per file or per line.

    A missing or empty folder is an error, and so is a file that does not parse.
    """
    return require_rows(spark.read.json(path, schema=EVAL_SCHEMA, multiLine=not one_per_line, mode="FAILFAST"), f"evaluation results {path}")


def flat_results(evaluation: DataFrame) -> DataFrame:
    """One row per test and provider."""
    return evaluation.select(F.explode("results.results").alias("r")).select(
        rs.provider_name(F.col("r.provider.id")).alias("provider"),
        F.col("r.latencyMs").alias("latency_ms"),
        F.col("r.gradingResult.pass").alias("pass"),
        F.col("r.score").alias("score"),
        tx.preview(F.col("r.prompt.raw")).alias("query"),
        F.col("r.testIdx").alias("test_idx"),
    )


def provider_counters(evaluation: DataFrame) -> DataFrame:
    """One row per provider and file with the counters of its metrics struct."""
    return evaluation.select(F.explode("results.prompts").alias("p")).select(
        rs.provider_name(F.col("p.provider")).alias("provider"),
        F.col("p.metrics.testPassCount").alias("test_pass_count"),
        F.col("p.metrics.testFailCount").alias("test_fail_count"),
        F.col("p.metrics.totalLatencyMs").alias("total_latency_ms"),
        F.col("p.metrics.tokenUsage.numRequests").alias("num_requests"),
    )


def append_request_log(requests: DataFrame, path: str) -> None:
    """Append requests as JSON lines."""
    requests.write.mode("append").json(path)


def union_cases(first: DataFrame, second: DataFrame) -> DataFrame:
    """Append two case tables whose columns differ; missing ones become null."""
    return first.unionByName(second, allowMissingColumns=True)


def itinerary(flights: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """``(key, itinerary)``: the flight and event result of a trip as one JSON object.

    ``flight_booking_data`` and ``event_booking_data`` are texts, as bookings return them.
    """
    both = F.struct("flight_booking_data", "event_booking_data")
    return flights.join(events, key).select(key, F.to_json(both, {"ignoreNullFields": "false"}).alias("itinerary"))


def write_itineraries(itineraries: DataFrame, path: str) -> None:
    itineraries.select(F.col("itinerary").alias("value")).write.text(path)


def _events(column: str) -> Column:
    return F.from_json(column, f"struct<events: array<struct<{_as_fields(EVENT_SCHEMA)}>>>")


def rejected_payloads(payloads: DataFrame, column: str = "value") -> DataFrame:
    """Rows of ``payloads`` that :func:`parse_events` cannot read: no object with a list of events."""
    return payloads.filter(_events(column)["events"].isNull())


def parse_events(payloads: DataFrame, column: str = "value") -> DataFrame:
    """Events from payload texts ``{"events": [...]}``; an event without sessions gets an empty array.

    Broken payloads give no event; :func:`rejected_payloads` lists them.
    """
    event = _events(column)
    sessions = F.col("event.sessions.sessions")
    empty = F.array().cast("array<struct<datetime_start: string, datetime_end: string, session_tickets: string>>")
    return (
        payloads.select(F.explode(event["events"]).alias("event"))
        .select("event.url", "event.name", "event.description", "event.is_sold_out", "event.location", F.coalesce(sessions, empty).alias("sessions"))
    )


def _as_fields(ddl: str) -> str:
    """Field list of a flat DDL text in the form used inside a struct type."""
    return StructType.fromDDL(ddl).simpleString()[len("struct<") : -1]

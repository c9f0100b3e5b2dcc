"""Expressions over evaluation results and usage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket edges (right-closed) and their labels.
LATENCY_EDGES = [0, 100, 500, 1000, 2000, 5000]
LATENCY_LABELS = ["<100ms", "100-500ms", "500ms-1s", "1-2s", ">2s"]

# Price in dollars per million tokens.
PROMPT_PRICE = 2.50
CACHED_PRICE = 1.25
COMPLETION_PRICE = 10.00


def provider_name(provider_id: Column) -> Column:
    """Display name of a provider id; case-sensitive, ``naive`` wins over ``bm25``."""
    return (
        F.when(provider_id.contains("naive"), F.lit("Naive"))
        .when(provider_id.contains("bm25"), F.lit("BM25"))
        .otherwise(provider_id)
    )


def status(passed: Column) -> Column:
    """``Pass`` or ``Fail``; null stays null."""
    return F.when(passed, F.lit("Pass")).when(~passed, F.lit("Fail"))


def latency_bucket_no(latency_ms: Column) -> Column:
    """1-based bucket, null at or below the first edge and above the last."""
    chain = F.when(latency_ms <= LATENCY_EDGES[0], F.lit(None).cast("int"))
    for number, edge in enumerate(LATENCY_EDGES[1:], start=1):
        chain = chain.when(latency_ms <= edge, F.lit(number))
    return chain


def pass_rate(passed: Column) -> Column:
    """Share of passes in percent, null over no rows."""
    return F.avg(F.when(passed, F.lit(100.0)).otherwise(F.lit(0.0)))


def cost_usd(prompt: Column, cached: Column, completion: Column) -> Column:
    """Price of one answer; cached prompt tokens are billed at their own rate."""
    return (
        (prompt - cached) * F.lit(PROMPT_PRICE)
        + cached * F.lit(CACHED_PRICE)
        + completion * F.lit(COMPLETION_PRICE)
    ) / F.lit(1e6)


def stats_line(prompt: Column, cached: Column, completion: Column, cost: Column, latency_ms: Column) -> Column:
    """One-line summary of an answer."""
    return F.format_string(
        "[stats] prompt=%d cached=%d completion=%d cost=$%.12f latency=%.2fms",
        prompt, cached, completion, cost, latency_ms,
    )

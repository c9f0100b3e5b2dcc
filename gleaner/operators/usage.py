"""Chat telemetry and agent logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import results as rs
from gleaner.functions import text as tx
from gleaner.operators.common import top_k

MEMORY = 10
OBSERVATION_WIDTH = 800
MAX_ATTEMPTS = 3
SUCCESS_MARK = "RESULT: success"
PIECES = 4096


def assemble_answers(chunks: DataFrame, pieces: int = PIECES) -> DataFrame:
    """``(session_id, turn, answer, usage)`` from ``chunks(session_id, turn, seq, delta, usage)``.

    Deltas are joined in ``seq`` order, null ones skipped; the last usage that
    is not null wins. Runs of ``pieces`` positions are joined first, so that a
    very long answer is put together by several tasks.
    """
    def joined(value: str, order: str) -> Column:
        pairs = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(order, value))))
        return F.array_join(F.transform(pairs, lambda p: p[value]), "")

    last = F.max_by(F.col("usage"), F.when(F.col("usage").isNotNull(), F.col("seq")))
    blocks = chunks.groupBy("session_id", "turn", F.floor(F.col("seq") / pieces).alias("block")).agg(
        joined("delta", "seq").alias("part"), last.alias("usage"),
    )
    return blocks.groupBy("session_id", "turn").agg(
        joined("part", "block").alias("answer"),
        F.max_by(F.col("usage"), F.when(F.col("usage").isNotNull(), F.col("block"))).alias("usage"),
    )


def last_messages(messages: DataFrame, n: int = MEMORY) -> DataFrame:
    """The last ``n`` messages of each session, ``position`` 1 being the newest."""
    return top_k(messages, ["session_id"], [F.desc("turn")], n, rank="position")


def chat_cost(usage: DataFrame) -> DataFrame:
    """Adds ``cost`` in dollars to rows with ``prompt, cached, completion``."""
    return usage.withColumn("cost", F.round(rs.cost_usd(F.col("prompt"), F.col("cached"), F.col("completion")), 12))


def latency_ms(start: Column, end: Column) -> Column:
    """Milliseconds between two timestamps, with fractions."""
    return F.timestamp_diff("MICROSECOND", start, end) / 1000.0


def session_usage(turns: DataFrame) -> DataFrame:
    """Totals per session of ``turns(session_id, prompt, cached, completion, cost, latency_ms)``."""
    return turns.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("answers"),
        F.sum("prompt").alias("prompt_tokens"),
        F.sum("cached").alias("cached_tokens"),
        F.sum("completion").alias("completion_tokens"),
        F.round(F.sum("cost"), 9).alias("cost"),
        F.round(F.avg("latency_ms"), 6).alias("avg_latency"),
    )


def reports_success(output: Column) -> Column:
    """Whether the last line carries the success mark; no output is a failure."""
    return F.coalesce(tx.last_line(output).contains(SUCCESS_MARK), F.lit(False))


def last_output(steps: DataFrame) -> DataFrame:
    """``(session_id, output)``: the last output of each session that is not null."""
    return steps.groupBy("session_id").agg(
        F.max_by("output", F.when(F.col("output").isNotNull(), F.col("step_no"))).alias("output")
    )


def agent_result(steps: DataFrame) -> DataFrame:
    """``(session_id, success)`` by the last output."""
    return last_output(steps).select("session_id", reports_success(F.col("output")).alias("success"))


def agent_steps(steps: DataFrame, width: int = OBSERVATION_WIDTH) -> DataFrame:
    """Step log for display, observations cut to ``width`` characters."""
    return steps.select("session_id", "step_no", "tool_calls", F.substring("observations", 1, width).alias("observations"))


def attempt_outcome(runs: DataFrame, limit: int = MAX_ATTEMPTS) -> DataFrame:
    """Per session: success iff the last of the first ``limit`` runs exits with 0.

    ``runs(session_id, attempt, exit_code)``; sessions that ran more often are flagged.
    """
    counted = runs.groupBy("session_id").agg(F.count(F.lit(1)).alias("attempts"))
    allowed = top_k(runs, ["session_id"], [F.asc("attempt")], limit)
    last = allowed.groupBy("session_id").agg(F.max_by("exit_code", "attempt").alias("exit_code"))
    return counted.join(last, "session_id").select(
        "session_id", "attempts",
        F.coalesce(F.col("exit_code") == 0, F.lit(False)).alias("success"),
        (F.col("attempts") > limit).alias("over_limit"),
    )


def agent_outcomes(results: DataFrame) -> DataFrame:
    """Runs, successes and success rate per ``agent``."""
    return results.groupBy("agent").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count(F.when(F.col("success"), F.lit(1))).alias("successes"),
        F.round(F.avg(F.col("success").cast("int")), 6).alias("success_rate"),
    )

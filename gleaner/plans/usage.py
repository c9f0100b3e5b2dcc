"""Chat telemetry and agent logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import results as rf
from gleaner.functions import text as tx
from gleaner.operators import usage
from gleaner.plans import views as v
from gleaner.plans.registry import query
from gleaner.plans.standins import Tables


@query(
    "assemble_answers",
    v.with_(
        v.MESSAGES,
        r"spoken AS (SELECT session_id, turn, regexp_extract_all(text, '\S+\s*') AS w FROM messages WHERE role = 'assistant')",
        select="""
        SELECT session_id, turn, array_to_string(w, '') AS answer, CAST(len(w) * 10 AS BIGINT) AS prompt, CAST(len(w) * 5 AS BIGINT) AS cached,
               CAST(len(w) AS BIGINT) AS completion
        FROM spoken WHERE len(w) > 0
        """,
    ),
)
def assemble_answers(t: Tables) -> DataFrame:
    whole = F.when(F.col("prompt").isNotNull(), F.struct("prompt", "cached", "completion"))
    chunks = t.stream_chunks().withColumn("usage", whole)
    return usage.assemble_answers(chunks).select("session_id", "turn", "answer", "usage.*")


def last_sql(n: int) -> str:
    return v.with_(v.MESSAGES, select="SELECT session_id, position, turn, role, text FROM " + v.top("messages", "session_id", "turn DESC", n, "position"))


@query("last_messages", last_sql(10))
def last_messages(t: Tables) -> DataFrame:
    return usage.last_messages(t.messages()).select("session_id", "position", "turn", "role", "text")


@query("last_three_messages", last_sql(3))
def last_three_messages(t: Tables) -> DataFrame:
    return usage.last_messages(t.messages(), 3).select("session_id", "position", "turn", "role", "text")


@query("chat_cost", v.with_(v.USAGE, select="SELECT session_id, turn, prompt, cached, completion, cost FROM usage"))
def chat_cost(t: Tables) -> DataFrame:
    return usage.chat_cost(t.usage())


@query(
    "stats_lines",
    v.with_(
        v.USAGE,
        select="""
        SELECT session_id, turn, concat('[stats] prompt=', prompt, ' cached=', cached, ' completion=', completion, ' cost=$',
               printf('%.12f', cost), ' latency=', printf('%.2f', completion::DOUBLE), 'ms') AS line
        FROM usage
        """,
    ),
)
def stats_lines(t: Tables) -> DataFrame:
    line = rf.stats_line(*[F.col(c) for c in ("prompt", "cached", "completion", "cost")], F.col("completion").cast("double"))
    return usage.chat_cost(t.usage()).select("session_id", "turn", line.alias("line"))


@query(
    "answer_latency",
    """
    SELECT event_id, user_id, round(epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) - ts) / 1000.0::DOUBLE, 3) AS latency_ms
    FROM events
    """,
)
def answer_latency(t: Tables) -> DataFrame:
    waited = F.round(usage.latency_ms(F.col("ts"), F.col("next_ts")), 3)
    return t.answer_latency().select("event_id", "user_id", waited.alias("latency_ms"))


@query(
    "session_usage",
    v.with_(
        v.USAGE,
        select="""
        SELECT session_id, count(*) AS answers, CAST(sum(prompt) AS BIGINT) AS prompt_tokens, CAST(sum(cached) AS BIGINT) AS cached_tokens,
               CAST(sum(completion) AS BIGINT) AS completion_tokens, round(sum(cost), 9) AS cost, round(avg(completion * 10.0::DOUBLE), 6) AS avg_latency
        FROM usage GROUP BY session_id
        """,
    ),
)
def session_usage(t: Tables) -> DataFrame:
    return usage.session_usage(usage.chat_cost(t.usage()).withColumn("latency_ms", F.col("completion") * 10.0))


@query("agent_result", v.with_(v.STEPS, select="SELECT session_id, success FROM outcomes"))
def agent_result(t: Tables) -> DataFrame:
    return usage.agent_result(t.agent_steps())


@query("agent_last_output", v.with_(v.STEPS, select="SELECT session_id, output FROM last_outputs"))
def agent_last_output(t: Tables) -> DataFrame:
    return usage.last_output(t.agent_steps())


@query(
    "agent_steps",
    v.with_(v.STEPS, select="SELECT session_id, step_no, role AS tool_calls, substring(observations, 1, 800) AS observations FROM steps"),
)
def agent_steps(t: Tables) -> DataFrame:
    return usage.agent_steps(t.agent_steps())


@query(
    "agent_outcomes",
    v.with_(
        v.STEPS,
        """named AS (SELECT session_id, CASE WHEN o.success THEN 1 ELSE 0 END AS s, coalesce(first_role, 'none') AS agent
          FROM outcomes o JOIN (SELECT session_id, arg_min(role, step_no) AS first_role FROM steps GROUP BY session_id) USING (session_id))""",
        select="SELECT agent, count(*) AS runs, CAST(sum(s) AS BIGINT) AS successes, round(avg(s), 6) AS success_rate FROM named GROUP BY agent",
    ),
)
def agent_outcomes(t: Tables) -> DataFrame:
    steps = t.agent_steps()
    agents = steps.groupBy("session_id").agg(F.min_by("role", "step_no").alias("agent"))
    return usage.agent_outcomes(usage.agent_result(steps).join(agents, "session_id"))


@query(
    "attempt_outcome",
    v.with_(
        v.STEPS,
        "runs AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY step_no) AS n, count(*) OVER (PARTITION BY session_id) AS attempts FROM steps WHERE role = 'assistant')",
        select="""
        SELECT session_id, max(attempts) AS attempts, arg_max(exit_code, n) = 0 AS success, max(attempts) > 3 AS over_limit
        FROM runs WHERE n <= 3 GROUP BY session_id
        """,
    ),
)
def attempt_outcome(t: Tables) -> DataFrame:
    runs = t.agent_steps().filter(F.col("role") == "assistant").select("session_id", F.col("step_no").alias("attempt"), "exit_code")
    return usage.attempt_outcome(runs)


@query(
    "clean_stdout",
    r"SELECT conv_id, turn, regexp_replace(replace(concat('  ', replace(text, ' ', '   '), ' ', chr(10)), '  ', ' '), '^\s+|\s+$', '', 'g') AS stdout FROM conversations",
)
def clean_stdout(t: Tables) -> DataFrame:
    raw = F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit("   ")), F.lit(" \n"))
    return t.read("conversations").select("conv_id", "turn", tx.clean_output(raw).alias("stdout"))

from pyspark.sql import functions as F

from gleaner.functions import results as rs
from gleaner.operators import usage
from tests.conftest import rows

CHUNK = "session_id bigint, turn bigint, seq bigint, delta string, usage struct<prompt:bigint,completion:bigint,cached:bigint>"


def test_stream_chunks_become_an_answer(spark):
    data = [(1, 1, 2, "world!", None), (1, 1, 0, "Hello", None), (1, 1, 1, " ", None), (1, 1, 3, None, (10, 5, 0)), (1, 2, 0, None, None)]
    got = rows(usage.assemble_answers(spark.createDataFrame(data, CHUNK)).select("session_id", "turn", "answer", "usage.*"), "turn")
    assert got == [(1, 1, "Hello world!", 10, 5, 0), (1, 2, "", None, None, None)]


def test_long_answers_join_across_blocks(spark):
    data = [(1, 1, i, f"{i},", (i, 0, 0) if i in (3, 17) else None) for i in range(50)]
    got = usage.assemble_answers(spark.createDataFrame(data, CHUNK).repartition(4), pieces=7).first()
    assert got["answer"] == "".join(f"{i}," for i in range(50)) and got["usage"]["prompt"] == 17


def test_memory_keeps_the_last_messages(spark):
    messages = spark.createDataFrame([(s, t, "user", f"m{t}") for s, n in ((1, 10), (2, 11), (3, 2)) for t in range(n)], "session_id bigint, turn bigint, role string, text string")
    got = rows(usage.last_messages(messages).groupBy("session_id").agg(F.min("turn"), F.max("turn"), F.count("*")), "session_id")
    assert got == [(1, 0, 9, 10), (2, 1, 10, 10), (3, 0, 1, 2)]


def test_cost_and_stats_line(spark):
    df = usage.chat_cost(spark.createDataFrame([(100, 0, 50), (100, 80, 50), (8, 0, 23)], "prompt bigint, cached bigint, completion bigint"))
    assert [r["cost"] for r in df.collect()] == [0.00075, 0.00065, 0.00025]
    line = rs.stats_line(*[F.col(c) for c in ("prompt", "cached", "completion", "cost")], F.lit(623.456))
    assert df.select(line).first()[0] == "[stats] prompt=100 cached=0 completion=50 cost=$0.000750000000 latency=623.46ms"


def test_latency_keeps_fractions(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.000250' AS a, timestamp'2024-01-01 00:00:01' AS b")
    assert df.select(usage.latency_ms(F.col("a"), F.col("b"))).first()[0] == 999.75


def test_agent_results(spark):
    steps = spark.createDataFrame(
        [(1, 1, "x"), (1, 2, "done\nRESULT: success"), (1, 3, None), (2, 1, "RESULT: success\nRESULT: failure"), (3, 1, None), (4, 1, ""), (5, 1, "ok\nRESULT: success\n")],
        "session_id bigint, step_no bigint, output string",
    )
    assert rows(usage.agent_result(steps), "session_id") == [(1, True), (2, False), (3, False), (4, False), (5, True)]


def test_attempts(spark):
    runs = spark.createDataFrame(
        [(1, 1, 1), (1, 2, 0), (2, 1, 1), (2, 2, 1), (2, 3, 1), (2, 4, 0), (3, 1, 0)], "session_id bigint, attempt bigint, exit_code bigint"
    )
    assert rows(usage.attempt_outcome(runs), "session_id") == [(1, 2, True, False), (2, 4, False, True), (3, 1, True, False)]
    outcomes = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "agent string, success boolean")
    assert rows(usage.agent_outcomes(outcomes), "agent") == [("a", 2, 1, 0.5), ("b", 1, 1, 1.0)]


def test_observations_are_cut(spark):
    steps = spark.createDataFrame([(1, 1, "t", "y" * 900)], "session_id bigint, step_no bigint, tool_calls string, observations string")
    assert len(usage.agent_steps(steps).first()["observations"]) == 800

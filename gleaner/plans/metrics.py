"""Dashboard metrics over evaluation results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions import results as rf
from gleaner.operators import evaluation, metrics
from gleaner.plans import views as v
from gleaner.plans.registry import query
from gleaner.plans.standins import Tables
from gleaner.sources import results as rs
from gleaner.sources.scratch import scratch_path

NAMES = "CASE WHEN contains({0}, 'naive') THEN 'Naive' WHEN contains({0}, 'bm25') THEN 'BM25' ELSE {0} END"


@query("load_eval", v.with_(v.RESULTS, select="SELECT provider, latency_ms, pass, score, query, test_idx FROM results"))
def load_eval(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "evaluation")
    t.evaluation_files().write.json(path)
    return rs.flat_results(rs.read_eval(t.spark, path, one_per_line=True))


@query(
    "eval_counters",
    v.with_(
        v.COUNTERS,
        select="SELECT provider, test_pass_count, test_fail_count, round(total_latency_ms, 6) AS total_latency_ms, num_requests FROM counters",
    ),
)
def eval_counters(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "evaluation")
    t.evaluation_files().write.json(path)
    counters = rs.provider_counters(rs.read_eval(t.spark, path, one_per_line=True))
    return counters.groupBy("provider").agg(
        F.sum("test_pass_count").alias("test_pass_count"), F.sum("test_fail_count").alias("test_fail_count"),
        F.round(F.sum("total_latency_ms"), 6).alias("total_latency_ms"), F.sum("num_requests").alias("num_requests"),
    )


@query("provider_name", v.with_(v.RESULTS, select=f"SELECT test_idx, provider_id, {NAMES.format('provider_id')} AS provider FROM results"))
def provider_name(t: Tables) -> DataFrame:
    return t.results().select("test_idx", "provider_id", rf.provider_name(F.col("provider_id")).alias("provider"))


@query(
    "pass_rate",
    v.with_(
        v.COUNTERS,
        select="""
        SELECT provider, round(test_pass_count / (test_pass_count + test_fail_count) * 100, 6) AS pass_rate,
               concat(test_pass_count, '/', test_pass_count + test_fail_count) AS ratio
        FROM counters
        """,
    ),
)
def pass_rate(t: Tables) -> DataFrame:
    return metrics.pass_rate(t.counters())


@query(
    "avg_latency",
    v.with_(
        v.COUNTERS,
        select="SELECT provider, round(total_latency_ms / num_requests, 6) AS avg_latency, round(total_latency_ms, 6) AS total_latency FROM counters",
    ),
)
def avg_latency(t: Tables) -> DataFrame:
    return metrics.avg_latency(t.counters())


@query(
    "pass_fail_counts",
    v.with_(
        v.RESULTS,
        select="SELECT provider, pass, count(*) AS count, CASE WHEN pass THEN 'Pass' ELSE 'Fail' END AS status FROM results GROUP BY provider, pass",
    ),
)
def pass_fail_counts(t: Tables) -> DataFrame:
    return metrics.pass_fail_counts(t.results())


@query(
    "latency_stats",
    v.with_(
        v.RESULTS,
        select="""
        SELECT provider, round(avg(latency_ms), 6) AS mean, round(stddev_samp(latency_ms), 6) AS std,
               round(quantile_cont(latency_ms, 0.5), 6) AS median, min(latency_ms) AS min, max(latency_ms) AS max,
               round(quantile_cont(latency_ms, 0.95), 6) AS p95,
               round(avg(latency_ms) - stddev_samp(latency_ms), 6) AS band_low, round(avg(latency_ms) + stddev_samp(latency_ms), 6) AS band_high
        FROM results GROUP BY provider
        """,
    ),
)
def latency_stats(t: Tables) -> DataFrame:
    return metrics.latency_stats(t.results())


FENCES = """
quartiles AS (
  SELECT provider, quantile_cont(latency_ms, 0.25) AS q1, quantile_cont(latency_ms, 0.5) AS median, quantile_cont(latency_ms, 0.75) AS q3
  FROM results GROUP BY provider),
fences AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS low, q3 + 1.5::DOUBLE * (q3 - q1) AS high FROM quartiles)"""


@query(
    "latency_box",
    v.with_(
        v.RESULTS, FENCES,
        select="""
        SELECT provider, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
               min(latency_ms) FILTER (WHERE latency_ms BETWEEN low AND high) AS lower_whisker,
               max(latency_ms) FILTER (WHERE latency_ms BETWEEN low AND high) AS upper_whisker,
               count(*) FILTER (WHERE latency_ms NOT BETWEEN low AND high) AS n_outliers
        FROM results JOIN fences USING (provider) GROUP BY provider, q1, median, q3
        """,
    ),
)
def latency_box(t: Tables) -> DataFrame:
    return metrics.latency_box(t.results())


@query(
    "latency_outliers",
    v.with_(
        v.RESULTS, FENCES,
        select="SELECT provider, test_idx, latency_ms FROM results JOIN fences USING (provider) WHERE latency_ms NOT BETWEEN low AND high",
    ),
)
def latency_outliers(t: Tables) -> DataFrame:
    return metrics.latency_outliers(t.results())


STEPS = "flatten(list_transform(range(-6, 300), lambda p: list_transform([1, 2, 5], lambda l: concat(l, 'e', p)::DOUBLE)))"


@query(
    "latency_hist",
    v.with_(
        v.RESULTS,
        f"""step AS (
          SELECT list_min(list_filter({STEPS}, lambda s: span / s <= 30)) AS step FROM (SELECT max(latency_ms) - min(latency_ms) AS span FROM results))""",
        select="""
        SELECT provider, round(floor(latency_ms / (SELECT step FROM step)) * (SELECT step FROM step), 6) AS bin_start,
               count(*) AS count, round(avg(latency_ms), 6) AS mean_latency
        FROM results GROUP BY ALL
        """,
    ),
)
def latency_hist(t: Tables) -> DataFrame:
    return metrics.latency_hist(t.results())


@query(
    "latency_sequence",
    v.with_(v.RESULTS, select="SELECT provider, test_idx, latency_ms, pass, CASE WHEN latency_ms > 0 THEN round(log10(latency_ms), 6) END AS log_latency FROM results"),
)
def latency_sequence(t: Tables) -> DataFrame:
    return metrics.latency_sequence(t.results())


@query(
    "pass_rate_by_bucket",
    v.with_(
        v.RESULTS,
        """labels_of(bucket_no, bucket, low, high) AS (
          VALUES (1, '<100ms', 0, 100), (2, '100-500ms', 100, 500), (3, '500ms-1s', 500, 1000), (4, '1-2s', 1000, 2000), (5, '>2s', 2000, 5000))""",
        "grid AS (SELECT * FROM (SELECT DISTINCT provider FROM results), labels_of)",
        select="""
        SELECT g.provider, CAST(bucket_no AS BIGINT) AS bucket_no, bucket, count(*) FILTER (WHERE pass) AS pass_count, count(r.test_idx) AS total_count,
               round(count(*) FILTER (WHERE pass) / nullif(count(r.test_idx), 0) * 100, 6) AS pass_rate
        FROM grid g LEFT JOIN results r ON r.provider = g.provider AND r.latency_ms > low AND r.latency_ms <= high
        GROUP BY g.provider, bucket_no, bucket
        """,
    ),
)
def pass_rate_by_bucket(t: Tables) -> DataFrame:
    return metrics.pass_rate_by_bucket(t.results())


@query(
    "results_detail",
    v.with_(
        v.RESULTS,
        select="""
        SELECT provider, query, CAST(CAST(latency_ms AS DECIMAL(18, 6)) AS DECIMAL(18, 0))::VARCHAR AS latency_ms, pass, printf('%.2f', score) AS score
        FROM results WHERE provider IN ('Naive', 'BM25') AND NOT pass
        """,
    ),
)
def results_detail(t: Tables) -> DataFrame:
    return metrics.results_detail(t.results(), ["Naive", "BM25"], ["Fail"])


@query(
    "provider_insights",
    v.with_(
        v.RESULTS,
        select="""
        SELECT provider, round(count(*) FILTER (WHERE pass) / count(*) * 100, 6) AS pass_rate, round(avg(latency_ms), 6) AS avg_latency,
               round(quantile_cont(latency_ms, 0.5), 6) AS median_latency
        FROM results GROUP BY provider
        """,
    ),
)
def provider_insights(t: Tables) -> DataFrame:
    return metrics.provider_insights(t.results())


@query(
    "provider_compare",
    v.with_(
        v.RESULTS,
        """sides AS (
          SELECT avg(CASE WHEN pass THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (WHERE provider = 'Naive') AS p1,
                 avg(CASE WHEN pass THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (WHERE provider = 'BM25') AS p2,
                 avg(latency_ms) FILTER (WHERE provider = 'Naive') AS l1, avg(latency_ms) FILTER (WHERE provider = 'BM25') AS l2
          FROM results)""",
        select="""
        SELECT CASE WHEN p2 > p1 THEN 'BM25' ELSE 'Naive' END AS more_accurate, round(abs(p2 - p1), 6) AS accuracy_gap,
               CASE WHEN l1 < l2 THEN 'Naive' ELSE 'BM25' END AS faster,
               round(CASE WHEN l1 < l2 THEN (l2 - l1) / l2 ELSE (l1 - l2) / l1 END * 100, 6) AS percent_faster,
               CASE WHEN p2 > p1 AND l2 > l1 THEN 'BM25: accuracy at the cost of latency'
                    WHEN p2 < p1 AND l2 < l1 THEN 'Naive: accuracy at the cost of latency' END AS trade_off
        FROM sides
        """,
    ),
)
def provider_compare(t: Tables) -> DataFrame:
    return metrics.provider_compare(t.results())


@query("providers", v.with_(v.RESULTS, select="SELECT DISTINCT provider FROM results"))
def providers(t: Tables) -> DataFrame:
    return metrics.providers(t.results())


@query(
    "first_per_group",
    v.with_(v.RESULTS, select="SELECT provider, test_idx, latency_ms, pass FROM " + v.top("results", "provider", "test_idx", 1)),
)
def first_per_group(t: Tables) -> DataFrame:
    return metrics.first_per_group(t.results().select("provider", "test_idx", "latency_ms", "pass"), ["provider"], ["test_idx"])


@query(
    "metrics_over_time",
    v.with_(
        v.RESULTS,
        select="""
        SELECT CAST(ts AS DATE) AS day, provider, count(*) AS requests, round(avg(latency_ms), 6) AS avg_latency, round(sum(cost), 6) AS cost,
               round(count(*) FILTER (WHERE pass) / count(*) * 100, 6) AS accuracy
        FROM results GROUP BY ALL
        """,
    ),
)
def metrics_over_time(t: Tables) -> DataFrame:
    return metrics.metrics_over_time(t.results())


REQUESTS = """
SELECT provider, prompt FROM (
  SELECT provider, text AS prompt FROM benchmark, (VALUES ('rag/naive'), ('rag/bm25')) p(provider)
  UNION ALL SELECT 'rag/naive', text FROM conversations WHERE role = 'user')
"""


@query("request_log", REQUESTS)
def request_log(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "request-log")
    asked = evaluation.eval_matrix(t.questions(), ["rag/naive", "rag/bm25"]).select("provider", F.col("text").alias("prompt"))
    rs.append_request_log(asked, path)
    chats = t.messages().filter(F.col("role") == "user").select(F.lit("rag/naive").alias("provider"), F.col("text").alias("prompt"))
    rs.append_request_log(chats, path)
    return t.spark.read.json(path, schema="provider string, prompt string")

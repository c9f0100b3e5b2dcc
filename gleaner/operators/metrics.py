"""Dashboard metrics over flat evaluation results.

Results have ``provider, latency_ms, pass, score, query, test_idx``; provider
counters have ``provider, test_pass_count, test_fail_count, total_latency_ms,
num_requests``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import results as rs
from gleaner.operators.quantiles import exact_quantiles
from gleaner.sources.scratch import stage

DIGITS = 6
MAX_BINS = 30


def _rounded(column: Column) -> Column:
    return F.round(column, DIGITS)


def pass_rate(counters: DataFrame) -> DataFrame:
    """Pass rate in percent per provider, and the counts as ``passed/all``."""
    passed, failed = F.sum("test_pass_count"), F.sum("test_fail_count")
    return counters.groupBy("provider").agg(
        _rounded(F.try_divide(passed, passed + failed) * 100).alias("pass_rate"),
        F.concat_ws("/", passed, passed + failed).alias("ratio"),
    )


def avg_latency(counters: DataFrame) -> DataFrame:
    """Total latency over number of requests, null without requests."""
    return counters.groupBy("provider").agg(
        _rounded(F.try_divide(F.sum("total_latency_ms"), F.sum("num_requests"))).alias("avg_latency"),
        _rounded(F.sum("total_latency_ms")).alias("total_latency"),
    )


def pass_fail_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("provider", "pass").agg(F.count(F.lit(1)).alias("count")).withColumn("status", rs.status(F.col("pass")))


def latency_stats(results: DataFrame) -> DataFrame:
    """Mean, deviation, median, extremes and 95th percentile, plus the mean ± deviation band."""
    plain = results.groupBy("provider").agg(
        F.avg("latency_ms").alias("mean"), F.stddev_samp("latency_ms").alias("std"),
        F.min("latency_ms").alias("min"), F.max("latency_ms").alias("max"),
    )
    ranks = exact_quantiles(results, ["provider"], "latency_ms", [0.5, 0.95])
    return plain.join(ranks, "provider").select(
        "provider",
        _rounded(F.col("mean")).alias("mean"), _rounded(F.col("std")).alias("std"),
        _rounded(F.col("q")[0]).alias("median"), "min", "max", _rounded(F.col("q")[1]).alias("p95"),
        _rounded(F.col("mean") - F.col("std")).alias("band_low"), _rounded(F.col("mean") + F.col("std")).alias("band_high"),
    )


def _numbers(results: DataFrame) -> DataFrame:
    """Rows whose latency is not NaN; a missing one stays."""
    return results.filter(~F.coalesce(F.isnan("latency_ms"), F.lit(False)))


def _fences(results: DataFrame) -> DataFrame:
    quartiles = exact_quantiles(results, ["provider"], "latency_ms", [0.25, 0.5, 0.75])
    # infinite quartiles of one sign have no spread
    spread = F.when(F.col("q")[2] == F.col("q")[0], 0.0).otherwise(F.col("q")[2] - F.col("q")[0])
    return stage(
        quartiles.select(
            "provider", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
            (F.col("q")[0] - 1.5 * spread).alias("low"), (F.col("q")[2] + 1.5 * spread).alias("high"),
        ),
        "fences",
    )


def latency_box(results: DataFrame) -> DataFrame:
    """Box-plot numbers: quartiles, whiskers at the last values inside 1.5 IQR, outlier count; NaN is left out."""
    fenced = _numbers(results).join(_fences(results), "provider")
    inside = F.col("latency_ms").between(F.col("low"), F.col("high"))
    return fenced.groupBy("provider", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("latency_ms"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("latency_ms"))).alias("upper_whisker"),
        F.count(F.when(~inside, F.lit(1))).alias("n_outliers"),
    ).select(
        "provider", *[_rounded(F.col(c)).alias(c) for c in ("q1", "median", "q3", "lower_whisker", "upper_whisker")], "n_outliers"
    )


def latency_outliers(results: DataFrame) -> DataFrame:
    """The rows a box plot draws as points; NaN is none."""
    return (
        _numbers(results).join(_fences(results), "provider")
        .filter(~F.col("latency_ms").between(F.col("low"), F.col("high")))
        .select("provider", "test_idx", "latency_ms")
    )


def latency_hist(results: DataFrame, max_bins: int = MAX_BINS) -> DataFrame:
    """Histogram per provider on one round bin width that gives at most ``max_bins`` bins.

    The width is 1, 2 or 5 times a power of ten, the least that serves, and
    follows from the span of the finite values whatever its size; without any
    span it is 1e-6. Infinite values have a bin of their own, NaN is left out.
    """
    results = _numbers(results)
    infinite = F.abs("latency_ms") == float("inf")
    finite = F.when(~infinite, F.col("latency_ms"))
    span = results.agg((F.max(finite) - F.min(finite)).alias("span"))
    power = F.floor(F.log10(F.col("span") / max_bins))
    steps = F.array(*[F.concat(F.lit(f"{lead}e"), (power + shift).cast("string")).cast("double") for shift in (-1, 0, 1) for lead in (1, 2, 5)])
    fitting = F.array_min(F.filter(steps, lambda s: F.col("span") / s <= max_bins))
    step = span.select(F.when(F.col("span") > 0, fitting).when(F.col("span") == 0, F.lit(1e-6))).scalar()
    start = F.when(infinite, F.col("latency_ms")).otherwise(_rounded(F.floor(finite / F.col("step")) * F.col("step")))
    return (
        results.withColumn("step", step)
        .withColumn("bin_start", start)
        .groupBy("provider", "bin_start")
        .agg(F.count(F.lit(1)).alias("count"), F.when(F.abs(F.avg("latency_ms")) < float("inf"), _rounded(F.avg(finite))).otherwise(F.avg("latency_ms")).alias("mean_latency"))
    )


def latency_sequence(results: DataFrame) -> DataFrame:
    """Latency and its logarithm by test number; null where the logarithm does not exist."""
    return results.select(
        "provider", "test_idx", "latency_ms", "pass", _rounded(F.log10("latency_ms")).alias("log_latency")
    )


def pass_rate_by_bucket(results: DataFrame) -> DataFrame:
    """Pass rate per provider and latency bucket; empty buckets stay with a null rate."""
    bucketed = results.withColumn("bucket_no", rs.latency_bucket_no(F.col("latency_ms")))
    aggregates = []
    for number in range(1, len(rs.LATENCY_LABELS) + 1):
        inside = F.col("bucket_no") == number
        aggregates += [
            F.count(F.when(inside, F.lit(1))).alias(f"total_{number}"),
            F.count(F.when(inside & F.col("pass"), F.lit(1))).alias(f"pass_{number}"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(number).cast("bigint").alias("bucket_no"), F.lit(label).alias("bucket"),
            F.col(f"pass_{number}").alias("pass_count"), F.col(f"total_{number}").alias("total_count"),
        )
        for number, label in enumerate(rs.LATENCY_LABELS, start=1)
    ])
    return (
        bucketed.groupBy("provider").agg(*aggregates)
        .select("provider", F.inline(rows))
        .withColumn("pass_rate", _rounded(F.try_divide("pass_count", "total_count") * 100))
    )


def results_detail(results: DataFrame, providers: Sequence[str], statuses: Sequence[str]) -> DataFrame:
    """Detail rows of the chosen providers and statuses, numbers formatted for display."""
    chosen = F.col("provider").isin(list(providers)) & rs.status(F.col("pass")).isin(list(statuses))
    return results.filter(chosen).select(
        "provider", "query",
        F.format_string("%.0f", "latency_ms").alias("latency_ms"), "pass", F.format_string("%.2f", "score").alias("score"),
    )


def provider_insights(results: DataFrame) -> DataFrame:
    """Pass rate, mean and median latency per provider."""
    plain = results.groupBy("provider").agg(rs.pass_rate(F.col("pass")).alias("rate"), F.avg("latency_ms").alias("mean"))
    medians = exact_quantiles(results, ["provider"], "latency_ms", [0.5])
    return plain.join(medians, "provider").select(
        "provider", _rounded(F.col("rate")).alias("pass_rate"),
        _rounded(F.col("mean")).alias("avg_latency"), _rounded(F.col("q")[0]).alias("median_latency"),
    )


def provider_compare(results: DataFrame, first: str = "Naive", second: str = "BM25") -> DataFrame:
    """One row: who is more accurate and by how much, who is faster, and the trade-off.

    On a tie the first provider counts as more accurate and the second as
    faster; the trade-off is null unless one wins accuracy and loses speed.
    """

    def of(name: str, value: Column) -> Column:
        return F.avg(F.when(F.col("provider") == name, value))

    passed = F.when(F.col("pass"), F.lit(100.0)).otherwise(F.lit(0.0))
    one = results.agg(
        of(first, passed).alias("rate1"), of(second, passed).alias("rate2"),
        of(first, F.col("latency_ms")).alias("lat1"), of(second, F.col("latency_ms")).alias("lat2"),
    )
    rate1, rate2, lat1, lat2 = (F.col(c) for c in ("rate1", "rate2", "lat1", "lat2"))
    return one.select(
        F.when(rate2 > rate1, F.lit(second)).otherwise(F.lit(first)).alias("more_accurate"),
        _rounded(F.when(rate2 > rate1, rate2 - rate1).otherwise(rate1 - rate2)).alias("accuracy_gap"),
        F.when(lat1 < lat2, F.lit(first)).otherwise(F.lit(second)).alias("faster"),
        _rounded(F.when(lat1 < lat2, F.try_divide(lat2 - lat1, lat2)).otherwise(F.try_divide(lat1 - lat2, lat1)) * 100).alias("percent_faster"),
        F.when((rate2 > rate1) & (lat2 > lat1), F.concat(F.lit(second), F.lit(": accuracy at the cost of latency")))
        .when((rate2 < rate1) & (lat2 < lat1), F.concat(F.lit(first), F.lit(": accuracy at the cost of latency")))
        .alias("trade_off"),
    )


def providers(results: DataFrame) -> DataFrame:
    return results.select("provider").distinct()


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each group in the given order, by one aggregation with map-side combine."""
    rest = [c for c in df.columns if c not in by]
    ordered = [*order, *[c for c in rest if c not in order]]
    return df.groupBy(*by).agg(F.min_by(F.struct(*ordered), F.struct(*order)).alias("row")).select(*by, "row.*")


def metrics_over_time(results: DataFrame, ts: str = "ts") -> DataFrame:
    """Requests, mean latency, cost and accuracy per day and provider."""
    return results.groupBy(F.to_date(ts).alias("day"), "provider").agg(
        F.count(F.lit(1)).alias("requests"),
        _rounded(F.avg("latency_ms")).alias("avg_latency"),
        _rounded(F.sum("cost")).alias("cost"),
        _rounded(rs.pass_rate(F.col("pass"))).alias("accuracy"),
    )

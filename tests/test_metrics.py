import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleaner.functions import results as rs
from gleaner.operators import metrics
from gleaner.operators.common import segmented_lead, segmented_running_sum
from gleaner.operators.quantiles import exact_quantiles
from tests.conftest import rows

RESULTS = "provider string, latency_ms double, pass boolean, score double, query string, test_idx bigint"


def results(spark, data):
    return spark.createDataFrame([(p, float(l), ok, float(ok), "q", i) for i, (p, l, ok) in enumerate(data)], RESULTS)


def test_quantiles_match_pandas_on_awkward_values(spark):
    rng = np.random.default_rng(5)
    groups = {
        "hot": rng.lognormal(5, 2, 4000), "same": np.full(500, 7.25), "one": [3.5], "two": [-2.0, 9.0],
        "signed": rng.normal(0, 1, 700), "dense": 100 + rng.random(3000) * 1e-4, "mixed": np.r_[np.zeros(50), -np.ones(3), 1e12, 5e-9],
        "outlier": np.r_[rng.random(999), 1e15],
    }
    data = [(g, float(v)) for g, values in groups.items() for v in values] + [("hot", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = {r["g"]: (r["count"], r["q"]) for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for g, values in groups.items():
        assert got[g][0] == len(values)
        assert np.allclose(got[g][1], np.quantile(np.asarray(values, dtype=float), probs), rtol=1e-12, atol=1e-12), g


def test_latency_buckets_are_right_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 0.5, 100, 100.5, 500, 1000, 2000, 5000, 5000.5, -1)], "v double")
    got = [r[0] for r in df.select(rs.latency_bucket_no(F.col("v"))).collect()]
    cut = pd.cut([0, 0.5, 100, 100.5, 500, 1000, 2000, 5000, 5000.5, -1], bins=rs.LATENCY_EDGES, labels=False)
    assert got == [None if pd.isna(c) else int(c) + 1 for c in cut]


def test_empty_buckets_stay(spark):
    got = rows(metrics.pass_rate_by_bucket(results(spark, [("A", 50, True), ("A", 60, False), ("A", 9000, True)])), "bucket_no")
    assert got == [
        ("A", 1, "<100ms", 1, 2, 50.0), ("A", 2, "100-500ms", 0, 0, None), ("A", 3, "500ms-1s", 0, 0, None),
        ("A", 4, "1-2s", 0, 0, None), ("A", 5, ">2s", 0, 0, None),
    ]


def test_stats_and_box_match_pandas(spark):
    rng = np.random.default_rng(1)
    data = [(p, l, bool(ok)) for p in "AB" for l, ok in zip(np.r_[rng.gamma(2, 100, 300), [9000.0]], rng.random(301) < 0.7)]
    df, frame = results(spark, data), pd.DataFrame(data, columns=["provider", "latency", "pass"])
    stats = {r["provider"]: r for r in metrics.latency_stats(df).collect()}
    box = {r["provider"]: r for r in metrics.latency_box(df).collect()}
    for provider, group in frame.groupby("provider")["latency"]:
        s, b = stats[provider], box[provider]
        wanted = [group.mean(), group.std(), group.median(), group.min(), group.max(), group.quantile(0.95)]
        assert np.allclose([s[c] for c in ("mean", "std", "median", "min", "max", "p95")], wanted, atol=1e-6)
        q1, q3 = group.quantile(0.25), group.quantile(0.75)
        inside = group[group.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
        assert np.allclose([b["q1"], b["q3"], b["lower_whisker"], b["upper_whisker"]], [q1, q3, inside.min(), inside.max()], atol=1e-6)
        assert b["n_outliers"] == len(group) - len(inside) >= 1
    assert metrics.latency_outliers(df).count() == sum(b["n_outliers"] for b in box.values())


def test_single_value_has_no_deviation(spark):
    row = metrics.latency_stats(results(spark, [("A", 5, True)])).first()
    assert (row["mean"], row["std"], row["median"], row["p95"]) == (5.0, None, 5.0, 5.0)


@pytest.mark.parametrize("span, step", [(30, 1), (31, 2), (100, 5), (6974, 500), (0.3, 0.01), (290, 10)])
def test_histogram_takes_the_smallest_round_step(spark, span, step):
    data = [("A", span * i / 1000, True) for i in range(1001)]
    got = rows(metrics.latency_hist(results(spark, data)).select("bin_start", "count"), "bin_start")
    assert sum(n for _, n in got) == 1001
    gaps = {round(b[0] - a[0], 9) for a, b in zip(got, got[1:])}
    assert all(abs(g / step - round(g / step)) < 1e-6 for g in gaps) and min(gaps) == pytest.approx(step)


def test_counters(spark):
    counters = spark.createDataFrame(
        [("A", 3, 1, 100.0, 4), ("B", 0, 2, 0.0, 0)],
        "provider string, test_pass_count bigint, test_fail_count bigint, total_latency_ms double, num_requests bigint",
    )
    assert rows(metrics.pass_rate(counters), "provider") == [("A", 75.0, "3/4"), ("B", 0.0, "0/2")]
    assert rows(metrics.avg_latency(counters), "provider") == [("A", 25.0, 100.0), ("B", None, 0.0)]


@pytest.mark.parametrize(
    "naive, bm25, wanted",
    [
        ([(100, True), (100, False)], [(200, True), (200, True)], ("BM25", 50.0, "Naive", 50.0, "BM25: accuracy at the cost of latency")),
        ([(200, True)], [(100, False)], ("Naive", 100.0, "BM25", 50.0, "Naive: accuracy at the cost of latency")),
        ([(100, True)], [(100, True)], ("Naive", 0.0, "BM25", 0.0, None)),
        ([(200, False)], [(100, True)], ("BM25", 100.0, "BM25", 50.0, None)),
    ],
)
def test_comparison_and_its_ties(spark, naive, bm25, wanted):
    data = [("Naive", l, p) for l, p in naive] + [("BM25", l, p) for l, p in bm25] + [("other", 1, False)]
    assert rows(metrics.provider_compare(results(spark, data))) == [wanted]


def test_detail_filters_and_formats(spark):
    df = results(spark, [("A", 1234.4, True), ("B", 5, True), ("A", 6, False)])
    assert rows(metrics.results_detail(df, ["A"], ["Pass"])) == [("A", "q", "1234", True, "1.00")]


def test_provider_name_order(spark):
    df = spark.createDataFrame([("x/naive/bm25",), ("x/bm25",), ("NAIVE",)], "id string")
    assert [r[0] for r in df.select(rs.provider_name(F.col("id"))).collect()] == ["Naive", "BM25", "NAIVE"]


def test_segmented_windows_equal_plain_ones(spark):
    rng = np.random.default_rng(2)
    data = [(int(k), i, int(v)) for i, (k, v) in enumerate(zip(rng.integers(0, 3, 400) ** 2, rng.integers(0, 50, 400)))]
    df = spark.createDataFrame(data, "k bigint, t bigint, v bigint")
    summed = {(r["k"], r["t"]): r["s"] for r in segmented_running_sum(df, ["k"], "t", "v", "s", width=7).collect()}
    led = {(r["k"], r["t"]): r["n"] for r in segmented_lead(df, ["k"], F.floor(F.col("t") / 5), "t", "v", "n").collect()}
    for k, t, _ in data:
        assert summed[k, t] == sum(v for kk, tt, v in data if kk == k and tt < t)
        assert led[k, t] == min((tt for kk, tt, _ in data if kk == k and tt > t), default=None)

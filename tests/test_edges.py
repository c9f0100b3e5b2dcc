"""Hot keys, infinite and missing numbers, and hits that are all blank."""

import math
from collections import Counter

from pyspark.sql import functions as F

from gleaner.operators import answers, common, metrics, travel
from tests.conftest import rows

RESULT = "provider string, test_idx bigint, latency_ms double, pass boolean"


def results(spark, values):
    return spark.createDataFrame([("p", i, v, True) for i, v in enumerate(values)], RESULT)


def test_one_infinite_and_one_nan_latency_keep_the_histogram(spark):
    got = rows(metrics.latency_hist(results(spark, [1.0, 2.0, math.inf, -math.inf, math.nan, 31.0])).select("bin_start", "count"), "bin_start")
    assert got == [(-math.inf, 1), (1.0, 1), (2.0, 1), (31.0, 1), (math.inf, 1)]
    assert rows(metrics.latency_hist(results(spark, [math.inf, math.inf])).select("bin_start", "count")) == [(math.inf, 2)]


def test_infinite_quartiles_have_fences(spark):
    (box,) = metrics.latency_box(results(spark, [1.0, math.inf])).collect()
    assert (box["q1"], box["upper_whisker"], box["n_outliers"]) == (math.inf, math.inf, 1)
    assert [r["latency_ms"] for r in metrics.latency_outliers(results(spark, [1.0, math.inf, math.nan])).collect()] == [1.0]
    (box,) = metrics.latency_box(results(spark, [1.0, 2.0, 3.0, 4.0, math.inf, math.nan])).collect()
    assert (box["median"], box["lower_whisker"], box["upper_whisker"], box["n_outliers"]) == (3.0, 1.0, 4.0, 1)


def test_a_hot_key_is_cut_into_the_parts_it_needs(spark):
    keys = ["hot"] * 900 + ["warm"] * 60 + [f"k{i}" for i in range(40)] + [None]
    left = spark.createDataFrame(list(enumerate(keys)), "id bigint, term string")
    right = spark.createDataFrame([("hot", 1), ("warm", 2), ("k3", 3), ("unused", 4)], "term string, df bigint")
    joined = common.counted_join(left, right, ["term"], ["id"], part_rows=50)
    assert Counter(r["term"] for r in joined.collect()) == {"hot": 900, "warm": 60, "k3": 1}
    assert joined.columns == ["term", "id", "df"]
    dealt, _ = common.counted_parts(left, right, ["term"], ["id"], part_rows=50)
    sizes = [n for (term, _), n in Counter(tuple(r) for r in dealt.select("term", "_part").collect()).items() if term == "hot"]
    assert len(sizes) == 18 and max(sizes) <= 80


def test_one_day_with_most_sessions(spark):
    sessions = spark.range(400).select(
        F.col("id").cast("string").alias("session_id"),
        F.when(F.col("id") < 380, F.lit("2025-01-05 10:00:00")).otherwise(F.lit("2025-03-01 00:00:00")).cast("timestamp").alias("starts"),
    ).withColumn("ends", F.col("starts") + F.expr("INTERVAL 1 HOUR"))
    ranges = spark.createDataFrame([(1, "2025-01-05", "2025-01-06"), (2, "2025-02-01", "2025-04-01")], "range_id bigint, a string, b string").select(
        "range_id", F.col("a").cast("timestamp").alias("range_start"), F.col("b").cast("timestamp").alias("range_end")
    )
    got = travel.range_overlap_join(sessions, ranges, part_rows=16)
    assert Counter(r["range_id"] for r in got.collect()) == {1: 380, 2: 20}
    assert got.columns == ["session_id", "starts", "ends", "range_id", "range_start", "range_end"]


def test_slugs_of_every_search(spark):
    events = spark.createDataFrame([("s1", "b"), ("s1", "a"), ("s1", "b"), ("s2", "c"), ("s2", "a")], "search string, location string")
    ranked = travel.rank_locations(events, ["search"])
    assert rows(travel.location_slugs(ranked, ["search"]), "search") == [("s1", "b,a"), ("s2", "a,c")]


def test_only_blank_hits_are_told_from_none(spark):
    hits = spark.createDataFrame(
        [(1, 1, 0.9, "A.md", "\t\n"), (2, 1, 0.8, "B.md", "x"), (2, 2, 0.7, "C.md", " ")], "query_id bigint, rank bigint, score double, file_name string, text string"
    )
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id bigint")
    outputs = answers.retrieved_files(answers.drop_blank_hits(hits))
    assert rows(answers.with_fallback(queries, outputs, hits=hits), "query_id") == [
        (1, answers.NO_VALID, False), (2, "B.md", True), (3, answers.NO_HITS, False)
    ]

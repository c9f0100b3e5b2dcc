"""Exact percentiles per group without bringing a group into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.sources.scratch import stage

# One bucket covers values within a tenth of a percent of each other; a double
# spans at most about 1.5 million such buckets per sign, in practice thousands.
_LOG_STEP = math.log(1.001)
_LOG_OFFSET = 800_000
_LOG_INFINITE = 750_000.0
_FINE_BUCKETS = 4096


def _coarse(value: Column) -> Column:
    """Order-preserving bucket number on a logarithmic scale; infinite values have one of their own."""
    size = F.floor(F.least(F.log(F.abs(value)) / F.lit(_LOG_STEP), F.lit(_LOG_INFINITE))) + F.lit(_LOG_OFFSET)
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("bigint"))


def _locate(counts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows of ``counts(keys, order, n, wanted)`` that hold a wanted rank.

    ``wanted`` is an array of (slot, rank) with ranks from 0 inside ``keys``;
    each kept row carries the slots it answers, with the rank inside the row.
    """
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.filter("wanted", lambda w: (w["rank"] >= F.col("_before")) & (w["rank"] < F.col("_before") + F.col("n")))
    shifted = F.transform(inside, lambda w: F.struct(w["slot"].alias("slot"), (w["rank"] - F.col("_before")).alias("rank")))
    return counts.withColumn("_before", before).withColumn("wanted", shifted).filter(F.size("wanted") > 0).drop("_before")


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """``(by, count, q)``: ``q`` is the array of linearly interpolated percentiles.

    Two rounds of counting narrow every wanted rank down to a sliver of the
    value range; only the distinct values inside a sliver are put in order.
    Counts combine on the map side, so a group that holds most of the rows
    costs no more than many small ones. Null and NaN values are ignored, infinite
    ones are the greatest and the least.
    """
    groups = list(by)
    data = df.select(*groups, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v")).withColumn("b1", _coarse(F.col("v")))

    counts = data.groupBy(*groups, "b1").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    total = F.sum("n").over(Window.partitionBy(*groups))
    slots = []
    for number, prob in enumerate(probs):
        position = F.lit(prob) * (F.col("total") - 1)
        slots.append(F.struct(F.lit(2 * number).alias("slot"), F.floor(position).alias("rank")))
        slots.append(F.struct(F.lit(2 * number + 1).alias("slot"), F.ceil(position).alias("rank")))
    first = stage(
        _locate(counts.withColumn("total", total).withColumn("wanted", F.array(*slots)), groups, "b1"), "quantile-buckets"
    )

    width = (F.col("hi") - F.col("lo")) / _FINE_BUCKETS
    fine = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(_FINE_BUCKETS - 1))).otherwise(F.lit(0))
    cells = data.join(first.select(*groups, "b1", "lo", "hi"), [*groups, "b1"]).withColumn("b2", fine.cast("bigint"))
    cell_counts = cells.groupBy(*groups, "b1", "b2").agg(F.count(F.lit(1)).alias("n"))
    second = stage(
        _locate(cell_counts.join(first.select(*groups, "b1", "lo", "hi", "total", "wanted"), [*groups, "b1"]), [*groups, "b1"], "b2"),
        "quantile-cells",
    )

    target = second.select(*groups, "b1", "b2", "lo", "hi", "total", "wanted")
    values = (
        data.join(target, [*groups, "b1"])
        .filter(fine.cast("bigint") == F.col("b2"))
        .groupBy(*groups, "b1", "b2", "v")
        .agg(F.count(F.lit(1)).alias("n"), F.first("total").alias("total"), F.first("wanted").alias("wanted"))
    )
    exact = _locate(values, [*groups, "b1", "b2"], "v").select(*groups, "total", "v", F.explode("wanted.slot").alias("slot"))
    found = exact.groupBy(*groups).agg(F.first("total").alias("count"), F.map_from_entries(F.collect_list(F.struct("slot", "v"))).alias("at"))
    interpolated = []
    for number, prob in enumerate(probs):
        low, high = F.col("at")[2 * number], F.col("at")[2 * number + 1]
        position = F.lit(prob) * (F.col("count") - 1)
        part = position - F.floor(position)
        interpolated.append(F.when((part == 0) | (low == high), low).otherwise(low + (high - low) * part))
    return found.select(*groups, "count", F.array(*interpolated).alias("q"))

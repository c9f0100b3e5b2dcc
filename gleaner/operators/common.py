"""Helpers shared by the operators: checks, top-k, and windows over hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.sources.scratch import stage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# Rows of one key that a single task joins, and the keys that are ever cut into parts.
PART_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, or an error when it holds no row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty or missing")
    return df


def _text_size() -> Column:
    return F.octet_length(F.to_json(F.struct("*")))


def measured_size(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[int, int]:
    """Rows and text bytes of ``df``, reading at most ``max_rows + 1`` rows."""
    row = (
        df.limit(max_rows + 1)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(_text_size()), F.lit(0)).alias("b"),
        )
        .first()
    )
    return row["n"], row["b"]


def broadcast_batches(
    df: DataFrame, key: str, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[tuple[DataFrame, bool]]:
    """Split ``df`` by ``key`` into parts, each with the answer whether it is small enough to broadcast.

    The size is measured first. Within the bound there is one part, the frame
    itself; beyond it the parts are disjoint hash ranges of ``key``, so that a
    caller which unions the results over all parts loses nothing. A part that
    one key alone lifts above the bound is marked as too large; its join is
    left to Catalyst.
    """
    rows, size = measured_size(df, max_rows)
    if rows <= max_rows and size <= max_bytes:
        return [(df, True)]
    total, total_bytes = df.agg(F.count(F.lit(1)), F.sum(_text_size())).first()
    parts = 2 * max(-(-total // max_rows), -(-total_bytes // max_bytes))
    number = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    sizes = df.groupBy(number.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum(_text_size()).alias("b")).collect()
    return [(df.filter(number == r["part"]), r["n"] <= max_rows and r["b"] <= max_bytes) for r in sorted(sizes)]


def hinted(df: DataFrame, small: bool) -> DataFrame:
    """``df`` with the broadcast hint if it is known to be small."""
    return F.broadcast(df) if small else df


def counted_parts(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], spread_by: Sequence[str], counts: DataFrame | None = None, part_rows: int = PART_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``keys``, with ``_part``: a key with many rows is cut into as many parts as it needs.

    A first pass of counts, ``counts(keys, n)`` where they are known already,
    gives each key above ``part_rows`` its own number of parts. Its rows are
    dealt out by a hash of ``spread_by``, and the rows of ``other`` are
    repeated for these parts only. At most ``MAX_HOT_KEYS`` keys are cut, since
    the parts grow with the table, so that their list can travel to the tasks.
    """
    on = list(keys)
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts.select(*on, "n")
    counted = stage(counted.filter(F.col("n") > part_rows), "large-keys")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    part_rows = max(part_rows, -(-total // MAX_HOT_KEYS))
    hot = F.broadcast(counted.select(*on, F.ceil(F.col("n") / part_rows).cast("int").alias("_parts")))
    dealt = rows.join(hot, on, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_parts")), F.lit(0))).drop("_parts")
    numbers = F.when(F.col("_parts").isNotNull(), F.sequence(F.lit(0), F.col("_parts") - 1)).otherwise(F.array(F.lit(0)))
    repeated = other.join(hot, on, "left").withColumn("_part", F.explode(numbers)).drop("_parts")
    return dealt, repeated


def counted_join(rows: DataFrame, other: DataFrame, keys: Sequence[str], spread_by: Sequence[str], counts: DataFrame | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Inner join on ``keys`` with the parts of :func:`counted_parts`."""
    dealt, repeated = counted_parts(rows, other, keys, spread_by, counts, part_rows)
    return dealt.join(repeated, [*keys, "_part"]).drop("_part")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name of one or more frames."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group, numbered from 1.

    Catalyst cuts every input partition to ``k`` rows per group before the
    shuffle, so a hot group does not reach one task whole.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("bigint"))


def segmented_lead(df: DataFrame, by: Sequence[str], segment: Column, order: str, tie: str, name: str) -> DataFrame:
    """Next value of ``order`` within ``by``, computed per segment.

    ``segment`` must not decrease along (order, tie). Only one summary row per
    segment is brought together per key, so a hot key spreads over its
    segments.
    """
    keyed = df.withColumn("_segment", segment)
    inside = Window.partitionBy(*by, "_segment").orderBy(order, tie)
    firsts = keyed.groupBy(*by, "_segment").agg(F.min(order).alias("_first"))
    following = firsts.withColumn("_next", F.lead("_first").over(Window.partitionBy(*by).orderBy("_segment"))).drop("_first")
    return (
        keyed.withColumn(name, F.lead(order).over(inside))
        .join(following, [*by, "_segment"], "left")
        .withColumn(name, F.coalesce(F.col(name), F.col("_next")))
        .drop("_segment", "_next")
    )


def segmented_running_sum(df: DataFrame, by: Sequence[str], order: str, value: str, name: str, width: int = 1024) -> DataFrame:
    """Sum of ``value`` over the earlier rows of ``by``, in blocks of ``width`` positions.

    ``order`` is a whole number unique per key. Blocks are summed first and
    their running totals joined back, so a long key spreads over its blocks.
    """
    keyed = df.withColumn("_block", F.floor(F.col(order) / width))
    inside = Window.partitionBy(*by, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        keyed.groupBy(*by, "_block").agg(F.sum(value).alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    return (
        keyed.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, [*by, "_block"])
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop("_block", "_before")
    )

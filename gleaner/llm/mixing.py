"""Mixing sources to target weights by systematic sampling.

Every document expects target / source size copies. The expected copies are
added up along the documents of a source, ordered by size, from one random
offset, and a document is emitted once for each whole number that the sum
crosses. In this order neighbours are of like size, so that the words taken
come close to the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.sources.scratch import stage

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """Target of each source from ``sizes(source, source_size)``, one row per source.

    Sources take the ``weights`` in turn, by code point with null last. All
    words are shared by weight; a target stops at ``cap`` times the source's
    size, and what is above goes to the other sources by weight, until none
    is above. Solved directly: sources reach their limit in order of limit /
    weight, so the level is found on the running sums of that order.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("_place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1).withColumn("weight", weight)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "_place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sums = ranked.select(
        "*",
        (F.lit(float(cap)) * F.col("source_size")).alias("_limit"),
        F.sum("source_size").over(everything).alias("_all"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("_full"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("_open"),
    ).withColumn("_level", (F.col("_all") - F.lit(float(cap)) * F.col("_full")) / F.col("_open"))
    # the first source that stays below its limit gives the level for itself and all after it
    levels = sums.withColumn(
        "_final",
        F.first(F.when(F.col("_level") * F.col("weight") <= F.col("_limit"), F.col("_level")), ignorenulls=True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ),
    )
    return levels.select(
        "source", "source_size",
        F.least(F.col("_limit"), F.coalesce("_final", F.lit(float("inf"))) * F.col("weight")).alias("target"),
    )


def expected_copies(
    docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3), cap: float = 3, seed: str = "mix", block_rows: int = 4096,
) -> DataFrame:
    """``docs`` with columns size, source_size, target and copies, one row per row.

    ``copies`` is the number of times the mix takes the row: target / source
    size rounded up or down, so never more than ``cap`` rounded up. A null
    source is a source of its own. Where all rows of a source are of size 0
    nothing is taken from it. Repeated rows count one by one. Columns of
    ``docs`` with the names of the new ones are replaced. The table is read
    four times; pass one that is cheap to read.

    The order within a source is size, then a digest of the id. Runs of equal
    size above ``block_rows`` rows (of which at most 100,000 are broadcast)
    are cut by that digest, and only block counts are added up across tasks,
    so that no source meets in one task.
    """
    new = ["size", "source_size", "target", "copies"]
    inner = {"source": "_mix_source", "size": "_mix_size", "slot": "_mix_slot", "digest": "_mix_digest"}
    source, amount, slot, digest = inner.values()
    table = docs.withColumns({
        amount: size.cast("bigint"),
        source: F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("")),
        digest: F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))),
    })
    runs = stage(table.groupBy(source, amount).agg(F.count(F.lit(1)).alias("n")), "mix-runs")
    total = runs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    block_rows = max(block_rows, -(-total // 100_000))
    digits = F.ceil(F.log(16.0, F.col("n") / F.lit(block_rows))).cast("int")
    long_runs = runs.filter(F.col("n") > block_rows).select(source, amount, digits.alias("_digits"))
    slotted = table.join(F.broadcast(long_runs), [source, amount], "left").withColumn(
        slot, F.coalesce(F.substring(F.col(digest), F.lit(1), F.col("_digits")), F.lit(""))
    ).drop("_digits")

    sizes = runs.groupBy(source).agg(F.sum(F.col(amount) * F.col("n")).alias("source_size"))
    real = F.when(F.col(source) == "", None).otherwise(F.substring(F.col(source), 2, 1 << 30))
    targets = source_targets(sizes.withColumn("source", real), weights, cap)
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce("source", F.lit("")))), 1, 12), 16, 10).cast("double") / float(1 << 48)
    targets = targets.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias(source), "source_size", "target", draw.alias("_draw"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"),
    )

    octave = F.floor(F.log2(F.col(amount) + 1.0) * 8)
    blocks = slotted.groupBy(source, amount, slot).agg(F.count(F.lit(1)).alias("_n")).withColumn("_octave", octave)
    inside = Window.partitionBy(source, "_octave").orderBy(amount, slot).rowsBetween(Window.unboundedPreceding, -1)
    octaves = blocks.groupBy(source, "_octave").agg(F.sum("_n").alias("_n"))
    below = Window.partitionBy(source).orderBy("_octave").rowsBetween(Window.unboundedPreceding, -1)
    starts = octaves.select(source, "_octave", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_start"))
    offsets = (
        blocks.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(starts, [source, "_octave"])
        .join(targets, source)
        .select(source, amount, slot, (F.col("_start") + F.col("_inside")).alias("_before"), "source_size", "target", "_rate", "_draw")
    )
    offsets = stage(offsets, "mix-offsets")

    place = F.row_number().over(Window.partitionBy(source, amount, slot).orderBy(digest, F.asc_nulls_last(id_col))) + F.col("_before")
    crossed = F.floor(place * F.col("_rate") + F.col("_draw")) - F.floor((place - 1) * F.col("_rate") + F.col("_draw"))
    kept = slotted.drop(*new)
    return (
        kept.join(offsets, [source, amount, slot])
        .withColumn("copies", crossed.cast("bigint"))
        .withColumnRenamed(amount, "size")
        .select(*kept.drop(source, amount, slot, digest).columns, *new)
    )


def mix(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, columns as they were.

    Sizes are word counts of whole texts; options as in :func:`expected_copies`.
    """
    columns = docs.columns
    packed = docs.select(F.struct(*columns).alias("_row"), F.col(options.pop("id_col", "doc_id")).alias("_id"), F.col(options.pop("source_col", "source")).alias("_source"))
    counted = expected_copies(packed, word_count(F.col("_row")[text_col]), id_col="_id", source_col="_source", **options)
    repeated = counted.select("_row", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))).alias("_copy"), "copies").filter(F.col("copies") > 0)
    return repeated.select("_row.*")

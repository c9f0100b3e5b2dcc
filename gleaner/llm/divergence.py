"""How far the words of one source stray from those of its language.

Every task cuts the Arrow buffers of its texts into slices, points at the start
of each word, and sorts the pointers by the bytes that follow. Runs of equal
words give, per language and source, in how many documents a word stands and
how often. Spark adds these rows up and compares the sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.operators.common import top_k
from gleaner.sources.scratch import stage

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
# Bytes of text whose pointers are sorted together; one document above that is sorted in pieces.
SLICE = 8 << 20
# Up to so many pointers are sorted at once, more are first parted around a pivot.
SMALL = 1 << 16
SYMBOL = 8

SHARD_SCHEMA = "lang string, source string, term string, docs bigint, n bigint"


def word_starts(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words in ``data``; no word crosses one of ``borders``.

    Letters A to Z and a to z and all bytes beyond ASCII belong to words.
    """
    is_word = np.zeros(256, bool)
    is_word[0x41:0x5B] = is_word[0x61:0x7B] = is_word[0x80:] = True
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    borders = borders[(borders > 0) & (borders < len(data))]
    first[borders] = inside[1:-1][borders]
    last[borders - 1] = inside[1:-1][borders - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def _symbols(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each word from ``depth`` on as one number, zero behind the word's end."""
    left = np.clip(lengths - depth, 0, SYMBOL)
    at = np.minimum(starts + depth, len(data) - SYMBOL)[:, None] + np.arange(SYMBOL)
    held = data[at]
    held[np.arange(SYMBOL) >= left[:, None]] = 0
    return held.view(">u8").ravel().astype(np.uint64)


def sort_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """Pointers in the order of their words, and whether each differs from the one before.

    A multikey quicksort on symbols of eight bytes: pointers are parted into
    those below, at and above a pivot, and the middle part goes on with the
    next symbol. Parts of up to ``small`` pointers are finished by sorting on
    one symbol after the other. ``data`` must end in eight spare bytes. Equal
    words keep the order of their pointers.
    """
    order = np.arange(len(starts))
    fresh = np.zeros(len(starts), bool)
    parts = [(0, len(starts), 0)]
    while parts:
        low, high, depth = parts.pop()
        if high <= low:
            continue
        fresh[low] = True
        held = order[low:high]
        if high - low <= small:
            order[low:high], fresh[low:high] = _finish(data, starts, lengths, held, depth)
            continue
        symbols = _symbols(data, starts[held], lengths[held], depth)
        pivot = np.partition(symbols[:: max(1, len(symbols) // 255)], 127)[127]
        below, equal = symbols < pivot, symbols == pivot
        middle = held[equal]
        order[low:high] = np.concatenate([held[below], middle, held[~below & ~equal]])
        first = low + int(below.sum())
        second = first + len(middle)
        parts += [(low, first, depth), (second, high, depth)]
        if (lengths[middle] > depth + SYMBOL).any():
            parts.append((first, second, depth + SYMBOL))
        else:
            fresh[first] = True
    return order, fresh


def _finish(data, starts, lengths, held, depth) -> tuple[np.ndarray, np.ndarray]:
    """Sort a small part by its symbols; only words that are still alike go on to the next one."""
    held = held.copy()
    run = np.zeros(len(held), np.int64)
    open_ = np.arange(len(held))
    while len(open_):
        words = held[open_]
        symbols = _symbols(data, starts[words], lengths[words], depth)
        rank = np.lexsort((symbols, run[open_]))
        held[open_], symbols = words[rank], symbols[rank]
        place = run[open_]
        new = np.ones(len(open_), bool)
        new[1:] = (place[1:] != place[:-1]) | (symbols[1:] != symbols[:-1])
        # a run is named by the place of its first pointer, so that names stay in order
        run[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        depth += SYMBOL
        longer = lengths[held[open_]] > depth
        alive = np.bincount(run[open_], weights=longer, minlength=len(held)) > 0
        open_ = open_[alive[run[open_]]]
    fresh = np.ones(len(held), bool)
    fresh[1:] = run[1:] != run[:-1]
    return held, fresh


def _strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The words at ``starts`` as an Arrow array."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    taken = data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(taken)).cast(pa.string())


def count_slice(data: np.ndarray, borders: np.ndarray, group: np.ndarray, small: int = SMALL) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words, groups, documents and occurrences of one slice.

    Document i lies between ``borders[i]`` and ``borders[i + 1]`` and belongs to ``group[i]``.
    """
    lowered = np.zeros(len(data) + SYMBOL, np.uint8)
    lowered[: len(data)] = data + (((data >= 0x41) & (data <= 0x5A)) * np.uint8(0x20))
    starts, lengths = word_starts(lowered[: len(data)], borders)
    order, fresh = sort_words(lowered, starts, lengths, small)
    document = (np.searchsorted(borders, starts, side="right") - 1)[order]
    run = np.cumsum(fresh) - 1
    new_document = fresh.copy()
    new_document[1:] |= document[1:] != document[:-1]
    width = int(group.max()) + 1 if len(group) else 1
    cell = run * width + group[document]
    cells, n = np.unique(cell, return_counts=True)
    docs = np.unique(cell[new_document], return_counts=True)[1]
    heads = order[fresh]
    return _strings(lowered, starts[heads], lengths[heads]).take(pa.array(cells // width)), cells % width, docs, n


def _pieces(data: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``size`` bytes, cut behind a byte that no word holds."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data):
            gap = np.flatnonzero(data[end : end + size] < 0x41)
            if len(gap):
                end += int(gap[0]) + 1
                break
            end += size
        yield data[at : min(end, len(data))]
        at = end


def shard_counts(docs: DataFrame, slice_bytes: int = SLICE, small: int = SMALL) -> DataFrame:
    """``(lang, source, term, docs, n)`` per slice of ``docs(lang, source, text)``, none of them null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(langs, sources, words, group, documents, n):
            columns = [langs.take(pa.array(group)), sources.take(pa.array(group)), words, pa.array(documents, pa.int64()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "docs", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            known = sorted(set(pairs))
            number = {pair: i for i, pair in enumerate(known)}
            group = np.array([number[pair] for pair in pairs], np.int64)
            langs, sources = (pa.array([pair[k] for pair in known], pa.string()) for k in (0, 1))
            texts = batch.column(2).cast(pa.large_string())
            _, offsets, held = texts.buffers()
            borders = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
            first = 0
            while first < len(group):
                last = max(first + 1, int(np.searchsorted(borders, borders[first] + slice_bytes, side="right")) - 1)
                piece = data[borders[first] : borders[last]]
                if last == first + 1 and len(piece) > slice_bytes:
                    parts = [count_slice(p, np.array([0, len(p)]), group[first:last], small) for p in _pieces(piece, slice_bytes)]
                    merged = pa.table({"term": pa.concat_arrays([p[0] for p in parts]), "n": np.concatenate([p[3] for p in parts])})
                    merged = merged.group_by("term").aggregate([("n", "sum")])
                    size = merged.num_rows
                    yield rows(langs, sources, merged["term"].combine_chunks(), np.full(size, group[first]), np.ones(size, np.int64), merged["n_sum"].to_numpy())
                else:
                    yield rows(langs, sources, *count_slice(piece, borders[first : last + 1] - borders[first], group[first:last], small))
                first = last

    return docs.select("lang", "source", "text").mapInArrow(count, SHARD_SCHEMA)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact for counts of any size."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    return 1 + F.call_function("div", above, F.greatest(total + 2 * kept, F.lit(1)).cast("decimal(19,0)"))


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two positive whole numbers."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit_sources(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_docs: int = MIN_DOCS, top: int = TOP_TERMS, slice_bytes: int = SLICE, small: int = SMALL,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: distances between sources, and the terms that set a source apart.

    A null text, language or source counts as an empty one. Only terms found
    in ``min_docs`` documents of a language count there. Part ``pair`` names
    every other source of the language, part ``term`` the ``top`` terms that
    the source uses more than its language does. Repeated rows are documents
    of their own. An empty table gives an empty one; a language without a kept
    term has distance 0 between all its sources. Other columns are ignored.

    A term meets all sources that use it as one row, so a row is no longer
    than the list of a language's sources; the result itself has the square of
    that. Terms that neither of two sources uses are counted, not visited.
    """
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = shard_counts(given, slice_bytes, small).groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    kept = stage(
        counts.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("uses"))
        .filter(F.col("docs") >= min_docs).drop("docs"),
        "kept-terms",
    )
    uses = kept.select("lang", "term", "lang_n", F.inline("uses"))

    occurring = given.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents")).drop("documents")
    in_source = uses.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    zero = F.lit(0).cast("bigint")
    groups = (
        occurring.join(in_source, ["lang", "source"], "left").join(in_lang, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")])
        .withColumn("absent", share(zero, F.col("total"), F.col("kept")))
    )
    groups = stage(groups, "source-totals")  # as many rows as there are sources: the plan measures it before it sends it anywhere
    first = groups.select("lang", F.col("source").alias("a"), "kept", F.col("total").alias("a_total"), F.col("absent").alias("a_absent"))
    second = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("b_total"), F.col("absent").alias("b_absent"))
    pairs = first.join(second, "lang").filter("a <> b")
    neither = distance(F.col("a_absent"), F.col("b_absent"))

    # every kept term as if neither source used it, then corrected where one does and where both do
    base = pairs.select("lang", "a", "b", (F.col("kept") * neither).alias("v"))
    used = uses.groupBy("lang", F.col("source").alias("a"), "n").agg(F.count(F.lit(1)).alias("terms"))
    one = (
        used.join(first, ["lang", "a"]).join(second, "lang").filter("a <> b")
        .groupBy("lang", "a", "b")
        .agg(F.sum(F.col("terms") * (distance(share(F.col("n"), F.col("a_total"), F.col("kept")), F.col("b_absent")) - neither)).alias("v"))
    )
    both = (
        kept.select("lang", F.posexplode("uses").alias("i", "x"), "uses")
        .select("lang", F.col("x.source").alias("a"), F.col("x.n").alias("a_n"), F.explode(F.slice("uses", F.col("i") + 2, F.size("uses"))).alias("y"))
        .select("lang", "a", "a_n", F.col("y.source").alias("b"), F.col("y.n").alias("b_n"))
        .join(first, ["lang", "a"]).join(second, ["lang", "b"])
        .withColumn("p", share(F.col("a_n"), F.col("a_total"), F.col("kept")))
        .withColumn("q", share(F.col("b_n"), F.col("b_total"), F.col("kept")))
        .groupBy("lang", "a", "b")
        .agg(F.sum(distance(F.col("p"), F.col("q")) - distance(F.col("p"), F.col("b_absent")) - distance(F.col("a_absent"), F.col("q")) + neither).alias("v"))
    )
    turned = lambda df: df.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "v")
    sums = base.unionByName(one).unionByName(turned(one)).unionByName(both).unionByName(turned(both))
    near = sums.groupBy("lang", "a", "b").agg(F.sum("v").alias("value"))
    pair_rows = near.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")

    own = share(F.col("n"), F.col("total"), F.col("kept"))
    usual = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    term_rows = (
        uses.join(groups, ["lang", "source"]).withColumn("p", own).withColumn("q", usual).filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    )
    order = [F.desc("value"), F.asc("item")]
    by = ["lang", "source", "part"]
    whole = pair_rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    best = top_k(term_rows, by, order, top).withColumn("rank", F.col("rank").cast("int"))
    return whole.unionByName(best)

"""Language identification by rank-order profiles.

A profile lists a language's most frequent letter n-grams by rank. A document's
own most frequent n-grams are compared with each profile: the distance is the
sum of the places by which they are out of order, a missing one counting as
the whole profile's length. The nearest language wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.llm.memo import fresh, per_worker, received, sent
from gleaner.operators.common import top_k

UNKNOWN = "und"
PROFILE = 400
OWN = 300
CHUNK = 1 << 20
GAP = 1  # stands for anything between two words


def letters_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of several (codes, counts)."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)


def grams(text: str, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the 1-, 2- and 3-grams of a text in lower case; none without letters.

    Anything but letters is a gap, and one gap stands at either end. A code
    packs up to three characters of 21 bits. Long texts are counted in pieces
    that share two characters.
    """
    parts, tail = [], np.array([GAP], np.int64)
    for at in range(0, len(text), CHUNK):
        points = np.frombuffer(text[at : at + CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        new = np.where(is_letter[points], points, GAP).astype(np.int64)
        if at + CHUNK >= len(text):
            new = np.append(new, GAP)
        run = np.concatenate([tail[-1:], new])
        new = new[(new != GAP) | (run[:-1] != GAP)]
        line = np.concatenate([tail, new])
        old = len(tail)
        codes = [new[new != GAP]]
        for n in (2, 3):
            if len(line) >= n:
                code = line[: len(line) - n + 1].copy()
                for k in range(1, n):
                    code = (code << 21) | line[k : len(line) - n + 1 + k]
                codes.append(code[max(0, old - n + 1) :])
        values, counts = np.unique(np.concatenate(codes), return_counts=True)
        parts.append((values, counts))
        tail = line[-2:]
    codes, counts = parts[0] if len(parts) == 1 else merged(parts)
    return (codes, counts) if len(codes) and codes[0] < 1 << 21 else (codes[:0], counts[:0])


def ranked(codes: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    return codes[np.lexsort((codes, -counts))[:length]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", length: int = PROFILE) -> DataFrame:
    """Profiles (lang, gram, rank) from all rows of ``docs`` with a language and a text.

    Each task adds up its own counts before anything is exchanged.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = per_worker("letters", letters_table)
        held: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts = held.setdefault(lang, [])
                parts.append(grams(text.as_py(), table))
                if len(parts) >= 512:
                    held[lang] = [merged(parts)]
        for lang, parts in held.items():
            codes, counts = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], ["lang", "gram", "n"]
            )

    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return top_k(counts, ["lang"], [F.desc("n"), F.asc("gram")], length).select("lang", "gram", (F.col("rank") - 1).alias("rank"))


class Profiles:
    """Ranks of all profiled n-grams in all languages, for whole-array comparison."""

    def __init__(self, rows: list[tuple[str, int, int]], length: int):
        self.length = length
        self.langs = sorted({r[0] for r in rows})
        self.codes = np.unique(np.array([r[1] for r in rows], np.int64))
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), -1, np.int32)
        number = {lang: n for n, lang in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.ranks[number[lang], np.searchsorted(self.codes, gram)] = rank

    def nearest(self, own: np.ndarray) -> tuple[str, float]:
        """Language of the least distance (the first of equals) and 1 less the distance as a share of the greatest possible."""
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != own] = len(self.codes)
        ranks = self.ranks[:, at]
        apart = np.where(ranks < 0, self.length, np.minimum(np.abs(ranks - np.arange(len(own))), self.length)).sum(axis=1)
        best = int(np.argmin(apart))
        return self.langs[best], 1.0 - float(apart[best]) / (self.length * len(own))


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = PROFILE, own: int = OWN, max_langs: int = 10_000) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) for every row; columns of those names are replaced.

    The whole text counts. A null text, one without letters, and any text
    when nothing was learned are ``und`` with score 0. Profiles are collected:
    at most ``length`` rows for each of at most ``max_langs`` languages, more
    is an error.
    """
    rows = [tuple(r) for r in profiles.limit(length * max_langs + 1).collect()]
    if len(rows) > length * max_langs:
        raise ValueError(f"more than {max_langs} languages")
    known = Profiles(rows, length)
    inner = fresh("_text", docs.columns)
    spark = docs.sparkSession
    shared = sent(spark.sparkContext, known)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = per_worker("letters", letters_table)
        profiles_here = received(shared)
        for batch in batches:
            found = [profiles_here.nearest(ranked(*grams(t.as_py() or "", table), own)) if t.is_valid and len(t.as_py()) else (UNKNOWN, 0.0) for t in batch.column(inner)]
            columns = [batch.column(n) for n in batch.schema.names if n != inner]
            names = [n for n in batch.schema.names if n != inner]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*names, "lang_pred", "score"]
            )

    kept = docs.drop("lang_pred", "score")
    if text_col in ("lang_pred", "score"):
        raise ValueError("the text column has the name of a result")
    schema = StructType(list(kept.schema.fields)).add("lang_pred", "string").add("score", "double")
    return kept.withColumn(inner, F.col(text_col)).mapInArrow(predict, schema)

"""Quality scores by a factorisation machine.

Features are hashed words, binned structure statistics and metadata. The score
is the logistic of a bias, linear weights and all pairwise interactions, whose
weights are inner products of short vectors; the sum over pairs is half the
square of the sum less the sum of the squares, so it takes linear time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.llm.memo import Memo, fresh, per_worker, received, sent

WORDS = 1 << 16
BINS = 12
MEMO_WORDS = 200_000
CLASSES = np.zeros(256, np.uint8)
for _class, _bytes in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:?'\"-()", b"!"], 1):
    CLASSES[list(_bytes)] = _class
CLASSES[128:] = 8
STATISTICS = 14


def statistics(text: str, numbers: np.ndarray, counts: np.ndarray, n_words: int, n_chars: int | None) -> list[float]:
    """Shares between 0 and 1 that describe the build of a text, then metadata."""
    kinds = np.bincount(CLASSES[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)], minlength=9)
    size = max(1, int(kinds.sum()))
    letters = max(1, int(kinds[1] + kinds[2] + kinds[8]))
    n = max(1, n_words)
    lines = int(kinds[5]) + 1
    return [
        kinds[2] / letters, kinds[3] / size * 4, kinds[6] / size * 8, kinds[7] / size * 8, kinds[0] / size * 8, kinds[4] / size * 2,
        len(counts) / n, (counts.max() if len(counts) else 0) / n, float((counts > 1).sum()) / max(1, len(counts)),
        min(1.0, size / n / 16), min(1.0, n / lines / 100), np.log1p(n) / 12,
        np.log1p(size) / 16, np.log1p(max(0, n_chars if n_chars is not None else len(text))) / 16,
    ]


class Features:
    """Feature numbers and values of whole texts."""

    def __init__(self):
        self.words = Memo(lambda word: zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORDS, MEMO_WORDS)

    def of(self, text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
        split = text.split()
        hashed = np.fromiter(map(self.words.__getitem__, split), np.int64, len(split))
        numbers, counts = np.unique(hashed, return_counts=True)
        weights = np.log1p(counts)
        weights = weights / max(1e-9, float(np.sqrt((weights * weights).sum())))
        stats = np.clip(np.array(statistics(text, numbers, counts, len(split), n_chars)), 0, 1)
        bins = WORDS + np.arange(STATISTICS) * BINS + np.minimum((stats * BINS).astype(np.int64), BINS - 1)
        return np.concatenate([numbers, bins]).astype(np.int32), np.concatenate([weights, np.full(STATISTICS, 0.5)]).astype(np.float32)


class Machine:
    """Weights of the factorisation machine; trained with adaptive gradients."""

    def __init__(self, rank: int = 8, seed: int = 7):
        size = WORDS + STATISTICS * BINS
        self.bias = 0.0
        self.linear = np.zeros(size, np.float32)
        self.factors = np.random.default_rng(seed).normal(0, 0.05, (size, rank)).astype(np.float32)

    def margin(self, numbers: np.ndarray, values: np.ndarray) -> float:
        rows = self.factors[numbers] * values[:, None]
        total = rows.sum(axis=0)
        return self.bias + float(self.linear[numbers] @ values) + 0.5 * float(total @ total - (rows * rows).sum())

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.08, decay: float = 1e-5, seed: int = 7) -> "Machine":
        """Logistic loss over mini-batches; without both labels only the bias is set."""
        share = (float(labels.sum()) + 0.5) / (len(labels) + 1.0)
        self.bias = float(np.log(share / (1 - share)))
        if not len(labels) or labels.min() == labels.max():
            return self
        random = np.random.default_rng(seed)
        seen_linear = np.full(self.linear.shape, 1e-6, np.float32)
        seen_factors = np.full(self.factors.shape, 1e-6, np.float32)
        for _ in range(epochs):
            order = random.permutation(len(rows))
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                lengths = np.array([len(rows[i][0]) for i in part])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                numbers = np.concatenate([rows[i][0] for i in part])
                values = np.concatenate([rows[i][1] for i in part])
                scaled = self.factors[numbers] * values[:, None]
                totals = np.add.reduceat(scaled, starts, axis=0)
                margins = self.bias + np.add.reduceat(self.linear[numbers] * values, starts) + 0.5 * ((totals * totals).sum(1) - np.add.reduceat((scaled * scaled).sum(1), starts))
                errors = 1 / (1 + np.exp(-np.clip(margins, -30, 30))) - labels[part]
                self.bias -= rate * 0.1 * float(errors.mean())
                weight = np.repeat(errors, lengths).astype(np.float32) * values
                steps = weight[:, None] * (np.repeat(totals, lengths, axis=0) - scaled)
                used, where = np.unique(numbers, return_inverse=True)
                by = np.argsort(where, kind="stable")
                firsts = np.searchsorted(where[by], np.arange(len(used)))
                linear = np.add.reduceat(weight[by], firsts) + decay * self.linear[used]
                factors = np.add.reduceat(steps[by], firsts, axis=0) + decay * self.factors[used]
                seen_linear[used] += linear * linear
                seen_factors[used] += factors * factors
                self.linear[used] -= rate * linear / np.sqrt(seen_linear[used])
                self.factors[used] -= rate * 0.5 * factors / np.sqrt(seen_factors[used])
        return self


def learn_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str | None = "n_chars", label_col: str = "quality", sample: int = 10_000) -> Machine:
    """Train on at most ``sample`` labelled ids, those with the smallest hash.

    Rows without a label or an id are left out of training; of repeated ids
    one row is taken. With no labelled row the machine gives one half.
    """
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label"))
        .dropna().groupBy("_id").agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = per_worker("quality features", Features)
        for batch in batches:
            made = [make.of(t.as_py(), c) for t, c in zip(batch.column("_text"), batch.column("_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array([m[0].tobytes() for m in made], pa.binary()), pa.array([m[1].tobytes() for m in made], pa.binary())],
                ["_id", "_label", "numbers", "values"],
            )

    n_chars = F.col(n_chars_col).cast("bigint") if n_chars_col else F.lit(None).cast("bigint")
    joined = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), n_chars.alias("_chars")).join(F.broadcast(chosen), "_id")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = (
        joined.select("_id", "_label", "_text", "_chars").mapInArrow(features, f"_id {id_type}, _label double, numbers binary, values binary")
        .dropDuplicates(["_id"]).orderBy("_id").collect()
    )
    pairs = [(np.frombuffer(r["numbers"], np.int32), np.frombuffer(r["values"], np.float32)) for r in rows]
    return Machine().fit(pairs, np.array([r["_label"] for r in rows], np.float64))


def score_quality(docs: DataFrame, machine: Machine, text_col: str = "text", n_chars_col: str | None = "n_chars", threshold: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on) for every row; columns of those names are replaced.

    The whole text counts, a null one as empty; empty texts are scored by
    their statistics. A null n_chars is the text's length.
    """
    inner, inner_chars = fresh("_text", docs.columns), fresh("_chars", docs.columns)
    shared = sent(docs.sparkSession.sparkContext, machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = per_worker("quality features", Features)
        model = received(shared)
        for batch in batches:
            margins = [model.margin(*make.of(t.as_py(), c)) for t, c in zip(batch.column(inner), batch.column(inner_chars).to_pylist())]
            scores = 1 / (1 + np.exp(-np.clip(np.array(margins, np.float64), -30, 30)))
            names = [n for n in batch.schema.names if n not in (inner, inner_chars)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32), pa.int32())], [*names, "score", "predicted"]
            )

    kept = docs.drop("score", "predicted")
    n_chars = F.col(n_chars_col).cast("bigint") if n_chars_col else F.lit(None).cast("bigint")
    schema = StructType(list(kept.schema.fields)).add("score", "double").add("predicted", "integer")
    return kept.withColumns({inner: F.coalesce(F.col(text_col), F.lit("")), inner_chars: n_chars}).mapInArrow(score, schema)

"""Calling an external model over a table, and the default encoder.

A model is any function from a list of row dictionaries to a list of results.
It runs inside the tasks; the number of partitions bounds how many calls are
open at once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gleaner.functions import text as tx

EMBED_BATCH = 10
# Fixed value: the published instruction of the usual encoder.
QUERY_INSTRUCTION = "Instruct: Given a web search query, retrieve relevant passages that answer the query\nQuery:"

Model = Callable[[list[dict[str, Any]]], Sequence[Any]]


def map_model(
    df: DataFrame, model: Model, inputs: Sequence[str], output: str, output_type: T.DataType,
    batch_size: int = EMBED_BATCH, attempts: int = 3, pause: float = 0.0, workers: int | None = None,
) -> DataFrame:
    """Adds ``output`` and ``error`` by calling ``model`` on batches of rows.

    A batch that keeps failing is retried row by row, so that one bad row costs
    neither the run nor its neighbours: its ``output`` is null and ``error``
    holds the reason. Columns that the model does not read pass through as they
    are. A running task is one open call: ``workers`` deals the rows to that
    many callers, None leaves the partitioning as it is.
    """
    arrow_type = to_arrow_type(output_type)
    fields = [*df.schema.fields, T.StructField(output, output_type), T.StructField("error", T.StringType())]
    columns = list(inputs)

    def call(rows: list[dict[str, Any]]) -> tuple[list[Any], str | None]:
        reason = None
        for attempt in range(attempts):
            try:
                answers = list(model(rows))
                if len(answers) != len(rows):
                    raise ValueError(f"model returned {len(answers)} results for {len(rows)} rows")
                return answers, None
            except Exception as failure:
                reason = f"{type(failure).__name__}: {failure}"
                if attempt + 1 < attempts and pause:
                    time.sleep(pause * 2**attempt)
        return [None] * len(rows), reason

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(columns).to_pylist()
            results: list[Any] = []
            errors: list[str | None] = []
            for start in range(0, len(rows), batch_size):
                part = rows[start : start + batch_size]
                answers, reason = call(part)
                if reason is None:
                    results += answers
                    errors += [None] * len(part)
                else:
                    for row in part:
                        answer, reason = call([row])
                        results += answer
                        errors.append(reason)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(results, arrow_type), pa.array(errors, pa.string())], [*batch.schema.names, output, "error"])

    source = df if workers is None else df.repartition(workers)
    return source.mapInArrow(run, T.StructType(fields))


def split_failures(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that succeeded, and rows with an ``error``."""
    return df.filter(F.col("error").isNull()).drop("error"), df.filter(F.col("error").isNotNull())


def as_query(text: Column) -> Column:
    """Query text for an instruction-tuned encoder; documents are embedded without it."""
    return F.concat(F.lit(QUERY_INSTRUCTION), text)


def fit_encoder(chunks: DataFrame, dim: int = 256) -> Callable[[DataFrame], DataFrame]:
    """Default encoder: hashed term counts weighted by rarity, scaled to unit length.

    Fitting reads the corpus once for the ``dim`` document frequencies. The
    returned function adds ``embedding`` to any frame with a ``text`` column.
    """
    stages = Pipeline(stages=[
        HashingTF(inputCol="_terms", outputCol="_counts", numFeatures=dim),
        IDF(inputCol="_counts", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="_unit"),
    ])
    fitted = stages.fit(chunks.select(tx.terms(F.col("text")).alias("_terms")))

    def encode(df: DataFrame) -> DataFrame:
        return (
            fitted.transform(df.withColumn("_terms", tx.terms(F.col("text"))))
            .withColumn("embedding", vector_to_array("_unit", "float32"))
            .drop("_terms", "_counts", "_weighted", "_unit")
        )

    return encode


def tokenizer_count(encode: Callable[[str], Sequence[int]]) -> Callable[[Column], Column]:
    """Token counter from a tokenizer's ``encode`` function, run on Arrow batches."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(encode(t)), na_action="ignore").astype("Int64")

    return count

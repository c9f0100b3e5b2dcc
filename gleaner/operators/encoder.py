"""The default encoder: signed hashed terms weighted by rarity, as a table that can be saved.

A term has a slot and a sign, both read off its md5, and a slot has a weight
from the number of chunks that use it. The table of weights is all there is to
an encoder: saved and loaded, it encodes questions a year later as it encoded
the chunks, in Spark or in any SQL that has md5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import text as tx
from gleaner.operators.common import require_rows
from gleaner.operators.models import as_query

DIM = 512
DIGITS = 6
# Hex digits of the md5 that give the slot, and the digit whose parity gives the sign.
SLOT_DIGITS, SIGN_DIGIT = 6, 7


def slot(term: Column, dim: int) -> Column:
    return (F.conv(F.substring(F.md5(term), 1, SLOT_DIGITS), 16, 10).cast("bigint") % dim).cast("int")


def fit_table(chunks: DataFrame, dim: int = DIM) -> DataFrame:
    """``(slot, df, idf)``, one row per slot, from one pass over ``chunks(text)``; needs no key."""
    slots = F.array_distinct(F.transform(tx.terms(F.col("text")), lambda t: slot(t, dim)))
    held = chunks.select(F.coalesce(slots, F.array().cast("array<int>")).alias("slots"))
    total = held.agg(F.count(F.lit(1)).alias("n"))
    used = held.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("df"))
    every = chunks.sparkSession.range(dim).select(F.col("id").cast("int").alias("slot"))
    # every slot has a row, and the number of chunks is a single one
    counted = every.join(used, "slot", "left").crossJoin(F.broadcast(total)).withColumn("df", F.coalesce("df", F.lit(0).cast("bigint")))
    return counted.select("slot", "df", F.log((F.col("n") + 1) / (F.col("df") + 1)).alias("idf"))


def save_encoder(table: DataFrame, path: str) -> None:
    table.coalesce(1).write.mode("overwrite").parquet(path)


def load_encoder(spark: SparkSession, path: str) -> DataFrame:
    return require_rows(spark.read.parquet(path), f"encoder {path}")


def encode(df: DataFrame, table: DataFrame, text: str = "text", output: str = "embedding") -> DataFrame:
    """``df`` with ``output``, the encoded ``text`` as an array of floats of unit length.

    Null where the text is null or names nothing that the weights tell apart.
    Only the weights, one number per slot, travel to the tasks. A term is
    digested once per task, and the rows of a batch are summed as a matrix.
    """
    weights = np.array([row["idf"] for row in table.select("slot", "idf").orderBy("slot").collect()])
    dim = len(weights)
    known_limit = 200_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, int]] = {}

        def place(term: str) -> tuple[int, int]:
            digest = hashlib.md5(term.encode("utf-8", "surrogatepass")).hexdigest()
            return int(digest[:SLOT_DIGITS], 16) % dim, 1 - 2 * (int(digest[SLOT_DIGITS], 16) % 2)

        for whole in batches:
            # a slice at a time bounds the matrix
            for first in range(0, whole.num_rows, 1024):
                batch = whole.slice(first, 1024)
                lists = batch.column(batch.num_columns - 1)
                terms = lists.flatten().dictionary_encode()
                if len(known) > known_limit:
                    known.clear()
                places = []
                for term in terms.dictionary.to_pylist():
                    found = known.get(term)
                    if found is None:
                        found = known[term] = place(term)
                    places.append(found)
                spots, signs = np.array(places, np.int64).reshape(-1, 2).T
                code = terms.indices.to_numpy()
                sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()], np.int64)
                row = np.repeat(np.arange(len(lists)), sizes)
                summed = np.bincount(row * dim + spots[code], weights=signs[code], minlength=len(lists) * dim).reshape(len(lists), dim) * weights
                norm = np.sqrt((summed**2).sum(axis=1))
                unit = np.round(summed / np.where(norm > 0, norm, 1)[:, None], DIGITS).astype(np.float32)
                # rows without a direction are null
                some = norm > 0
                offsets = pa.array(np.append(np.cumsum(np.where(some, dim, 0)) - np.where(some, dim, 0), some.sum() * dim), pa.int32())
                encoded = pa.ListArray.from_arrays(offsets, pa.array(unit[some].ravel(), pa.float32()), mask=pa.array(~some))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], encoded], [*batch.schema.names[:-1], output])

    kept = df.drop(output)
    schema = T.StructType([*kept.schema.fields, T.StructField(output, T.ArrayType(T.FloatType()))])
    return kept.withColumn("_terms", tx.terms(F.col(text))).mapInArrow(run, schema)


def encode_queries(queries: DataFrame, table: DataFrame, instruct: bool = True) -> DataFrame:
    """``(query_id, embedding)`` of ``queries(query_id, text)``, led by the instruction that tells a question from a passage."""
    asked = as_query(F.col("text")) if instruct else F.col("text")
    return encode(queries.select("query_id", asked.alias("text")), table).select("query_id", "embedding")

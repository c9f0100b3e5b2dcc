"""Summing fixed-size count arrays over all tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

STRIPE = 1 << 14
WIDTHS = (1, 2, 4, 8)
SCHEMA = "stripe int, part int, cells binary"


def stripes_of(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's own counts, whose number is a multiple of ``STRIPE``, as rows to be summed; in as few bytes as the largest needs."""
    part = TaskContext.get().partitionId() // 64
    for number, stripe in enumerate(total.reshape(-1, STRIPE)):
        most = int(stripe.max())
        if not most:
            continue
        small = stripe.astype(next(f"<u{width}" for width in WIDTHS if most < 1 << 8 * width))
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([part], pa.int32()), pa.array([small.tobytes()], pa.binary())], ["stripe", "part", "cells"])


def sum_stripes(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of the arrays of all tasks, ``size`` counts long whatever the number of rows.

    Stripes meet by sixty-fours of tasks first, so that no group grows beyond
    what one task holds.
    """

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(STRIPE, np.int64)
        for cells in rows["cells"]:
            total += np.frombuffer(cells, f"<u{len(cells) // STRIPE}").astype(np.int64)
        return pd.DataFrame({"stripe": rows["stripe"].iloc[:1].astype("int32"), "part": rows["part"].iloc[:1].astype("int32"), "cells": [total.tobytes()]})

    result = np.zeros((size // STRIPE, STRIPE), np.int64)
    for row in rows.groupBy("stripe", "part").applyInPandas(add, SCHEMA).groupBy("stripe").applyInPandas(add, SCHEMA).collect():
        result[row["stripe"]] = np.frombuffer(row["cells"], np.int64)
    return result.reshape(-1)

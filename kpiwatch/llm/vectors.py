"""What the operators on embeddings share: which rows take part, and their numpy form."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwatch.llm.common import shared_folder


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, e (array<double>): the rows whose vector holds no null and no non-finite component.

    Empty vectors take no part. Vectors of another width than the most common one (of several, the
    widest) can't be compared with the others and take no part either. Rows may repeat, and vec_id may be null.
    """
    e = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    good = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    e = e.filter((F.size("e") > 0) & F.coalesce(good, F.lit(False)))
    common = e.groupBy(F.size("e").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return e.filter(F.size("e") == (common.width if common else 0))


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back: many passes read it, none recomputes it."""
    path = f"{shared_folder(df.sparkSession)}/vectors-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column as a matrix with a row for each list; all lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a list column."""
    offsets = np.arange(0, rows.size + 1, rows.shape[1] if rows.shape[1] else 1, dtype=np.int32)[: len(rows) + 1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel(), kind))

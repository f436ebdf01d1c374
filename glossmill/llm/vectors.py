"""Checks that the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rows_of(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v array<double>) of the usable rows with an id."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))


def lengths(rows: DataFrame) -> list[int]:
    """How many components the vectors have: in most tables one number. Vectors are compared with
    those of their own length alone, so each length is a table of its own."""
    return sorted(r["d"] for r in rows.select(F.size("v").alias("d")).distinct().collect())


def matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    """(rows, d) of a column of lists of d numbers, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)

"""Intake of embedding vectors: the kept rows, and their entries as whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlake.llm.common import take


def kept(df: DataFrame) -> DataFrame:
    """vec_id, embedding array<double>, label as text, of the rows whose vector is not null and
    holds neither nulls nor non-finite entries. An empty vector is kept."""
    rows = take(df, vec_id="bigint", embedding="array<double>", label="string")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.coalesce(fine, F.lit(False)))


def _floor(x: float, scale: int) -> int:
    return int(x) * scale if abs(x) >= 1 << 52 else math.floor(x * scale)


def whole(column: pa.Array, scale: int, width: int, limit: float) -> np.ndarray:
    """floor(scale * entry) as a matrix of ``width`` columns; shorter vectors end in zeros.
    ``scale`` is a power of two. Of int64 where every magnitude is below ``limit``, else of
    Python integers, exact at any size."""
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    small = not len(flat) or float(np.abs(flat).max()) * scale < limit
    out = np.zeros((len(sizes), width), np.int64 if small else object)
    found = np.floor(flat * scale).astype(np.int64) if small else np.array([_floor(x, scale) for x in flat.tolist()], object)
    out[np.arange(width) < sizes[:, None]] = found
    return out

"""Vectors as matrices, and which rows take part."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>, dim) of the rows that take part: id and vector not null, not empty or all zero, every
    component finite. Rows that repeat id and vector are one row. Other columns are not read."""
    v = F.col(embedding).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    return rows.withColumn("dim", F.size("v"))


def matrix(column) -> np.ndarray:
    """An Arrow list column of equally long double lists as a matrix; a copy is not made."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere for a seed."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))

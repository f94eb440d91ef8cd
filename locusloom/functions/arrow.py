"""Arrow list columns as NumPy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def dosage_matrix(batch: pa.RecordBatch, column: str, n: int) -> np.ndarray:
    """(rows, n) doubles from a list column, nulls as NaN. Rows of another length fail."""
    lists = batch.column(column)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    if lists.null_count or np.any(lengths != n):
        raise ValueError(f"every {column} array must hold {n} values")
    values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, n)


def fill_with_mean(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(x with each row's gaps filled by its mean, number of gaps per row, mean per row)``."""
    gaps = np.isnan(x)
    n_miss = gaps.sum(axis=1)
    called = x.shape[1] - n_miss
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(gaps, 0.0, x).sum(axis=1) / called
    return np.where(gaps, mean[:, None], x), n_miss, mean

"""Relatedness between samples as one distributed aggregation over markers.

The sample axis is cut into tiles, and a pair of tiles is the largest block anyone holds. Samples that
fit into one tile are multiplied where the markers lie: a task emits one block. Otherwise the
tiles of some markers at a time are dealt to (pair of tiles, group) tasks, which add the products as
they stream in. Dealt dosages are one byte each where they are whole numbers, so with t tiles about
t bytes travel for a dosage, before compression; summing n x n in each of k tasks would send 4 n^2 k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrow import dosage_matrix, fill_with_mean
from ..session import ship_package

#: Dosages that are worked on at once.
BLOCK_CELLS = 4_000_000
#: Samples on a side of a tile: a task holds one block of its square, 134 MB.
SIDE = 4096
#: Groups in which the partial sums of one pair of tiles are added first.
SALTS = 16
#: Stands for a gap among dealt dosages of one byte.
_GAP = -1


def _usable(x: np.ndarray, n_miss: np.ndarray, mean: np.ndarray, var: np.ndarray, maf: float, max_missing: float):
    af = mean / 2.0
    with np.errstate(invalid="ignore"):
        return (n_miss <= max_missing * x.shape[1]) & (np.minimum(af, 1.0 - af) >= maf) & (var > 1e-12)


def _tiles(n: int, side: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(0, n, side) for j in range(i, n, side)]


def _block_row(i: int, j: int, salt: int, block: np.ndarray, used: int) -> pa.RecordBatch:
    columns = [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([salt], pa.int32())]
    columns += [pa.array([block.ravel()], pa.list_(pa.float64())), pa.array([used], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["i", "j", "salt", "block", "m"])


_BLOCK = "i int, j int, salt int, block array<double>, m long"
_DEALT = "i int, j int, salt int, used int, whole boolean, left binary, right binary, mean binary, scale binary"


def _markers(geno: Iterator[pa.RecordBatch], n: int, standardize: bool, maf: float, max_missing: float) -> Iterator[tuple[np.ndarray, ...]]:
    """``(dosages, mean, scale)`` of the markers that count, some rows at a time; gaps are NaN."""
    rows = max(1, BLOCK_CELLS // n)
    for batch in geno:
        for start in range(0, batch.num_rows, rows):
            raw = dosage_matrix(batch.slice(start, rows), "dosage", n)
            x, n_miss, mean = fill_with_mean(raw)
            var = (x * x).mean(axis=1) - mean * mean
            keep = _usable(x, n_miss, mean, var, maf, max_missing)
            if keep.any():
                yield raw[keep], mean[keep], np.sqrt(var[keep]) if standardize else np.ones(int(keep.sum()))


def _centred(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = x - mean[:, None]
    z[np.isnan(z)] = 0.0
    return z / scale[:, None]


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, ...], np.ndarray, int]]:
    """Sums over rows of blocks sorted by block and salt."""
    at, block, used = None, None, 0
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("i", "j", "salt")), strict=True)
        for key, row, m in zip(keys, batch.column("block"), batch.column("m").to_pylist(), strict=True):
            if key != at:
                if at is not None:
                    yield at, block, used
                at, block, used = key, 0.0, 0
            block, used = block + row.values.to_numpy(), used + m
    if at is not None:
        yield at, block, used


def kinship_sums(
    geno: DataFrame,
    n_samples: int,
    standardize: bool = False,
    maf: float = 0.01,
    max_missing: float = 0.05,
    side: int = SIDE,
) -> DataFrame:
    """``i, j, total, m`` for i <= j: the sum of the products that :func:`kinship` takes the mean of, and how many
    markers count. Sums of parts of the markers can be stored and added (:func:`kinship_of_sums`).
    Without any marker that counts there are no rows."""
    n = n_samples
    pairs = _tiles(n, side)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, used = np.zeros((n, n)), 0
        for x, mean, scale in _markers(batches, n, standardize, maf, max_missing):
            z = _centred(x, mean, scale)
            total += z.T @ z
            used += len(z)
        if used:
            yield _block_row(0, 0, TaskContext.get().partitionId() % SALTS, total, used)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for x, mean, scale in _markers(batches, n, standardize, maf, max_missing):
            turn += 1
            whole = bool(np.isin(x, (0.0, 1.0, 2.0)).sum() + np.isnan(x).sum() == x.size)
            held = np.nan_to_num(x, nan=_GAP).astype(np.int8) if whole else x
            tile = {i: np.ascontiguousarray(held[:, i : i + side]).tobytes() for i in range(0, n, side)}
            for i, j in pairs:
                values = (i, j, turn % SALTS, len(x), whole, tile[i], None if i == j else tile[j], mean.tobytes(), scale.tobytes())
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), *[pa.binary()] * 4)
                names = ["i", "j", "salt", "used", "whole", "left", "right", "mean", "scale"]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    def matrix(raw: bytes, whole: bool, rows: int, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
        x = np.frombuffer(raw, dtype=np.int8 if whole else np.float64).reshape(rows, -1).astype(np.float64)
        return _centred(np.where(x == _GAP, np.nan, x) if whole else x, mean, scale)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Dealt tiles sorted by pair and group -> a block for each."""
        at, block, used = None, None, 0
        for batch in batches:
            for k in range(batch.num_rows):
                i, j, salt, rows, whole, left, right, mean, scale = (c[k].as_py() for c in batch.columns)
                if (i, j, salt) != at:
                    if at is not None:
                        yield _block_row(at[0], at[1], 0, block, used)
                    at, block, used = (i, j, salt), 0.0, 0
                mean, scale = np.frombuffer(mean), np.frombuffer(scale)
                a = matrix(left, whole, rows, mean, scale)
                block, used = block + a.T @ (a if right is None else matrix(right, whole, rows, mean, scale)), used + rows
        if at is not None:
            yield _block_row(at[0], at[1], 0, block, used)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (i, j, _), block, used in _added(batches):
            yield _block_row(i, j, 0, block, used)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (i, j, _), block, used in _added(batches):
            columns = np.arange(j, min(j + side, n))
            block = block.reshape(-1, len(columns))
            for a in range(i, min(i + side, n)):  # a row of the matrix at a time
                b = columns[columns >= a]
                total = block[a - i, len(columns) - len(b) :]
                values = (pa.array(np.full(len(b), a), pa.int32()), pa.array(b, pa.int32()), pa.array(total), pa.array(np.full(len(b), used), pa.int64()))
                yield pa.RecordBatch.from_arrays(list(values), ["i", "j", "total", "m"])

    ship_package(geno.sparkSession)
    key = ["i", "j", "salt"]
    if len(pairs) == 1:
        partial = geno.select("dosage").mapInArrow(multiply, _BLOCK)
        first = partial.repartition(*key).sortWithinPartitions(*key).mapInArrow(add, _BLOCK)
    else:
        dealt = geno.select("dosage").mapInArrow(deal, _DEALT)
        first = dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(products, _BLOCK)
    return first.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(cells, "i int, j int, total double, m long")


def kinship_of_sums(sums: DataFrame) -> DataFrame:
    """``i, j, k`` of the rows of one or several :func:`kinship_sums`."""
    return sums.groupBy("i", "j").agg((F.sum("total") / F.sum("m")).alias("k"))


def kinship(geno: DataFrame, n_samples: int, standardize: bool = False, maf: float = 0.01, max_missing: float = 0.05, side: int = SIDE) -> DataFrame:
    """``i, j, k`` for i <= j: the mean over markers of the product of the two samples' centred
    dosages, each marker divided by its variance first when ``standardize``.

    Gaps take the marker mean. Markers without variation, below ``maf`` or with more than the
    allowed share of gaps are not counted. Phenotypes play no part. No task holds more than one block of
    ``side`` x ``side`` samples.
    """
    sums = kinship_sums(geno, n_samples, standardize, maf, max_missing, side)
    return sums.select("i", "j", (F.col("total") / F.col("m")).alias("k"))


def kinship_centered(geno: DataFrame, n_samples: int, **options) -> DataFrame:
    return kinship(geno, n_samples, standardize=False, **options)


def kinship_standardized(geno: DataFrame, n_samples: int, **options) -> DataFrame:
    return kinship(geno, n_samples, standardize=True, **options)

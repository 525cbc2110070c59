"""Pearson correlation in long form, and the report built on it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.numeric import magnitude_class, magnitude_mark
from claimlens.functions.text import named
from claimlens.session import with_package

# A variance below this share of the sum of squares that it is taken from is rounding.
ROUNDING = 1e-11
MERGED = 64


def _shifts(frame: DataFrame) -> list[float | None]:
    """First pass: the value that each column is shifted by, its mean. A constant column is shifted by
    its own value, to exact zeros; a column without a value has none."""
    found = frame.agg(*[F.struct(F.avg(c), F.min(c), F.max(c)).alias(c) for c in frame.columns]).first()
    return [low if low == high else mean for mean, low, high in found]


def _gramian(frame: DataFrame, shifts: list[float | None]) -> np.ndarray:
    """Second pass: sums of products of all pairs among the shifted values, their squares and the marks
    of presence; a missing value is 0 in all three. A task adds up a matrix of (3 d)^2 numbers from its batches,
    and tasks' matrices are added in groups of ``MERGED`` before the rest reach the driver."""
    size = 3 * len(shifts)
    if not any(s is not None for s in shifts):
        return np.zeros((size, size))
    with_package(frame.sparkSession)
    around = np.array([s or 0.0 for s in shifts])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            values = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1) - around
            here = ~np.isnan(values)
            values = np.where(here, values, 0.0)
            parts = np.concatenate([values, values * values, here], 1)
            total += parts.T @ parts
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sums": [_sum(part["sums"], size).tobytes()]})

    sums = frame.mapInArrow(added, "sums binary").withColumn("part", F.floor(F.spark_partition_id() / MERGED))
    found = sums.groupBy("part").applyInPandas(merged, "sums binary").collect()
    return _sum([bytes(r["sums"]) for r in found], size)


def _sum(matrices: Iterable[bytes], size: int) -> np.ndarray:
    """In one order, however they arrive, so that a recomputed task adds alike."""
    return sum((np.frombuffer(m).reshape(size, size) for m in sorted(matrices)), np.zeros((size, size)))


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Square Pearson matrix as rows (Fila, Columna, fila_pos, columna_pos, r).

    A pair's correlation is that of the rows where both are present. Undefined values (a
    constant column, no such rows) are NULL. The data is read twice, whatever the number of
    columns; the result, columns x columns, is a local table that reports read again.
    """
    frame = df.select(
        [F.nanvl(named(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)]
    )
    d = len(columns)
    sums = _gramian(frame, _shifts(frame))
    n, own = sums[2 * d :, 2 * d :], sums[:d, 2 * d :]  # own[i, j]: sum of i where j is present
    with np.errstate(all="ignore"):
        product = sums[:d, :d] - own * own.T / n
        square = sums[d : 2 * d, 2 * d :]
        spread = square - own * own / n
        spread[~(spread > ROUNDING * square)] = 0.0
        # A column's product with itself is its spread; added up elsewhere in the matrix, it may differ in the last digit.
        np.fill_diagonal(product, np.diag(spread))
        r = product / np.sqrt(spread * spread.T)
    rows = [
        (columns[i], columns[j], i, j, float(np.clip(r[i, j], -1, 1)) if np.isfinite(r[i, j]) else None)
        for i in range(d)
        for j in range(d)
    ]
    schema = "Fila string, Columna string, fila_pos int, columna_pos int, r double"
    return df.sparkSession.createDataFrame(rows, schema)


def lower_triangle(matrix: DataFrame) -> DataFrame:
    """Below and on the diagonal."""
    return matrix.where("fila_pos >= columna_pos")


def labels(matrix: DataFrame) -> DataFrame:
    """Lower triangle with its star marks; a missing correlation has an empty mark."""
    return lower_triangle(matrix).withColumn("magnitud", F.coalesce(magnitude_mark("r"), F.lit("")))


def class_pairs(matrix: DataFrame) -> DataFrame:
    """Pairs of different columns by class; a correlation of exactly one is in no class."""
    return (
        matrix.where("fila_pos > columna_pos")
        .withColumn("clase", magnitude_class("r"))
        .where("clase is not null")
        .select("clase", F.least("Fila", "Columna").alias("primera"), F.greatest("Fila", "Columna").alias("segunda"))
        .orderBy("clase", "primera", "segunda")
    )


def mean_absolute(matrix: DataFrame) -> DataFrame:
    """Mean |r| of each column against the others, strongest first."""
    return (
        matrix.where("fila_pos != columna_pos")
        .groupBy("Columna")
        .agg(F.avg(F.abs("r")).alias("promedio"))
        .orderBy(F.desc_nulls_last("promedio"), "Columna")
    )


def wide(long: DataFrame, columns: list[str], value: str) -> DataFrame:
    """Square display form of a long matrix."""
    return (
        long.groupBy("fila_pos", "Fila")
        .pivot("Columna", columns)
        .agg(F.first(value))
        .orderBy("fila_pos")
        .drop("fila_pos")
    )


def analyze(matrix: DataFrame, target: str = "magnitud", return_input: bool = False) -> tuple[DataFrame, ...]:
    """Marks, pairs by class and mean |r|; with ``return_input`` the masked matrix as well."""
    if target not in "magnitud":
        raise ValueError(f"unknown target {target!r}")
    shape = matrix.agg(
        F.count(F.lit(1)).alias("cells"),
        F.countDistinct("Fila").alias("rows"),
        F.countDistinct("Columna").alias("columns"),
    ).first()
    if shape["rows"] != shape["columns"] or shape["cells"] != shape["rows"] * shape["columns"]:
        raise ValueError("the correlation matrix is not square")
    report = (labels(matrix), class_pairs(matrix), mean_absolute(matrix))
    return (*report, lower_triangle(matrix)) if return_input else report

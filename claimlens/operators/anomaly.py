"""Anomaly score: distance between a standardised row and its principal-component reconstruction."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.text import named, quoted
from claimlens.operators.rowid import number_of_id

HOVER = [
    "ruttitular", "numerosolicitud", "clasificaciongrupo", "clasificacionsubgrupo", "clasificacionapertura",
    "fechaprestacion", "fecharecepcionliquidacion", "rutprestador", "nombreprestador",
    "cantidad", "valorprestacionclp", "valorpagoclp", "costounitarioclp",
]


# Names of our own beside the data's columns.
VECTOR, SCORES = "__z", "__scores"


@dataclass
class Scaling:
    """Mean and population standard deviation per column."""

    columns: list[str]
    mean: list[float]
    deviation: list[float]
    rows: int


def fit_scaling(df: DataFrame, columns: list[str]) -> Scaling:
    """One aggregate over the data; two numbers per column come back."""
    row = df.agg(
        *[F.avg(c) for c in quoted(columns)], *[F.stddev_pop(c) for c in quoted(columns)], F.count(F.lit(1))
    ).first()
    d = len(columns)
    return Scaling(columns, list(row[:d]), list(row[d : 2 * d]), row[2 * d])


def zscore(name: str, mean: float, deviation: float) -> Column:
    """Standardised column; a constant one becomes 0."""
    if not deviation:
        return F.when(named(name).isNotNull(), F.lit(0.0)).alias(name)
    return ((named(name) - F.lit(mean)) / F.lit(deviation)).alias(name)


def standardize(df: DataFrame, scaling: Scaling) -> DataFrame:
    """Every scaled column replaced by its z-score; other columns pass through."""
    z = {n: zscore(n, m, s) for n, m, s in zip(scaling.columns, scaling.mean, scaling.deviation, strict=True)}
    return df.select([z[c] if c in z else named(c) for c in df.columns])


def assemble(df: DataFrame, columns: list[str], name: str = VECTOR) -> DataFrame:
    """Add the columns as one vector; the assembler sees plain names only."""
    plain = {f"__part{i}": c for i, c in enumerate(quoted(columns))}
    return VectorAssembler(inputCols=list(plain), outputCol=name).transform(df.withColumns(plain)).drop(*plain)


@dataclass
class Components:
    """All principal components of standardised data, strongest first."""

    model: PCAModel
    ratio: np.ndarray
    vectors: np.ndarray
    scaling: Scaling

    def eigenvalues(self) -> np.ndarray:
        """Sample variance along each component.

        Standardised columns have population variance 1 (0 when constant), so the total
        is known without another pass.
        """
        varying = sum(1 for s in self.scaling.deviation if s)
        rows = self.scaling.rows
        return self.ratio * varying * rows / (rows - 1)


def fit_components(z: DataFrame, scaling: Scaling) -> Components:
    """Fit on the covariance matrix: executors sum d-by-d parts, the driver decomposes one."""
    d = len(scaling.columns)
    model = PCA(k=d, inputCol=VECTOR, outputCol=SCORES).fit(assemble(z.select(quoted(scaling.columns)), scaling.columns))
    return Components(model, model.explainedVariance.toArray(), model.pc.toArray(), scaling)


def choose_components(ratio: np.ndarray, threshold: float = 0.95) -> tuple[int, float, float]:
    """Fewest components whose cumulative explained variance (4 digits) reaches the threshold.

    At most all but one are considered. Returns their number, the variance they explain
    and their share of the dimensions.
    """
    d = len(ratio)
    reached = np.round(np.cumsum(ratio[: d - 1]), 4)
    enough = np.flatnonzero(reached >= threshold)
    if not len(enough):
        best = reached[-1] if len(reached) else 0.0
        raise ValueError(f"{d - 1} components explain {best}, short of {threshold}")
    k = int(enough[0]) + 1
    return k, float(reached[k - 1]), float(np.round(k / d, 4))


def explained_variance(z: DataFrame, components: Components) -> DataFrame:
    """Components considered with their cumulative explained variance."""
    reached = np.round(np.cumsum(components.ratio[:-1]), 4)
    rows = [(i + 1, float(v)) for i, v in enumerate(reached)]
    return z.sparkSession.createDataFrame(rows, "comps int, exp double")


def with_scores(z: DataFrame, components: Components) -> DataFrame:
    """Add the coordinates of each row along all components, as an array."""
    projected = components.model.transform(assemble(z, components.scaling.columns))
    return projected.withColumn(SCORES, vector_to_array(SCORES)).drop(VECTOR)


def whitened(z: DataFrame, components: Components, k: int) -> DataFrame:
    """The first k coordinates divided by their standard deviation, as columns 0 … k-1."""
    spread = np.sqrt(components.eigenvalues()[:k])
    rest = quoted(c for c in z.columns if c not in components.scaling.columns)
    return with_scores(z, components).select(
        *rest, *[(F.col(SCORES)[j] / F.lit(float(spread[j]))).alias(str(j)) for j in range(k)]
    )


def reconstruct(z: DataFrame, components: Components, k: int) -> DataFrame:
    """Standardised columns rebuilt from the first k coordinates; whitening cancels out."""
    columns = components.scaling.columns
    rebuilt = {
        name: reduce(Column.__add__, [F.col(SCORES)[j] * F.lit(float(components.vectors[i, j])) for j in range(k)])
        for i, name in enumerate(columns)
    }
    rest = quoted(c for c in z.columns if c not in columns)
    return with_scores(z, components).select(*rest, *[v.alias(n) for n, v in rebuilt.items()])


def anomaly_scores(z: DataFrame, components: Components, k: int) -> DataFrame:
    """Add ``anomalyscore``.

    The components are orthonormal, so what the first k miss is exactly what lies along
    the others: the norm of the remaining coordinates is the reconstruction error, without
    rebuilding any column and without cancellation near zero.
    """
    left = len(components.scaling.columns) - k
    missed = F.slice(SCORES, k + 1, left)
    norm = F.sqrt(F.aggregate(missed, F.lit(0.0), lambda total, s: total + s * s))
    return with_scores(z, components).withColumn("anomalyscore", norm).drop(SCORES)


def score_rows(df: DataFrame, features: list[str], threshold: float = 0.95) -> tuple[DataFrame, tuple[int, float, float]]:
    """Score every row of a prepared frame; the frame's own columns are kept unscaled.

    Two jobs fit the model (moments, covariance); scoring is one narrow pass.
    """
    scaling = fit_scaling(df, features)
    components = fit_components(standardize(df, scaling), scaling)
    choice = choose_components(components.ratio, threshold)
    raw = F.struct(*quoted(df.columns)).alias("__row")
    z = [zscore(n, m, s) for n, m, s in zip(features, scaling.mean, scaling.deviation, strict=True)]
    scored = anomaly_scores(df.select(raw, *z), components, choice[0])
    return scored.select("anomalyscore", "__row.*"), choice


def inspection_series(result: DataFrame, hover: list[str] = HOVER) -> DataFrame:
    """Record number, score and the columns shown beside it, in record order."""
    return result.select(number_of_id().alias("registro"), "anomalyscore", *hover).orderBy("registro")


def sample_ids(df: DataFrame, key: str = "uniqueid", rows: int = 3, seed: int = 16) -> DataFrame:
    """Keys of a random sample; drawn by hash, so a recomputed task draws the same rows."""
    return df.select(key).orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(rows)


def rows_of(df: DataFrame, keys: DataFrame, key: str = "uniqueid") -> DataFrame:
    """The same sampled rows in another frame."""
    return df.join(keys, key, "left_semi")

"""Estimate the missing values of a column from other columns."""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from typing import Any

from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.numeric import r4
from claimlens.functions.text import named, quoted
from claimlens.operators import tree
from claimlens.operators.anomaly import VECTOR, assemble, fit_scaling, standardize
from claimlens.operators.profile import is_missing
from claimlens.operators.running import running_totals
from claimlens.session import stage

METHODS = ["regress", "clasif"]
MODELS = ["lreg", "dtree", "forest", "svm"]
SPLIT_STEPS = 1_000_000
FOREST_DEPTH = 30  # the library's maximum
FOREST_CUTS = 256  # a forest's trees look at so many cuts of a predictor; a single tree looks at all
TREES = 100
LABEL, HELD_OUT = "__label", "__held_out"  # beside the data's columns


@dataclass
class Estimate:
    """Predictions for the rows whose value is missing, the validation metric and the fitted model."""

    predictions: DataFrame
    metric: float
    model: Any


def split_column(keys: list[str], share: float, seed: int) -> Column:
    """True for about ``share`` of the rows, by a hash of their keys.

    Unlike a random draw, a recomputed task puts every row on the same side again.
    """
    drawn = F.pmod(F.xxhash64(*quoted(keys), F.lit(seed)), F.lit(SPLIT_STEPS))
    return drawn < int(share * SPLIT_STEPS)


def _regressor(model: str, seed: int, depth: int, trees: int):
    common = {"featuresCol": VECTOR, "labelCol": LABEL}
    if model == "lreg":
        return LinearRegression(**common)
    if model == "forest":
        return RandomForestRegressor(
            maxDepth=depth, numTrees=trees, featureSubsetStrategy="all", maxBins=FOREST_CUTS, seed=seed, **common
        )
    raise ValueError("no distributed kernel regression: choose lreg, dtree or forest")


def _classifier(model: str, seed: int, rows: int, depth: int, trees: int):
    # Penalty per row: the usual unit-strength L2 term over the summed loss.
    common = {"featuresCol": VECTOR, "labelCol": LABEL}
    if model == "lreg":
        return LogisticRegression(regParam=1.0 / rows, standardization=False, **common)
    if model == "forest":
        return RandomForestClassifier(maxDepth=depth, numTrees=trees, maxBins=FOREST_CUTS, seed=seed, **common)
    return LinearSVC(regParam=1.0 / rows, standardization=False, **common)


def rmse(predicted: DataFrame, normalized: bool = False, label: str = "label") -> float:
    """Root mean squared error, optionally over the absolute mean of the actual values."""
    error = F.sqrt(F.avg(F.pow(F.col(label) - F.col("prediction"), 2)))
    row = predicted.agg(error.alias("rmse"), F.abs(F.avg(label)).alias("level")).first()
    if not normalized:
        return row["rmse"]
    if row["level"] == 0:
        raise ValueError("the actual values average 0: the error cannot be normalised")
    return row["rmse"] / row["level"]


def auc(predicted: DataFrame, label: str = "label", score: str = "rawPrediction") -> float:
    """Area under the ROC curve, 4 digits: over all scores, rows of one score counting half against each other.

    Rows are counted per score; the rows of class 0 below each score are running totals over ranges of
    scores. Products of counts are added as exact decimals. Rows without a score or a label take no part."""
    value = F.col(score)
    if isinstance(predicted.schema[score].dataType, VectorUDT):
        value = vector_to_array(value)[1]
    rows = predicted.select(value.cast("double").alias("score"), F.col(label).alias("label")).dropna()
    counts = rows.groupBy("score").agg(F.count_if(F.col("label") > 0).alias("ones"), F.count_if(F.col("label") <= 0).alias("zeros"))
    ranked = running_totals(counts, [], "score", ["zeros"])
    exact = [F.col(c).cast("decimal(19,0)") for c in ("ones", "zeros", "zeros_before")]
    twice = F.sum(exact[0] * (2 * exact[2] + exact[1]))
    total = ranked.agg(twice.alias("twice"), F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).first()
    if not total["ones"] or not total["zeros"]:
        raise ValueError("the area needs rows of both classes")
    return round(float(Fraction(int(total["twice"]), 2 * total["ones"] * total["zeros"])), 4)


def estimate_missing(
    df: DataFrame,
    target: str,
    predictors: str | list[str],
    model: str = "lreg",
    method: str = "regress",
    normalized: bool = False,
    seed: int = 16,
    validation: float = 0.1,
    keys: list[str] | None = None,
    depth: int | None = None,
    trees: int = TREES,
    held_out: Column | None = None,
) -> Estimate:
    """Fit on rows where the target is known, validate on a held-out share, predict the rest.

    Rows with a missing predictor take no part. Predictors are standardised by the training
    rows. ``keys`` identify a row (default: target and predictors); they return with the
    predictions and decide the split, unless ``held_out`` says which rows are held out.
    Classification is binary, with the higher class as 1. A tree tries every cut and grows until
    its leaves are pure, unless ``depth`` bounds it; a forest's trees are bounded by ``depth`` or
    the library's maximum. The input is read once: what takes part is written to the shared folder.
    """
    if method not in METHODS:
        raise ValueError(f"choose a valid method: {METHODS}")
    if model not in MODELS:
        raise ValueError(f"choose a valid model: {MODELS}")
    predictors = [predictors] if isinstance(predictors, str) else list(predictors)
    keys = keys or [target, *predictors]
    own = [f"x{i}" for i in range(len(predictors))]
    complete = ~reduce(Column.__or__, [is_missing(df.schema[p]) for p in predictors])
    drawn = split_column(keys, validation, seed) if held_out is None else held_out
    rows = stage(
        df.where(complete).select(
            F.struct(*quoted(keys)).alias("__key"),
            F.coalesce(drawn, F.lit(False)).alias(HELD_OUT),
            named(target).cast("double").alias(LABEL),
            *[named(p).cast("double").alias(x) for p, x in zip(predictors, own, strict=True)],
        ),
        "estimate",
    )
    known = rows.where(F.col(LABEL).isNotNull())
    training = known.where(~F.col(HELD_OUT))
    predictors = own
    if model == "dtree":
        return _by_tree(rows, known, training, predictors, method, normalized, depth)
    depth = FOREST_DEPTH if depth is None else depth
    scaling = fit_scaling(training, predictors)

    def ready(part: DataFrame) -> DataFrame:
        return assemble(standardize(part, scaling), predictors)

    algorithm = (
        _regressor(model, seed, depth, trees) if method == "regress" else _classifier(model, seed, scaling.rows, depth, trees)
    )
    fitted = algorithm.fit(ready(training))
    validated = fitted.transform(ready(known.where(HELD_OUT)))
    predicted = fitted.transform(ready(rows.where(F.col(LABEL).isNull())))
    if method == "regress":
        return Estimate(predicted.select("__key.*", F.col("prediction").alias("pred")), rmse(validated, normalized, LABEL), fitted)
    proba = (
        vector_to_array("probability")[1] if "probability" in predicted.columns else F.lit(None).cast("double")
    )
    return Estimate(
        predicted.select("__key.*", F.col("prediction").alias("pred"), r4(proba).alias("proba")), auc(validated, LABEL), fitted
    )


def _by_tree(
    rows: DataFrame, known: DataFrame, training: DataFrame, predictors: list[str], method: str, normalized: bool, depth: int | None
) -> Estimate:
    """The estimate of one tree. Cuts lie between values, so predictors need no standardising; a class is the
    one that more than half of a leaf's training rows have."""
    fitted = tree.fit(training, LABEL, predictors, depth)
    validated = fitted.predict(known.where(HELD_OUT))
    predicted = fitted.predict(rows.where(F.col(LABEL).isNull()))
    value = F.col("prediction")
    if method == "regress":
        return Estimate(predicted.select("__key.*", value.alias("pred")), rmse(validated, normalized, LABEL), fitted)
    found = predicted.select("__key.*", (value > 0.5).cast("double").alias("pred"), r4(value).alias("proba"))
    return Estimate(found, auc(validated, LABEL, "prediction"), fitted)

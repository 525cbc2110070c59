from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimlens.operators import anomaly, features, impute
from claimlens.plans.config import DETAIL_TYPES
from claimlens.plans.jobs import prepare_rows


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(16)
    core = rng.normal(size=(300, 3))
    data = core @ rng.normal(size=(3, 6)) + rng.normal(size=(300, 6)) * 0.2
    frame = pd.DataFrame(data, columns=list("abcdef"))
    frame["flat"] = 7.0
    frame["key"] = np.arange(300)
    return frame


COLUMNS = [*"abcdef", "flat"]


def reference(table):
    """Z-scores, singular values and right vectors by plain linear algebra."""
    x = table[COLUMNS].to_numpy()
    spread = x.std(axis=0)
    z = np.divide(x - x.mean(axis=0), spread, out=np.zeros_like(x), where=spread > 0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    return z, s, vt


@pytest.fixture(scope="module")
def fitted(spark, table):
    df = spark.createDataFrame(table)
    scaling = anomaly.fit_scaling(df, COLUMNS)
    z = anomaly.standardize(df, scaling)
    return z, anomaly.fit_components(z, scaling)


def by_key(df, columns):
    return df.orderBy("key").toPandas()[columns].to_numpy(float)


def test_zscore_uses_population_deviation_and_zeroes_constants(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(1, 5)], "x double, c double")
    z = anomaly.standardize(df, anomaly.fit_scaling(df, ["x", "c"])).collect()
    assert [r.x for r in z] == pytest.approx([(i - 2.5) / 1.118033988749895 for i in range(1, 5)])
    assert {r.c for r in z} == {0.0}


def test_components_match_singular_values(fitted, table):
    _, s, _ = reference(table)
    np.testing.assert_allclose(fitted[1].ratio, s**2 / (s**2).sum(), atol=1e-10)
    np.testing.assert_allclose(fitted[1].eigenvalues(), s**2 / (len(table) - 1), atol=1e-8)


def test_scores_projection_and_reconstruction(fitted, table):
    z, components = fitted
    k, explained, share = anomaly.choose_components(components.ratio)
    ref, s, vt = reference(table)
    rebuilt = ref @ vt[:k].T @ vt[:k]
    assert explained == np.round((s[:k] ** 2).sum() / (s**2).sum(), 4) >= 0.95
    assert share == np.round(k / len(COLUMNS), 4)
    np.testing.assert_allclose(by_key(anomaly.reconstruct(z, components, k), COLUMNS), rebuilt, atol=1e-8)
    scores = by_key(anomaly.anomaly_scores(z, components, k), ["anomalyscore"])[:, 0]
    np.testing.assert_allclose(scores, np.sqrt(((rebuilt - ref) ** 2).sum(axis=1)), atol=1e-8)
    white = by_key(anomaly.whitened(z, components, k), [str(j) for j in range(k)])
    expected = ref @ vt[:k].T / (s[:k] / np.sqrt(len(table) - 1))
    np.testing.assert_allclose(np.abs(white), np.abs(expected), atol=1e-7)


def test_score_is_zero_at_full_rank(spark):
    rng = np.random.default_rng(1)
    core = rng.normal(size=(100, 2))
    df = spark.createDataFrame(pd.DataFrame(core @ rng.normal(size=(2, 4)), columns=list("abcd")))
    result, (k, explained, _) = anomaly.score_rows(df, list("abcd"), threshold=1.0)
    assert (k, explained) == (2, 1.0)
    assert result.agg(F.max("anomalyscore")).first()[0] < 1e-7


@pytest.mark.parametrize("ratio, expected", [([0.6, 0.3, 0.08, 0.02], (3, 0.98, 0.75)), ([0.95, 0.05], (1, 0.95, 0.5))])
def test_choice_of_components(ratio, expected):
    assert anomaly.choose_components(np.array(ratio)) == expected


def test_threshold_out_of_reach():
    with pytest.raises(ValueError, match="short of 0.95"):
        anomaly.choose_components(np.array([0.5, 0.5]))


def extract_row(**changes):
    row = {
        "RutTitular": "1", "RutBeneficiario": "1", "NumeroSolicitud": "s", "IdGrupoPrestacion": 1, "ClasificacionGrupo": "g",
        "IdSubgrupoPrestacion": 2, "ClasificacionSubgrupo": "m", "IdAperturaPrestacion": 3, "ClasificacionApertura": "B",
        "Cantidad": 2, "ValorPrestacionCLP": 10.9, "ValorPrestacionUF": 0.5, "CostoUnitarioCLP": 5.9, "ValorReclamadoCLP": 9.0,
        "ValorPagoUF": 0.3, "ValorPagoCLP": 8.0, "FechaPrestacion": datetime(2023, 12, 31),
        "FechaRecepcionLiquidacion": datetime(2024, 1, 2), "Prevision": "FONASA", "RutPrestador": "p", "NombrePrestador": "n",
    }
    return {**row, **changes}


def test_preparation(spark):
    data = [
        extract_row(), extract_row(ClasificacionApertura="a", RutBeneficiario="2", Prevision=None),
        extract_row(ClasificacionApertura=None, NumeroSolicitud="t"),
    ]
    prepared = prepare_rows(spark.createDataFrame(pd.DataFrame(data)), DETAIL_TYPES)
    got = prepared.frame.orderBy("uniqueid").collect()
    assert prepared.extracted == [
        "fonasa", "clasif_a", "clasif_b", "day_sin", "day_cos", "month_sin", "month_cos", "titular",
    ]
    assert [(r.fonasa, r.clasif_a, r.clasif_b, r.titular) for r in got] == [(1, 0, 1, 1), (1, 0, 0, 1), (0, 1, 0, 0)]
    assert (got[0].valorprestacionclp, got[0].costounitarioclp, got[0].uniqueid) == (10, 5, "id_0")
    assert (got[0].day_sin, got[0].month_cos) == (pytest.approx(0, abs=1e-12), pytest.approx(1))
    assert len(prepared.features) == 7 + len(prepared.extracted) and len(prepared.information) == 14
    roles = prepared.variables().groupBy("role").count().collect()
    assert {r.role: r["count"] for r in roles} == {"original": 21, "information": 14, "extracted": 8}
    assert set(prepared.dataset().columns) == {"uniqueid", *prepared.features}


def test_undeclared_column_and_missing_integer(spark):
    df = spark.createDataFrame([(1, None)], "cantidad int, otra int")
    with pytest.raises(KeyError):
        features.apply_types(df, DETAIL_TYPES)
    strict = features.apply_types(df.select(F.col("otra").alias("cantidad")), DETAIL_TYPES, strict=True)
    with pytest.raises(Exception, match="missing value in integer column cantidad"):
        strict.collect()


def test_any_number_of_classes(spark):
    """More than a thousand classes, dots and backticks in their names."""
    df = spark.range(1200).selectExpr("id", "concat('Hosp. `dia` ', id) as c")
    classes = features.classes_of(df, "c")
    assert len(classes) == 1200
    few = [classes[0], classes[7]]
    hot = df.select("id", *[c.alias(n) for n, c in features.one_hot("c", few).items()])
    names = [f"clasif_{c}" for c in few]
    assert sum(sum(r[n] for n in names) for r in hot.collect()) == 2
    scaling = anomaly.fit_scaling(hot, names)
    assert scaling.mean == pytest.approx([1 / 1200] * 2)
    vectors = anomaly.assemble(anomaly.standardize(hot, scaling), names)
    assert vectors.columns == ["id", *names, anomaly.VECTOR] and vectors.count() == 1200


def test_columns_named_like_our_own(spark):
    df = spark.range(300).selectExpr("id", "id % 7 as label", "id % 5 as z", "cast(id as double) as n", "id % 3 as key")
    df = df.selectExpr("*", "if(id % 10 = 0, null, 2 * label + z) as target")
    found = impute.estimate_missing(df, "target", ["label", "z"], keys=["id", "key"])
    assert found.metric == pytest.approx(0, abs=1e-6)
    expected = {r.id: 2 * r.label + r.z for r in df.collect()}
    assert all(r.pred == pytest.approx(expected[r.id]) for r in found.predictions.collect())
    scored, _ = anomaly.score_rows(df.select("id", "label", "z", "n"), ["label", "z", "n"], 0.5)
    assert scored.columns == ["anomalyscore", "id", "label", "z", "n"]


def test_stated_hold_out_and_class_forest(spark):
    df = spark.range(400).selectExpr("id", "id % 20 as x", "if(id % 40 = 3, null, cast(id % 20 >= 10 as int)) as y")
    found = impute.estimate_missing(
        df, "y", "x", model="forest", method="clasif", keys=["id"], trees=5, depth=4, held_out=F.floor(F.col("id") / 20) % 4 == 0
    )
    assert found.metric == 1.0
    assert {(r.pred, r.proba) for r in found.predictions.collect()} == {(0.0, 0.0)}


def test_sample_is_stable(spark):
    df = spark.range(100).selectExpr("concat('id_', id) as uniqueid", "id")
    keys = [r.uniqueid for r in anomaly.sample_ids(df).collect()]
    assert len(keys) == 3 and keys == [r.uniqueid for r in anomaly.sample_ids(df.repartition(9)).collect()]
    assert anomaly.rows_of(df, anomaly.sample_ids(df)).count() == 3


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 4
    frame = pd.DataFrame({"k": np.arange(600), "x1": x[:, 0], "x2": x[:, 1], "y": y, "c": (y > 4).astype(float)})
    frame.loc[::6, ["y", "c"]] = None
    frame.loc[1, "x1"] = None
    return spark.createDataFrame(frame).coalesce(1).select(
        "k", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ["x1", "x2", "y", "c"]]
    )


def test_linear_target_is_recovered(gappy):
    estimate = impute.estimate_missing(gappy, "y", ["x1", "x2"], keys=["k"])
    got = estimate.predictions.join(gappy, "k").selectExpr("max(abs(pred - (3 * x1 - 2 * x2 + 4)))", "count(*)").first()
    assert got[0] < 1e-6 and got[1] == 100
    assert estimate.metric < 1e-6


@pytest.mark.parametrize("model", ["dtree", "forest"])
def test_trees_estimate_roughly(gappy, model, monkeypatch):
    monkeypatch.setattr(impute, "TREES", 10)
    estimate = impute.estimate_missing(gappy, "y", ["x1", "x2"], model=model, keys=["k"], normalized=True)
    assert 0 < estimate.metric < 1 and estimate.predictions.count() == 100


@pytest.mark.parametrize("model", ["lreg", "dtree", "svm"])
def test_classes(gappy, model):
    estimate = impute.estimate_missing(gappy, "c", ["x1", "x2"], model=model, method="clasif", keys=["k"])
    assert estimate.metric > 0.85
    right = estimate.predictions.join(gappy, "k").selectExpr("avg(int(pred = int(3 * x1 - 2 * x2 > 0)))").first()[0]
    assert right > 0.85
    assert (estimate.predictions.where("proba is null").count() == 100) == (model == "svm")


def test_split_does_not_depend_on_partitions(gappy):
    def held(df):
        return {r.k for r in df.where(impute.split_column(["k"], 0.1, 16)).collect()}

    assert held(gappy) == held(gappy.repartition(11)) and 30 < len(held(gappy)) < 100


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    assert (impute.rmse(df), impute.rmse(df, normalized=True)) == (1.0, 0.5)
    with pytest.raises(ValueError, match="average 0"):
        impute.rmse(df.selectExpr("label - 2 as label", "prediction"), normalized=True)


def test_bad_choices(gappy):
    with pytest.raises(ValueError, match="valid method"):
        impute.estimate_missing(gappy, "y", "x1", method="reg")
    with pytest.raises(ValueError, match="valid model"):
        impute.estimate_missing(gappy, "y", "x1", model="knn")
    with pytest.raises(ValueError, match="kernel"):
        impute.estimate_missing(gappy, "y", "x1", model="svm")

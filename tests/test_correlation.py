import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimlens.operators import correlation as corr


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    base = rng.normal(size=400)
    frame = pd.DataFrame(
        {
            "a": base, "b": base * 0.5 + rng.normal(size=400), "twin": base, "mirror": -base, "flat": 2.5,
            "gaps": np.where(rng.random(400) < 0.3, np.nan, base + rng.normal(size=400) * 3),
            "noise": rng.normal(size=400) * 1e6 + 1e9,
        }
    )
    frame["const_where_gaps"] = np.where(frame.gaps.isna(), rng.normal(size=400), 1.5)
    return frame


@pytest.fixture(scope="module")
def matrix(spark, data):
    return corr.correlation(spark.createDataFrame(data), list(data.columns))


def test_matches_pairwise_pearson(matrix, data):
    got = matrix.toPandas().pivot(index="Fila", columns="Columna", values="r").loc[data.columns, data.columns]
    np.testing.assert_allclose(got.to_numpy(float), data.corr().to_numpy(float), atol=1e-9)


def test_equal_and_opposite_columns_are_exact(matrix):
    r = {(x.Fila, x.Columna): x.r for x in matrix.collect()}
    assert r["a", "twin"] == r["twin", "a"] == 1.0
    assert r["a", "mirror"] == -1.0
    assert r["flat", "a"] is None and r["flat", "flat"] is None
    assert r["gaps", "const_where_gaps"] is None


def test_sixty_columns_with_gaps_are_read_twice(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    base = spark.range(500).mapInPandas(counted, "id bigint")
    names = [f"c.{i}" for i in range(60)]
    wide = base.select([F.when(F.col("id") % 7 != i % 7, F.sin(F.col("id") * (i + 1))).alias(n) for i, n in enumerate(names)])
    matrix = corr.correlation(wide, names)
    corr.analyze(matrix)[0].collect()
    assert read.value == 1000 and matrix.count() == 3600
    data = pd.DataFrame({n: [np.sin(k * (i + 1)) if k % 7 != i % 7 else np.nan for k in range(500)] for i, n in enumerate(names)})
    got = np.array([x.r for x in matrix.orderBy("fila_pos", "columna_pos").collect()]).reshape(60, 60)
    np.testing.assert_allclose(got, data.corr().to_numpy(), atol=1e-9)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [x.r for x in corr.correlation(empty, ["a", "b"]).collect()] == [None] * 4


def test_report(matrix, data):
    marks, pairs, means, masked = corr.analyze(matrix, return_input=True)
    n = len(data.columns)
    assert marks.count() == masked.count() == n * (n + 1) // 2
    found = [tuple(r) for r in pairs.collect()]
    assert found == sorted(found)
    named = {frozenset(p[1:]) for p in found}
    assert frozenset(("a", "twin")) not in named and frozenset(("a", "b")) in named
    expected = data.corr().where(~np.eye(n, dtype=bool)).abs().mean().drop(["flat"])
    got = {r.Columna: r.promedio for r in means.collect()}
    assert got["flat"] is None
    for name, value in expected.items():
        assert got[name] == pytest.approx(value, abs=1e-9)


def test_wide_form_is_blank_above_the_diagonal(matrix, data):
    wide = corr.wide(corr.labels(matrix), list(data.columns), "magnitud").collect()
    assert [r.Fila for r in wide] == list(data.columns)
    assert wide[0]["a"] == "(*****)" and wide[0]["b"] is None and wide[1]["b"] == "(*****)"


def test_bad_input(matrix):
    with pytest.raises(ValueError, match="square"):
        corr.analyze(matrix.where("Fila != 'a'"))
    with pytest.raises(ValueError, match="target"):
        corr.analyze(matrix, target="otro")


def test_a_column_with_itself(spark, monkeypatch):
    """Exactly 1, though its squares and its products are added up in different orders."""
    def noisy(frame, shifts, real=corr._gramian):
        sums = real(frame, shifts)
        sums[np.arange(len(shifts)), np.arange(len(shifts))] *= 1 - 1e-15
        return sums

    monkeypatch.setattr(corr, "_gramian", noisy)
    df = spark.createDataFrame([(0.1 * i, 0.3 * i * i) for i in range(50)], "a double, b double")
    found = {(r.Fila, r.Columna): r.r for r in corr.correlation(df, ["a", "b"]).collect()}
    assert found["a", "a"] == found["b", "b"] == 1.0

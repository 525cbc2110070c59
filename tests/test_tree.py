"""Exact trees against a plain recursion, running totals and the exact area against plain sums."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.operators import impute, tree
from claimlens.operators.running import running_totals


def plain(x, y, depth=None):
    """{row: estimate}: the tree grown by trying every cut of every node."""
    found = {}

    def grow(rows, level):
        label = y[rows]
        mean = label.mean()
        spread = ((label - mean) ** 2).sum()
        best = None
        if label.min() < label.max() and (depth is None or level < depth):
            for j in range(x.shape[1]):
                values = np.unique(x[rows, j])
                for low, high in zip(values, values[1:], strict=False):
                    left = label[x[rows, j] <= low]
                    n, k, s = len(rows), len(left), (left - mean).sum()
                    gain = round(s * s * n / (k * (n - k)) / spread, tree.DIGITS)
                    if best is None or gain > best[0]:
                        best = (gain, j, low + (high - low) / 2)
        if best is None:
            found.update(dict.fromkeys(rows.tolist(), mean))
        else:
            side = x[rows, best[1]] > best[2]
            grow(rows[~side], level + 1)
            grow(rows[side], level + 1)

    grow(np.arange(len(y)), 0)
    return [found[i] for i in range(len(y))]


def sample(seed, n=300, distinct=80):
    rng = np.random.default_rng(seed)
    x = np.round(rng.integers(0, distinct, size=(n, 3)) / 7, 3)
    y = np.round(10 * (x[:, 0] > 5) + x[:, 1] ** 2 + rng.integers(0, 3, n), 2)
    return x, y


def frame(spark, x, y):
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "i int, x0 double, x1 double, x2 double, y double").repartition(5)


def estimates(spark, x, y, depth=None):
    data = frame(spark, x, y)
    found = tree.fit(data, "y", ["x0", "x1", "x2"], depth).predict(data)
    return [r.prediction for r in sorted(found.collect(), key=lambda r: r.i)]


@pytest.mark.parametrize("depth", [0, 1, 3, None])
def test_equals_a_plain_tree(spark, depth):
    x, y = sample(1)
    assert estimates(spark, x, y, depth) == pytest.approx(plain(x, y, depth))


@pytest.mark.parametrize("depth", [2, 5, None])
def test_levels_over_all_executors(spark, monkeypatch, depth):
    """Nodes above 60 rows are cut by Spark, several levels of them, and smaller ones in a task."""
    monkeypatch.setattr(tree, "LOCAL_ROWS", 60)
    monkeypatch.setattr(tree, "PASSENGERS", 7)
    x, y = sample(2)
    data = frame(spark, x, y)
    fitted = tree.fit(data, "y", ["x0", "x1", "x2"], depth)
    assert len(fitted.cuts) >= 2
    found = [r.prediction for r in sorted(fitted.predict(data).collect(), key=lambda r: r.i)]
    assert found == pytest.approx(plain(x, y, depth))


def test_a_cut_between_any_two_of_many_values(spark):
    """A step and a parity: wrong nearly everywhere where only some cuts are tried."""
    value = np.arange(1000) % 500
    y = 10.0 * (value >= 317) + value % 2
    x = np.stack([value, value * 0, value * 0], 1)
    assert estimates(spark, x, y) == y.tolist()


@pytest.mark.parametrize("local", [10_000, 8])
def test_nodes_that_no_cut_divides(spark, monkeypatch, local):
    """Equal predictors with different labels are a leaf with their mean, however many; one label is a leaf."""
    monkeypatch.setattr(tree, "LOCAL_ROWS", local)
    x = np.array([[1.0, 2.0, 3.0]] * 30 + [[2.0, 2.0, 3.0]] * 30)
    y = np.array([0.0, 1.0] * 15 + [5.0] * 30)
    assert estimates(spark, x, y) == [0.5] * 30 + [5.0] * 30
    assert estimates(spark, x[:30], y[:30]) == [0.5] * 30


def test_neighbours_that_have_no_middle():
    """Between neighbouring doubles the lower one is the threshold."""
    a = 1.0
    b = np.nextafter(a, 2)
    feature, threshold, child, value = tree.grown(np.array([[a], [b]]), np.array([0.0, 1.0]))
    assert (feature[0], threshold[0], child[0], value.tolist()) == (0, a, 1, [0.5, 0.0, 1.0])


def test_estimate_missing_by_tree(spark):
    """Regression and class: equal to the plain tree of the training rows, with metric and columns."""
    x, y = sample(3)
    rows = frame(spark, x, y).withColumns({"y": F.when(F.col("i") % 5 != 0, F.col("y")), "c": F.when(F.col("i") % 5 != 0, (F.col("y") > 20).cast("int"))})
    trained = [i for i in range(len(y)) if i % 5 and i % 3]
    held_out = F.col("i") % 3 == 0
    names = ["x0", "x1", "x2"]
    for target, method, label in (("y", "regress", y), ("c", "clasif", (y > 20).astype(float))):
        estimate = impute.estimate_missing(rows, target, names, model="dtree", method=method, keys=["i"], held_out=held_out)
        found = {r.i: r for r in estimate.predictions.collect()}
        assert sorted(found) == list(range(0, 300, 5))
        fitted = tree.grown(x[trained], label[trained])

        def at(i, fitted=fitted):
            node = 0
            while fitted[2][node]:
                node = fitted[2][node] + (x[i, fitted[0][node]] > fitted[1][node])
            return fitted[3][node]

        values = {i: at(i) for i in found}
        held = [i for i in range(0, 300, 3) if i % 5]
        if method == "regress":
            assert {i: r.pred for i, r in found.items()} == pytest.approx(values)
            error = np.sqrt(np.mean([(label[i] - at(i)) ** 2 for i in held]))
            assert estimate.metric == pytest.approx(error)
        else:
            assert {i: (r.pred, r.proba) for i, r in found.items()} == {i: (float(v > 0.5), round(v, 4)) for i, v in values.items()}
            assert estimate.metric == plain_auc([(label[i], at(i)) for i in held])


def plain_auc(rows):
    ones = [s for y, s in rows if y > 0]
    zeros = [s for y, s in rows if y <= 0]
    return round(sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros)), 4)


def test_area_counts_every_score(spark):
    """More scores than any curve of 1000 bins holds, few ones, ties, and rows without a score."""
    rng = random.Random(4)
    rows = [(float(rng.random() < 0.02), round(rng.gauss(0, 1), 3)) for _ in range(4000)]
    rows = [(y, s + (y and 0.7)) for y, s in rows]
    df = spark.createDataFrame([*rows, (1.0, None), (None, 0.5)], "label double, rawPrediction double").repartition(7)
    assert impute.auc(df) == plain_auc(rows)


def test_area_of_two_groups(spark):
    df = spark.createDataFrame([(1.0, 3.0), (0.0, 1.0), (0.0, 3.0)], "label double, rawPrediction double")
    assert impute.auc(df) == 0.75
    with pytest.raises(ValueError, match="both classes"):
        impute.auc(df.where("label = 0"))


def test_running_totals(spark):
    rng = random.Random(5)
    rows = [(g, o, rng.randrange(10)) for g in ("a", "b", None) for o in rng.sample(range(1000), 200)]
    df = spark.createDataFrame([r for r in rows if r[0]], "g string, o int, v int").repartition(6)
    found = {(r.g, r.o): (r.v_before, r.after) for r in running_totals(df, ["g"], "o", ["v"], following="after").collect()}
    for g in ("a", "b"):
        own = sorted((o, v) for h, o, v in rows if h == g)
        for i, (o, _) in enumerate(own):
            assert found[g, o] == (sum(v for _, v in own[:i]), own[i + 1][0] if i + 1 < len(own) else None)
    assert len(found) == 400
    assert running_totals(df.limit(0), ["g"], "o", ["v"]).collect() == []


def written(monkeypatch):
    """{label: rows}, added up, of all that the tree stages."""
    found = {}

    def stage(df, label, real=tree.stage):
        staged = real(df, label)
        found[label] = found.get(label, 0) + staged.count()
        return staged

    monkeypatch.setattr(tree, "stage", stage)
    return found


def test_levels_move_sums_not_points(spark, monkeypatch):
    """Points are written once, and again when half of them are done; not at every level."""
    monkeypatch.setattr(tree, "LOCAL_ROWS", 60)
    found = written(monkeypatch)
    rng = np.random.default_rng(6)
    x = rng.random((1500, 3))
    y = x[:, 0] * (1 - x[:, 1])
    fitted = tree.fit(frame(spark, x, y), "y", ["x0", "x1", "x2"])
    assert len(fitted.cuts) >= 5
    assert found["tree-points"] == 1500
    assert sum(n for label, n in found.items() if label != "tree-subtrees") < 3.5 * 1500


@pytest.mark.parametrize("cells", [(1, 1), (2, 3), (16, 1024)])
def test_cells_that_must_be_opened(spark, monkeypatch, cells):
    """Few and wide cells, and labels that are noise: the best cut lies inside cells of any predictor."""
    monkeypatch.setattr(tree, "LOCAL_ROWS", 40)
    monkeypatch.setattr(tree, "NODE_CELLS", cells)
    monkeypatch.setattr(tree, "CELLS", 20)
    rng = np.random.default_rng(7)
    x = np.stack([np.exp(8 * rng.normal(size=150)), rng.integers(-3, 3, 150) * 1.0, -(rng.random(150) ** 9)], 1)
    y = np.round(rng.normal(size=150) * 1e6, 3)
    assert estimates(spark, x, y, 3) == pytest.approx(plain(x, y, 3))


def test_rows_meet_subtrees_as_columns(spark):
    """Rows of any columns reach their leaf in Arrow tables, not as Python objects."""
    x, y = sample(8)
    data = frame(spark, x, y).withColumns({"a.b": F.struct(F.col("i").alias("k"), F.lit(None).cast("date").alias("d")), "none": F.lit(None).cast("string")})
    found = tree.fit(data, "y", ["x0", "x1", "x2"], 4).predict(data)
    assert found.columns == [*data.columns, "prediction"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "InPandas" not in plan
    rows = sorted(found.collect(), key=lambda r: r.i)
    assert [r["a.b"].k for r in rows] == list(range(300))
    assert [r.prediction for r in rows] == pytest.approx(plain(x, y, 4))


def test_tasks_hold_arrow_and_leaves_start_no_python(spark, monkeypatch):
    """Subtrees grow from Arrow tables, not pandas; leaves of large nodes reach Spark without Python workers of their own."""
    monkeypatch.setattr(tree, "LOCAL_ROWS", 60)
    kinds = []

    def stage(df, label, real=tree.stage):
        if label == "tree-subtrees":
            kinds.append(df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().toRdd().toDebugString())
        return real(df, label)

    monkeypatch.setattr(tree, "stage", stage)
    x, y = sample(9)
    y = np.where(x[:, 0] > 5, y, 1.0)  # the left side is pure: a leaf among large nodes
    data = frame(spark, x, y)
    fitted = tree.fit(data, "y", ["x0", "x1", "x2"])
    assert len(fitted.cuts) >= 1 and fitted.subtrees.where("size(feature) = 1").count() >= 1
    assert "FlatMapGroupsInArrow" in kinds[0] and "InPandas" not in kinds[0] and "PythonRDD" not in kinds[0]
    found = [r.prediction for r in sorted(fitted.predict(data).collect(), key=lambda r: r.i)]
    assert found == pytest.approx(plain(x, y))

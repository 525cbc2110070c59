import pytest
from pyspark.sql import functions as F

from claimlens.operators import profile


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_value_counts(spark):
    df = frame(spark, [("a",), ("a",), ("b",), (None,)], "x string")
    assert ordered(profile.value_counts(df, "x")) == [("a", 2, 0.67), ("b", 1, 0.33)]


def test_value_counts_ties_are_in_value_order(spark):
    df = frame(spark, [(3,), (1,), (2,)], "x int")
    assert [r[0] for r in ordered(profile.value_counts(df, "x"))] == [1, 2, 3]


def test_mode_takes_the_lowest_of_equals(spark):
    df = frame(spark, [("b",), ("a",), ("b",), ("a",), (None,)], "x string")
    assert ordered(profile.mode(df, "x")) == [("x", "a")]


def test_modes_compare_numbers_as_numbers(spark):
    nan = float("nan")
    df = frame(spark, [(10, 0.0, "z"), (9, -0.0, None), (10, nan, None), (9, nan, None)], "i int, d double, s string")
    assert dict(ordered(profile.modes(df))) == {"i": "9", "d": "0.0", "s": "z"}


def test_missing_values(spark):
    df = frame(spark, [(1, 1.0), (None, float("nan")), (2, 2.0), (3, None)], "x int, y double")
    assert ordered(profile.missing_values(df)) == [("y", 2, 0.5), ("x", 1, 0.25)]
    assert profile.missing_values(df.dropna()).count() == 0
    assert ordered(profile.missing_row_share(df)) == [(0.5,)]


@pytest.mark.parametrize(
    "data, expected",
    [
        ("aabccc", (6, 1, 5, 3, 3, 1.67)),
        ("abc", (3, 3, 0, 3, 0, -1.0)),
        ("", (0, 0, 0, 0, 0, -1.0)),
        ("aa", (2, 0, 2, 1, 1, 2.0)),
    ],
)
def test_duplicates(spark, data, expected):
    report = ordered(profile.duplicates(frame(spark, [(c,) for c in data], "x string")))
    assert report == [expected]
    total, unique, repeated, distinct, surplus, _ = report[0]
    assert total == unique + repeated == distinct + surplus


def test_duplicates_count_null_rows_as_equal(spark):
    df = frame(spark, [(None, 1), (None, 1), (2, 1)], "x int, y int")
    assert ordered(profile.duplicates(df))[0][:5] == (3, 1, 2, 2, 1)


def test_fill_missing_covers_nan(spark):
    df = frame(spark, [(1, float("nan")), (None, 2.0)], "x int, y double")
    assert ordered(profile.fill_missing(df, {"x": 9, "y": 0})) == [(1, 0.0), (9, 2.0)]


def test_mode_of_a_hot_value_is_counted_before_it_moves(spark):
    """A third of all rows share one value; the shuffle carries one partial count per task and value."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("x"))
    assert ordered(profile.mode(df, "x")) == [("x", -1)]
    plan = profile.mode(df, "x")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan

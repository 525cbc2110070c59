from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from claimlens.functions import dates, numeric, rules, text


def values(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_id_padding(spark):
    data = [("7",), ("12345678-9",), ("123456789-K",), (None,), ("Sin rut prestador",)]
    got = values(spark, data, "x string", text.pad_id("x"), text.pad_provider_id("x"))
    assert [g[0] for g in got[:4]] == ["00000000007", "0012345678-9", "00123456789-", None]
    assert got[4] == ("00Sin rut pr", "Sin rut prestador")


def test_codes(spark):
    data = [("0012",), ("",), ("  ",), ("abc",), ("12.5",), (None,)]
    assert [g[0] for g in values(spark, data, "x string", text.code_to_int("x"))] == [12, 0, 0, None, None, None]


def test_zero_fill_never_cuts(spark):
    assert values(spark, [("7",), ("12345",)], "x string", text.zero_fill("x", 3)) == [("007",), ("12345",)]


def test_spec_fields_are_trimmed(spark):
    assert values(spark, [(" Id ; INT;int ",)], "x string", text.spec_fields("x")) == [(["Id", "INT", "int"],)]


def test_moving_back_keeps_time_and_clamps(spark):
    data = [(datetime(2024, 2, 29, 13, 5), datetime(2024, 5, 31, 10, 0))]
    got = values(spark, data, "a timestamp_ntz, b timestamp_ntz", dates.back("a", years=1), dates.back("b", months=3))
    assert got == [(datetime(2023, 2, 28, 13, 5), datetime(2024, 2, 29, 10, 0))]


def test_age_counts_365_day_years(spark):
    data = [(date(2000, 1, 1), datetime(2001, 1, 1)), (date(2000, 1, 1), datetime(2000, 12, 30)), (date(2001, 1, 1), datetime(2000, 6, 1))]
    assert values(spark, data, "b date, t timestamp_ntz", dates.age_years("b", "t")) == [(1,), (0,), (0,)]


def test_cyclic_dates(spark):
    data = [(datetime(2023, 12, 31),), (datetime(2023, 2, 28),), (datetime(2023, 1, 1),)]
    got = values(spark, data, "d timestamp_ntz", dates.day_angle("d") / F.pi(), dates.month_angle("d") / F.pi())
    assert got[0] == (pytest.approx(2), pytest.approx(2))
    assert got[1] == (pytest.approx(2 * 27 / 28), pytest.approx(2 / 11))
    assert got[2] == (0, 0)


def test_rounding_is_half_even(spark):
    """2.675 scales to 267.5, as array libraries have it, and not to its exact decimal value."""
    got = values(spark, [(2.5, 0.125, 2.675)], "a double, b double, c double", numeric.r0("a"), numeric.r2("b"), numeric.r2("c"))
    assert got == [(2.0, 0.12, 2.68)]


def test_ratio_by_zero_is_null(spark):
    assert values(spark, [(10, 0), (10, 4)], "a int, b int", numeric.ratio("a", "b")) == [(None,), (2.5,)]


def test_correlation_marks(spark):
    data = [(0.19,), (0.2,), (0.8,), (0.999,), (1.0,), (-0.5,), (None,)]
    got = values(spark, data, "r double", numeric.magnitude_mark("r"), numeric.magnitude_class("r"))
    assert [g[0] for g in got] == ["(-----)", "(*----)", "(****-)", "(****-)", "(*****)", "(**---)", None]
    assert [g[1] for g in got] == ["veryweak", "weak", "verystrong", "verystrong", None, "moderate", None]


@pytest.mark.parametrize(
    "category, channel, kind, kept",
    [(1, 1, 1, True), (5, 1, 1, False), (1, 2, 1, False), (1, 1, 4, False), (1, 1, 5, False), (None, 1, 1, False), (1, None, 1, False)],
)
def test_channel_exclusions_are_literal(spark, category, channel, kind, kept):
    frame = spark.createDataFrame([(category, channel, kind)], "a int, b int, c int")
    assert frame.where(rules.channel_in_scope("a", "b", "c")).count() == int(kept)


def test_labels_treat_null_as_other(spark):
    got = values(
        spark, [(None, None, None)], "a string, b string, c int",
        rules.role_label("a", "b"), rules.insurer_label("a"), rules.state_label("c"), rules.female_flag("a"),
    )
    assert got == [("Carga", "NO FONASA", "RECHAZADA", 0)]


def test_diagnosis_scope(spark):
    data = [(7, "F32"), (-1, "F32"), (16051, "F32"), (7, "Z10"), (7, "K01"), (7, "K10"), (7, "BBB"), (7, None)]
    frame = spark.createDataFrame(data, "i int, c string")
    assert [tuple(r) for r in frame.where(rules.diagnosis_in_scope("i", "c")).collect()] == [(7, "F32"), (7, "K10")]

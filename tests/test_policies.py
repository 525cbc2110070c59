import itertools

import pytest

from claimlens.operators import policies

PERIODS = ["202401", "202402", "202403", "202404"]
CASES = ["SIN_DATOS", "SOLO_CANCELADOS", "COMIENZA_CANCELADA", "MESES_NO_REGISTRADOS"]


def long(spark, series, zeros=True):
    data = [(p, t, v) for p, vs in series.items() for t, v in zip(PERIODS, vs) if zeros or v or not any(vs)]
    return spark.createDataFrame(data, "poliza string, periodo string, valor int")


def flags_of(values):
    """Straight reading of the rules for one series."""
    active = [v for v in values if v]
    if not active:
        return (1, 1, 0, 0, 0)
    tail = values[next(i for i, v in enumerate(values) if v):]
    only, starts, silent = all(v == -1 for v in active), tail[0] == -1, 0 in tail
    return (int(only or starts or silent), 0, int(only), int(starts), int(silent))


@pytest.fixture(scope="module")
def series():
    return {"p" + "".join("-01"[v + 1] for v in vs): list(vs) for vs in itertools.product((-1, 0, 1), repeat=4)}


@pytest.mark.parametrize("zeros", [True, False])
def test_flags_of_every_possible_series(spark, series, zeros):
    got = {r.poliza: (r.CASO, *[r[c] for c in CASES]) for r in policies.policy_flags(long(spark, series, zeros), PERIODS).collect()}
    assert got == {p: flags_of(vs) for p, vs in series.items()}


def test_anomalous_policies_carry_their_series(spark, series):
    found = policies.anomalous_policies(long(spark, series, zeros=False), PERIODS).collect()
    assert {r.POLIZA: [r[p] for p in PERIODS] for r in found} == {p: vs for p, vs in series.items() if flags_of(vs)[0]}


def test_series_from_first_activity(spark, series):
    got = {}
    for r in policies.partial_series(long(spark, series, zeros=False), PERIODS).orderBy("poliza", "periodo").collect():
        got.setdefault(r.poliza, []).append(r.valor)
    expected = {p: vs[next(i for i, v in enumerate(vs) if v):] for p, vs in series.items() if any(vs)}
    assert got == expected


def test_running_activity_and_first_active(spark):
    matrix = long(spark, {"x": [0, -1, 0, 1]})
    assert [r.acumulado for r in policies.running_activity(matrix).orderBy("periodo").collect()] == [0, 1, 1, 2]
    assert [tuple(r) for r in policies.first_active(matrix).collect()] == [("x", "202402", -1)]


def test_conflicting_events_take_the_largest_then_the_positive(spark):
    events = spark.createDataFrame(
        [("a", "1", 0), ("a", "1", -1), ("b", "1", -1), ("b", "1", 1), ("c", "1", 0)], "poliza string, periodo string, valor int"
    )
    assert {r.poliza: r.valor for r in policies.policy_matrix(events).collect()} == {"a": -1, "b": 1, "c": 0}


def test_one_policy_with_most_events_stays_one_row_per_period(spark):
    events = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('p', id)) as poliza", "cast(202401 + id % 4 as string) as periodo", "cast(1 as int) as valor"
    )
    matrix = policies.policy_matrix(events)
    assert matrix.where("poliza = 'hot'").count() == 4
    assert policies.policy_flags(matrix).where("poliza = 'hot'").first().CASO == 0


def test_any_number_of_periods(spark):
    """Six thousand daily periods: flags and long series without a limit."""
    events = spark.range(6000).selectExpr(
        "if(id % 2 = 0, 'even', 'odd') as poliza", "date_format(date_add(date'2000-01-01', cast(id as int)), 'yyyyMMdd') as periodo", "1 as valor"
    )
    flags = {r.poliza: r for r in policies.policy_flags(events).collect()}
    assert flags["even"].MESES_NO_REGISTRADOS == flags["odd"].MESES_NO_REGISTRADOS == 1
    series = policies.anomalous_series(events)
    assert series.count() == 12_000 and series.where("valor = 1").count() == 6000
    assert policies.partial_series(events).count() == 6000 + 5999

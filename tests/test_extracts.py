from datetime import datetime
from decimal import Decimal

import pytest

from claimlens.plans import claims, detail, insured
from tests.conftest import rows
from tests.micro import Micro

PERIOD = ("20240601", "20240701")


def mental(**changes):
    return {"CodigoBeneficio": "0501", **changes}


def test_classification_needs_validity_and_matching_bridges(spark):
    codes = {r.CodigoPrestacion for r in claims.classification(Micro().build(spark)).collect()}
    assert codes == {"0501", "502", "505", "", "A1"}
    codes = {r.CodigoPrestacion for r in claims.classification(Micro().build(spark), "SALUD MENTAL").collect()}
    assert codes == {"0501", "502", "", "A1"}


def test_period_is_half_open_and_plan_rule_is_optional(spark):
    wh = Micro()
    inside = wh.claim(FechaRecepcionLiquidacionVC=datetime(2024, 6, 1), FechaSiniestro=datetime(2024, 6, 1))
    wh.claim(FechaRecepcionLiquidacionVC=datetime(2024, 7, 1))
    wh.claim(FechaSiniestro=datetime(2024, 5, 31, 23, 59))
    wh.claim(vigente=0)
    dental = wh.claim(IdPlanBeneficio="DENTAL")
    unknown = wh.claim(IdPlanBeneficio=None)
    tables = wh.build(spark)
    free = {r.idsiniestro for r in claims.claims_in_period(tables, *PERIOD, plan_rule=False).collect()}
    strict = {r.idsiniestro for r in claims.claims_in_period(tables, *PERIOD, plan_rule=True).collect()}
    assert free == {inside, dental, unknown}
    assert strict == {inside}


def test_detail_rows_drop_every_rule_breaker(spark):
    wh = Micro()
    wh.claim(request="good")
    wh.claim(IdCanal=3)
    wh.claim(IdCanal=9)
    wh.claim(IdDenuncioTipo=4)
    wh.claim(IdCanal=None)
    wh.claim(IdPrevisionAsegurado=3)
    wh.claim(details=[{"IdLiquidacionDetalleEstado": 2}])
    wh.claim(details=[{"CodigoBeneficio": "505"}])
    wh.claim(details=[{"CodigoBeneficio": "A1"}])
    wh.claim(settlements=0)
    got = detail.detail_rows(wh.build(spark), *PERIOD).collect()
    assert [r.NumeroSolicitud for r in got] == ["good"]


def test_blank_code_counts_as_zero(spark):
    wh = Micro()
    wh.claim(details=[{"CodigoBeneficio": ""}])
    assert [r.CodigoBeneficio for r in detail.detail_rows(wh.build(spark), *PERIOD).collect()] == [0]


@pytest.mark.parametrize("rows_of", [detail.weighted_rows, detail.detail_rows])
def test_two_settlements_weigh_the_sums(spark, rows_of):
    wh = Micro()
    wh.claim(settlements=2)
    (row,) = detail.requests(rows_of(wh.build(spark), *PERIOD)).collect()
    assert (row.Cantidad, row.ValorPrestacionCLP, row.CostoUnitarioCLP) == (4, Decimal("20.0000"), 5.0)
    assert (row.RutTitular, row.RutPrestador) == ("0000000000100"[-12:], "00000000007")


@pytest.mark.parametrize("quantity, kept", [(0, False), (2, True), (99, True), (100, False)])
def test_quantity_limits(spark, quantity, kept):
    wh = Micro()
    wh.claim(details=[{"cantidad": quantity}])
    got = detail.requests(detail.detail_rows(wh.build(spark), *PERIOD)).collect()
    assert [r.Cantidad for r in got] == ([quantity] if kept else [])


def test_provider_label_is_not_padded(spark):
    wh = Micro()
    wh.claim(branch=901)
    wh.claim(branch=902)
    got = {r.RutPrestador for r in detail.requests(detail.detail_rows(wh.build(spark), *PERIOD)).collect()}
    assert got == {"Sin rut prestador", "00123456789-"}


@pytest.mark.parametrize(
    "criterion, flags",
    [
        (("2", "1", "100"), (0, 0, 0)),  # quantity equal to the bound is not high
        (("1", "1", "100"), (1, 0, 0)),
        (("9", "1", "5"), (0, 1, 0)),  # cost equal to the upper bound is high
        (("9", "5", "100"), (0, 0, 1)),  # cost equal to the lower bound is low
        (None, (0, 0, 0)),
    ],
)
def test_outlier_bounds(spark, criterion, flags):
    wh = Micro()
    wh.claim()
    if criterion:
        wh.criterion(*criterion)
    tables = wh.build(spark)
    grouped = detail.requests(detail.detail_rows(tables, *PERIOD))
    flagged = detail.flag_outliers(grouped, detail.outlier_criteria(tables))
    (row,) = flagged.collect()
    assert (row.OutlierCantidadAlta, row.OutlierCostoAlto, row.OutlierCostoBajo) == flags
    kept = detail.regular_rows(flagged)
    assert kept.count() == int(sum(flags) == 0)
    assert kept.columns == detail.EXPORT


def test_two_criteria_make_two_rows_and_expired_models_make_none(spark):
    wh = Micro()
    wh.claim()
    wh.criterion("9", "1", "100")
    wh.criterion("8", "1", "100")
    wh.criterion("0", "1", "100", statistic=2)
    assert detail.detail_extract(wh.build(spark), *PERIOD).count() == 2


def test_cohort_keeps_unclassified_benefits_and_is_distinct(spark):
    wh = Micro()
    wh.claim(settlements=3, details=[{"CodigoBeneficio": "999", "IdGrupo": 200}, {"IdGrupo": 300}, {"IdGrupo": 400}])
    got = rows(insured.cohort_rows(wh.build(spark), *PERIOD).select("CodigoBeneficio", "ClasificacionSubgrupo", "GlosaBeneficio"))
    assert got == [(501, "SALUD MENTAL", "OTROS BENEFICIOS"), (999, None, "BENEFICIOS DE SALUD MENTAL")]


def test_holder_windows_need_a_mental_health_benefit(spark):
    wh = Micro()
    wh.claim(RutTitular="a")
    wh.claim(RutTitular="a", FechaRecepcionLiquidacionVC=datetime(2024, 6, 20, 8, 0))
    wh.claim(RutTitular="b", details=[{"CodigoBeneficio": "505", "IdGrupo": 400}])
    got = rows(insured.holder_windows(insured.cohort_rows(wh.build(spark), *PERIOD)))
    assert got == [("a", datetime(2024, 6, 20, 8, 0), datetime(2023, 6, 20, 8, 0), datetime(2024, 5, 20, 8, 0))]


def test_history_takes_the_window_and_keeps_rejected_details(spark):
    wh = Micro()
    wh.claim(request="now", details=[{}, {"IdLiquidacionDetalleEstado": 2}], rejections=2)
    wh.claim(request="old", FechaRecepcionLiquidacionVC=datetime(2023, 6, 10, 9, 30))
    wh.claim(request="too old", FechaRecepcionLiquidacionVC=datetime(2023, 6, 10, 9, 29))
    wh.claim(request="late report", FechaSiniestro=datetime(2024, 5, 10, 9, 29))
    wh.claim(request="other holder", RutTitular="zz", FechaRecepcionLiquidacionVC=datetime(2024, 1, 1))
    history = insured.insured_history(wh.build(spark), *PERIOD).collect()
    # two rejection rows repeat each detail of the claim
    assert sorted((r.NumeroSolicitud, r.Estado) for r in history) == [
        ("now", "APROBADA"), ("now", "APROBADA"), ("now", "RECHAZADA"), ("now", "RECHAZADA"), ("old", "APROBADA"),
    ]
    row = next(r for r in history if r.NumeroSolicitud == "now")
    assert (row.RolPersona, row.TitularFemenino, row.EdadTitular, row.Prevision) == ("Titular", 1, 24, "FONASA")
    assert (row.PeriodoPrestacion, row.PeriodoLiquidacion, row.Hospitalizacion) == ("202406", "202406", 1)
    assert row.ValorPagoCLP == Decimal("5.0000")


def test_diagnoses_are_counted_once_per_person(spark):
    wh = Micro()
    wh.claim(settlements=2, details=[{}, {}])
    wh.claim(idcausaprimaria=9)
    wh.claim(idcausaprimaria=8)
    wh.claim(idcausaprimaria=10)
    wh.claim(idcausaprimaria=0)
    wh.claim(idcausaprimaria=9, details=[{"CodigoBeneficio": "505", "IdGrupo": 400}], RutSiniestrado="child")
    tables = wh.build(spark)
    people = insured.insured_history(tables, *PERIOD)
    per_person = insured.person_diagnoses(tables, people)
    assert rows(per_person) == [("100", "100", 2, "DEPRESION", "ANSIEDAD")]
    joined = insured.with_diagnoses(people, insured.holder_diagnoses(per_person))
    assert {r.Diagnosticos for r in joined.collect()} == {2}


def test_provider_profile_over_three_months(spark):
    wh = Micro()
    wh.claim(settlements=2)
    wh.claim(RutTitular="200", RutSiniestrado="201", IdPrevisionAsegurado=2, IdCanal=4, details=[{"CodigoBeneficio": "502"}])
    wh.claim(RutSiniestrado="zz", FechaRecepcionLiquidacionVC=datetime(2024, 3, 10, 9, 29))
    tables = wh.build(spark)
    history = insured.insured_history(tables, *PERIOD)
    (row,) = insured.provider_profiles(tables, insured.provider_windows(history)).collect()
    assert (row.PrestadorBeneficiarios, row.PrestadorSolicitudes, row.PrestadorPrestaciones) == (2, 2, 2)
    # the claim with two settlements weighs twice in shares and sums
    assert (row.PrestadorFonasa, row.PrestadorImed) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    assert row.PrestadorValorPrestacion == Decimal("1.5")


def test_insured_export_layout(spark):
    wh = Micro()
    wh.claim()
    got = insured.insured_extract(wh.build(spark), *PERIOD)
    assert got.columns == insured.EXPORT and len(got.columns) == 36
    assert got.count() == 1


def test_rejected_requests_are_counted_beside_approved_rows(spark):
    frame = spark.createDataFrame(
        [("a", "1", "APROBADA"), ("a", "2", "RECHAZADA"), ("a", "2", "RECHAZADA"), ("b", "3", "APROBADA")],
        "RutTitular string, NumeroSolicitud string, Estado string",
    )
    got = rows(insured.approved_with_rejections(frame).select("RutTitular", "SolicitudesRechazadas"))
    assert got == [("a", 1), ("b", 0)]


def test_a_holder_with_a_third_of_all_claims(spark):
    """A hot holder and provider change nothing but the work per task."""
    wh = Micro()
    for i in range(30):
        wh.claim(RutTitular="hot" if i % 3 == 0 else f"h{i}", RutSiniestrado=f"p{i}", branch=901)
    tables = wh.build(spark)
    windows = insured.holder_windows(insured.cohort_rows(tables, *PERIOD))
    assert windows.count() == 21
    assert insured.holder_history(tables, windows).count() == 30

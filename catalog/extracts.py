"""The composed extract queries."""

from __future__ import annotations

from catalog.base import DIAGNOSES_SINCE, SINCE, UNTIL, doubles, plain, warehouse_query
from claimlens.plans import claims, detail, insured
from claimlens.session import stage


CLASS_IDS = ["IdGrupoPrestacion", "IdSubgrupoPrestacion", "IdAperturaPrestacion"]
CLASS_IDS_SQL = "replace (" + ", ".join(f"{c}::double as {c}" for c in CLASS_IDS) + ")"


def history(wh):
    return insured.insured_history(wh, SINCE, UNTIL)


@warehouse_query("q1_benefit_classification", "select * exclude (codigo) from clasif")
def q1(wh):
    return claims.classification(wh)


@warehouse_query(
    "q1_mental_health_classification",
    "select * exclude (codigo) from clasif where ClasificacionSubgrupo = 'SALUD MENTAL'",
)
def q1_mental(wh):
    return claims.classification(wh, "SALUD MENTAL")


@warehouse_query(
    "q2_detail_rows",
    """select * replace (ValorPrestacionCLP::double as ValorPrestacionCLP, ValorPrestacionUF::double as ValorPrestacionUF,
              ValorReclamadoCLP::double as ValorReclamadoCLP, ValorReclamadoUF::double as ValorReclamadoUF,
              ValorPagoCLP::double as ValorPagoCLP, ValorPagoUF::double as ValorPagoUF)
       from detalle""",
)
def q2(wh):
    return plain(detail.detail_rows(wh, SINCE, UNTIL))


@warehouse_query("q3_requests", "select * from solicitudes")
def q3(wh):
    return plain(detail.requests(detail.weighted_rows(wh, SINCE, UNTIL)))


@warehouse_query(
    "out1_outlier_criteria",
    """select * replace (CriterioCantidadAlta::double as CriterioCantidadAlta,
              CriterioCostoUnitarioBajo::double as CriterioCostoUnitarioBajo,
              CriterioCostoUnitarioAlto::double as CriterioCostoUnitarioAlto)
       from criterios""",
)
def out1(wh):
    return plain(detail.outlier_criteria(wh))


@warehouse_query("out2_outlier_flags", "select * from marcadas")
def out2(wh):
    grouped = detail.requests(detail.weighted_rows(wh, SINCE, UNTIL))
    return plain(detail.flag_outliers(grouped, detail.outlier_criteria(wh)))


@warehouse_query("out3_detail_extract", "select * from regulares")
def out3(wh):
    return plain(detail.detail_extract(wh, SINCE, UNTIL))


@warehouse_query("q4_cohort_rows", f"select * {CLASS_IDS_SQL} from candidatos")
def q4(wh):
    return doubles(insured.cohort_rows(wh, SINCE, UNTIL), *CLASS_IDS)


@warehouse_query("q5_holder_windows", "select * from titulares")
def q5(wh):
    return insured.holder_windows(insured.cohort_rows(wh, SINCE, UNTIL))


@warehouse_query("q6_holder_history", f"select * {CLASS_IDS_SQL} from historia")
def q6(wh):
    return doubles(plain(history(wh)), *CLASS_IDS)


@warehouse_query("q7_person_diagnoses", "select * from diagnosticos")
def q7(wh):
    wh = claims.extract_of(wh)
    return insured.person_diagnoses(wh, history(wh), since=DIAGNOSES_SINCE)


@warehouse_query(
    "q7_history_with_diagnoses",
    f"""select h.* {CLASS_IDS_SQL}, coalesce(d.Diagnosticos, 0) as Diagnosticos
       from historia h left join diagnosticos_titular d on d.RutTitular = h.RutTitular""",
)
def q7_joined(wh):
    wh = claims.extract_of(wh)
    rows = history(wh)
    per_holder = insured.holder_diagnoses(insured.person_diagnoses(wh, rows, since=DIAGNOSES_SINCE))
    return doubles(plain(insured.with_diagnoses(rows, per_holder)), *CLASS_IDS)


@warehouse_query("q8_provider_profiles", "select * from perfiles")
def q8(wh):
    wh = claims.extract_of(wh)
    windows = stage(insured.provider_windows(history(wh)), "provider-windows")
    return plain(insured.provider_profiles(wh, windows))


@warehouse_query(
    "q9_insured_extract",
    """select h.* exclude (FechaRecepcionLiquidacion, IdGrupoPrestacion, IdSubgrupoPrestacion, IdAperturaPrestacion, Estado),
              h.FechaRecepcionLiquidacion as FechaLiquidacion,
              p.* exclude (RutPrestador)
       from historia h join perfiles p on p.RutPrestador = h.RutPrestador""",
)
def q9(wh):
    return plain(insured.insured_extract(wh, SINCE, UNTIL))

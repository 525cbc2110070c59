"""Insured extract: one year of history for holders with mental-health benefits, with provider profiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions import rules
from claimlens.functions.dates import age_years, back, day_literal, period
from claimlens.functions.numeric import flag, ratio
from claimlens.plans import claims
from claimlens.session import stage
from claimlens.sources.warehouse import Warehouse

# First day of diagnoses, and the column names of the profile and the export.
DIAGNOSES_SINCE = "20190101"

PROFILE = [
    "NombrePrestador", "PrestadorFonasa", "PrestadorImed", "PrestadorBeneficiarios", "PrestadorSolicitudes",
    "PrestadorPrestaciones", "PrestadorValorPrestacion", "PrestadorValorPago",
]

EXPORT = [
    "RolPersona", "RutTitular", "TitularFemenino", "EdadTitular", "RutSiniestrado", "SiniestradoFemenino",
    "EdadSiniestrado", "Prevision", "CanalLiquidacion", "FechaPrestacion", "PeriodoPrestacion",
    "FechaLiquidacion", "PeriodoLiquidacion", "NumeroSolicitud", "CodigoBeneficio",
    "ClasificacionGrupo", "ClasificacionSubgrupo", "ClasificacionApertura", "GlosaBeneficio", "Hospitalizacion",
    "Cantidad", "ValorPrestacionCLP", "ValorPrevisionCLP", "ValorReclamadoCLP", "ValorIndemnizarCLP",
    "ValorDeducibleCLP", "ValorPagoCLP", "RutPrestador", *PROFILE,
]


def cohort_rows(wh: Warehouse, since: str, until: str) -> DataFrame:
    """Distinct approved details of the period, classified where a class is known."""
    in_period = claims.enrich_claims(wh, claims.claims_in_period(wh, since, until, plan_rule=True))
    return (
        claims.fan_out(wh, in_period, True, claims.providers(wh).select("idprestadorsucursal"))
        .join(claims.benefit_groups(wh), "IdGrupo")
        .join(claims.classification_by_code(wh), "CodigoBeneficio", "left")
        .select(
            "RutTitular",
            F.col("FechaRecepcionLiquidacionVC").alias("FechaRecepcionLiquidacion"),
            "CodigoBeneficio",
            "IdGrupoPrestacion", "ClasificacionGrupo",
            "IdSubgrupoPrestacion", "ClasificacionSubgrupo",
            "IdAperturaPrestacion", "ClasificacionApertura",
            "GlosaBeneficio",
        )
        .distinct()
    )


def holder_windows(cohort: DataFrame) -> DataFrame:
    """Per holder with mental-health benefits: last settlement, a year and a month before it."""
    last = F.max("FechaRecepcionLiquidacion")
    return (
        cohort.where(rules.is_mental_health("GlosaBeneficio", "ClasificacionSubgrupo"))
        .groupBy("RutTitular")
        .agg(last.alias("LiquidacionHasta"))
        .withColumns(
            {
                "LiquidacionDesde": back("LiquidacionHasta", years=1),
                "PrestacionDesde": back("LiquidacionHasta", months=1),
            }
        )
    )


def within(column: str, windows: DataFrame, first: str, last: str) -> Column:
    """The span all windows cover, as two scalar subqueries.

    Implied by the per-key window join that follows; it lets the scan skip claims outside
    every window before they are shuffled.
    """
    low = windows.agg(F.min(first)).scalar()
    high = windows.agg(F.max(last)).scalar()
    return F.col(column).between(low, high)


def persons(wh: Warehouse, prefix: str, key: str) -> DataFrame:
    return wh["persona"].select(
        F.col("idpersona").alias(key),
        F.col("sexo").alias(f"{prefix}_sexo"),
        F.col("fechanacimiento").alias(f"{prefix}_nacimiento"),
    )


def holder_history(wh: Warehouse, windows: DataFrame) -> DataFrame:
    """Every detail, approved or not, of the cohort's claims inside each holder's window.

    Person, channel and insurer joins run at claim grain; only then do claims fan out. Rows
    repeat per settlement and per rejection of their detail; both are counted first and the
    repetition is the last step.
    """
    claim = (
        claims.valid_claims(wh, plan_rule=True)
        .where(within("FechaRecepcionLiquidacionVC", windows, "LiquidacionDesde", "LiquidacionHasta"))
        .join(windows, "RutTitular")
        .where(
            F.col("FechaRecepcionLiquidacionVC").between(F.col("LiquidacionDesde"), F.col("LiquidacionHasta"))
            & (F.col("FechaSiniestro") >= F.col("PrestacionDesde"))
        )
    )
    claim = (
        claims.enrich_claims(wh, claim)
        .join(persons(wh, "titular", "IdTitular"), "IdTitular")
        .join(persons(wh, "siniestrado", "IdSiniestrado"), "IdSiniestrado")
    )
    details = (
        claims.fan_out(wh, claim, False, claims.providers(wh).drop("NombrePrestador"))
        .join(claims.benefit_groups(wh), "IdGrupo")
        .join(claims.classification_by_code(wh), "CodigoBeneficio", "left")
        .join(claims.rejection_counts(wh), "idliquidaciondetalle", "left")
    )
    return (
        claims.repeat_rows(details, F.col("Liquidaciones"), F.coalesce("Rechazos", F.lit(1))).select(
            rules.role_label("RutTitular", "RutSiniestrado").alias("RolPersona"),
            "RutTitular",
            rules.female_flag("titular_sexo").alias("TitularFemenino"),
            age_years("titular_nacimiento", "FechaBeneficio").alias("EdadTitular"),
            "RutSiniestrado",
            rules.female_flag("siniestrado_sexo").alias("SiniestradoFemenino"),
            age_years("siniestrado_nacimiento", "FechaBeneficio").alias("EdadSiniestrado"),
            rules.insurer_label("GlosaIsapre").alias("Prevision"),
            F.col("GlosaHomologacion").alias("CanalLiquidacion"),
            F.col("NumeroDenuncio").alias("NumeroSolicitud"),
            F.col("FechaBeneficio").alias("FechaPrestacion"),
            period("FechaBeneficio").alias("PeriodoPrestacion"),
            F.col("FechaRecepcionLiquidacionVC").alias("FechaRecepcionLiquidacion"),
            period("FechaRecepcionLiquidacionVC").alias("PeriodoLiquidacion"),
            "CodigoBeneficio",
            "IdGrupoPrestacion", "ClasificacionGrupo",
            "IdSubgrupoPrestacion", "ClasificacionSubgrupo",
            "IdAperturaPrestacion", "ClasificacionApertura",
            "GlosaBeneficio",
            rules.hospital_flag("IdGrupo", "IdCategorizacionCanal").alias("Hospitalizacion"),
            F.col("cantidad").alias("Cantidad"),
            F.col("MontoValorBeneficio").alias("ValorPrestacionCLP"),
            F.col("MontoAporteInstitucionSalud").alias("ValorPrevisionCLP"),
            F.col("MontoReclamado").alias("ValorReclamadoCLP"),
            F.col("MontoLiquidado").alias("ValorIndemnizarCLP"),
            F.col("MontoDeduciblePrestacion").alias("ValorDeducibleCLP"),
            (F.col("MontoLiquidado") - F.col("MontoDeduciblePrestacion")).alias("ValorPagoCLP"),
            rules.state_label("IdLiquidacionDetalleEstado").alias("Estado"),
            "RutPrestador",
        )
    )


def person_diagnoses(
    wh: Warehouse,
    people: DataFrame,
    since: str = DIAGNOSES_SINCE,
    until: Column | None = None,
    keep: claims.Keep = stage,
) -> DataFrame:
    """Distinct mental-health diagnoses per holder and person.

    The claims of those people are picked first; only theirs meet documents and details.
    Keys of the semi-joins are made distinct before they move, and written, so that the claims
    of one person can be split; so are the diagnoses made distinct: a person with a third of the
    history is a handful of rows per task by then.
    """
    known = wh["diagnostico"].where(rules.diagnosis_in_scope("idDiagnostico", "codigo")).select(
        F.col("idDiagnostico").alias("idcausaprimaria"), F.col("Glosa").alias("Diagnostico")
    )
    last = F.localtimestamp() if until is None else until
    diagnosed = (
        claims.valid_claims(wh, plan_rule=False)
        .where(F.col("FechaRecepcionLiquidacionVC").between(day_literal(since), last))
        .where("idcausaprimaria != 0")
        .join(known, "idcausaprimaria")
        .join(keep(people.select("RutSiniestrado").distinct(), "people"), "RutSiniestrado", "left_semi")
        .join(wh["denuncio"], "iddenuncio", "left_semi")
    )
    return (
        claims.fan_out(wh, diagnosed, True)
        .join(claims.benefit_groups(wh), "IdGrupo")
        .join(claims.classification_by_code(wh), "CodigoBeneficio", "left")
        .where(rules.is_mental_health("GlosaBeneficio", "ClasificacionSubgrupo"))
        .select("RutTitular", "RutSiniestrado", "Diagnostico")
        .distinct()
        .groupBy("RutTitular", "RutSiniestrado")
        .agg(
            F.count("Diagnostico").alias("Diagnosticos"),
            F.max("Diagnostico").alias("Diagnostico1"),
            F.min("Diagnostico").alias("Diagnostico2"),
        )
    )


def holder_diagnoses(per_person: DataFrame) -> DataFrame:
    return per_person.groupBy("RutTitular").agg(F.sum("Diagnosticos").alias("Diagnosticos"))


def with_diagnoses(history: DataFrame, per_holder: DataFrame, keep: claims.Keep = stage) -> DataFrame:
    """History with the holder's diagnosis count, 0 where there is none.

    An aggregate on the join's own key is written first: read from a table it has a shuffle
    of its own, and the rows of a holder with very many can be split."""
    return history.join(keep(per_holder, "holder-diagnoses"), "RutTitular", "left").withColumn(
        "Diagnosticos", F.coalesce("Diagnosticos", F.lit(0))
    )


def approved_with_rejections(history: DataFrame, keep: claims.Keep = stage) -> DataFrame:
    """Approved rows with the holder's number of rejected requests (switched off in the extract)."""
    rejected = (
        history.where("Estado = 'RECHAZADA'")
        .groupBy("RutTitular")
        .agg(F.countDistinct("NumeroSolicitud").alias("SolicitudesRechazadas"))
    )
    return (
        history.where("Estado = 'APROBADA'")
        .join(keep(rejected, "rejected-requests"), "RutTitular", "left")
        .withColumn("SolicitudesRechazadas", F.coalesce("SolicitudesRechazadas", F.lit(0)))
    )


def provider_windows(history: DataFrame) -> DataFrame:
    """Per provider: last settlement in the history and three months before it."""
    return (
        history.groupBy("RutPrestador")
        .agg(F.max("FechaRecepcionLiquidacion").alias("FechaHasta"))
        .withColumn("FechaDesde", back("FechaHasta", months=3))
    )


def provider_profiles(wh: Warehouse, windows: DataFrame) -> DataFrame:
    """Profile of each provider over its window, across all of its claims.

    The windows meet the branch table first: dimension against dimension, so the facts never
    shuffle by provider id before the aggregate, whose partial step runs ahead of its shuffle.
    A claim weighs as often as it has settlements.
    """
    branches = claims.providers(wh).join(windows, "RutPrestador")
    claim = claims.valid_claims(wh, plan_rule=True).where(
        within("FechaRecepcionLiquidacionVC", windows, "FechaDesde", "FechaHasta")
    )
    rows = (
        claims.fan_out(wh, claims.enrich_claims(wh, claim), True, branches)
        .where(F.col("FechaRecepcionLiquidacionVC").between(F.col("FechaDesde"), F.col("FechaHasta")))
        .join(claims.benefit_groups(wh), "IdGrupo")
    )
    times = F.col("Liquidaciones")
    public = flag(rules.is_public("GlosaIsapre"))
    electronic = flag(F.col("GlosaHomologacion") == rules.ELECTRONIC_CHANNEL)
    return rows.groupBy("RutPrestador").agg(
        F.max("NombrePrestador").alias("NombrePrestador"),
        F.countDistinct("RutSiniestrado").alias("PrestadorBeneficiarios"),
        ratio(F.sum(public * times), F.sum(times)).alias("PrestadorFonasa"),
        ratio(F.sum(electronic * times), F.sum(times)).alias("PrestadorImed"),
        F.countDistinct("NumeroDenuncio").alias("PrestadorSolicitudes"),
        F.countDistinct("CodigoBeneficio").alias("PrestadorPrestaciones"),
        F.sum(F.col("MontoConversionBeneficio") * times).alias("PrestadorValorPrestacion"),
        F.sum(F.col("MontoConversionLiquidado") * times).alias("PrestadorValorPago"),
    )


def export_rows(history: DataFrame, profiles: DataFrame, keep: claims.Keep = stage) -> DataFrame:
    """History of providers that have a profile, in the export layout.

    The label of providers without an id is one key: written profiles let its rows be split."""
    return (
        history.join(keep(profiles, "provider-profiles"), "RutPrestador")
        .withColumnRenamed("FechaRecepcionLiquidacion", "FechaLiquidacion")
        .select(*EXPORT)
    )


def insured_history(
    wh: Warehouse,
    since: str,
    until: str,
    keep: Callable[[DataFrame, str], DataFrame] = stage,
) -> DataFrame:
    """Cohort, windows and history; windows and history are kept, as both are read again."""
    wh = claims.extract_of(wh, keep)
    windows = keep(holder_windows(cohort_rows(wh, since, until)), "holder-windows")
    return keep(holder_history(wh, windows), "holder-history")


def insured_extract(
    wh: Warehouse,
    since: str,
    until: str,
    keep: Callable[[DataFrame, str], DataFrame] = stage,
) -> DataFrame:
    """The full 36-column export.

    The diagnosis count is part of an intermediate table only (``with_diagnoses``): the export
    does not carry it, and the left join on a unique holder key changes no row, so it is left out.
    """
    wh = claims.extract_of(wh, keep)
    history = insured_history(wh, since, until, keep)
    windows = keep(provider_windows(history), "provider-windows")
    return export_rows(history, provider_profiles(wh, windows), keep)

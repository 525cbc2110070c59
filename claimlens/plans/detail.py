"""Detail extract: approved mental-health details of a period, grouped, with outlier rows removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions import rules
from claimlens.functions.numeric import flag, ratio
from claimlens.functions.text import pad_id, pad_provider_id
from claimlens.plans import claims
from claimlens.sources.warehouse import Warehouse

# Column names of the criteria, the request grain, its measures and the export.
CRITERIA_KEYS = ["IdGrupoPrestacion", "IdSubgrupoPrestacion", "IdAperturaPrestacion"]

GRAIN = [
    "RutTitular", "RutBeneficiario", "NumeroSolicitud", "FechaPrestacion", "FechaRecepcionLiquidacion",
    "Prevision", "RutPrestador", "NombrePrestador",
    "IdGrupoPrestacion", "ClasificacionGrupo", "IdSubgrupoPrestacion", "ClasificacionSubgrupo",
    "IdAperturaPrestacion", "ClasificacionApertura",
]

MEASURES = [
    "Cantidad", "ValorPrestacionCLP", "ValorPrestacionUF", "ValorReclamadoCLP", "ValorReclamadoUF",
    "ValorPagoUF", "ValorPagoCLP",
]

EXPORT = [
    "RutTitular", "RutBeneficiario", "NumeroSolicitud",
    "IdGrupoPrestacion", "ClasificacionGrupo", "IdSubgrupoPrestacion", "ClasificacionSubgrupo",
    "IdAperturaPrestacion", "ClasificacionApertura",
    "Cantidad", "ValorPrestacionCLP", "ValorPrestacionUF", "CostoUnitarioCLP", "ValorReclamadoCLP",
    "ValorPagoUF", "ValorPagoCLP", "FechaPrestacion", "FechaRecepcionLiquidacion", "Prevision",
    "RutPrestador", "NombrePrestador",
]

QUANTITY_LIMIT = 100


WEIGHT = "Liquidaciones"


def weighted_rows(wh: Warehouse, since: str, until: str, subgroup: str | None = rules.MENTAL_HEALTH) -> DataFrame:
    """Approved, classified details of claims settled in the period, with the claim's settlement count."""
    wh = claims.extract_of(wh)
    in_period = claims.enrich_claims(wh, claims.claims_in_period(wh, since, until, plan_rule=False))
    return (
        claims.fan_out(wh, in_period, True, claims.providers(wh))
        .join(claims.classification_by_code(wh, subgroup), "CodigoBeneficio")
        .select(
            "RutTitular",
            F.col("RutSiniestrado").alias("RutBeneficiario"),
            F.col("NumeroDenuncio").alias("NumeroSolicitud"),
            F.col("FechaBeneficio").alias("FechaPrestacion"),
            F.col("FechaRecepcionLiquidacionVC").alias("FechaRecepcionLiquidacion"),
            "CodigoBeneficio",
            "IdGrupoPrestacion",
            "ClasificacionGrupo",
            "IdSubgrupoPrestacion",
            "ClasificacionSubgrupo",
            "IdAperturaPrestacion",
            "ClasificacionApertura",
            F.col("cantidad").alias("Cantidad"),
            F.col("MontoValorBeneficio").alias("ValorPrestacionCLP"),
            F.col("MontoConversionBeneficio").alias("ValorPrestacionUF"),
            F.col("MontoReclamado").alias("ValorReclamadoCLP"),
            F.col("MontoConversionReclamado").alias("ValorReclamadoUF"),
            F.col("MontoLiquidado").alias("ValorPagoCLP"),
            F.col("MontoConversionLiquidado").alias("ValorPagoUF"),
            rules.insurer_label("GlosaIsapre").alias("Prevision"),
            "RutPrestador",
            "NombrePrestador",
            WEIGHT,
        )
    )


def detail_rows(wh: Warehouse, since: str, until: str, subgroup: str | None = rules.MENTAL_HEALTH) -> DataFrame:
    """The same details as plain rows: a claim with two settlements has each of them twice."""
    return claims.repeat_rows(weighted_rows(wh, since, until, subgroup), F.col(WEIGHT)).drop(WEIGHT)


def request_totals(rows: DataFrame) -> DataFrame:
    """Sums of quantity and amounts at the request grain.

    Weighted rows count as often as their claim has settlements, without being repeated.
    """
    times = F.col(WEIGHT) if WEIGHT in rows.columns else F.lit(1)
    return rows.groupBy(*GRAIN).agg(*[F.sum(F.col(m) * times).alias(m) for m in MEASURES])


def plausible(totals: DataFrame, limit: int = QUANTITY_LIMIT) -> DataFrame:
    return totals.where(
        (F.col("Cantidad") > 0) & (F.col("Cantidad") < limit) & (F.col("ValorPrestacionCLP") > 0)
    )


def with_unit_costs(totals: DataFrame) -> DataFrame:
    """Ratios of sums; computed after the plausibility filter and NULL on a zero quantity."""
    return totals.withColumns(
        {
            "CostoUnitarioCLP": ratio("ValorPrestacionCLP", "Cantidad"),
            "CostoUnitarioUF": ratio("ValorPrestacionUF", "Cantidad"),
        }
    )


def requests(rows: DataFrame, limit: int = QUANTITY_LIMIT) -> DataFrame:
    """Grouped request detail with unit costs and padded ids.

    Grouping is by the raw ids; padding cuts long ids and may make two of them look alike.
    """
    return with_unit_costs(plausible(request_totals(rows), limit)).withColumns(
        {
            "RutTitular": pad_id("RutTitular"),
            "RutBeneficiario": pad_id("RutBeneficiario"),
            "RutPrestador": pad_provider_id("RutPrestador"),
        }
    )


def outlier_criteria(wh: Warehouse) -> DataFrame:
    """Criteria in force, with the model they come from."""
    return (
        claims.in_force(wh, "modelo_analitico")
        .join(claims.in_force(wh, "modelo_generico"), "IdModeloGenerico")
        .join(claims.in_force(wh, "estadistico"), "IdModeloAnalitico")
        .join(claims.in_force(wh, "criterio_outlier_liquidacion"), "IdEstadistico")
        .select(
            *CRITERIA_KEYS,
            "CriterioCantidadAlta", "CriterioCostoUnitarioBajo", "CriterioCostoUnitarioAlto",
            "IdEstadistico", "DescripcionDetalle", "FechaModelo",
            "IdModeloAnalitico", "AreaProposito", "Descripcion",
            "GlosaModeloGenerico", "TipoMachineLearning",
        )
    )


def flag_outliers(grouped: DataFrame, criteria: DataFrame) -> DataFrame:
    """Outlier flags per request row; no criterion means no flag, several criteria mean several rows."""
    bounds = criteria.select(
        *CRITERIA_KEYS, "CriterioCantidadAlta", "CriterioCostoUnitarioBajo", "CriterioCostoUnitarioAlto"
    )
    return grouped.join(bounds, CRITERIA_KEYS, "left").withColumns(
        {
            "OutlierCantidadAlta": flag(F.col("Cantidad") > F.col("CriterioCantidadAlta")),
            "OutlierCostoAlto": flag(F.col("CostoUnitarioCLP") >= F.col("CriterioCostoUnitarioAlto")),
            "OutlierCostoBajo": flag(F.col("CostoUnitarioCLP") <= F.col("CriterioCostoUnitarioBajo")),
        }
    )


def regular_rows(flagged: DataFrame) -> DataFrame:
    """Rows without any flag, in the export layout."""
    quiet = (F.col("OutlierCantidadAlta") == 0) & (F.col("OutlierCostoAlto") == 0) & (F.col("OutlierCostoBajo") == 0)
    return flagged.where(quiet).select(*EXPORT)


def detail_extract(
    wh: Warehouse, since: str, until: str, subgroup: str | None = rules.MENTAL_HEALTH, limit: int = QUANTITY_LIMIT
) -> DataFrame:
    grouped = requests(weighted_rows(wh, since, until, subgroup), limit)
    return regular_rows(flag_outliers(grouped, outlier_criteria(wh)))

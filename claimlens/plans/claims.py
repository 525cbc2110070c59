"""Shared parts of the extracts: benefit classification and the claim-to-detail joins.

Joins carry no broadcast hints. Dimension sizes are not bounded by anything in the data
model, so the choice is left to Catalyst's size estimates and to AQE, which measures the
shuffled side before it turns a join into a broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions import rules
from claimlens.functions.dates import day_literal
from claimlens.functions.text import code_to_int
from claimlens.session import stage
from claimlens.sources.warehouse import Warehouse

Keep = Callable[[DataFrame, str], DataFrame]
COPIES = 1024  # of a row that are made at a time


class Extract:
    """A warehouse with the dimensions that one extract joins again and again, each written once.

    The planner knows a written table's size, so joins with it shuffle the facts only if it is large.
    """

    def __init__(self, wh: Warehouse, keep: Keep = stage):
        self._wh, self._keep = wh, keep
        self._kept: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return self._wh[name]

    def once(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        if label not in self._kept:
            self._kept[label] = self._keep(build(), label)
        return self._kept[label]


def extract_of(wh: Warehouse, keep: Keep = stage) -> Extract:
    return wh if isinstance(wh, Extract) else Extract(wh, keep)


def _once(wh: Warehouse, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    return wh.once(label, build) if isinstance(wh, Extract) else build()


def in_force(wh: Warehouse, name: str) -> DataFrame:
    """Rows of a dimension that are valid, without the validity column."""
    return wh[name].where("Vigencia = 1").drop("Vigencia")


def classification(wh: Warehouse, subgroup: str | None = None) -> DataFrame:
    """Benefit code with its group, subgroup and opening; optionally one subgroup only.

    A benefit takes part only if both of its bridge rows agree on the subgroup.
    """
    subgroups = in_force(wh, "subgrupo_prestacion")
    if subgroup is not None:
        subgroups = subgroups.where(F.col("ClasificacionSubgrupo") == subgroup)
    openings = in_force(wh, "subgrupo_apertura_prestacion").join(in_force(wh, "apertura_prestacion"), "IdAperturaPrestacion")
    groups = in_force(wh, "grupo_subgrupo_prestacion").join(in_force(wh, "grupo_prestacion"), "IdGrupoPrestacion")
    return (
        in_force(wh, "detalle_prestacion")
        .join(openings, "IdSubgrupoApertura")
        .join(groups, ["IdGrupoSubgrupo", "IdSubgrupoPrestacion"])
        .join(subgroups, "IdSubgrupoPrestacion")
        .join(in_force(wh, "patologia_asociada"), "IdPatologiaAsociada")
        .select(
            "CodigoPrestacion",
            "GlosaPrestacionHomologada",
            "IdGrupoPrestacion",
            "ClasificacionGrupo",
            "IdSubgrupoPrestacion",
            "ClasificacionSubgrupo",
            "IdAperturaPrestacion",
            "ClasificacionApertura",
        )
    )


def classification_by_code(wh: Warehouse, subgroup: str | None = None) -> DataFrame:
    """Classification keyed by the integer benefit code; blank and odd codes handled once, here."""
    return _once(wh, f"classification-{subgroup}".replace(" ", "-"), lambda: classification(wh, subgroup)).select(
        code_to_int("CodigoPrestacion").alias("CodigoBeneficio"),
        "IdGrupoPrestacion",
        "ClasificacionGrupo",
        "IdSubgrupoPrestacion",
        "ClasificacionSubgrupo",
        "IdAperturaPrestacion",
        "ClasificacionApertura",
    )


def between_days(column: str, since: str, until: str) -> Column:
    """Half-open period given as ``yyyymmdd``."""
    return (F.col(column) >= day_literal(since)) & (F.col(column) < day_literal(until))


def valid_claims(wh: Warehouse, plan_rule: bool) -> DataFrame:
    claims = wh["siniestro"].where("vigente = 1")
    return claims.where(rules.plan_in_scope("IdPlanBeneficio")) if plan_rule else claims


def claims_in_period(wh: Warehouse, since: str, until: str, plan_rule: bool) -> DataFrame:
    """Valid claims settled in the period and not older than its start."""
    return valid_claims(wh, plan_rule).where(
        between_days("FechaRecepcionLiquidacionVC", since, until)
        & (F.col("FechaSiniestro") >= day_literal(since))
    )


def channels(wh: Warehouse) -> DataFrame:
    """Channel categories that take part, keyed by channel, request class and request type."""
    return wh["categorizacioncanal"].where(
        rules.channel_in_scope("IdCategorizacionCanal", "IdCanal", "IdDenuncioTipo")
    )


def insurers(wh: Warehouse) -> DataFrame:
    return wh["isapre"].where("vigente = 1").select(
        F.col("idIsapre").alias("IdPrevisionAsegurado"), F.col("glosa").alias("GlosaIsapre")
    )


def providers(wh: Warehouse) -> DataFrame:
    """Branch with its provider's id and name."""

    def build() -> DataFrame:
        return wh["prestadorsucursal"].join(wh["prestador"], "idprestador").select(
            "idprestadorsucursal", F.col("rutprestador").alias("RutPrestador"), "NombrePrestador"
        )

    return _once(wh, "providers", build)


def benefit_groups(wh: Warehouse) -> DataFrame:
    return wh["instancia_general"].where(rules.benefit_group_in_scope("Codigo")).select(
        F.col("Codigo").alias("IdGrupo"), F.col("Glosa").alias("GlosaBeneficio")
    )


def details(wh: Warehouse, approved_only: bool) -> DataFrame:
    """Paid detail with the integer benefit code."""
    rows = wh["liquidaciondetalle"]
    if approved_only:
        rows = rows.where(F.col("IdLiquidacionDetalleEstado") == rules.APPROVED)
    return rows.withColumn("CodigoBeneficio", code_to_int("CodigoBeneficio"))


def settlement_counts(wh: Warehouse) -> DataFrame:
    """Settlements per claim, counted before they move: one row per claim, however many it has."""
    return wh["liquidacion"].groupBy(F.col("idSiniestro").alias("idsiniestro")).agg(
        F.count(F.lit(1)).cast("int").alias("Liquidaciones")
    )


def rejection_counts(wh: Warehouse) -> DataFrame:
    """Rejections per paid detail."""
    return wh["liquidaciondetallerechazo"].groupBy("idliquidaciondetalle").agg(
        F.count(F.lit(1)).cast("int").alias("Rechazos")
    )


def enrich_claims(wh: Warehouse, claims: DataFrame) -> DataFrame:
    """Joins at claim grain, before the fan-out to details: channel, insurer, settlements, request number.

    The two small filtering dimensions come first, so that fewer claims are shuffled later.
    Claims without a settlement drop out; ``Liquidaciones`` is the weight of the others. The
    request join comes after it, so that the document join that follows has a shuffle of its
    own on both sides, which is what AQE needs to split a claim with very many documents.
    """
    return (
        claims.join(channels(wh), ["IdCanal", "IdDenuncioClasificacion", "IdDenuncioTipo"])
        .join(insurers(wh), "IdPrevisionAsegurado")
        .join(settlement_counts(wh), "idsiniestro")
        .join(wh["denuncio"], "iddenuncio")
    )


def fan_out(wh: Warehouse, claims: DataFrame, approved_only: bool, branches: DataFrame | None = None) -> DataFrame:
    """Claims with documents and paid details, one row per detail.

    Branches, with their provider, are joined per document: what they filter out never
    meets the details, the largest table.
    """
    documents = claims.join(wh["siniestrodocumento"], "idsiniestro")
    if branches is not None:
        documents = documents.join(branches, "idprestadorsucursal")
    return documents.join(details(wh, approved_only), "idSiniestroDocumento")


def repeat_rows(rows: DataFrame, *times: Column) -> DataFrame:
    """Every row as many times as its weights say: the plain join's bag of rows.

    One weight after the other, and each in blocks of ``COPIES``, so that no array is long."""
    first, last = F.lit(0).cast("bigint"), F.lit(COPIES - 1).cast("bigint")
    for n in times:
        blocks = F.sequence(first, n.cast("bigint") - 1, F.lit(COPIES).cast("bigint"))
        rows = rows.withColumns({"_left": n.cast("bigint"), "_block": F.explode(blocks)})
        copies = F.sequence(first, F.least(last, F.col("_left") - 1 - F.col("_block")))
        rows = rows.withColumn("_copy", F.explode(copies)).drop("_copy", "_block", "_left")
    return rows

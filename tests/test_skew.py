"""A hot key is split at run time, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from claimlens.plans import claims, insured
from claimlens.sources.warehouse import SCHEMAS
from tests.micro import Micro

DOCUMENTS = 60_000


@pytest.fixture
def no_broadcast(spark):
    """Thresholds scaled down to the fixture: every join shuffles and a partition is skewed early."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    result = df.collect()
    return result, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def warehouse(spark):
    """A thousand claims; a third of all documents belong to claim 7 and a third of all claims to one holder."""
    tables = dict(Micro().build(spark))
    keys = spark.range(1000).withColumnRenamed("id", "idsiniestro")
    template = Micro()
    template.claim()
    claim = {c: template.tables["siniestro"][0][c] for c in template.tables["siniestro"][0]}
    columns = {c.split()[0]: c.split()[1] for c in SCHEMAS["siniestro"].split(", ")}
    tables["siniestro"] = keys.select(
        "idsiniestro",
        F.col("idsiniestro").alias("iddenuncio"),
        F.when(F.col("idsiniestro") % 3 == 0, "hot").otherwise(F.col("idsiniestro").cast("string")).alias("RutTitular"),
        *[F.lit(claim[c]).cast(t).alias(c) for c, t in columns.items() if c not in ("idsiniestro", "iddenuncio", "RutTitular")],
    )
    tables["denuncio"] = keys.select(F.col("idsiniestro").alias("iddenuncio"), F.col("idsiniestro").cast("string").alias("NumeroDenuncio"))
    tables["liquidacion"] = keys.select(F.col("idsiniestro").alias("idSiniestro"))
    documents = spark.range(0, DOCUMENTS, 1, 8)
    tables["siniestrodocumento"] = documents.select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("bigint").alias("idsiniestro"),
        F.col("id").alias("idSiniestroDocumento"),
        F.lit(900).cast("bigint").alias("idprestadorsucursal"),
    )
    detail = template.tables["liquidaciondetalle"][0]
    types = {c.split(" ")[0]: c.split(" ")[1] for c in SCHEMAS["liquidaciondetalle"].split(", ")}
    tables["liquidaciondetalle"] = documents.select(
        F.col("id").alias("idliquidaciondetalle"),
        F.col("id").alias("idSiniestroDocumento"),
        *[F.lit(detail[c]).cast(t).alias(c) for c, t in types.items() if c not in ("idliquidaciondetalle", "idSiniestroDocumento")],
    )
    return tables


def test_documents_of_a_hot_claim_are_split(spark, no_broadcast):
    tables = warehouse(spark)
    enriched = claims.enrich_claims(tables, claims.valid_claims(tables, plan_rule=True))
    joined = enriched.join(tables["siniestrodocumento"], "idsiniestro").select("idsiniestro", "idSiniestroDocumento")
    result, plan = final_plan(joined)
    assert len(result) == len(set(result)) == DOCUMENTS
    assert "skew=true" in plan


def test_profile_of_a_hot_provider(spark, no_broadcast):
    """One provider holds every row: partial aggregates leave its tasks one row per distinct key."""
    tables = warehouse(spark)
    history = tables["siniestro"].select(
        F.lit("7").alias("RutPrestador"), F.col("FechaRecepcionLiquidacionVC").alias("FechaRecepcionLiquidacion")
    )
    profile = insured.provider_profiles(tables, insured.provider_windows(history))
    (row,), plan = final_plan(profile)
    assert (row.PrestadorSolicitudes, row.PrestadorPrestaciones, row.PrestadorFonasa) == (1000, 1, 1.0)
    assert row.PrestadorValorPrestacion == DOCUMENTS / 2
    assert "partial_sum" in plan


def hot_history(spark):
    """A third of the rows belong to one holder and to the providers without an id."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, DOCUMENTS, 1, 8).select(
        F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("RutTitular"),
        F.when(hot, "Sin rut prestador").otherwise((F.col("id") % 900).cast("string")).alias("RutPrestador"),
        F.when(F.col("id") % 2 == 0, "APROBADA").otherwise("RECHAZADA").alias("Estado"),
        F.col("id").cast("string").alias("NumeroSolicitud"),
        *[F.col("id").alias(c) for c in insured.EXPORT if c not in (*insured.PROFILE, "RutTitular", "RutPrestador", "NumeroSolicitud", "FechaLiquidacion")],
        F.col("id").alias("FechaRecepcionLiquidacion"),
    )


def test_export_of_a_hot_provider_is_split(spark, no_broadcast):
    history = hot_history(spark)
    profiles = history.groupBy("RutPrestador").agg(*[F.count(F.lit(1)).alias(c) for c in insured.PROFILE])
    result, plan = final_plan(insured.export_rows(history, profiles))
    assert len(result) == DOCUMENTS and "skew=true" in plan


def test_diagnoses_of_a_hot_holder_are_split(spark, no_broadcast):
    history = hot_history(spark)
    counts = history.where("Cantidad % 2 = 0").groupBy("RutTitular").agg(F.count(F.lit(1)).alias("Diagnosticos"))
    result, plan = final_plan(insured.with_diagnoses(history, counts))
    assert len(result) == DOCUMENTS and "skew=true" in plan
    assert sum(r.Diagnosticos > 0 for r in result) > DOCUMENTS // 2


def test_rejections_of_a_hot_holder_are_split(spark, no_broadcast):
    result, plan = final_plan(insured.approved_with_rejections(hot_history(spark)))
    assert len(result) == DOCUMENTS // 2 and "skew=true" in plan
    assert {r.SolicitudesRechazadas for r in result if r.RutTitular == "hot"} == {DOCUMENTS // 6}


def test_classification_does_not_shuffle_the_details(spark):
    """Written once, its size is known: details meet it where they are, and blank codes are no hot key."""
    tables = warehouse(spark)
    code = (F.col("idliquidaciondetalle") % 1000).cast("string")
    tables["liquidaciondetalle"] = tables["liquidaciondetalle"].withColumn("CodigoBeneficio", code)
    tables = claims.extract_of(tables)
    joined = claims.details(tables, False).join(claims.classification_by_code(tables), "CodigoBeneficio")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan

"""The warehouse: table name to DataFrame, from parquet, the catalog or JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Warehouse = Mapping[str, DataFrame]

# The columns the analytics read, per table.
SCHEMAS = {
    "detalle_prestacion": "CodigoPrestacion string, GlosaPrestacionHomologada string, IdSubgrupoApertura int, IdGrupoSubgrupo int, IdPatologiaAsociada int, Vigencia int",
    "subgrupo_apertura_prestacion": "IdSubgrupoApertura int, IdSubgrupoPrestacion int, IdAperturaPrestacion int, Vigencia int",
    "grupo_subgrupo_prestacion": "IdGrupoSubgrupo int, IdGrupoPrestacion int, IdSubgrupoPrestacion int, Vigencia int",
    "grupo_prestacion": "IdGrupoPrestacion int, ClasificacionGrupo string, Vigencia int",
    "subgrupo_prestacion": "IdSubgrupoPrestacion int, ClasificacionSubgrupo string, Vigencia int",
    "apertura_prestacion": "IdAperturaPrestacion int, ClasificacionApertura string, Vigencia int",
    "patologia_asociada": "IdPatologiaAsociada int, Vigencia int",
    "siniestro": "idsiniestro bigint, iddenuncio bigint, RutTitular string, RutSiniestrado string, IdTitular bigint, IdSiniestrado bigint, FechaRecepcionLiquidacionVC timestamp_ntz, FechaSiniestro timestamp_ntz, vigente int, IdPlanBeneficio string, IdCanal int, IdDenuncioClasificacion int, IdDenuncioTipo int, IdPrevisionAsegurado int, idcausaprimaria int",
    "denuncio": "iddenuncio bigint, NumeroDenuncio string",
    "siniestrodocumento": "idsiniestro bigint, idSiniestroDocumento bigint, idprestadorsucursal bigint",
    "liquidaciondetalle": "idliquidaciondetalle bigint, idSiniestroDocumento bigint, IdLiquidacionDetalleEstado int, CodigoBeneficio string, IdGrupo int, FechaBeneficio timestamp_ntz, cantidad int, MontoValorBeneficio decimal(18,4), MontoAporteInstitucionSalud decimal(18,4), MontoReclamado decimal(18,4), MontoLiquidado decimal(18,4), MontoDeduciblePrestacion decimal(18,4), MontoConversionBeneficio decimal(18,6), MontoConversionReclamado decimal(18,6), MontoConversionLiquidado decimal(18,6)",
    "liquidacion": "idSiniestro bigint",
    "categorizacioncanal": "IdCategorizacionCanal int, IdCanal int, IdDenuncioClasificacion int, IdDenuncioTipo int, GlosaHomologacion string",
    "prestadorsucursal": "idprestadorsucursal bigint, idprestador bigint",
    "prestador": "idprestador bigint, rutprestador string, NombrePrestador string",
    "liquidaciondetallerechazo": "idliquidaciondetalle bigint",
    "isapre": "idIsapre int, vigente int, glosa string",
    "persona": "idpersona bigint, sexo string, fechanacimiento date",
    "instancia_general": "Codigo int, Glosa string",
    "diagnostico": "idDiagnostico int, codigo string, Glosa string",
    "modelo_analitico": "IdModeloAnalitico int, IdModeloGenerico int, AreaProposito string, Descripcion string, Vigencia int",
    "modelo_generico": "IdModeloGenerico int, GlosaModeloGenerico string, TipoMachineLearning string, Vigencia int",
    "estadistico": "IdEstadistico int, IdModeloAnalitico int, DescripcionDetalle string, FechaModelo date, Vigencia int",
    "criterio_outlier_liquidacion": "IdEstadistico int, IdGrupoPrestacion int, IdSubgrupoPrestacion int, IdAperturaPrestacion int, CriterioCantidadAlta decimal(18,4), CriterioCostoUnitarioBajo decimal(18,4), CriterioCostoUnitarioAlto decimal(18,4), Vigencia int",
}


def from_parquet(spark: SparkSession, root: str, names: Iterable[str] = SCHEMAS) -> Warehouse:
    """One parquet folder per table below ``root``; declared schemas, so nothing is inferred."""
    return {name: spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}") for name in names}


def from_catalog(spark: SparkSession, database: str, names: Iterable[str] = SCHEMAS) -> Warehouse:
    return {name: spark.table(f"{database}.{name}") for name in names}


def declared(df: DataFrame, name: str) -> DataFrame:
    """The columns that the analytics read, in their declared types; date-times lose a time zone."""
    if name not in SCHEMAS:
        return df
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(SCHEMAS[name])])


def from_jdbc(
    spark: SparkSession,
    url: str,
    tables: Mapping[str, str],
    split: Mapping[str, tuple[str, int, int, int]] | None = None,
    properties: Mapping[str, str] | None = None,
) -> Warehouse:
    """Remote tables by three-part name.

    ``split`` gives (column, lower, upper, parts) for the large tables, so that the
    executors read ranges in parallel. The bounds only set the stride: rows outside
    them are still read.
    """
    out = {}
    for name, remote in tables.items():
        reader = spark.read.format("jdbc").options(url=url, dbtable=remote, preferTimestampNTZ=True, **(properties or {}))
        if split and name in split:
            column, lower, upper, parts = split[name]
            reader = reader.options(
                partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
            )
        out[name] = declared(reader.load(), name)
    return out


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, mode: str = "errorifexists") -> None:
    """Save as a table bucketed and sorted by its join keys.

    Fact tables written this way with equal bucket counts join on those keys without a shuffle.
    """
    df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)

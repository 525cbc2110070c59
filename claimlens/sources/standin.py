"""A warehouse derived from the order/line-item star schema, for machines without the real one.

Each table is one SELECT over the given tables, in SQL that Spark and other ANSI engines read
alike, so that a check engine can derive the very same rows. ``{name}`` is a source table and
``{each:x:n}`` adds a column ``x`` counting 0 … n-1 to every source row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

_PRICE = "cast(l_extendedprice as decimal(18,2))"
_SETTLED = f"cast({_PRICE} * (1 - cast(l_discount as decimal(4,2))) as decimal(18,4))"

SELECTS = {
    "siniestro": """
        select o_orderkey as idsiniestro, o_orderkey as iddenuncio,
               cast(o_custkey as string) as RutTitular,
               case when o_orderkey % 3 = 0 then cast(o_custkey as string)
                    else concat(cast(o_custkey as string), '-', cast(o_orderkey % 3 as string)) end as RutSiniestrado,
               o_custkey as IdTitular,
               case when o_orderkey % 3 = 0 then o_custkey else cast(floor(o_custkey / 2) as bigint) end as IdSiniestrado,
               o_orderdate as FechaRecepcionLiquidacionVC,
               case when o_orderkey % 4 = 0 then o_orderdate - interval '45' day else o_orderdate end as FechaSiniestro,
               case when o_orderstatus = 'O' then 0 else 1 end as vigente,
               case when o_orderkey % 97 = 0 then null when o_orderkey % 11 = 0 then 'DEN01' else 'SAL01' end as IdPlanBeneficio,
               case when o_orderkey % 89 = 0 then null else cast(o_orderkey % 10 as int) end as IdCanal,
               cast(o_custkey % 3 as int) as IdDenuncioClasificacion,
               cast(substring(o_orderpriority, 1, 1) as int) as IdDenuncioTipo,
               cast(o_custkey % 5 as int) as IdPrevisionAsegurado,
               cast(o_orderkey % 26 as int) as idcausaprimaria
        from {orders}""",
    "denuncio": """
        select o_orderkey as iddenuncio, cast(cast(floor(o_orderkey / 2) as bigint) as string) as NumeroDenuncio
        from {orders}""",
    "siniestrodocumento": """
        select l_orderkey as idsiniestro, l_orderkey * 8 + l_linenumber as idSiniestroDocumento,
               min(l_suppkey) as idprestadorsucursal
        from {lineitem} group by l_orderkey, l_linenumber""",
    "liquidaciondetalle": f"""
        select (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey % 1000000 as idliquidaciondetalle,
               l_orderkey * 8 + l_linenumber as idSiniestroDocumento,
               case when l_returnflag = 'R' then 2 else 1 end as IdLiquidacionDetalleEstado,
               case when l_partkey % 71 = 3 then '' else cast(l_partkey as string) end as CodigoBeneficio,
               cast((l_linenumber + l_partkey % 3) * 100 as int) as IdGrupo,
               l_shipdate as FechaBeneficio,
               cast(l_quantity as int) as cantidad,
               cast({_PRICE} as decimal(18,4)) as MontoValorBeneficio,
               cast({_PRICE} * cast(l_discount as decimal(4,2)) as decimal(18,4)) as MontoAporteInstitucionSalud,
               {_SETTLED} as MontoReclamado,
               {_SETTLED} as MontoLiquidado,
               cast({_PRICE} * cast(l_tax as decimal(4,2)) as decimal(18,4)) as MontoDeduciblePrestacion,
               cast({_PRICE} * 0.01 as decimal(18,6)) as MontoConversionBeneficio,
               cast({_SETTLED} * 0.01 as decimal(18,6)) as MontoConversionReclamado,
               cast({_SETTLED} * 0.01 as decimal(18,6)) as MontoConversionLiquidado
        from {{lineitem}}""",
    "liquidacion": """
        select o_orderkey as idSiniestro from {orders}
        union all select o_orderkey as idSiniestro from {orders} where o_orderkey % 13 = 0""",
    "liquidaciondetallerechazo": """
        select (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey % 1000000 as idliquidaciondetalle
        from {lineitem} where l_returnflag = 'R'
        union all
        select (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey % 1000000 as idliquidaciondetalle
        from {lineitem} where l_returnflag = 'R' and l_linenumber = 7""",
    "categorizacioncanal": """
        select cast((n_nationkey * 5 + tipo + 1) % 50 as int) as IdCategorizacionCanal,
               cast(n_nationkey % 10 as int) as IdCanal,
               cast(floor(n_nationkey / 10) as int) as IdDenuncioClasificacion,
               cast(tipo + 1 as int) as IdDenuncioTipo,
               case when n_nationkey % 3 = 0 then 'Bonificacion I-Med' else n_name end as GlosaHomologacion
        from {nation} {each:tipo:5}""",
    "prestadorsucursal": "select s_suppkey as idprestadorsucursal, s_suppkey as idprestador from {supplier}",
    "prestador": """
        select s_suppkey as idprestador,
               case when s_suppkey % 17 = 0 then 'Sin rut prestador'
                    else concat(cast(76000000 + cast(floor(s_suppkey / 2) as bigint) as string), '-K') end as rutprestador,
               s_name as NombrePrestador
        from {supplier}""",
    "isapre": """
        select r_regionkey as idIsapre, case when r_regionkey = 4 then 0 else 1 end as vigente,
               case when r_name = 'AMERICA' then 'FONASA' else r_name end as glosa
        from {region}""",
    "persona": """
        select c_custkey as idpersona,
               case when c_custkey % 29 = 0 then null when c_mktsegment = 'HOUSEHOLD' then 'F' else 'M' end as sexo,
               date '1950-01-01' + cast(c_custkey % 20000 as int) as fechanacimiento
        from {customer}""",
    "instancia_general": """
        select n_nationkey * 100 as Codigo,
               case when n_nationkey = 4 then 'BENEFICIOS DE SALUD MENTAL' else concat('BENEFICIO ', n_name) end as Glosa
        from {nation}""",
    "diagnostico": """
        select n_nationkey + 1 as idDiagnostico,
               case n_nationkey % 8 when 5 then concat('Z', cast(n_nationkey as string))
                                    when 6 then concat('K0', cast(n_nationkey as string))
                                    when 7 then 'BBB'
                                    else concat('F', cast(n_nationkey as string)) end as codigo,
               concat('DIAGNOSTICO ', cast(n_nationkey % 12 as string)) as Glosa
        from {nation}""",
    "detalle_prestacion": """
        select case when p_partkey % 61 = 7 then concat('X', cast(p_partkey as string))
                    when p_partkey % 40 = 39 then lpad(cast(p_partkey - 1 as string), 12, '0')
                    else lpad(cast(p_partkey as string), 12, '0') end as CodigoPrestacion,
               p_name as GlosaPrestacionHomologada,
               cast((p_partkey % 25) * 25 + p_size % 25 as int) as IdSubgrupoApertura,
               cast((cast(floor(p_partkey / 25) as bigint) % 5) * 25
                    + (p_partkey + case when p_partkey % 19 = 0 then 1 else 0 end) % 25 as int) as IdGrupoSubgrupo,
               cast(p_partkey % 24 as int) as IdPatologiaAsociada,
               case when p_partkey % 23 = 5 then 0 else 1 end as Vigencia
        from {part}""",
    "subgrupo_apertura_prestacion": """
        select cast(n_nationkey * 25 + apertura as int) as IdSubgrupoApertura, n_nationkey as IdSubgrupoPrestacion,
               cast(apertura as int) as IdAperturaPrestacion,
               case when (n_nationkey * 25 + apertura) % 29 = 28 then 0 else 1 end as Vigencia
        from {nation} {each:apertura:25}""",
    "grupo_subgrupo_prestacion": """
        select cast(r_regionkey * 25 + subgrupo as int) as IdGrupoSubgrupo, r_regionkey as IdGrupoPrestacion,
               cast(subgrupo as int) as IdSubgrupoPrestacion, 1 as Vigencia
        from {region} {each:subgrupo:25}""",
    "grupo_prestacion": """
        select r_regionkey as IdGrupoPrestacion, concat('GRUPO ', r_name) as ClasificacionGrupo, 1 as Vigencia
        from {region}""",
    "subgrupo_prestacion": """
        select n_nationkey as IdSubgrupoPrestacion,
               case when n_nationkey % 4 = 3 then 'SALUD MENTAL' else concat('SUBGRUPO ', n_name) end as ClasificacionSubgrupo,
               1 as Vigencia
        from {nation}""",
    "apertura_prestacion": """
        select n_nationkey as IdAperturaPrestacion,
               concat('Apertura ', substring('ABCDEF', cast(n_nationkey % 6 as int) + 1, 1)) as ClasificacionApertura,
               case when n_nationkey = 24 then 0 else 1 end as Vigencia
        from {nation}""",
    "patologia_asociada": """
        select n_nationkey as IdPatologiaAsociada, case when n_nationkey = 23 then 0 else 1 end as Vigencia
        from {nation}""",
    "modelo_analitico": """
        select n_nationkey as IdModeloAnalitico, cast(n_nationkey % 5 as int) as IdModeloGenerico,
               'SALUD' as AreaProposito, concat('MODELO ', n_name) as Descripcion,
               case when n_nationkey = 3 then 0 else 1 end as Vigencia
        from {nation}""",
    "modelo_generico": """
        select r_regionkey as IdModeloGenerico, concat('GENERICO ', r_name) as GlosaModeloGenerico,
               'NO SUPERVISADO' as TipoMachineLearning, 1 as Vigencia
        from {region}""",
    "estadistico": """
        select n_nationkey as IdEstadistico, cast(n_nationkey % 4 as int) as IdModeloAnalitico,
               concat('DETALLE ', n_name) as DescripcionDetalle, date '2024-01-01' as FechaModelo,
               case when n_nationkey % 9 = 8 then 0 else 1 end as Vigencia
        from {nation}""",
    "criterio_outlier_liquidacion": """
        select cast((n_nationkey + apertura) % 25 as int) as IdEstadistico,
               cast(grupo as int) as IdGrupoPrestacion, n_nationkey as IdSubgrupoPrestacion,
               cast(apertura as int) as IdAperturaPrestacion,
               cast(40 + (n_nationkey + apertura) % 15 as decimal(18,4)) as CriterioCantidadAlta,
               cast(200 + grupo * 100 as decimal(18,4)) as CriterioCostoUnitarioBajo,
               cast(9000 + grupo * 1000 as decimal(18,4)) as CriterioCostoUnitarioAlto,
               case when (n_nationkey + grupo) % 11 = 10 then 0 else 1 end as Vigencia
        from {nation} {each:grupo:5} {each:apertura:25}
        where (n_nationkey + apertura + grupo) % 7 <> 0
        union all
        select cast(n_nationkey as int) as IdEstadistico, cast(grupo as int) as IdGrupoPrestacion,
               n_nationkey as IdSubgrupoPrestacion, cast(n_nationkey as int) as IdAperturaPrestacion,
               cast(45 as decimal(18,4)) as CriterioCantidadAlta,
               cast(300 as decimal(18,4)) as CriterioCostoUnitarioBajo,
               cast(8000 as decimal(18,4)) as CriterioCostoUnitarioAlto, 1 as Vigencia
        from {nation} {each:grupo:5}""",
}

def read_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(str(PurePosixPath(folder) / f"{name}.parquet"))


def spark_select(name: str) -> str:
    return re.sub(
        r"\{each:(\w+):(\d+)\}",
        lambda m: f"lateral view explode(sequence(0, {int(m[2]) - 1})) t_{m[1]} as {m[1]}",
        SELECTS[name],
    )


class StandIn(Mapping):
    """Tables derived from the parquet files in ``folder`` when they are first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._known: dict[str, DataFrame] = {}
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = read_source(self._spark, self._folder, name)
        return self._sources[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            text = spark_select(name)
            used = set(re.findall(r"\{(\w+)\}", text))
            self._known[name] = self._spark.sql(text, **{s: self.source(s) for s in used})
        return self._known[name]

    def __iter__(self) -> Iterator[str]:
        return iter(SELECTS)

    def __len__(self) -> int:
        return len(SELECTS)

"""Registration, and the SQL twins' common table expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions import rules
from claimlens.session import tune
from claimlens.sources.standin import SELECTS, StandIn

SINCE, UNTIL = "19970101", "20000101"
DIAGNOSES_SINCE = "19950101"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under a name; ``sql`` is the twin's final SELECT."""

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = with_parts(sql)
        return fn

    return add


def warehouse_query(name: str, sql: str | None = None):
    """Same, for functions of the derived warehouse."""

    def add(fn):
        query(name, sql)(lambda spark, folder: fn(StandIn(spark, folder)))
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines print the same value."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def doubles(df: DataFrame, *names: str) -> DataFrame:
    """Integer columns that may be NULL, as doubles (the one numeric type every reader can leave empty)."""
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _twin_table(text: str) -> str:
    text = re.sub(
        r"\{each:(\w+):(\d+)\}",
        lambda m: f"cross join (select unnest(range({m[2]})) as {m[1]}) as t_{m[1]}",
        text,
    )
    return dedent(re.sub(r"\{(\w+)\}", r"\1", text)).strip()


def sql_list(values) -> str:
    return "(" + ", ".join(str(v) for v in values) + ")"


CODE = "case when trim({c}) = '' then 0 else try_cast(trim({c}) as integer) end"
PAD = "right('0000000000' || left(cast({c} as varchar), 10), 12)"


def pad_sql(c: str) -> str:
    return PAD.format(c=c)


def code_sql(c: str) -> str:
    return CODE.format(c=c)


def day_sql(yyyymmdd: str) -> str:
    return f"timestamp '{yyyymmdd[:4]}-{yyyymmdd[4:6]}-{yyyymmdd[6:]}'"


IN_SCOPE = f"""cat.IdCategorizacionCanal not in {sql_list(rules.EXCLUDED_CATEGORIES)}
      and cat.IdCanal not in {sql_list(rules.EXCLUDED_CHANNELS)}
      and cat.IdDenuncioTipo not in {sql_list(rules.EXCLUDED_REQUEST_TYPES)}"""

PARTS: dict[str, str] = {name: _twin_table(text) for name, text in SELECTS.items()}

PARTS["clasif"] = f"""
    select dp.CodigoPrestacion, {code_sql('dp.CodigoPrestacion')} as codigo, dp.GlosaPrestacionHomologada,
           gp.IdGrupoPrestacion, gp.ClasificacionGrupo, sp.IdSubgrupoPrestacion, sp.ClasificacionSubgrupo,
           ap.IdAperturaPrestacion, ap.ClasificacionApertura
    from detalle_prestacion dp
    join subgrupo_apertura_prestacion sap on sap.IdSubgrupoApertura = dp.IdSubgrupoApertura and sap.Vigencia = 1
    join apertura_prestacion ap on ap.IdAperturaPrestacion = sap.IdAperturaPrestacion and ap.Vigencia = 1
    join subgrupo_prestacion sp on sp.IdSubgrupoPrestacion = sap.IdSubgrupoPrestacion and sp.Vigencia = 1
    join grupo_subgrupo_prestacion gsp on gsp.IdGrupoSubgrupo = dp.IdGrupoSubgrupo
      and gsp.IdSubgrupoPrestacion = sp.IdSubgrupoPrestacion and gsp.Vigencia = 1
    join grupo_prestacion gp on gp.IdGrupoPrestacion = gsp.IdGrupoPrestacion and gp.Vigencia = 1
    join patologia_asociada pa on pa.IdPatologiaAsociada = dp.IdPatologiaAsociada and pa.Vigencia = 1
    where dp.Vigencia = 1"""

# Claims with every table that takes part in all three claim queries.
PARTS["base"] = f"""
    select s.*, den.NumeroDenuncio, ld.idliquidaciondetalle, ld.IdLiquidacionDetalleEstado,
           {code_sql('ld.CodigoBeneficio')} as codigo, ld.IdGrupo, ld.FechaBeneficio, ld.cantidad,
           ld.MontoValorBeneficio, ld.MontoAporteInstitucionSalud, ld.MontoReclamado, ld.MontoLiquidado,
           ld.MontoDeduciblePrestacion, ld.MontoConversionBeneficio, ld.MontoConversionReclamado,
           ld.MontoConversionLiquidado, cat.IdCategorizacionCanal, cat.GlosaHomologacion,
           pre.rutprestador, pre.NombrePrestador, isa.glosa
    from siniestro s
    join denuncio den on den.iddenuncio = s.iddenuncio
    join siniestrodocumento doc on doc.idsiniestro = s.idsiniestro
    join liquidaciondetalle ld on ld.idSiniestroDocumento = doc.idSiniestroDocumento
    join liquidacion liq on liq.idSiniestro = s.idsiniestro
    join categorizacioncanal cat on cat.IdCanal = s.IdCanal and cat.IdDenuncioTipo = s.IdDenuncioTipo
      and cat.IdDenuncioClasificacion = s.IdDenuncioClasificacion and {IN_SCOPE}
    join prestadorsucursal ps on ps.idprestadorsucursal = doc.idprestadorsucursal
    join prestador pre on pre.idprestador = ps.idprestador
    join isapre isa on isa.idIsapre = s.IdPrevisionAsegurado and isa.vigente = 1
    where s.vigente = 1"""

_PERIOD = f"""b.FechaRecepcionLiquidacionVC >= {day_sql(SINCE)} and b.FechaRecepcionLiquidacionVC < {day_sql(UNTIL)}
      and b.FechaSiniestro >= {day_sql(SINCE)}"""

PARTS["detalle"] = f"""
    select b.RutTitular, b.RutSiniestrado as RutBeneficiario, b.NumeroDenuncio as NumeroSolicitud,
           b.FechaBeneficio as FechaPrestacion, b.FechaRecepcionLiquidacionVC as FechaRecepcionLiquidacion,
           b.codigo as CodigoBeneficio, c.IdGrupoPrestacion, c.ClasificacionGrupo, c.IdSubgrupoPrestacion,
           c.ClasificacionSubgrupo, c.IdAperturaPrestacion, c.ClasificacionApertura, b.cantidad as Cantidad,
           b.MontoValorBeneficio as ValorPrestacionCLP, b.MontoConversionBeneficio as ValorPrestacionUF,
           b.MontoReclamado as ValorReclamadoCLP, b.MontoConversionReclamado as ValorReclamadoUF,
           b.MontoLiquidado as ValorPagoCLP, b.MontoConversionLiquidado as ValorPagoUF,
           case when b.glosa = 'FONASA' then 'FONASA' else 'NO FONASA' end as Prevision,
           b.rutprestador as RutPrestador, b.NombrePrestador
    from base b join clasif c on c.codigo = b.codigo and c.ClasificacionSubgrupo = 'SALUD MENTAL'
    where b.IdLiquidacionDetalleEstado = 1 and {_PERIOD}"""

PARTS["solicitudes"] = f"""
    select {pad_sql('RutTitular')} as RutTitular, {pad_sql('RutBeneficiario')} as RutBeneficiario, NumeroSolicitud,
           IdGrupoPrestacion, ClasificacionGrupo, IdSubgrupoPrestacion, ClasificacionSubgrupo,
           IdAperturaPrestacion, ClasificacionApertura,
           cast(sum(Cantidad) as bigint) as Cantidad,
           sum(ValorPrestacionCLP)::double as ValorPrestacionCLP,
           sum(ValorPrestacionCLP)::double / sum(Cantidad)::double as CostoUnitarioCLP,
           sum(ValorPrestacionUF)::double as ValorPrestacionUF,
           sum(ValorPrestacionUF)::double / sum(Cantidad)::double as CostoUnitarioUF,
           sum(ValorReclamadoCLP)::double as ValorReclamadoCLP, sum(ValorReclamadoUF)::double as ValorReclamadoUF,
           sum(ValorPagoUF)::double as ValorPagoUF, sum(ValorPagoCLP)::double as ValorPagoCLP,
           FechaPrestacion, FechaRecepcionLiquidacion, Prevision,
           case when RutPrestador = 'Sin rut prestador' then RutPrestador else {pad_sql('RutPrestador')} end as RutPrestador,
           NombrePrestador
    from detalle d
    group by d.RutTitular, d.RutBeneficiario, NumeroSolicitud, FechaPrestacion, FechaRecepcionLiquidacion, Prevision,
             d.RutPrestador, NombrePrestador, IdGrupoPrestacion, ClasificacionGrupo, IdSubgrupoPrestacion,
             ClasificacionSubgrupo, IdAperturaPrestacion, ClasificacionApertura
    having sum(Cantidad) > 0 and sum(Cantidad) < 100 and sum(ValorPrestacionCLP) > 0"""

PARTS["criterios"] = """
    select co.IdGrupoPrestacion, co.IdSubgrupoPrestacion, co.IdAperturaPrestacion,
           co.CriterioCantidadAlta, co.CriterioCostoUnitarioBajo, co.CriterioCostoUnitarioAlto,
           es.IdEstadistico, es.DescripcionDetalle, es.FechaModelo, ma.IdModeloAnalitico, ma.AreaProposito,
           ma.Descripcion, mg.GlosaModeloGenerico, mg.TipoMachineLearning
    from modelo_analitico ma
    join modelo_generico mg on mg.IdModeloGenerico = ma.IdModeloGenerico
    join estadistico es on es.IdModeloAnalitico = ma.IdModeloAnalitico
    join criterio_outlier_liquidacion co on co.IdEstadistico = es.IdEstadistico
    where ma.Vigencia = 1 and mg.Vigencia = 1 and es.Vigencia = 1 and co.Vigencia = 1"""

PARTS["marcadas"] = """
    select s.*, co.CriterioCantidadAlta::double as CriterioCantidadAlta,
           co.CriterioCostoUnitarioBajo::double as CriterioCostoUnitarioBajo,
           co.CriterioCostoUnitarioAlto::double as CriterioCostoUnitarioAlto,
           case when s.Cantidad > co.CriterioCantidadAlta then 1 else 0 end as OutlierCantidadAlta,
           case when s.CostoUnitarioCLP >= co.CriterioCostoUnitarioAlto::double then 1 else 0 end as OutlierCostoAlto,
           case when s.CostoUnitarioCLP <= co.CriterioCostoUnitarioBajo::double then 1 else 0 end as OutlierCostoBajo
    from solicitudes s left join criterios co using (IdGrupoPrestacion, IdSubgrupoPrestacion, IdAperturaPrestacion)"""

PARTS["regulares"] = """
    select RutTitular, RutBeneficiario, NumeroSolicitud, IdGrupoPrestacion, ClasificacionGrupo, IdSubgrupoPrestacion,
           ClasificacionSubgrupo, IdAperturaPrestacion, ClasificacionApertura, Cantidad, ValorPrestacionCLP,
           ValorPrestacionUF, CostoUnitarioCLP, ValorReclamadoCLP, ValorPagoUF, ValorPagoCLP, FechaPrestacion,
           FechaRecepcionLiquidacion, Prevision, RutPrestador, NombrePrestador
    from marcadas where OutlierCantidadAlta + OutlierCostoAlto + OutlierCostoBajo = 0"""

PARTS["candidatos"] = f"""
    select distinct b.RutTitular, b.FechaRecepcionLiquidacionVC as FechaRecepcionLiquidacion, b.codigo as CodigoBeneficio,
           c.IdGrupoPrestacion, c.ClasificacionGrupo, c.IdSubgrupoPrestacion, c.ClasificacionSubgrupo,
           c.IdAperturaPrestacion, c.ClasificacionApertura, ig.Glosa as GlosaBeneficio
    from base b
    join instancia_general ig on ig.Codigo = b.IdGrupo and ig.Codigo not in (300, 700, 800, 900)
    left join clasif c on c.codigo = b.codigo
    where b.IdLiquidacionDetalleEstado = 1 and {_PERIOD} and b.IdPlanBeneficio not like 'DEN%'"""

PARTS["titulares"] = """
    select RutTitular, max(FechaRecepcionLiquidacion) as LiquidacionHasta,
           max(FechaRecepcionLiquidacion) - interval '1' year as LiquidacionDesde,
           max(FechaRecepcionLiquidacion) - interval '1' month as PrestacionDesde
    from candidatos
    where GlosaBeneficio = 'BENEFICIOS DE SALUD MENTAL' or ClasificacionSubgrupo = 'SALUD MENTAL'
    group by RutTitular"""

PARTS["historia"] = """
    select case when b.RutTitular = b.RutSiniestrado then 'Titular' else 'Carga' end as RolPersona, b.RutTitular,
           case when p.sexo = 'F' then 1 else 0 end as TitularFemenino,
           cast(trunc(date_diff('day', p.fechanacimiento, cast(b.FechaBeneficio as date)) / 365) as integer) as EdadTitular,
           b.RutSiniestrado, case when pb.sexo = 'F' then 1 else 0 end as SiniestradoFemenino,
           cast(trunc(date_diff('day', pb.fechanacimiento, cast(b.FechaBeneficio as date)) / 365) as integer) as EdadSiniestrado,
           case when b.glosa = 'FONASA' then 'FONASA' else 'NO FONASA' end as Prevision,
           b.GlosaHomologacion as CanalLiquidacion, b.NumeroDenuncio as NumeroSolicitud,
           b.FechaBeneficio as FechaPrestacion, strftime(b.FechaBeneficio, '%Y%m') as PeriodoPrestacion,
           b.FechaRecepcionLiquidacionVC as FechaRecepcionLiquidacion,
           strftime(b.FechaRecepcionLiquidacionVC, '%Y%m') as PeriodoLiquidacion, b.codigo as CodigoBeneficio,
           c.IdGrupoPrestacion, c.ClasificacionGrupo, c.IdSubgrupoPrestacion, c.ClasificacionSubgrupo,
           c.IdAperturaPrestacion, c.ClasificacionApertura, ig.Glosa as GlosaBeneficio,
           case when ig.Codigo = 100 or b.IdCategorizacionCanal in (6, 12, 15, 16, 48) then 1 else 0 end as Hospitalizacion,
           b.cantidad as Cantidad, b.MontoValorBeneficio::double as ValorPrestacionCLP,
           b.MontoAporteInstitucionSalud::double as ValorPrevisionCLP, b.MontoReclamado::double as ValorReclamadoCLP,
           b.MontoLiquidado::double as ValorIndemnizarCLP, b.MontoDeduciblePrestacion::double as ValorDeducibleCLP,
           (b.MontoLiquidado - b.MontoDeduciblePrestacion)::double as ValorPagoCLP,
           case when b.IdLiquidacionDetalleEstado = 1 then 'APROBADA' else 'RECHAZADA' end as Estado,
           b.rutprestador as RutPrestador
    from base b
    join titulares t on t.RutTitular = b.RutTitular and b.FechaSiniestro >= t.PrestacionDesde
      and b.FechaRecepcionLiquidacionVC between t.LiquidacionDesde and t.LiquidacionHasta
    join persona p on p.idpersona = b.IdTitular
    join persona pb on pb.idpersona = b.IdSiniestrado
    join instancia_general ig on ig.Codigo = b.IdGrupo and ig.Codigo not in (300, 700, 800, 900)
    left join clasif c on c.codigo = b.codigo
    left join liquidaciondetallerechazo r on r.idliquidaciondetalle = b.idliquidaciondetalle
    where b.IdPlanBeneficio not like 'DEN%'"""

PARTS["diagnosticos"] = f"""
    select s.RutTitular, s.RutSiniestrado, count(distinct di.Glosa) as Diagnosticos,
           max(di.Glosa) as Diagnostico1, min(di.Glosa) as Diagnostico2
    from siniestro s
    join (select distinct RutSiniestrado from historia) h on h.RutSiniestrado = s.RutSiniestrado
    join diagnostico di on di.idDiagnostico = s.idcausaprimaria
    join denuncio den on den.iddenuncio = s.iddenuncio
    join siniestrodocumento doc on doc.idsiniestro = s.idsiniestro
    join liquidaciondetalle ld on ld.idSiniestroDocumento = doc.idSiniestroDocumento and ld.IdLiquidacionDetalleEstado = 1
    join instancia_general ig on ig.Codigo = ld.IdGrupo and ig.Codigo not in (300, 700, 800, 900)
    left join clasif c on c.codigo = {code_sql('ld.CodigoBeneficio')}
    where s.vigente = 1 and s.idcausaprimaria <> 0
      and s.FechaRecepcionLiquidacionVC between {day_sql(DIAGNOSES_SINCE)} and cast(now() as timestamp)
      and di.idDiagnostico not in (-1, 16051) and di.codigo not like 'Z%' and di.codigo not like 'K0%' and di.codigo <> 'BBB'
      and (ig.Glosa = 'BENEFICIOS DE SALUD MENTAL' or c.ClasificacionSubgrupo = 'SALUD MENTAL')
    group by s.RutTitular, s.RutSiniestrado"""

PARTS["diagnosticos_titular"] = """
    select RutTitular, cast(sum(Diagnosticos) as bigint) as Diagnosticos from diagnosticos group by RutTitular"""

PARTS["ventanas"] = """
    select RutPrestador, max(FechaRecepcionLiquidacion) as FechaHasta,
           max(FechaRecepcionLiquidacion) - interval '3' month as FechaDesde
    from historia group by RutPrestador"""

PARTS["perfiles"] = """
    select b.rutprestador as RutPrestador, max(b.NombrePrestador) as NombrePrestador,
           count(distinct b.RutSiniestrado) as PrestadorBeneficiarios,
           avg(case when b.glosa = 'FONASA' then 1.0::double else 0.0::double end) as PrestadorFonasa,
           avg(case when b.GlosaHomologacion = 'Bonificacion I-Med' then 1.0::double else 0.0::double end) as PrestadorImed,
           count(distinct b.NumeroDenuncio) as PrestadorSolicitudes,
           count(distinct b.codigo) as PrestadorPrestaciones,
           sum(b.MontoConversionBeneficio)::double as PrestadorValorPrestacion,
           sum(b.MontoConversionLiquidado)::double as PrestadorValorPago
    from base b
    join ventanas v on v.RutPrestador = b.rutprestador and b.FechaRecepcionLiquidacionVC between v.FechaDesde and v.FechaHasta
    join instancia_general ig on ig.Codigo = b.IdGrupo and ig.Codigo not in (300, 700, 800, 900)
    where b.IdLiquidacionDetalleEstado = 1 and b.IdPlanBeneficio not like 'DEN%'
    group by b.rutprestador"""


def _uses(text: str, name: str) -> bool:
    return re.search(rf"\b(?:from|join|,)\s+{name}\b", text, re.IGNORECASE) is not None


def with_parts(final: str) -> str:
    """Prepend the parts a SELECT reads, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and _uses(text, name):
                visit(PARTS[name])
                needed.append(name)

    final = dedent(final).strip()
    visit(final)
    if not needed:
        return final
    ctes = ",\n".join(f"{name} as (\n{dedent(PARTS[name]).strip()}\n)" for name in needed)
    if final.lower().startswith("with "):
        return f"with {ctes},\n{final[5:]}"
    return f"with {ctes}\n{final}"

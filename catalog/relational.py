"""Scans, stages, projections, filters, joins and aggregates of the claim warehouse."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import IN_SCOPE, SINCE, UNTIL, code_sql, day_sql, doubles, plain, query, warehouse_query
from claimlens.functions import rules
from claimlens.functions.dates import back
from claimlens.functions.numeric import flag, ratio
from claimlens.functions.text import code_to_int
from claimlens.operators.features import lower_names, new_columns
from claimlens.plans import claims, detail, insured
from claimlens.session import stage
from claimlens.sources.standin import StandIn

# --- scans and stages -------------------------------------------------------------------


@warehouse_query("src1_scan_table", "select * replace (IdCanal::double as IdCanal) from siniestro")
def src1(wh):
    return doubles(wh["siniestro"], "IdCanal")


@warehouse_query(
    "stg1_staged_result",
    """select IdGrupo, count(*) as filas, sum(MontoLiquidado)::double as liquidado, max(cantidad) as mayor
       from liquidaciondetalle where IdLiquidacionDetalleEstado = 1 group by IdGrupo""",
)
def stg1(wh):
    approved = stage(claims.details(wh, approved_only=True).select("IdGrupo", "MontoLiquidado", "cantidad"), "approved")
    sums = approved.groupBy("IdGrupo").agg(F.count(F.lit(1)).alias("filas"), F.sum("MontoLiquidado").alias("liquidado"))
    tops = approved.groupBy("IdGrupo").agg(F.max("cantidad").alias("mayor"))
    return plain(sums.join(tops, "IdGrupo"))


@query("stg2_replaced_stage", "select idsiniestro, RutTitular from siniestro where vigente = 0")
def stg2(spark, folder):
    wh = StandIn(spark, folder)
    wh["siniestro"].where("vigente = 1").createOrReplaceTempView("siniestros_etapa")
    wh["siniestro"].where("vigente = 0").createOrReplaceTempView("siniestros_etapa")
    return spark.table("siniestros_etapa").select("idsiniestro", "RutTitular")


@query(
    "stg3_script_parameters",
    f"""select idsiniestro, FechaSiniestro from siniestro
        where FechaSiniestro >= {day_sql(SINCE)} and FechaSiniestro < {day_sql(UNTIL)}""",
)
def stg3(spark, folder):
    return spark.sql(
        """select idsiniestro, FechaSiniestro from {siniestro}
           where FechaSiniestro >= to_timestamp_ntz(:desde, 'yyyyMMdd') and FechaSiniestro < to_timestamp_ntz(:hasta, 'yyyyMMdd')""",
        args={"desde": SINCE, "hasta": UNTIL},
        siniestro=StandIn(spark, folder)["siniestro"],
    )


# --- projections ------------------------------------------------------------------------


@warehouse_query(
    "prj1_select_alias",
    """select RutTitular, RutSiniestrado as RutBeneficiario, FechaRecepcionLiquidacionVC as FechaLiquidacion
       from siniestro""",
)
def prj1(wh):
    return wh["siniestro"].select(
        "RutTitular",
        F.col("RutSiniestrado").alias("RutBeneficiario"),
        F.col("FechaRecepcionLiquidacionVC").alias("FechaLiquidacion"),
    )


@warehouse_query("prj2_star_plus", "select p.*, length(NombrePrestador) as largo from prestador p")
def prj2(wh):
    return wh["prestador"].select("*", F.length("NombrePrestador").alias("largo"))


@warehouse_query(
    "prj3_case_labels",
    """select s.idsiniestro, case when RutTitular = RutSiniestrado then 'Titular' else 'Carga' end as rol,
              case when isa.glosa = 'FONASA' then 'FONASA' else 'NO FONASA' end as prevision
       from siniestro s left join isapre isa on isa.idIsapre = s.IdPrevisionAsegurado and isa.vigente = 1""",
)
def prj3(wh):
    return wh["siniestro"].join(claims.insurers(wh), "IdPrevisionAsegurado", "left").select(
        "idsiniestro",
        rules.role_label("RutTitular", "RutSiniestrado").alias("rol"),
        rules.insurer_label("GlosaIsapre").alias("prevision"),
    )


@warehouse_query(
    "prj3_state_label",
    """select idliquidaciondetalle, case when IdLiquidacionDetalleEstado = 1 then 'APROBADA' else 'RECHAZADA' end as estado
       from liquidaciondetalle""",
)
def prj3_state(wh):
    return wh["liquidaciondetalle"].select(
        "idliquidaciondetalle", rules.state_label("IdLiquidacionDetalleEstado").alias("estado")
    )


@warehouse_query(
    "prj4_case_indicators",
    "select idpersona, case when sexo = 'F' then 1 else 0 end as femenino from persona",
)
def prj4(wh):
    return wh["persona"].select("idpersona", rules.female_flag("sexo").alias("femenino"))


@warehouse_query(
    "prj4_hospital_indicator",
    """select ld.idliquidaciondetalle, cat.IdCategorizacionCanal,
              case when ld.IdGrupo = 100 or cat.IdCategorizacionCanal in (6, 12, 15, 16, 48) then 1 else 0 end as hospitalizacion
       from siniestro s
       join categorizacioncanal cat on cat.IdCanal = s.IdCanal and cat.IdDenuncioTipo = s.IdDenuncioTipo
        and cat.IdDenuncioClasificacion = s.IdDenuncioClasificacion
       join siniestrodocumento doc on doc.idsiniestro = s.idsiniestro
       join liquidaciondetalle ld on ld.idSiniestroDocumento = doc.idSiniestroDocumento""",
)
def prj4_hospital(wh):
    return (
        wh["siniestro"]
        .join(wh["categorizacioncanal"], ["IdCanal", "IdDenuncioClasificacion", "IdDenuncioTipo"])
        .join(wh["siniestrodocumento"], "idsiniestro")
        .join(wh["liquidaciondetalle"], "idSiniestroDocumento")
        .select(
            "idliquidaciondetalle",
            "IdCategorizacionCanal",
            rules.hospital_flag("IdGrupo", "IdCategorizacionCanal").alias("hospitalizacion"),
        )
    )


@warehouse_query("prj5_null_default", "select idsiniestro, case when IdCanal is null then 0 else IdCanal end as canal from siniestro")
def prj5(wh):
    return wh["siniestro"].select("idsiniestro", F.coalesce("IdCanal", F.lit(0)).alias("canal"))


@warehouse_query(
    "prj6_column_arithmetic",
    "select idliquidaciondetalle, (MontoLiquidado - MontoDeduciblePrestacion)::double as pago from liquidaciondetalle",
)
def prj6(wh):
    return plain(
        wh["liquidaciondetalle"].select(
            "idliquidaciondetalle", (F.col("MontoLiquidado") - F.col("MontoDeduciblePrestacion")).alias("pago")
        )
    )


@warehouse_query("prj7_lower_names", "select idprestador, rutprestador, NombrePrestador as nombreprestador from prestador")
def prj7(wh):
    return lower_names(wh["prestador"])


@query("prj10_rename", "select o_custkey as POLIZA, sum(o_totalprice::decimal(18,2))::double as anomalyscore from orders group by o_custkey")
def prj10(spark, folder):
    totals = (
        StandIn(spark, folder).source("orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("0"))
    )
    return plain(totals.withColumnsRenamed({"o_custkey": "POLIZA", "0": "anomalyscore"}))


# --- filters ----------------------------------------------------------------------------


@warehouse_query("flt1_equality", "select idsiniestro, RutTitular from siniestro where vigente = 1")
def flt1(wh):
    return claims.valid_claims(wh, plan_rule=False).select("idsiniestro", "RutTitular")


@warehouse_query("flt2_channel_exclusion", f"select * from categorizacioncanal cat where {IN_SCOPE}")
def flt2(wh):
    return claims.channels(wh)


@warehouse_query("flt3_code_exclusion", "select Codigo, Glosa from instancia_general where Codigo not in (300, 700, 800, 900)")
def flt3(wh):
    return wh["instancia_general"].where(rules.benefit_group_in_scope("Codigo")).select("Codigo", "Glosa")


@warehouse_query(
    "flt4_in_not_in",
    """select IdCategorizacionCanal, IdCanal from categorizacioncanal
       where IdCategorizacionCanal in (6, 12, 15, 16, 48) and IdCanal not in (-1, 16051)""",
)
def flt4(wh):
    return wh["categorizacioncanal"].where(
        F.col("IdCategorizacionCanal").isin(rules.HOSPITAL_CATEGORIES) & ~F.col("IdCanal").isin(rules.EXCLUDED_DIAGNOSES)
    ).select("IdCategorizacionCanal", "IdCanal")


@warehouse_query("flt5_not_like_prefix", "select idsiniestro, IdPlanBeneficio from siniestro where IdPlanBeneficio not like 'DEN%'")
def flt5(wh):
    return wh["siniestro"].where(rules.plan_in_scope("IdPlanBeneficio")).select("idsiniestro", "IdPlanBeneficio")


@warehouse_query(
    "flt5_diagnosis_codes",
    """select * from diagnostico where idDiagnostico not in (-1, 16051)
       and codigo not like 'Z%' and codigo not like 'K0%' and codigo not like 'BBB'""",
)
def flt5_diagnoses(wh):
    return wh["diagnostico"].where(rules.diagnosis_in_scope("idDiagnostico", "codigo"))


@warehouse_query(
    "flt6_half_open_range",
    f"""select idsiniestro, FechaRecepcionLiquidacionVC as fecha from siniestro
        where vigente = 1 and FechaRecepcionLiquidacionVC >= {day_sql(SINCE)}
          and FechaRecepcionLiquidacionVC < {day_sql(UNTIL)} and FechaSiniestro >= {day_sql(SINCE)}""",
)
def flt6(wh):
    rows = claims.claims_in_period(wh, SINCE, UNTIL, plan_rule=False)
    return rows.select("idsiniestro", F.col("FechaRecepcionLiquidacionVC").alias("fecha"))


@warehouse_query(
    "flt7_between_until_now",
    f"""select idsiniestro, FechaRecepcionLiquidacionVC as fecha from siniestro
        where FechaRecepcionLiquidacionVC between {day_sql(SINCE)} and cast(now() as timestamp)""",
)
def flt7(wh):
    date = F.col("FechaRecepcionLiquidacionVC")
    since = F.to_timestamp_ntz(F.lit(SINCE), F.lit("yyyyMMdd"))
    return wh["siniestro"].where(date.between(since, F.localtimestamp())).select("idsiniestro", date.alias("fecha"))


@warehouse_query(
    "flt8_or_across_tables",
    f"""select ld.idliquidaciondetalle, ig.Glosa, c.ClasificacionSubgrupo
        from liquidaciondetalle ld join instancia_general ig on ig.Codigo = ld.IdGrupo
        left join clasif c on c.codigo = {code_sql('ld.CodigoBeneficio')}
        where ig.Codigo not in (300, 700, 800, 900)
          and (ig.Glosa = 'BENEFICIOS DE SALUD MENTAL' or c.ClasificacionSubgrupo = 'SALUD MENTAL')""",
)
def flt8(wh):
    rows = claims.details(wh, approved_only=False).join(claims.benefit_groups(wh), "IdGrupo")
    rows = rows.join(claims.classification_by_code(wh), "CodigoBeneficio", "left")
    return rows.where(rules.is_mental_health("GlosaBeneficio", "ClasificacionSubgrupo")).select(
        "idliquidaciondetalle", F.col("GlosaBeneficio").alias("Glosa"), "ClasificacionSubgrupo"
    )


@warehouse_query("flt9_not_equal", "select idsiniestro, idcausaprimaria from siniestro where idcausaprimaria <> 0")
def flt9(wh):
    return wh["siniestro"].where("idcausaprimaria != 0").select("idsiniestro", "idcausaprimaria")


@warehouse_query(
    "flt10_no_flag_set",
    """select NumeroSolicitud, Cantidad, CostoUnitarioCLP from marcadas
       where OutlierCantidadAlta = 0 and OutlierCostoBajo = 0 and OutlierCostoAlto = 0""",
)
def flt10(wh):
    grouped = detail.requests(detail.weighted_rows(wh, SINCE, UNTIL))
    rows = detail.regular_rows(detail.flag_outliers(grouped, detail.outlier_criteria(wh)))
    return rows.select("NumeroSolicitud", "Cantidad", "CostoUnitarioCLP")


# --- joins ------------------------------------------------------------------------------


@warehouse_query(
    "jn1_snowflake_chain",
    "select IdSubgrupoPrestacion, IdGrupoPrestacion, IdAperturaPrestacion, count(*) as codigos from clasif group by 1, 2, 3",
)
def jn1(wh):
    return claims.classification(wh).groupBy("IdSubgrupoPrestacion", "IdGrupoPrestacion", "IdAperturaPrestacion").agg(
        F.count(F.lit(1)).alias("codigos")
    )


@warehouse_query(
    "jn2_keys_of_two_tables",
    """select sap.IdSubgrupoApertura, gsp.IdGrupoSubgrupo, sp.ClasificacionSubgrupo
       from subgrupo_apertura_prestacion sap, grupo_subgrupo_prestacion gsp, subgrupo_prestacion sp
       where sp.IdSubgrupoPrestacion = sap.IdSubgrupoPrestacion and sp.IdSubgrupoPrestacion = gsp.IdSubgrupoPrestacion""",
)
def jn2(wh):
    sap, gsp, sp = wh["subgrupo_apertura_prestacion"], wh["grupo_subgrupo_prestacion"], wh["subgrupo_prestacion"]
    return (
        sp.join(sap, "IdSubgrupoPrestacion")
        .join(gsp, "IdSubgrupoPrestacion")
        .select("IdSubgrupoApertura", "IdGrupoSubgrupo", "ClasificacionSubgrupo")
    )


@warehouse_query(
    "jn3_claim_document_detail",
    """select s.idsiniestro, den.NumeroDenuncio, doc.idSiniestroDocumento, ld.idliquidaciondetalle
       from siniestro s join denuncio den on den.iddenuncio = s.iddenuncio
       join siniestrodocumento doc on doc.idsiniestro = s.idsiniestro
       join liquidaciondetalle ld on ld.idSiniestroDocumento = doc.idSiniestroDocumento""",
)
def jn3(wh):
    return (
        wh["siniestro"]
        .join(wh["denuncio"], "iddenuncio")
        .join(wh["siniestrodocumento"], "idsiniestro")
        .join(wh["liquidaciondetalle"], "idSiniestroDocumento")
        .select("idsiniestro", "NumeroDenuncio", "idSiniestroDocumento", "idliquidaciondetalle")
    )


@warehouse_query(
    "jn4_three_key_dimension",
    f"""select s.idsiniestro, cat.GlosaHomologacion from siniestro s
        join categorizacioncanal cat on cat.IdCanal = s.IdCanal and cat.IdDenuncioTipo = s.IdDenuncioTipo
         and cat.IdDenuncioClasificacion = s.IdDenuncioClasificacion and {IN_SCOPE}""",
)
def jn4(wh):
    return wh["siniestro"].join(claims.channels(wh), ["IdCanal", "IdDenuncioClasificacion", "IdDenuncioTipo"]).select(
        "idsiniestro", "GlosaHomologacion"
    )


@warehouse_query(
    "jn5_document_to_provider",
    """select doc.idSiniestroDocumento, pre.rutprestador as RutPrestador, pre.NombrePrestador
       from siniestrodocumento doc join prestadorsucursal ps on ps.idprestadorsucursal = doc.idprestadorsucursal
       join prestador pre on pre.idprestador = ps.idprestador""",
)
def jn5(wh):
    return wh["siniestrodocumento"].join(claims.providers(wh), "idprestadorsucursal").select(
        "idSiniestroDocumento", "RutPrestador", "NombrePrestador"
    )


@warehouse_query(
    "jn6_insurer_and_benefit_group",
    """select ld.idliquidaciondetalle, isa.glosa as insurer, ig.Glosa as benefit
       from siniestro s join isapre isa on isa.idIsapre = s.IdPrevisionAsegurado and isa.vigente = 1
       join siniestrodocumento doc on doc.idsiniestro = s.idsiniestro
       join liquidaciondetalle ld on ld.idSiniestroDocumento = doc.idSiniestroDocumento
       join instancia_general ig on ig.Codigo = ld.IdGrupo and ig.Codigo not in (300, 700, 800, 900)""",
)
def jn6(wh):
    return (
        wh["siniestro"]
        .join(claims.insurers(wh), "IdPrevisionAsegurado")
        .join(wh["siniestrodocumento"], "idsiniestro")
        .join(wh["liquidaciondetalle"], "idSiniestroDocumento")
        .join(claims.benefit_groups(wh), "IdGrupo")
        .select("idliquidaciondetalle", F.col("GlosaIsapre").alias("insurer"), F.col("GlosaBeneficio").alias("benefit"))
    )


def _by_code(kind: str) -> str:
    return f"""select ld.idliquidaciondetalle, c.ClasificacionGrupo, c.ClasificacionApertura
               from liquidaciondetalle ld {kind} join clasif c on c.codigo = {code_sql('ld.CodigoBeneficio')}"""


@warehouse_query("jn7_cast_keys_left", _by_code("left"))
def jn7_left(wh):
    wh = claims.extract_of(wh)
    return claims.details(wh, False).join(claims.classification_by_code(wh), "CodigoBeneficio", "left").select(
        "idliquidaciondetalle", "ClasificacionGrupo", "ClasificacionApertura"
    )


@warehouse_query("jn7_cast_keys_inner", _by_code("inner"))
def jn7_inner(wh):
    wh = claims.extract_of(wh)
    return claims.details(wh, False).join(claims.classification_by_code(wh), "CodigoBeneficio").select(
        "idliquidaciondetalle", "ClasificacionGrupo", "ClasificacionApertura"
    )


@warehouse_query(
    "jn8_holder_look_back",
    """select s.idsiniestro, s.RutTitular, t.LiquidacionHasta
       from siniestro s
       join (select RutTitular, max(FechaRecepcionLiquidacionVC) as LiquidacionHasta from siniestro where vigente = 1 group by 1) t
         on t.RutTitular = s.RutTitular
        and s.FechaRecepcionLiquidacionVC between t.LiquidacionHasta - interval '1' year and t.LiquidacionHasta
        and s.FechaSiniestro >= t.LiquidacionHasta - interval '1' month""",
)
def jn8(wh):
    last = claims.valid_claims(wh, False).groupBy("RutTitular").agg(F.max("FechaRecepcionLiquidacionVC").alias("LiquidacionHasta"))
    return (
        wh["siniestro"]
        .join(last, "RutTitular")
        .where(F.col("FechaRecepcionLiquidacionVC").between(back("LiquidacionHasta", years=1), F.col("LiquidacionHasta")))
        .where(F.col("FechaSiniestro") >= back("LiquidacionHasta", months=1))
        .select("idsiniestro", "RutTitular", "LiquidacionHasta")
    )


_PROVIDER_CLAIMS = """
    select s.idsiniestro, s.FechaRecepcionLiquidacionVC as fecha, pre.rutprestador as rut
    from siniestro s join siniestrodocumento doc on doc.idsiniestro = s.idsiniestro
    join prestadorsucursal ps on ps.idprestadorsucursal = doc.idprestadorsucursal
    join prestador pre on pre.idprestador = ps.idprestador"""


def provider_claims(wh):
    return (
        wh["siniestro"]
        .join(wh["siniestrodocumento"], "idsiniestro")
        .join(claims.providers(wh), "idprestadorsucursal")
        .select("idsiniestro", F.col("FechaRecepcionLiquidacionVC").alias("FechaRecepcionLiquidacion"), "RutPrestador")
    )


@warehouse_query(
    "jn9_provider_look_back",
    f"""with docs as ({_PROVIDER_CLAIMS}), ult as (select rut, max(fecha) as hasta from docs group by rut)
        select d.idsiniestro, d.rut as RutPrestador, d.fecha as FechaRecepcionLiquidacion from docs d join ult u on u.rut = d.rut
        and d.fecha between u.hasta - interval '3' month and u.hasta""",
)
def jn9(wh):
    rows = provider_claims(wh)
    windows = stage(insured.provider_windows(rows), "provider-windows")
    return rows.join(windows, "RutPrestador").where(
        F.col("FechaRecepcionLiquidacion").between(F.col("FechaDesde"), F.col("FechaHasta"))
    ).select("idsiniestro", "RutPrestador", "FechaRecepcionLiquidacion")


@warehouse_query(
    "jn10_person_in_two_roles",
    """select s.idsiniestro, p.sexo as titular_sexo, pb.sexo as siniestrado_sexo, pb.fechanacimiento as siniestrado_nacimiento
       from siniestro s join persona p on p.idpersona = s.IdTitular join persona pb on pb.idpersona = s.IdSiniestrado""",
)
def jn10(wh):
    return (
        wh["siniestro"]
        .join(insured.persons(wh, "titular", "IdTitular"), "IdTitular")
        .join(insured.persons(wh, "siniestrado", "IdSiniestrado"), "IdSiniestrado")
        .select("idsiniestro", "titular_sexo", "siniestrado_sexo", "siniestrado_nacimiento")
    )


@warehouse_query(
    "jn11_left_counts_with_zero",
    """select s.idsiniestro, s.RutTitular, coalesce(c.Diagnosticos, 0) as Diagnosticos
       from siniestro s left join (select RutTitular, count(distinct idcausaprimaria) as Diagnosticos from siniestro
                                   where idcausaprimaria > 20 group by 1) c on c.RutTitular = s.RutTitular""",
)
def jn11(wh):
    counts = wh["siniestro"].where("idcausaprimaria > 20").groupBy("RutTitular").agg(
        F.countDistinct("idcausaprimaria").alias("Diagnosticos")
    )
    return insured.with_diagnoses(wh["siniestro"].select("idsiniestro", "RutTitular"), counts)


@warehouse_query(
    "jn12_left_criteria_fan_out",
    """select c.CodigoPrestacion, co.CriterioCantidadAlta::double as CriterioCantidadAlta
       from clasif c left join criterios co using (IdGrupoPrestacion, IdSubgrupoPrestacion, IdAperturaPrestacion)""",
)
def jn12(wh):
    return plain(
        claims.classification(wh)
        .join(detail.outlier_criteria(wh).select(*detail.CRITERIA_KEYS, "CriterioCantidadAlta"), detail.CRITERIA_KEYS, "left")
        .select("CodigoPrestacion", "CriterioCantidadAlta")
    )


@warehouse_query(
    "jn13_attach_profile",
    f"""with docs as ({_PROVIDER_CLAIMS}),
             per as (select rut, count(distinct idsiniestro) as solicitudes from docs where rut <> 'Sin rut prestador' group by rut)
        select d.idsiniestro, d.rut as RutPrestador, p.solicitudes from docs d join per p on p.rut = d.rut""",
)
def jn13(wh):
    rows = provider_claims(wh).select("idsiniestro", "RutPrestador")
    profile = rows.where("RutPrestador != 'Sin rut prestador'").groupBy("RutPrestador").agg(
        F.countDistinct("idsiniestro").alias("solicitudes")
    )
    return rows.join(stage(profile, "profile"), "RutPrestador")


@warehouse_query(
    "jn14_multiplying_inner_join",
    "select s.idsiniestro, s.RutTitular from siniestro s join liquidacion liq on liq.idSiniestro = s.idsiniestro",
)
def jn14(wh):
    counted = wh["siniestro"].join(claims.settlement_counts(wh), "idsiniestro")
    return claims.repeat_rows(counted, F.col("Liquidaciones")).select("idsiniestro", "RutTitular")


@warehouse_query(
    "jn15_multiplying_left_join",
    """select ld.idliquidaciondetalle, ld.MontoLiquidado::double as MontoLiquidado from liquidaciondetalle ld
       left join liquidaciondetallerechazo r on r.idliquidaciondetalle = ld.idliquidaciondetalle""",
)
def jn15(wh):
    counted = wh["liquidaciondetalle"].join(claims.rejection_counts(wh), "idliquidaciondetalle", "left")
    repeated = claims.repeat_rows(counted, F.coalesce("Rechazos", F.lit(1)))
    return plain(repeated.select("idliquidaciondetalle", "MontoLiquidado"))


@warehouse_query(
    "jn16_restrict_persons",
    """select s.RutTitular, s.RutSiniestrado, count(distinct s.idcausaprimaria) as causas
       from siniestro s join (select RutSiniestrado from siniestro where vigente = 0) o on o.RutSiniestrado = s.RutSiniestrado
       where s.vigente = 1 group by 1, 2""",
)
def jn16(wh):
    people = wh["siniestro"].where("vigente = 0").select("RutSiniestrado").distinct()
    return (
        claims.valid_claims(wh, False)
        .join(people, "RutSiniestrado", "left_semi")
        .groupBy("RutTitular", "RutSiniestrado")
        .agg(F.countDistinct("idcausaprimaria").alias("causas"))
    )


@warehouse_query(
    "jn17_criteria_chain",
    "select IdModeloAnalitico, TipoMachineLearning, count(*) as criterios from criterios group by 1, 2",
)
def jn17(wh):
    return detail.outlier_criteria(wh).groupBy("IdModeloAnalitico", "TipoMachineLearning").agg(
        F.count(F.lit(1)).alias("criterios")
    )


# --- aggregates -------------------------------------------------------------------------


@warehouse_query(
    "ag1_holder_last_and_offsets",
    """select RutTitular, max(FechaRecepcionLiquidacion) as LiquidacionHasta,
              max(FechaRecepcionLiquidacion) - interval '1' year as LiquidacionDesde,
              max(FechaRecepcionLiquidacion) - interval '1' month as PrestacionDesde
       from candidatos where ClasificacionSubgrupo = 'SALUD MENTAL' or GlosaBeneficio = 'BENEFICIOS DE SALUD MENTAL'
       group by RutTitular""",
)
def ag1(wh):
    return insured.holder_windows(insured.cohort_rows(wh, SINCE, UNTIL))


@warehouse_query(
    "ag2_provider_last_and_offset",
    f"""with docs as ({_PROVIDER_CLAIMS})
        select rut as RutPrestador, max(fecha) as FechaHasta, max(fecha) - interval '3' month as FechaDesde from docs group by rut""",
)
def ag2(wh):
    return insured.provider_windows(provider_claims(wh))


_SUMS = ", ".join(f"sum({m})::double as {m}" for m in detail.MEASURES if m != "Cantidad")


@warehouse_query(
    "ag3_sums_at_request_grain",
    f"select {', '.join(detail.GRAIN)}, cast(sum(Cantidad) as bigint) as Cantidad, {_SUMS} from detalle group by all",
)
def ag3(wh):
    return plain(detail.request_totals(detail.weighted_rows(wh, SINCE, UNTIL)))


@warehouse_query(
    "ag4_ratio_of_sums",
    """select IdGrupo, sum(MontoValorBeneficio)::double / nullif(sum(cantidad), 0)::double as costo_unitario
       from liquidaciondetalle group by IdGrupo""",
)
def ag4(wh):
    sums = wh["liquidaciondetalle"].groupBy("IdGrupo").agg(F.sum("MontoValorBeneficio").alias("v"), F.sum("cantidad").alias("q"))
    return sums.select("IdGrupo", ratio("v", "q").alias("costo_unitario"))


@warehouse_query(
    "ag5_having_on_sums",
    """select RutTitular, NumeroSolicitud, cast(sum(Cantidad) as bigint) as Cantidad,
              sum(ValorPrestacionCLP)::double as ValorPrestacionCLP
       from detalle group by RutTitular, NumeroSolicitud
       having sum(Cantidad) > 0 and sum(Cantidad) < 45 and sum(ValorPrestacionCLP) > 0""",
)
def ag5(wh):
    sums = detail.detail_rows(wh, SINCE, UNTIL).groupBy("RutTitular", "NumeroSolicitud").agg(
        F.sum("Cantidad").alias("Cantidad"), F.sum("ValorPrestacionCLP").alias("ValorPrestacionCLP")
    )
    return plain(detail.plausible(sums, limit=45))


@warehouse_query(
    "ag6_count_distinct",
    """select s.RutTitular, s.RutSiniestrado, count(distinct d.Glosa) as Diagnosticos
       from siniestro s join diagnostico d on d.idDiagnostico = s.idcausaprimaria group by 1, 2""",
)
def ag6(wh):
    return (
        wh["siniestro"]
        .join(wh["diagnostico"], F.col("idcausaprimaria") == F.col("idDiagnostico"))
        .groupBy("RutTitular", "RutSiniestrado")
        .agg(F.countDistinct("Glosa").alias("Diagnosticos"))
    )


@warehouse_query(
    "ag7_several_count_distincts",
    f"""select doc.idprestadorsucursal, count(distinct s.RutSiniestrado) as personas,
               count(distinct den.NumeroDenuncio) as solicitudes, count(distinct {code_sql('ld.CodigoBeneficio')}) as prestaciones,
               sum(ld.MontoConversionBeneficio)::double as valor
        from siniestro s join denuncio den on den.iddenuncio = s.iddenuncio
        join siniestrodocumento doc on doc.idsiniestro = s.idsiniestro
        join liquidaciondetalle ld on ld.idSiniestroDocumento = doc.idSiniestroDocumento
        group by doc.idprestadorsucursal""",
)
def ag7(wh):
    return plain(
        wh["siniestro"]
        .join(wh["denuncio"], "iddenuncio")
        .join(wh["siniestrodocumento"], "idsiniestro")
        .join(wh["liquidaciondetalle"], "idSiniestroDocumento")
        .groupBy("idprestadorsucursal")
        .agg(
            F.countDistinct("RutSiniestrado").alias("personas"),
            F.countDistinct("NumeroDenuncio").alias("solicitudes"),
            F.countDistinct(code_to_int("CodigoBeneficio")).alias("prestaciones"),
            F.sum("MontoConversionBeneficio").alias("valor"),
        )
    )


@warehouse_query(
    "ag8_min_max_distinct_text",
    "select idprestador % 10 as grupo, max(distinct NombrePrestador) as mayor, min(distinct NombrePrestador) as menor from prestador group by 1",
)
def ag8(wh):
    return wh["prestador"].groupBy((F.col("idprestador") % 10).alias("grupo")).agg(
        F.max("NombrePrestador").alias("mayor"), F.min("NombrePrestador").alias("menor")
    )


@warehouse_query(
    "ag9_sum_of_distinct_counts",
    """select RutTitular, cast(sum(n) as bigint) as Diagnosticos from
       (select RutTitular, RutSiniestrado, count(distinct idcausaprimaria) as n from siniestro group by 1, 2) x group by 1""",
)
def ag9(wh):
    per_person = wh["siniestro"].groupBy("RutTitular", "RutSiniestrado").agg(
        F.countDistinct("idcausaprimaria").alias("Diagnosticos")
    )
    return insured.holder_diagnoses(per_person)


@warehouse_query(
    "ag10_share_of_flag",
    """select s.RutTitular, avg(case when isa.glosa = 'FONASA' then 1.0::double else 0.0::double end) as fonasa
       from siniestro s join isapre isa on isa.idIsapre = s.IdPrevisionAsegurado group by 1""",
)
def ag10(wh):
    return (
        wh["siniestro"]
        .join(wh["isapre"], F.col("IdPrevisionAsegurado") == F.col("idIsapre"))
        .groupBy("RutTitular")
        .agg(F.avg(flag(rules.is_public("glosa")).cast("double")).alias("fonasa"))
    )


@warehouse_query("ag11_representative_text", "select rutprestador, max(NombrePrestador) as NombrePrestador from prestador group by rutprestador")
def ag11(wh):
    return wh["prestador"].groupBy("rutprestador").agg(F.max("NombrePrestador").alias("NombrePrestador"))


@warehouse_query("ag12_distinct_rows", "select distinct RutTitular, IdPrevisionAsegurado, IdDenuncioTipo from siniestro")
def ag12(wh):
    return wh["siniestro"].select("RutTitular", "IdPrevisionAsegurado", "IdDenuncioTipo").distinct()


@warehouse_query(
    "ag13_distinct_of_grouped",
    "select distinct RutTitular, count(*) as n from siniestro group by RutTitular",
)
def ag13(wh):
    return wh["siniestro"].groupBy("RutTitular").agg(F.count(F.lit(1)).alias("n"))


@warehouse_query(
    "ag23_rejected_requests_per_holder",
    """select h.RutTitular, h.NumeroSolicitud, h.ValorPagoCLP, coalesce(r.n, 0) as SolicitudesRechazadas
       from historia h left join (select RutTitular, count(distinct NumeroSolicitud) as n from historia
                                  where Estado = 'RECHAZADA' group by 1) r on r.RutTitular = h.RutTitular
       where h.Estado = 'APROBADA'""",
)
def ag23(wh):
    rows = insured.approved_with_rejections(insured.insured_history(wh, SINCE, UNTIL))
    return plain(rows.select("RutTitular", "NumeroSolicitud", "ValorPagoCLP", "SolicitudesRechazadas"))


# --- sets -------------------------------------------------------------------------------


@query(
    "set1_added_columns",
    """select count(*) as filas, max(cargo) as mayor_cargo, max(neto) as mayor_neto
       from (select l_quantity * 2 as cargo, l_quantity - 1 as neto from lineitem)""",
)
def set1(spark, folder):
    before = StandIn(spark, folder).source("lineitem")
    after = before.withColumns({"cargo": F.col("l_quantity") * 2, "neto": F.col("l_quantity") - 1})
    added = new_columns(after.columns, before.columns)
    return after.agg(F.count(F.lit(1)).alias("filas"), *[F.max(c).alias(f"mayor_{c}") for c in added])

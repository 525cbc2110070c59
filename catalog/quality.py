"""Profiles, data quality and correlation over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import plain, query, warehouse_query
from catalog.scalars import source_query
from claimlens.functions.numeric import magnitude_class, magnitude_mark
from claimlens.operators import correlation as corr
from claimlens.operators import profile
from claimlens.sources.standin import StandIn

# --- frequencies and modes --------------------------------------------------------------


@source_query(
    "ag14_value_counts",
    "lineitem",
    """select l_linenumber as Campo, count(*) as Frecuencia,
              round_even(count(*) / (select count(*) from lineitem)::double * 100, 0) / 100 as Relativo
       from lineitem group by 1""",
)
def ag14(lineitem):
    return profile.value_counts(lineitem, "l_linenumber")


@source_query(
    "srt1_descending_counts",
    "orders",
    """select o_custkey as Campo, count(*) as Frecuencia, round_even(count(*) / (select count(*) from orders)::double * 100, 0) / 100 as Relativo
       from orders group by 1 order by 2 desc, 1""",
)
def srt1(orders):
    return profile.value_counts(orders, "o_custkey")


@source_query(
    "ag15_mode_of_column",
    "orders",
    """select 'o_custkey' as Campo, o_custkey as Moda from orders group by o_custkey order by count(*) desc, o_custkey limit 1""",
)
def ag15(orders):
    return profile.mode(orders, "o_custkey")


def _mode_sql(column: str, table: str, text: str | None = None) -> str:
    return f"""(select '{column}' as Campo, {text or column + '::varchar'} as Moda from {table}
                where {column} is not null group by {column} order by count(*) desc, {column} limit 1)"""


@source_query(
    "ag16_mode_of_every_column",
    "orders",
    " union all ".join(
        _mode_sql(c, "orders")
        for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    ),
)
def ag16(orders):
    return profile.modes(orders)


# --- missing values ---------------------------------------------------------------------


@warehouse_query(
    "ag17_missing_values",
    """select * from (
         select 'IdPlanBeneficio' as Campo, count(*) filter (where IdPlanBeneficio is null) as ValoresPerdidos,
                count(*) filter (where IdPlanBeneficio is null) / count(*)::double as Porcentaje from siniestro
         union all
         select 'IdCanal', count(*) filter (where IdCanal is null), count(*) filter (where IdCanal is null) / count(*)::double
         from siniestro) x where ValoresPerdidos > 0""",
)
def ag17(wh):
    return profile.missing_values(wh["siniestro"])


@warehouse_query(
    "ag18_rows_with_missing",
    "select avg(case when IdPlanBeneficio is null or IdCanal is null then 1.0::double else 0.0::double end) as Porcentaje from siniestro",
)
def ag18(wh):
    return profile.missing_row_share(wh["siniestro"])


@warehouse_query("flt11_null_tests", "select idsiniestro, IdPlanBeneficio from siniestro where IdCanal is null and IdPlanBeneficio is not null")
def flt11(wh):
    rows = wh["siniestro"]
    fields = rows.schema
    return rows.where(profile.is_missing(fields["IdCanal"])).dropna(subset=["IdPlanBeneficio"]).select("idsiniestro", "IdPlanBeneficio")


@warehouse_query(
    "flt12_summary_rows_above_zero",
    """select 'sexo' as Campo, count(*) as ValoresPerdidos from persona where sexo is null having count(*) > 0""",
)
def flt12(wh):
    return profile.missing_values(wh["persona"]).select("Campo", "ValoresPerdidos")


@warehouse_query(
    "dq1_fill_missing",
    "select idsiniestro, coalesce(IdPlanBeneficio, 'SIN PLAN') as IdPlanBeneficio, coalesce(IdCanal, -1) as IdCanal from siniestro",
)
def dq1(wh):
    rows = wh["siniestro"].select("idsiniestro", "IdPlanBeneficio", "IdCanal")
    return profile.fill_missing(rows, {"IdPlanBeneficio": "SIN PLAN", "IdCanal": -1})


# --- duplicates -------------------------------------------------------------------------

_DUPLICATES = """
    select sum(n)::bigint as totales, count(*) filter (where n = 1) as no_duplicados_sin_keep,
           coalesce(sum(n) filter (where n > 1), 0)::bigint as duplicados_sin_keep,
           count(*) as no_duplicados_con_keep, sum(n - 1)::bigint as duplicados_con_keep,
           case when sum(n - 1) = 0 then -1.0::double
                else round_even(coalesce(sum(n) filter (where n > 1), 0)::double / sum(n - 1)::double * 100, 0) / 100 end as margen_de_duplicacion
    from (select count(*) as n from {rows}) x"""


@source_query("ag19_duplicate_report", "lineitem", _DUPLICATES.format(rows="lineitem group by l_orderkey, l_linenumber"))
def ag19(lineitem):
    return profile.duplicates(lineitem.select("l_orderkey", "l_linenumber"))


@source_query("ag19_no_duplicates", "orders", _DUPLICATES.format(rows="orders group by all").replace("count(*) as n from", "count(*) as n, * from"))
def ag19_none(orders):
    return profile.duplicates(orders)


@source_query(
    "set2_rows_outside_reduced_set",
    "lineitem",
    """select l_orderkey, l_linenumber, count(*) as copias from lineitem group by 1, 2 having count(*) > 1""",
)
def set2(lineitem):
    counted = lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copias"))
    return counted.where("copias > 1")


# --- correlation ------------------------------------------------------------------------

NUMBERS = ["cantidad", "precio", "descuento", "impuesto", "opuesto", "copia", "constante", "parcial"]
NUMBER_SQL = {
    "cantidad": "l_quantity",
    "precio": "l_extendedprice",
    "descuento": "l_discount",
    "impuesto": "l_tax",
    "opuesto": "-l_quantity",
    "copia": "l_quantity",
    "constante": "1.0::double",
    "parcial": "case when l_linenumber < 4 then l_extendedprice * l_discount end",
}

_PAIRS = " union all ".join(
    f"""select '{a}' as Fila, '{b}' as Columna, {i} as fila_pos, {j} as columna_pos,
               corr({a}, {b}) as raw from numeros"""
    for i, a in enumerate(NUMBERS)
    for j, b in enumerate(NUMBERS)
)
_NUMEROS = f"numeros as (select {', '.join(f'{e} as {n}' for n, e in NUMBER_SQL.items())} from lineitem)"
# Rounded: sums of doubles depend on their order. An undefined correlation is NULL.
_MATRIX = f"""{_NUMEROS}, matriz as (
    select Fila, Columna, fila_pos, columna_pos, case when isnan(raw) then null else round(raw, 6) + 0.0 end as r from ({_PAIRS}) p)"""

_MARK = """case when r is null then '' when abs(r) < 0.2 then '(-----)' when abs(r) < 0.4 then '(*----)'
                when abs(r) < 0.6 then '(**---)' when abs(r) < 0.8 then '(***--)' when abs(r) < 1 then '(****-)' else '(*****)' end"""
_CLASS = """case when abs(r) < 0.2 then 'veryweak' when abs(r) < 0.4 then 'weak' when abs(r) < 0.6 then 'moderate'
                 when abs(r) < 0.8 then 'strong' when abs(r) < 1 then 'verystrong' end"""


def numbers(lineitem):
    own = {
        "cantidad": F.col("l_quantity"),
        "precio": F.col("l_extendedprice"),
        "descuento": F.col("l_discount"),
        "impuesto": F.col("l_tax"),
        "opuesto": -F.col("l_quantity"),
        "copia": F.col("l_quantity"),
        "constante": F.lit(1.0),
        "parcial": F.when(F.col("l_linenumber") < 4, F.col("l_extendedprice") * F.col("l_discount")),
    }
    return lineitem.select([c.alias(n) for n, c in own.items()])


def matrix(lineitem):
    return corr.correlation(numbers(lineitem), NUMBERS)


@source_query("ag22_correlation_matrix", "lineitem", f"with {_MATRIX} select * from matriz")
def ag22(lineitem):
    return matrix(lineitem).withColumn("r", F.round("r", 6) + 0.0)


@source_query(
    "ag21_mean_absolute_correlation",
    "lineitem",
    f"with {_MATRIX} select Columna, round(avg(abs(r)), 4) as promedio from matriz where fila_pos <> columna_pos group by Columna",
)
def ag21(lineitem):
    return corr.mean_absolute(matrix(lineitem)).withColumn("promedio", F.round("promedio", 4))


@source_query(
    "cr1_magnitude_marks",
    "customer",
    f"select c_custkey, {_MARK} as marca, {_CLASS} as clase from (select c_custkey, c_acctbal / 8000 as r from customer) x",
)
def cr1(customer):
    r = F.col("c_acctbal") / 8000
    return customer.select("c_custkey", magnitude_mark(r).alias("marca"), magnitude_class(r).alias("clase"))


@source_query("cr2_lower_triangle", "lineitem", f"with {_MATRIX} select Fila, Columna, r from matriz where fila_pos >= columna_pos")
def cr2(lineitem):
    return corr.lower_triangle(matrix(lineitem)).select("Fila", "Columna", (F.round("r", 6) + 0.0).alias("r"))


_CLASSED = f"""with {_MATRIX} select clase, least(Fila, Columna) as primera, greatest(Fila, Columna) as segunda
               from (select *, {_CLASS} as clase from matriz where fila_pos > columna_pos) x where clase is not null"""


@source_query("cr3_pairs_by_class", "lineitem", _CLASSED)
def cr3(lineitem):
    return corr.class_pairs(matrix(lineitem))


@source_query(
    "srt2_sorted_pairs",
    "lineitem",
    f"select * from ({_CLASSED}) y order by clase, primera, segunda",
)
def srt2(lineitem):
    return corr.class_pairs(matrix(lineitem)).orderBy("clase", "primera", "segunda")


@source_query(
    "cr4_correlation_report",
    "lineitem",
    f"""with {_MATRIX}, promedios as (
          select Columna, round(avg(abs(r)), 4) as promedio from matriz where fila_pos <> columna_pos group by Columna)
        select m.Fila, m.Columna, {_MARK} as magnitud, p.promedio
        from matriz m join promedios p on p.Columna = m.Columna where fila_pos >= columna_pos""",
)
def cr4(lineitem):
    marks, _, means = corr.analyze(matrix(lineitem))
    return marks.select("Fila", "Columna", "magnitud").join(
        means.withColumn("promedio", F.round("promedio", 4)), "Columna"
    ).select("Fila", "Columna", "magnitud", "promedio")


@query(
    "cr2_wide_marks",
    f"""with {_MATRIX}, marcas as (select Fila, Columna, {_MARK} as m from matriz where fila_pos >= columna_pos)
        select Fila, {', '.join(f"max(m) filter (where Columna = '{n}') as {n}" for n in NUMBERS)} from marcas group by Fila""",
)
def cr2_wide(spark, folder):
    marks = corr.labels(matrix(StandIn(spark, folder).source("lineitem")))
    return plain(corr.wide(marks, NUMBERS, "magnitud"))

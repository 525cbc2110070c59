"""Policy time-series over orders: a customer is a policy, a month a period, the order status its value."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.scalars import source_query
from claimlens.functions.dates import period
from claimlens.operators import policies

_EVENTS = """eventos as (
    select o_custkey::varchar as poliza, strftime(o_orderdate, '%Y%m') as periodo,
           case o_orderstatus when 'F' then 1 when 'P' then -1 else 0 end as valor from orders),
  matriz as (
    select poliza, periodo, case when max(abs(valor)) = 0 then 0 when max(valor) = 1 then 1 else -1 end as valor
    from eventos group by poliza, periodo),
  eje as (select periodo, row_number() over (order by periodo) - 1 as i from (select distinct periodo from matriz) p),
  inicio as (select poliza, min(periodo) as periodo, arg_min(valor, periodo) as valor from matriz where valor <> 0 group by poliza)"""

_FLAGS = f"""{_EVENTS},
  cuentas as (
    select m.poliza, count(*) filter (where m.valor <> 0) as activos, count(*) filter (where m.valor = -1) as cancelados,
           any_value(s.valor) as primero, any_value(e.i) as i0, (select count(*) from eje) as n
    from matriz m left join inicio s on s.poliza = m.poliza left join eje e on e.periodo = s.periodo group by m.poliza),
  casos as (
    select poliza, (activos = 0)::integer as SIN_DATOS, (activos > 0 and cancelados = activos)::integer as SOLO_CANCELADOS,
           (activos > 0 and primero = -1)::integer as COMIENZA_CANCELADA,
           (activos > 0 and n - i0 - activos <> 0)::integer as MESES_NO_REGISTRADOS from cuentas)"""


def events(orders):
    value = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", -1).otherwise(0)
    return orders.select(
        F.col("o_custkey").cast("string").alias("poliza"), period("o_orderdate").alias("periodo"), value.alias("valor")
    )


def matrix(orders):
    return policies.policy_matrix(events(orders))


@source_query("policy_matrix", "orders", f"with {_EVENTS} select * from matriz")
def policy_matrix(orders):
    return matrix(orders)


@source_query(
    "wn1_running_activity",
    "orders",
    f"""with {_EVENTS} select poliza, periodo, valor,
        cast(sum(abs(valor)) over (partition by poliza order by periodo rows unbounded preceding) as bigint) as acumulado from matriz""",
)
def wn1(orders):
    return policies.running_activity(matrix(orders))


@source_query("wn2_first_active", "orders", f"with {_EVENTS} select * from inicio")
def wn2(orders):
    return policies.first_active(matrix(orders))


@source_query(
    "ps1_policy_flags",
    "orders",
    f"""with {_FLAGS} select poliza, greatest(SIN_DATOS, SOLO_CANCELADOS, COMIENZA_CANCELADA, MESES_NO_REGISTRADOS) as CASO,
        SIN_DATOS, SOLO_CANCELADOS, COMIENZA_CANCELADA, MESES_NO_REGISTRADOS from casos""",
)
def ps1(orders):
    return policies.policy_flags(matrix(orders))


@source_query(
    "ps1_anomalous_policies_with_series",
    "orders",
    f"""with {_FLAGS}, anomalas as (
          select *, greatest(SIN_DATOS, SOLO_CANCELADOS, COMIENZA_CANCELADA, MESES_NO_REGISTRADOS) as CASO from casos)
        select a.poliza as POLIZA, CASO, SIN_DATOS, SOLO_CANCELADOS, COMIENZA_CANCELADA, MESES_NO_REGISTRADOS, e.periodo, coalesce(m.valor, 0) as valor
        from anomalas a cross join eje e left join matriz m on m.poliza = a.poliza and m.periodo = e.periodo where a.CASO = 1""",
)
def ps1_series(orders):
    return policies.anomalous_series(matrix(orders))


@source_query(
    "ps2_series_from_first_activity",
    "orders",
    f"""with {_EVENTS} select s.poliza, e.periodo, coalesce(m.valor, 0) as valor
        from inicio s join eje e on e.periodo >= s.periodo
        left join matriz m on m.poliza = s.poliza and m.periodo = e.periodo""",
)
def ps2(orders):
    return policies.partial_series(matrix(orders))

"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import code_sql, pad_sql, plain, query, warehouse_query
from claimlens.functions import dates, numeric, rules, text
from claimlens.functions.text import NO_PROVIDER_ID
from claimlens.operators import load
from claimlens.sources.standin import StandIn


def source_query(name: str, table: str, sql: str | None = None):
    """Register a query over one of the given tables."""

    def add(fn):
        query(name, sql)(lambda spark, folder: fn(StandIn(spark, folder).source(table)))
        return fn

    return add


# --- text -------------------------------------------------------------------------------


@source_query("str1_id_padding", "orders", f"select o_orderkey, {pad_sql('o_custkey')} as rut, {pad_sql('o_orderpriority')} as largo from orders")
def str1(orders):
    return orders.select("o_orderkey", text.pad_id("o_custkey").alias("rut"), text.pad_id("o_orderpriority").alias("largo"))


@warehouse_query(
    "str2_guarded_id_padding",
    f"""select idprestador, case when rutprestador = '{NO_PROVIDER_ID}' then rutprestador
                                 else {pad_sql('rutprestador')} end as rut from prestador""",
)
def str2(wh):
    return wh["prestador"].select("idprestador", text.pad_provider_id("rutprestador").alias("rut"))


@source_query("str3_lower_values", "part", "select p_partkey, lower(p_brand) as marca, lower(p_type) as tipo from part")
def str3(part):
    return part.select("p_partkey", F.lower("p_brand").alias("marca"), F.lower("p_type").alias("tipo"))


@source_query(
    "str4_zero_fill",
    "orders",
    """select o_orderkey, case when length(o_custkey::varchar) >= 4 then o_custkey::varchar
                               else lpad(o_custkey::varchar, 4, '0') end as codigo from orders""",
)
def str4(orders):
    return orders.select("o_orderkey", text.zero_fill("o_custkey", 4).alias("codigo"))


@source_query("str5_truncate", "documents", "select doc_id, substring(text, 1, 10) as inicio, substring(source, 1, 3) as fuente from documents")
def str5(documents):
    return documents.select("doc_id", text.truncate("text", 10).alias("inicio"), text.truncate("source", 3).alias("fuente"))


@warehouse_query(
    "str6_concat_null",
    "select idsiniestro, case when IdPlanBeneficio is null then null else '0000' || IdPlanBeneficio end as plan from siniestro",
)
def str6(wh):
    return wh["siniestro"].select("idsiniestro", F.concat(F.lit("0000"), F.col("IdPlanBeneficio")).alias("plan"))


@source_query(
    "str7_split_spec_lines",
    "part",
    """select p_partkey, p_name as campo, p_type as sqltype, p_brand as pytype from part""",
)
def str7(part):
    line = F.concat(F.col("p_name"), F.lit(" ; "), F.col("p_type"), F.lit(";"), F.col("p_brand"), F.lit(" "))
    parts = part.select("p_partkey", text.spec_fields(line).alias("p"))
    return parts.select("p_partkey", F.col("p")[0].alias("campo"), F.col("p")[1].alias("sqltype"), F.col("p")[2].alias("pytype"))


@source_query(
    "str8_to_text",
    "orders",
    """select o_orderkey::varchar as clave, o_totalprice::varchar as total, o_orderdate::varchar as fecha from orders""",
)
def str8(orders):
    return orders.select(
        F.col("o_orderkey").cast("string").alias("clave"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.col("o_orderdate").cast("string").alias("fecha"),
    )


@warehouse_query(
    "str_code_to_integer",
    f"select CodigoPrestacion, coalesce({code_sql('CodigoPrestacion')}, -1) as codigo from detalle_prestacion",
)
def str_code(wh):
    return wh["detalle_prestacion"].select("CodigoPrestacion", F.coalesce(text.code_to_int("CodigoPrestacion"), F.lit(-1)).alias("codigo"))


# --- dates ------------------------------------------------------------------------------


@source_query(
    "dt1_move_back",
    "events",
    "select event_id, ts - interval '1' year as anual, ts - interval '1' month as mes, ts - interval '3' month as trimestre from events",
)
def dt1(events):
    return events.select(
        "event_id",
        dates.back("ts", years=1).alias("anual"),
        dates.back("ts", months=1).alias("mes"),
        dates.back("ts", months=3).alias("trimestre"),
    )


@query(
    "dt2_day_difference",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
              date_diff('day', o_orderdate::date, l_shipdate::date)::integer as dias
       from lineitem join orders on o_orderkey = l_orderkey""",
)
def dt2(spark, folder):
    source = StandIn(spark, folder).source
    return (
        source("lineitem")
        .join(source("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dates.day_gap("o_orderdate", "l_shipdate").alias("dias"))
    )


@warehouse_query(
    "dt3_age_in_years",
    """select s.idsiniestro, trunc(date_diff('day', p.fechanacimiento, s.FechaSiniestro::date) / 365)::integer as edad
       from siniestro s join persona p on p.idpersona = s.IdTitular""",
)
def dt3(wh):
    return wh["siniestro"].join(wh["persona"], F.col("IdTitular") == F.col("idpersona")).select(
        "idsiniestro", dates.age_years("fechanacimiento", "FechaSiniestro").alias("edad")
    )


@source_query("dt4_period", "orders", "select o_orderkey, strftime(o_orderdate, '%Y%m') as periodo from orders")
def dt4(orders):
    return orders.select("o_orderkey", dates.period("o_orderdate").alias("periodo"))


@source_query("dt5_before_now", "events", "select event_id, 1 as pasado from events where ts <= now()::timestamp")
def dt5(events):
    return events.where(F.col("ts") <= F.localtimestamp()).select("event_id", F.lit(1).alias("pasado"))


@source_query(
    "dt6_day_literal",
    "orders",
    "select o_orderkey, timestamp '1998-01-01' as desde from orders where o_orderdate >= timestamp '1998-01-01'",
)
def dt6(orders):
    since = dates.day_literal("19980101")
    return orders.where(F.col("o_orderdate") >= since).select("o_orderkey", since.alias("desde"))


@source_query("dt7_parse_datetime", "orders", "select o_orderkey, o_orderdate as fecha from orders")
def dt7(orders):
    return orders.select("o_orderkey", F.col("o_orderdate").cast("string").cast("timestamp_ntz").alias("fecha"))


@source_query(
    "dt8_month_and_day",
    "events",
    "select event_id, month(ts)::integer as mes, day(ts)::integer as dia from events",
)
def dt8(events):
    return events.select("event_id", F.month("ts").alias("mes"), F.dayofmonth("ts").alias("dia"))


@source_query(
    "dt9_truncate_to_second",
    "events",
    "select event_id, date_trunc('second', ts) as segundo, date_trunc('second', ts) <= now()::timestamp as pasado from events",
)
def dt9(events):
    return events.select(
        "event_id",
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("segundo"),
        (F.col("ts") <= dates.now_to_second()).alias("pasado"),
    )


@query(
    "dt10_settlement_lag",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
              date_diff('day', o_orderdate::date, l_shipdate::date) / 60 as sla
       from lineitem join orders on o_orderkey = l_orderkey""",
)
def dt10(spark, folder):
    source = StandIn(spark, folder).source
    return (
        source("lineitem")
        .join(source("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dates.settlement_lag("o_orderdate", "l_shipdate").alias("sla"))
    )


# --- numbers ----------------------------------------------------------------------------


@source_query(
    "ma1_round_half_even",
    "lineitem",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, round_even(l_quantity / 2, 0) as r0,
              round_even(l_extendedprice / 8 * 100, 0) / 100 as r2, round_even(l_extendedprice / 32 * 10000, 0) / 10000 as r4
       from lineitem""",
)
def ma1(lineitem):
    return lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        numeric.r0(F.col("l_quantity") / 2).alias("r0"),
        numeric.r2(F.col("l_extendedprice") / 8).alias("r2"),
        numeric.r4(F.col("l_extendedprice") / 32).alias("r4"),
    )


@source_query(
    "ma2_sine_cosine",
    "orders",
    """select o_orderkey, round(sin(2 * pi() * o_custkey / 365), 9) + 0.0 as seno,
              round(cos(2 * pi() * o_custkey / 365), 9) + 0.0 as coseno from orders""",
)
def ma2(orders):
    angle = F.lit(2) * F.pi() * F.col("o_custkey") / 365
    return orders.select(
        "o_orderkey", (F.round(F.sin(angle), 9) + 0.0).alias("seno"), (F.round(F.cos(angle), 9) + 0.0).alias("coseno")
    )


@source_query(
    "ma3_square_sum_root",
    "lineitem",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber,
              round(sqrt((l_quantity - 10) * (l_quantity - 10) + (l_linenumber - 3) * (l_linenumber - 3)), 9) as distancia
       from lineitem""",
)
def ma3(lineitem):
    squares = F.pow(F.col("l_quantity") - 10, 2) + F.pow(F.col("l_linenumber") - 3, 2)
    return lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(F.sqrt(squares), 9).alias("distancia"))


@source_query(
    "ma4_absolute_and_sign",
    "customer",
    "select c_custkey, abs(c_acctbal) as tamano, case when c_acctbal < 0 then 1 else 0 end as negativo from customer",
)
def ma4(customer):
    return customer.select("c_custkey", F.abs("c_acctbal").alias("tamano"), numeric.flag(F.col("c_acctbal") < 0).alias("negativo"))


@source_query("ma5_truncate_to_integer", "orders", "select o_orderkey, trunc(o_totalprice)::bigint as entero from orders")
def ma5(orders):
    return orders.select("o_orderkey", F.col("o_totalprice").cast("bigint").alias("entero"))


@source_query(
    "mp1_month_days",
    "orders",
    """select o_orderkey, case when month(o_orderdate) = 2 then 29 when month(o_orderdate) in (4, 6, 9, 11) then 30
                               else 31 end as dias from orders""",
)
def mp1(orders):
    return orders.select("o_orderkey", dates.month_days("o_orderdate").alias("dias"))


# --- optional flags and load types ---------------------------------------------------------


@warehouse_query(
    "fe8_age_groups",
    """select RutSiniestrado, EdadSiniestrado, case when EdadSiniestrado <= 14 then 1 else 0 end as PacientePediatrico,
              case when EdadSiniestrado >= 70 then 1 else 0 end as PacienteGeriatrico
       from (select s.RutSiniestrado, trunc(date_diff('day', p.fechanacimiento, s.FechaSiniestro::date) / 365)::integer as EdadSiniestrado
             from siniestro s join persona p on p.idpersona = s.IdSiniestrado) x""",
)
def fe8(wh):
    aged = wh["siniestro"].join(wh["persona"], F.col("IdSiniestrado") == F.col("idpersona")).select(
        "RutSiniestrado", dates.age_years("fechanacimiento", "FechaSiniestro").alias("EdadSiniestrado")
    )
    return aged.withColumns(
        {
            "PacientePediatrico": rules.paediatric_flag("EdadSiniestrado"),
            "PacienteGeriatrico": rules.geriatric_flag("EdadSiniestrado"),
        }
    )


@source_query(
    "dq3_database_types",
    "orders",
    """select o_orderkey, round_even(o_totalprice, 0)::integer as entero, (round_even(o_totalprice / 10 * 10, 0) / 10)::decimal(12,1)::double as decimales,
              o_orderdate as fecha, substring(o_orderpriority, 1, 5) as prioridad
       from orders""",
)
def dq3(orders):
    return plain(
        orders.select(
            "o_orderkey",
            load.coerced(F.col("o_totalprice"), "INT").alias("entero"),
            load.coerced(F.col("o_totalprice") / 10, "DECIMAL(12,1)").alias("decimales"),
            load.coerced(F.col("o_orderdate").cast("string"), "DATETIME").cast("timestamp_ntz").alias("fecha"),
            load.coerced(F.col("o_orderpriority"), "VARCHAR(5)").alias("prioridad"),
        )
    )

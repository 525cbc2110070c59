"""Typing, features, the anomaly model and imputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.base import SINCE, UNTIL, query, warehouse_query
from catalog.scalars import source_query
from claimlens.operators import anomaly, features, impute
from claimlens.operators.rowid import add_row_id, number_of_id, number_rows
from claimlens.plans.config import DETAIL_TYPES
from claimlens.plans.detail import detail_extract
from claimlens.plans.jobs import DETAIL_ORDER, prepare_rows
from claimlens.session import stage
from claimlens.sources.standin import StandIn

# --- row ids ----------------------------------------------------------------------------

_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@source_query(
    "wn3_padded_row_id",
    "lineitem",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
              'id_' || lpad((row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1)::varchar,
                            length((count(*) over () - 1)::varchar)::integer, '0') as uniqueid
       from lineitem""",
)
def wn3(lineitem):
    return add_row_id(lineitem.select(*_LINE_ORDER), _LINE_ORDER)


@source_query(
    "wn4_record_number",
    "orders",
    "select o_orderkey, row_number() over (order by o_orderkey) - 1 as registro from orders",
)
def wn4(orders):
    return number_rows(orders.select("o_orderkey"), ["o_orderkey"])


# --- typing and features ----------------------------------------------------------------

_TYPED = ", ".join(
    {
        "str": f"{c}::varchar as {c.lower()}",
        "int": f"trunc({c})::bigint as {c.lower()}",
        "float": f"{c}::double as {c.lower()}",
        "datetime": f"{c} as {c.lower()}",
    }[spec["dtype"]]
    for c, spec in DETAIL_TYPES.items()
)
_ROWS = f"""tipos as (select {_TYPED} from regulares),
  filas as (select *, 'id_' || lpad((row_number() over (order by {', '.join(DETAIL_ORDER)}) - 1)::varchar,
                                    length((count(*) over () - 1)::varchar)::integer, '0') as uniqueid from tipos)"""

CLASSES = ["apertura a", "apertura b", "apertura c", "apertura d", "apertura e", "apertura f"]
NUMERIC = [
    "cantidad", "valorprestacionclp", "valorprestacionuf", "costounitarioclp", "valorreclamadoclp", "valorpagouf",
    "valorpagoclp",
]
_ANGLE_DAY = """2 * pi() * (day(fechaprestacion) - 1) / (case when month(fechaprestacion) = 2 then 28
                when month(fechaprestacion) in (4, 6, 9, 11) then 29 else 30 end)"""
_ANGLE_MONTH = "2 * pi() * (month(fechaprestacion) - 1) / 11"
_CYCLIC_DAY = f"round(sin({_ANGLE_DAY}), 9) + 0.0 as day_sin, round(cos({_ANGLE_DAY}), 9) + 0.0 as day_cos"
_CYCLIC_MONTH = f"round(sin({_ANGLE_MONTH}), 9) + 0.0 as month_sin, round(cos({_ANGLE_MONTH}), 9) + 0.0 as month_cos"
_CYCLIC = f"{_CYCLIC_DAY}, {_CYCLIC_MONTH}"
DAY, MONTH = ["day_sin", "day_cos"], ["month_sin", "month_cos"]
_FONASA = "case when prevision = 'FONASA' then 1 else 0 end as fonasa"
_HOLDER = "case when ruttitular = rutbeneficiario then 1 else 0 end as titular"


def _one_hot_sql(source: str) -> str:
    return ", ".join(f"case when lower({source}) = '{c}' then 1 else 0 end as \"clasif_{c}\"" for c in CLASSES)


def typed(wh):
    return features.apply_types(features.lower_names(detail_extract(wh, SINCE, UNTIL)), DETAIL_TYPES)


def prepared(wh):
    return prepare_rows(detail_extract(wh, SINCE, UNTIL), DETAIL_TYPES)


def rounded(df, names):
    """Trigonometric results agree to rounding between engines."""
    return df.withColumns({n: F.round(n, 9) + 0.0 for n in names})


@warehouse_query("prj9_types_from_config", f"with {_ROWS} select * from tipos")
def prj9(wh):
    return typed(wh)


@warehouse_query(
    "prj8_information_frame",
    f"with {_ROWS} select uniqueid, {', '.join(features.INFORMATION)} from filas",
)
def prj8(wh):
    return prepared(wh).info()


@warehouse_query("fe1_public_insurer", f"with {_ROWS} select numerosolicitud, prevision, {_FONASA} from tipos")
def fe1(wh):
    return typed(wh).select("numerosolicitud", "prevision", features.public_insurer().alias("fonasa"))


@warehouse_query(
    "fe2_one_hot_classes",
    f"select IdAperturaPrestacion, {_one_hot_sql('ClasificacionApertura')} from apertura_prestacion",
)
def fe2(wh):
    openings = wh["apertura_prestacion"]
    classes = features.classes_of(openings, "ClasificacionApertura")
    return openings.withColumns(features.one_hot("ClasificacionApertura", classes)).drop("ClasificacionApertura", "Vigencia")


@source_query("fe3_cyclic_day", "orders", f"select o_orderkey, {_CYCLIC_DAY.replace('fechaprestacion', 'o_orderdate')} from orders")
def fe3(orders):
    cyclic = features.cyclic_dates("o_orderdate")
    return rounded(orders.select("o_orderkey", *[cyclic[n].alias(n) for n in DAY]), DAY)


@source_query("fe4_cyclic_month", "orders", f"select o_orderkey, {_CYCLIC_MONTH.replace('fechaprestacion', 'o_orderdate')} from orders")
def fe4(orders):
    cyclic = features.cyclic_dates("o_orderdate")
    return rounded(orders.select("o_orderkey", *[cyclic[n].alias(n) for n in MONTH]), MONTH)


@warehouse_query("fe5_holder_flag", f"with {_ROWS} select numerosolicitud, ruttitular, rutbeneficiario, {_HOLDER} from tipos")
def fe5(wh):
    return typed(wh).select("numerosolicitud", "ruttitular", "rutbeneficiario", features.holder_flag().alias("titular"))


_EXTRACTED = ["fonasa", *[f"clasif_{c}" for c in CLASSES], "day_sin", "day_cos", "month_sin", "month_cos", "titular"]
_ORIGINAL = [
    "ruttitular", "rutbeneficiario", "numerosolicitud", "idgrupoprestacion", "clasificaciongrupo", "idsubgrupoprestacion",
    "clasificacionsubgrupo", "idaperturaprestacion", "clasificacionapertura", "cantidad", "valorprestacionclp",
    "valorprestacionuf", "costounitarioclp", "valorreclamadoclp", "valorpagouf", "valorpagoclp", "fechaprestacion",
    "fecharecepcionliquidacion", "prevision", "rutprestador", "nombreprestador",
]


def _role_sql() -> str:
    roles = {"original": _ORIGINAL, "information": features.INFORMATION, "extracted": _EXTRACTED}
    rows = [f"('{role}', {i}, '{c}')" for role, names in roles.items() for i, c in enumerate(names)]
    return f"select * from (values {', '.join(rows)}) v(role, position, \"column\")"


@warehouse_query("fe6_column_roles", _role_sql())
def fe6(wh):
    return prepared(wh).variables()


@warehouse_query(
    "fe7_feature_set",
    f"""with {_ROWS} select uniqueid, {', '.join(NUMERIC)}, {_FONASA}, {_one_hot_sql('clasificacionapertura')}, {_CYCLIC}, {_HOLDER}
        from filas""",
)
def fe7(wh):
    return rounded(prepared(wh).dataset(), DAY + MONTH)


@warehouse_query(
    "jn18_row_aligned_concat",
    f"""with {_ROWS} select uniqueid, {', '.join(features.INFORMATION)}, {', '.join(NUMERIC)}, {_FONASA}, {_HOLDER} from filas""",
)
def jn18(wh):
    data = prepared(wh)
    right = data.dataset().select(features.ROW_ID, *NUMERIC, "fonasa", "titular")
    return data.info().join(right, features.ROW_ID)


# --- anomaly model ----------------------------------------------------------------------

# The model also runs over every line item, with these as its features.
LINE_FEATURES = ["cantidad", "precio", "descuento", "impuesto", "linea", "neto", "fonasa", "titular"]


def line_frame(spark, folder):
    """Line items as rows to score; nearly dependent amounts leave something to reduce."""
    source = StandIn(spark, folder).source
    return source("lineitem").select(
        *_LINE_ORDER,
        F.col("l_quantity").alias("cantidad"),
        F.col("l_extendedprice").alias("precio"),
        F.col("l_discount").alias("descuento"),
        F.col("l_tax").alias("impuesto"),
        F.col("l_linenumber").cast("double").alias("linea"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("neto"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("fonasa"),
        F.lit(1.0).alias("titular"),
    )


_LINES = """lineas as (
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity as cantidad, l_extendedprice as precio,
           l_discount as descuento, l_tax as impuesto, l_linenumber::double as linea,
           l_extendedprice * (1 - l_discount) as neto, case when l_returnflag = 'R' then 1.0::double else 0.0::double end as fonasa,
           1.0::double as titular
    from lineitem)"""


def scaled_lines(spark, folder):
    frame = line_frame(spark, folder)
    scaling = anomaly.fit_scaling(frame, LINE_FEATURES)
    return anomaly.standardize(frame, scaling), scaling


def fitted_lines(spark, folder):
    z, scaling = scaled_lines(spark, folder)
    components = anomaly.fit_components(z, scaling)
    return z, components, anomaly.choose_components(components.ratio)


_MOMENTS_SQL = " union all ".join(
    f"select '{c}' as Campo, round(avg({c}), 7) as media, round(stddev_pop({c}), 7) as desviacion from lineas" for c in LINE_FEATURES
)


@query("ag20_mean_and_deviation", f"with {_LINES} {_MOMENTS_SQL}")
def ag20(spark, folder):
    scaling = anomaly.fit_scaling(line_frame(spark, folder), LINE_FEATURES)
    rows = [(c, round(m, 7), round(s, 7)) for c, m, s in zip(scaling.columns, scaling.mean, scaling.deviation, strict=True)]
    return spark.createDataFrame(rows, "Campo string, media double, desviacion double")


@query(
    "ml1_zscore",
    f"""with {_LINES}, m as (select {', '.join(f'avg({c}) as m_{c}, stddev_pop({c}) as s_{c}' for c in LINE_FEATURES)} from lineas)
        select {', '.join(_LINE_ORDER)}, {', '.join(f'case when s_{c} = 0 then 0.0 else round(({c} - m_{c}) / s_{c}, 6) + 0.0 end::double as {c}' for c in LINE_FEATURES)}
        from lineas, m""",
)
def ml1(spark, folder):
    z, _ = scaled_lines(spark, folder)
    return z.withColumns({c: F.round(c, 6) + 0.0 for c in LINE_FEATURES})


# Two correlated features beside a constant one have components known in closed form: the
# sum and the difference of the two z-scores, which explain (1 + r) / 2 and (1 - r) / 2.
PAIR = ["precio", "neto", "titular"]
_PAIR_SQL = f"""{_LINES},
  m as (select avg(precio) as mp, stddev_pop(precio) as sp, avg(neto) as mn, stddev_pop(neto) as sn,
               corr(precio, neto) as r, count(*) as n from lineas),
  z as (select {', '.join(_LINE_ORDER)}, (precio - mp) / sp as zp, (neto - mn) / sn as zn, r, n, precio, neto, titular from lineas, m)"""


def fitted_pair(spark, folder):
    frame = line_frame(spark, folder).select(*_LINE_ORDER, *PAIR)
    scaling = anomaly.fit_scaling(frame, PAIR)
    z = anomaly.standardize(frame, scaling)
    components = anomaly.fit_components(z, scaling)
    return z, components, anomaly.choose_components(components.ratio)


@query(
    "wn5_cumulative_variance",
    f"with {_PAIR_SQL} select 1 as comps, round((1 + r) / 2, 4) as exp from m union all select 2, 1.0 from m",
)
def wn5(spark, folder):
    z, components, _ = fitted_pair(spark, folder)
    return anomaly.explained_variance(z, components)


@query("wn5_cumulative_variance_of_lines")
def wn5_lines(spark, folder):
    z, components, _ = fitted_lines(spark, folder)
    return anomaly.explained_variance(z, components)


@query(
    "lim2_first_component_over_threshold",
    f"with {_PAIR_SQL} select 1 as comps, round((1 + r) / 2, 4) as exp from m where round((1 + r) / 2, 4) >= 0.95",
)
def lim2(spark, folder):
    z, components, _ = fitted_pair(spark, folder)
    return anomaly.explained_variance(z, components).where("exp >= 0.95").orderBy("comps").limit(1)


@query(
    "ml2_choose_components",
    f"with {_PAIR_SQL} select 1 as comps, round((1 + r) / 2, 4) as expvar, round(1 / 3, 4) as redu from m",
)
def ml2(spark, folder):
    _, _, choice = fitted_pair(spark, folder)
    return spark.createDataFrame([choice], "comps int, expvar double, redu double")


@query("ml2_choose_components_of_lines")
def ml2_lines(spark, folder):
    _, _, choice = fitted_lines(spark, folder)
    return spark.createDataFrame([choice], "comps int, expvar double, redu double")


@query(
    "ml3_whitened_projection",
    f"""with {_PAIR_SQL} select {', '.join(_LINE_ORDER)},
        round(abs(zp + zn) / sqrt(2) / sqrt((1 + r) * n / (n - 1)), 6) as tamano from z""",
)
def ml3(spark, folder):
    z, components, (k, _, _) = fitted_pair(spark, folder)
    # The sign of a component is arbitrary, so its size is compared.
    return anomaly.whitened(z, components, k).select(*_LINE_ORDER, F.round(F.abs("0"), 6).alias("tamano"))


@query("ml3_whitened_projection_of_lines")
def ml3_lines(spark, folder):
    z, components, (k, _, _) = fitted_lines(spark, folder)
    return anomaly.whitened(z, components, k)


@query(
    "ml4_reconstruction",
    f"""with {_PAIR_SQL} select {', '.join(_LINE_ORDER)}, round((zp + zn) / 2, 6) + 0.0 as precio,
        round((zp + zn) / 2, 6) + 0.0 as neto, 0.0::double as titular from z""",
)
def ml4(spark, folder):
    z, components, (k, _, _) = fitted_pair(spark, folder)
    return anomaly.reconstruct(z, components, k).withColumns({c: F.round(c, 6) + 0.0 for c in PAIR})


@query("ml4_reconstruction_of_lines")
def ml4_lines(spark, folder):
    z, components, (k, _, _) = fitted_lines(spark, folder)
    return anomaly.reconstruct(z, components, k)


@query(
    "ml5_anomaly_scores",
    f"with {_PAIR_SQL} select {', '.join(_LINE_ORDER)}, round(abs(zp - zn) / sqrt(2), 6) as anomalyscore from z",
)
def ml5(spark, folder):
    z, components, (k, _, _) = fitted_pair(spark, folder)
    scored = anomaly.anomaly_scores(z, components, k)
    return scored.select(*_LINE_ORDER, F.round("anomalyscore", 6).alias("anomalyscore"))


@query("ml5_anomaly_scores_of_lines")
def ml5_lines(spark, folder):
    z, components, (k, _, _) = fitted_lines(spark, folder)
    return anomaly.anomaly_scores(z, components, k).select(*_LINE_ORDER, "anomalyscore")


@query(
    "ml6_scored_lines",
    f"""with {_PAIR_SQL} select {', '.join(_LINE_ORDER)}, precio, neto, titular,
        round(abs(zp - zn) / sqrt(2), 6) as anomalyscore from z""",
)
def ml6_lines(spark, folder):
    frame = line_frame(spark, folder).select(*_LINE_ORDER, *PAIR)
    result, _ = anomaly.score_rows(frame, PAIR)
    return result.withColumn("anomalyscore", F.round("anomalyscore", 6))


@warehouse_query("ml6_scored_extract")
def ml6(wh):
    data = prepared(wh)
    result, _ = anomaly.score_rows(data.frame, data.features)
    return result


@warehouse_query("ml7_inspection_series")
def ml7(wh):
    data = prepared(wh)
    result, _ = anomaly.score_rows(data.frame, data.features)
    return anomaly.inspection_series(result)


_SHOWN = ["valorprestacionclp", "costounitarioclp"]


@warehouse_query(
    "ml7_inspection_of_two_features",
    f"""with {_ROWS}, m as (
            select avg({_SHOWN[0]}) as ma, stddev_pop({_SHOWN[0]}) as sa, avg({_SHOWN[1]}) as mb, stddev_pop({_SHOWN[1]}) as sb,
                   sign(corr({_SHOWN[0]}, {_SHOWN[1]})) as lado from filas
        ), puntajes as (
            select split_part(uniqueid, '_', 2)::bigint as registro,
                   round(abs(({_SHOWN[0]} - ma) / sa - lado * ({_SHOWN[1]} - mb) / sb) / sqrt(2), 6) as anomalyscore,
                   {', '.join(anomaly.HOVER)} from filas, m
        )
        select *, row_number() over (order by anomalyscore desc, registro) as puesto,
               'registro,anomalyscore,{','.join(anomaly.HOVER)}' as columnas from puntajes""",
)
def ml7_two(wh):
    """The series to inspect: record numbers, the score of two features (one component: a closed form), what is
    shown beside it, the columns' order and the records' rank."""
    result, _ = anomaly.score_rows(prepared(wh).frame, _SHOWN, threshold=0.5)
    series = anomaly.inspection_series(result.withColumn("anomalyscore", F.round("anomalyscore", 6)))
    rank = F.row_number().over(Window.orderBy(F.desc("anomalyscore"), "registro")).cast("bigint")
    return series.withColumns({"puesto": rank, "columnas": F.lit(",".join(series.columns))})


@warehouse_query(
    "ml7_record_numbers",
    f"with {_ROWS} select uniqueid, row_number() over (order by uniqueid) - 1 as registro, valorpagoclp from filas",
)
def ml7_numbers(wh):
    return prepared(wh).frame.select("uniqueid", number_of_id().alias("registro"), "valorpagoclp")


@warehouse_query("smp1_sampled_rows_in_two_frames")
def smp1(wh):
    data = prepared(wh)
    keys = anomaly.sample_ids(data.frame, features.ROW_ID)
    return anomaly.rows_of(data.info(), keys).join(anomaly.rows_of(data.dataset(), keys), features.ROW_ID)


# --- imputation -------------------------------------------------------------------------

_IMPUTE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def gappy_lines(spark, folder):
    """Line items with a seventh of their net amounts missing, and a binary class likewise."""
    missing = F.col("l_linenumber") == 7
    return line_frame(spark, folder).withColumns(
        {
            "neto": F.when(~missing, F.col("neto")),
            "caro": F.when(~missing, (F.col("precio") > 50000).cast("int")),
        }
    )


def _estimate(spark, folder, **how):
    target, predictors = how.pop("target"), how.pop("predictors")
    return impute.estimate_missing(gappy_lines(spark, folder), target, predictors, keys=_IMPUTE_KEYS, **how)


_NET = {"target": "neto", "predictors": ["precio", "descuento", "impuesto"]}
_DEAR = {"target": "caro", "predictors": ["cantidad", "precio", "descuento"], "method": "clasif"}


@query("ml8_estimate_by_regression")
def ml8(spark, folder):
    return _estimate(spark, folder, **_NET).predictions


@query(
    "ml8_estimate_of_linear_target",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round(3 * l_quantity - 2 * l_linenumber + 100 * l_discount + 10, 4) as pred from lineitem where l_linenumber = 7""",
)
def ml8_linear(spark, folder):
    """A target that is linear in its predictors is recovered exactly, whatever rows train the model."""
    exact = 3 * F.col("cantidad") - 2 * F.col("linea") + 100 * F.col("descuento") + 10
    rows = line_frame(spark, folder).withColumn("total", F.when(F.col("l_linenumber") != 7, exact))
    estimate = impute.estimate_missing(rows, "total", ["cantidad", "linea", "descuento"], keys=_IMPUTE_KEYS)
    return estimate.predictions.withColumn("pred", F.round("pred", 4))


@query(
    "ml8_regression_with_stated_split",
    f"""with {_LINES}, known as (select cantidad as x, precio as y, l_orderkey % 10 = 0 as apartada from lineas where l_linenumber <> 7),
             f as (select regr_slope(y, x) as s, regr_intercept(y, x) as i from known where not apartada),
             e as (select round(sqrt(avg((y - s * x - i) * (y - s * x - i))), 2) as rmse from known, f where apartada)
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(s * cantidad + i, 2) as pred, rmse
        from lineas, f, e where l_linenumber = 7""",
)
def ml8_stated(spark, folder):
    """One predictor and a stated hold-out: fit, metric and predictions have a closed form."""
    rows = line_frame(spark, folder).withColumn("precio", F.when(F.col("l_linenumber") != 7, F.col("precio")))
    estimate = impute.estimate_missing(
        rows, "precio", "cantidad", keys=_IMPUTE_KEYS, held_out=F.col("l_orderkey") % 10 == 0
    )
    return estimate.predictions.select(
        *_IMPUTE_KEYS, F.round("pred", 2).alias("pred"), F.lit(round(estimate.metric, 2)).alias("rmse")
    )


@query("ml8_estimate_by_tree")
def ml8_tree(spark, folder):
    return _estimate(spark, folder, model="dtree", **_NET).predictions


_STATED = f"""with {_LINES}, known as (select *, l_orderkey % 10 = 0 as apartada from lineas where l_linenumber <> 7)"""


@query(
    "ml8_tree_of_one_cut",
    f"""{_STATED}, v as (
            select precio as x, count(*) as n, sum(neto) as s, sum(neto * neto) as q from known where not apartada group by precio
        ), r as (
            select x, lead(x) over (order by x) as y, sum(n) over (order by x) as n, sum(s) over (order by x) as s,
                   sum(n) over () as en, sum(s) over () as es, sum(q) over () as eq from v
        ), c as (
            select (x + y) / 2 as corte, s / n as bajo, (es - s) / (en - n) as alto from r where y is not null
            order by round((s - n * es / en) * (s - n * es / en) * en / (n * (en - n)) / (eq - es * es / en), 9) desc, corte limit 1
        ), e as (
            select sqrt(avg((neto - case when precio > corte then alto else bajo end)
                            * (neto - case when precio > corte then alto else bajo end))) as rmse from known, c where apartada
        )
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(case when precio > corte then alto else bajo end, 2) as pred,
               round(rmse, 2) as rmse from lineas, c, e where l_linenumber = 7""",
)
def ml8_one_cut(spark, folder):
    """A tree of depth 1 on a predictor of many values: the best of all cuts, its two means and the error."""
    how = {"model": "dtree", "depth": 1, "held_out": F.col("l_orderkey") % 10 == 0}
    estimate = _estimate(spark, folder, target="neto", predictors="precio", **how)
    return estimate.predictions.select(
        *_IMPUTE_KEYS, F.round("pred", 2).alias("pred"), F.lit(round(estimate.metric, 2)).alias("rmse")
    )


@query(
    "ml8_tree_until_pure",
    f"""with {_LINES} select l_orderkey, l_linenumber, l_partkey, l_suppkey,
               (l_partkey % 200 > 117)::int * 10 + l_partkey % 200 % 2 * 3.0::double as pred, 0.0::double as rmse
        from lineas where l_linenumber = 7""",
)
def ml8_pure(spark, folder):
    """A step and a parity over 200 values: only a tree with a cut between any two of them is right everywhere."""
    value = F.col("l_partkey") % 200
    exact = F.when(value > 117, 10).otherwise(0) + value % 2 * 3
    rows = line_frame(spark, folder).withColumns({"valor": value, "total": F.when(F.col("l_linenumber") != 7, exact)})
    estimate = impute.estimate_missing(rows, "total", "valor", model="dtree", keys=_IMPUTE_KEYS)
    return estimate.predictions.withColumn("rmse", F.lit(estimate.metric))


@query(
    "ml9_rows_to_estimate",
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem where l_linenumber = 7",
)
def ml9(spark, folder):
    return _estimate(spark, folder, **_NET).predictions.select(*_IMPUTE_KEYS)


@query("ml9_hash_split")
def ml9_split(spark, folder):
    held_out = impute.split_column(_IMPUTE_KEYS, 0.1, 16)
    return line_frame(spark, folder).groupBy(held_out.alias("validacion")).agg(F.count(F.lit(1)).alias("filas"))


@query(
    "ml9_split_is_whole_and_near_its_share",
    "select count(*) as filas, 1 as cerca from lineitem",
)
def ml9_share(spark, folder):
    """Every row is on one side, and the side held out has its share to within two hundredths."""
    held_out = impute.split_column(_IMPUTE_KEYS, 0.1, 16)
    share = F.count_if(held_out) / F.count(F.lit(1))
    sides = F.count_if(held_out) + F.count_if(~held_out)
    return line_frame(spark, folder).agg(sides.alias("filas"), (F.abs(share - 0.1) < 0.02).cast("int").alias("cerca"))


@source_query(
    "ml10_rmse",
    "lineitem",
    """select round(sqrt(avg((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000))), 3) as rmse,
              round(sqrt(avg((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000))) / abs(avg(l_extendedprice)), 6) as normalizado
       from lineitem""",
)
def ml10(lineitem):
    predicted = lineitem.select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 2000).alias("prediction"))
    both = (round(impute.rmse(predicted), 3), round(impute.rmse(predicted, normalized=True), 6))
    return lineitem.sparkSession.createDataFrame([both], "rmse double, normalizado double")


@source_query(
    "ml11_roc_auc",
    "lineitem",
    """with r as (select case when l_returnflag = 'R' then 1 else 0 end as y,
                        rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2.0 as puesto from lineitem)
       select round((sum(puesto) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2.0)
              / (count(*) filter (where y = 1) * count(*) filter (where y = 0)::double), 4) as auc from r""",
)
def ml11(lineitem):
    predicted = lineitem.select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"), F.col("l_quantity").alias("rawPrediction")
    )
    return lineitem.sparkSession.createDataFrame([(impute.auc(predicted),)], "auc double")


@source_query(
    "ml11_roc_auc_of_many_scores",
    "lineitem",
    """with r as (select case when l_discount > 0.04 and l_extendedprice < 70000 then 1 else 0 end as y,
                        rank() over (order by l_extendedprice) + (count(*) over (partition by l_extendedprice) - 1) / 2.0 as puesto
                 from lineitem)
       select round((sum(puesto) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2.0)
              / (count(*) filter (where y = 1) * count(*) filter (where y = 0)::double), 4) as auc from r""",
)
def ml11_many(lineitem):
    rare = (F.col("l_discount") > 0.04) & (F.col("l_extendedprice") < 70000)
    predicted = lineitem.select(rare.cast("double").alias("label"), F.col("l_extendedprice").alias("rawPrediction"))
    return lineitem.sparkSession.createDataFrame([(impute.auc(predicted),)], "auc double")


@query("ml12_estimate_class_and_probability")
def ml12(spark, folder):
    return _estimate(spark, folder, **_DEAR).predictions


@query(
    "ml12_separable_class",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity > 25)::int::double as pred,
              (l_quantity > 25)::int::double as proba, 1.0::double as auc from lineitem where l_linenumber = 7""",
)
def ml12_separable(spark, folder):
    """A class that one cut separates: every prediction, its probability and the area are known."""
    rows = line_frame(spark, folder).withColumn(
        "caro", F.when(F.col("l_linenumber") != 7, (F.col("cantidad") > 25).cast("int"))
    )
    estimate = impute.estimate_missing(
        rows, "caro", "cantidad", model="dtree", method="clasif", keys=_IMPUTE_KEYS, held_out=F.col("l_orderkey") % 10 == 0
    )
    return estimate.predictions.withColumn("auc", F.lit(estimate.metric))


_FRAMES = ["z", "reducida", "reconstruida", "puntaje"]


@query(
    "smp1_sampled_rows_in_four_frames",
    " union all ".join(
        f"select '{f}' as marco, least(3, count(*)) as filas, least(3, count(*)) as claves from lineitem" for f in _FRAMES
    ),
)
def smp1_four(spark, folder):
    """The same sampled rows in the scaled, the reduced, the rebuilt and the scored frame."""
    z, components, (k, _, _) = fitted_lines(spark, folder)
    key = F.concat_ws("-", *_LINE_ORDER).alias("clave")
    frames = {
        "z": z,
        "reducida": anomaly.whitened(z, components, k),
        "reconstruida": anomaly.reconstruct(z, components, k),
        "puntaje": anomaly.anomaly_scores(z, components, k),
    }
    keys = stage(anomaly.sample_ids(z.select(key), "clave"), "sample")
    found = [
        anomaly.rows_of(frames[name].select(key), keys, "clave").agg(
            F.lit(name).alias("marco"), F.count(F.lit(1)).alias("filas"), F.countDistinct("clave").alias("claves")
        )
        for name in _FRAMES
    ]
    return reduce(DataFrame.unionByName, found)

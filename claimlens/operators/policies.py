"""Policy time-series: one value per policy and period (1 active, -1 cancelled, 0 nothing).

Input is long: (poliza, periodo, valor). A period without a row counts as 0, so zeros need not
be stored. After ``policy_matrix`` a policy has at most one row per calendar period, which
bounds every per-policy group below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = "__valores"  # no period has this name
# Names of the flags.
FLAGS = ["SIN_DATOS", "SOLO_CANCELADOS", "COMIENZA_CANCELADA", "MESES_NO_REGISTRADOS"]


def policy_matrix(events: DataFrame) -> DataFrame:
    """One value per policy and period: the largest in size, then the positive one."""
    best = F.max(F.struct(F.abs("valor"), F.col("valor").alias("valor")))
    return events.groupBy("poliza", "periodo").agg(best.alias("best")).select("poliza", "periodo", "best.valor")


def axis_of(matrix: DataFrame) -> Column:
    """The period axis: sorted distinct periods, as one array that plans refer to (a scalar subquery)."""
    periods = matrix.select("periodo").distinct()
    return periods.agg(F.sort_array(F.collect_list("periodo")).alias("eje")).scalar()


def periods_of(matrix: DataFrame) -> list[str]:
    """The period axis as a list, for callers who want a column per period."""
    return sorted(row.periodo for row in matrix.select("periodo").distinct().collect())


def running_activity(matrix: DataFrame) -> DataFrame:
    """Running sum of absolute values per policy."""
    so_far = Window.partitionBy("poliza").orderBy("periodo").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return matrix.withColumn("acumulado", F.sum(F.abs("valor")).over(so_far))


def first_active(matrix: DataFrame) -> DataFrame:
    """First period with activity and its value."""
    return matrix.where("valor != 0").groupBy("poliza").agg(
        F.min("periodo").alias("periodo"), F.min_by("valor", "periodo").alias("valor")
    )


def _flag(condition: Column, name: str) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int").alias(name)


def policy_flags(matrix: DataFrame, periods: list[str] | None = None, series: bool = False) -> DataFrame:
    """Flags per policy, and with ``series`` the values by period as a map, from one aggregate.

    A policy without any activity is flagged as such and nothing else. Months without a
    record are the periods from the first activity on that are not active: their number
    follows from the axis (``periods`` or that of the matrix), so zeros are neither stored
    nor counted.
    """
    axis = axis_of(matrix) if periods is None else F.array(*[F.lit(p) for p in periods]).cast("array<string>")
    active = F.col("valor") != 0
    values = F.map_from_entries(F.collect_list(F.when(active, F.struct("periodo", "valor"))))
    totals = matrix.groupBy("poliza").agg(
        F.count_if(active).alias("activos"),
        F.count_if(F.col("valor") == -1).alias("cancelados"),
        F.min(F.when(active, F.col("periodo"))).alias("inicio"),
        F.min_by("valor", F.when(active, F.col("periodo"))).alias("primero"),
        *([values.alias(SERIES)] if series else []),
    )
    some = F.col("activos") > 0
    silent = F.size(axis) - F.array_position(axis, F.col("inicio")) + 1 - F.col("activos")
    flags = totals.select(
        "poliza",
        _flag(~some, "SIN_DATOS"),
        _flag(some & (F.col("cancelados") == F.col("activos")), "SOLO_CANCELADOS"),
        _flag(some & (F.col("primero") == -1), "COMIENZA_CANCELADA"),
        _flag(some & (silent != 0), "MESES_NO_REGISTRADOS"),
        *([SERIES] if series else []),
    )
    return flags.select("poliza", F.greatest(*FLAGS).alias("CASO"), *FLAGS, *([SERIES] if series else []))


def _value(period: Column | str) -> Column:
    return F.coalesce(F.try_element_at(SERIES, F.lit(period) if isinstance(period, str) else period), F.lit(0))


def anomalous_policies(matrix: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """Policies with any flag, with a column per period. The columns are made for these policies only."""
    axis = periods_of(matrix) if periods is None else periods
    flagged = policy_flags(matrix, axis, series=True).where("CASO = 1")
    return flagged.select(F.col("poliza").alias("POLIZA"), "CASO", *FLAGS, *[_value(p).alias(p) for p in axis])


def anomalous_series(matrix: DataFrame) -> DataFrame:
    """The same with a row per policy and period, however long the axis is."""
    flagged = policy_flags(matrix, series=True).where("CASO = 1")
    rows = flagged.select("*", F.explode(axis_of(matrix)).alias("periodo"))
    return rows.select(F.col("poliza").alias("POLIZA"), "CASO", *FLAGS, "periodo", _value(F.col("periodo")).alias("valor"))


def partial_series(matrix: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """Every policy's series from its first activity to the end of the axis, zeros included."""
    if periods is None:  # the axis holds every first activity
        axis = axis_of(matrix)
        tail = F.slice(axis, F.array_position(axis, F.col("inicio")).cast("int"), F.size(axis))
    else:
        tail = F.filter(F.array(*[F.lit(p) for p in periods]), lambda p: p >= F.col("inicio"))
    known = F.map_from_entries(F.collect_list(F.struct("periodo", "valor")))
    return (
        matrix.where("valor != 0")
        .groupBy("poliza")
        .agg(F.min("periodo").alias("inicio"), known.alias(SERIES))
        .select("poliza", SERIES, F.explode(tail).alias("periodo"))
        .select("poliza", "periodo", _value(F.col("periodo")).alias("valor"))
    )

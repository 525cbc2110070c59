"""Column and row profiles: frequencies, modes, missing values, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.numeric import r2
from claimlens.functions.text import named, quoted

REAL = (T.DoubleType, T.FloatType)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_missing(field: T.StructField) -> Column:
    """NULL, or NaN in a real column."""
    c = named(field.name)
    return c.isNull() | F.isnan(c) if isinstance(field.dataType, REAL) else c.isNull()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Values with count and share of the non-missing rows, most frequent first."""
    present = df.where(~is_missing(df.schema[column])).select(named(column).alias("Campo"))
    total = present.agg(F.count(F.lit(1))).scalar()
    return (
        present.groupBy("Campo")
        .agg(F.count(F.lit(1)).alias("Frecuencia"))
        .withColumn("Relativo", r2(F.col("Frecuencia") / total))
        .orderBy(F.desc("Frecuencia"), "Campo")
    )


def mode(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value of a column; the lowest one among equals.

    Counted by value first, so that no task ever holds all distinct values.
    """
    counts = df.where(~is_missing(df.schema[column])).groupBy(named(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("best")).select(
        F.lit(column).alias("Campo"), F.col("best.value").alias("Moda")
    )


def _cell(field: T.StructField) -> Column:
    """A value as text, beside the key it sorts by among values of its own column."""
    c, kind = named(field.name), field.dataType
    whole, real = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    if isinstance(kind, WHOLE):
        whole = c.cast("bigint")
    elif isinstance(kind, REAL):
        c = c + F.lit(0.0)  # one zero, not two
        real = c.cast("double")
    elif isinstance(kind, T.DecimalType):
        real = c.cast("double")
    return F.struct(
        F.lit(field.name).alias("Campo"),
        whole.alias("whole"),
        real.alias("real"),
        F.when(~is_missing(field), c.cast("string")).alias("text"),
    )


def modes(df: DataFrame) -> DataFrame:
    """Mode of every column as text, one row per column, in one pass over the data."""
    cells = df.select(F.inline(F.array(*[_cell(f) for f in df.schema.fields])))
    counts = cells.where("text is not null").groupBy("Campo", "whole", "real", "text").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct(-F.col("n"), F.col("whole"), F.col("real"), F.col("text")))
    return counts.groupBy("Campo").agg(best.alias("best")).select("Campo", F.col("best.text").alias("Moda"))


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and fraction of rows, most affected first."""
    counts = [F.count_if(is_missing(f)).alias(f"c{i}") for i, f in enumerate(df.schema.fields)]
    cells = [
        F.struct(F.lit(f.name).alias("Campo"), F.col(f"c{i}").alias("ValoresPerdidos"))
        for i, f in enumerate(df.schema.fields)
    ]
    return (
        df.agg(F.count(F.lit(1)).alias("total"), *counts)
        .select("total", F.inline(F.array(*cells)))
        .where("ValoresPerdidos > 0")
        .select("Campo", "ValoresPerdidos", (F.col("ValoresPerdidos") / F.col("total")).alias("Porcentaje"))
        .orderBy(F.desc("ValoresPerdidos"), "Campo")
    )


def missing_row_share(df: DataFrame) -> DataFrame:
    """Fraction of rows with at least one missing value."""
    hit = F.lit(False)
    for field in df.schema.fields:
        hit = hit | is_missing(field)
    return df.agg(F.avg(hit.cast("int")).alias("Porcentaje"))


def duplicates(df: DataFrame) -> DataFrame:
    """Duplicate report in one row.

    Rows; rows that occur once; rows that occur more than once; distinct rows; surplus
    copies; and rows in duplicate groups per surplus copy (-1 without duplicates).
    """
    # The data's columns are out of sight when the counts get a name.
    rows = df.select([c.alias(f"c{i}") for i, c in enumerate(quoted(df.columns))])
    n = F.col("n")
    report = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("totales"),
        F.count_if(n == 1).alias("no_duplicados_sin_keep"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("duplicados_sin_keep"),
        F.count(F.lit(1)).alias("no_duplicados_con_keep"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicados_con_keep"),
    )
    share = r2(F.try_divide(F.col("duplicados_sin_keep"), F.col("duplicados_con_keep")))
    return report.withColumn("margen_de_duplicacion", F.coalesce(share, F.lit(-1.0)))


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    """Replace missing values, NaN included, by one value per column."""
    fixed = {
        name: F.when(is_missing(df.schema[name]), F.lit(value).cast(df.schema[name].dataType)).otherwise(named(name))
        for name, value in values.items()
    }
    return df.withColumns(fixed)

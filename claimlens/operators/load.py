"""Prepare a frame for loading into a database table: audit columns and declared types."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.dates import now_to_second
from claimlens.functions.numeric import r0, round_even
from claimlens.functions.text import named, truncate

# Names of the audit columns and of the configuration key.
USER_COLUMN = "UsuarioModificacion"
MODIFIED_COLUMN = "FechaModificacion"
CREATED_COLUMN = "FechaCreacion"
USER_KEY = "USER"
MODES = ["create", "update"]


def _numbers(sqltype: str) -> list[int]:
    return [int(n) for n in re.findall(r"\d+", sqltype)]


def spark_type(sqltype: str) -> str:
    """Declared SQL type as a Spark type; the length of a VARCHAR is part of the value, not the type."""
    name = sqltype.split("(")[0].strip().upper()
    if name == "INT":
        return "int"
    if name == "DECIMAL":
        precision, scale = _numbers(sqltype)
        return f"decimal({precision},{scale})"
    if name == "DATETIME":
        return "timestamp"
    if name == "VARCHAR":
        return "string"
    raise ValueError(f"unknown column type {sqltype!r}")


def coerced(column: Column, sqltype: str, held: T.DataType | None = None) -> Column:
    """A column as its declared type: numbers rounded half to even, text cut to length.

    ``held`` is its present type: decimals and integers are rounded as such, anything else as a double."""
    kind = spark_type(sqltype)
    if isinstance(held, T.DecimalType) and (kind == "int" or kind.startswith("decimal")):
        return F.bround(column, 0 if kind == "int" else _numbers(sqltype)[1]).cast(kind)
    if isinstance(held, T.IntegralType) and (kind == "int" or kind.startswith("decimal")):
        return column.cast(kind)
    if kind == "int":
        return r0(column).cast("int")
    if kind == "string":
        return truncate(column, _numbers(sqltype)[0])
    if kind.startswith("decimal"):
        return round_even(column, _numbers(sqltype)[1]).cast(kind)
    return column.cast(kind)


def stamp_audit(df: DataFrame, user: str, mode: str, now: datetime | None = None) -> DataFrame:
    """Set user and modification time where the columns exist; creation time only on create.

    An update leaves the stored creation time alone, so the column is taken out.
    """
    if mode not in MODES:
        raise ValueError(f"choose a valid mode: {MODES}")
    moment = now_to_second() if now is None else F.lit(now.replace(microsecond=0))
    if USER_COLUMN in df.columns:
        df = df.withColumn(USER_COLUMN, F.lit(user))
    if MODIFIED_COLUMN in df.columns:
        df = df.withColumn(MODIFIED_COLUMN, moment)
    if CREATED_COLUMN in df.columns:
        df = df.withColumn(CREATED_COLUMN, moment) if mode == "create" else df.drop(CREATED_COLUMN)
    return df


def column_types(fields: dict[str, dict[str, str]], columns: list[str]) -> str:
    """``createTableColumnTypes`` text for the declared columns present."""
    return ", ".join(f"{name} {spec['sqltype']}" for name, spec in fields.items() if name in columns)


def prepare_load(
    df: DataFrame, fields: dict[str, dict[str, str]], config: dict[str, str], mode: str, now: datetime | None = None
) -> tuple[DataFrame, str]:
    """Stamped and typed frame with its database column types."""
    df = stamp_audit(df, config[USER_KEY], mode, now)
    typed = {name: coerced(named(name), spec["sqltype"], df.schema[name].dataType) for name, spec in fields.items() if name in df.columns}
    return df.withColumns(typed), column_types(fields, df.columns)

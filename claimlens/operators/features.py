"""Typing and feature preparation of the detail extract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.dates import day_angle, month_angle, settlement_lag
from claimlens.functions.numeric import flag
from claimlens.functions.rules import is_public
from claimlens.functions.text import quoted

# Type names of the column config, the columns set apart as information, and
# the columns shown beside the score.
SPARK_TYPES = {"str": "string", "int": "bigint", "float": "double", "datetime": "timestamp_ntz"}
INFORMATION = [
    "ruttitular", "rutbeneficiario", "numerosolicitud", "idgrupoprestacion", "clasificaciongrupo",
    "idsubgrupoprestacion", "clasificacionsubgrupo", "idaperturaprestacion", "clasificacionapertura",
    "fechaprestacion", "fecharecepcionliquidacion", "prevision", "rutprestador", "nombreprestador",
]
ROW_ID = "uniqueid"


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _typed(df: DataFrame, name: str, kind: str, strict: bool) -> Column:
    c = F.col(name).cast(SPARK_TYPES[kind])
    if strict and kind == "int":
        c = F.when(F.col(name).isNull(), F.raise_error(F.lit(f"missing value in integer column {name}"))).otherwise(c)
    return c.alias(name)


def apply_types(df: DataFrame, config: dict[str, dict], keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """Cast every column as declared; an undeclared one is a KeyError.

    Fractions are cut off by ``int``. Missing values stay NULL in every type; with
    ``strict`` a missing integer fails the job.
    """
    return df.select(
        [F.col(c) if c in keep else _typed(df, c, config[c]["dtype"], strict) for c in df.columns]
    )


def classes_of(df: DataFrame, column: str) -> list[str]:
    """Sorted lower-case classes of a column, for callers who have not declared them."""
    found = df.select(F.lower(column).alias("c")).where("c is not null").distinct().collect()
    return sorted(row.c for row in found)


def one_hot(column: str, classes: list[str], prefix: str = "clasif") -> dict[str, Column]:
    """One 0/1 column per class; a missing value is 0 everywhere."""
    return {f"{prefix}_{c}": flag(F.lower(column) == c) for c in classes}


def cyclic_dates(column: str) -> dict[str, Column]:
    return {
        "day_sin": F.sin(day_angle(column)),
        "day_cos": F.cos(day_angle(column)),
        "month_sin": F.sin(month_angle(column)),
        "month_cos": F.cos(month_angle(column)),
    }


def public_insurer(column: str = "prevision") -> Column:
    return flag(is_public(column))


def holder_flag(holder: str = "ruttitular", person: str = "rutbeneficiario") -> Column:
    return flag(F.col(holder) == F.col(person))


def derived(classes: list[str], lag: bool = False) -> dict[str, Column]:
    """All derived features; the settlement lag is off unless asked for."""
    out = {"fonasa": public_insurer(), **one_hot("clasificacionapertura", classes)}
    if lag:
        out["slaliquidacion"] = settlement_lag("fechaprestacion", "fecharecepcionliquidacion")
    return {**out, **cyclic_dates("fechaprestacion"), "titular": holder_flag()}


@dataclass
class Prepared:
    """Prepared data: one frame with everything, and which columns play which role."""

    frame: DataFrame
    original: list[str]
    information: list[str]
    features: list[str]
    extracted: list[str]

    def dataset(self) -> DataFrame:
        return self.frame.select(*quoted([ROW_ID, *self.features]))

    def info(self) -> DataFrame:
        return self.frame.select(*quoted([ROW_ID, *self.information]))

    def variables(self) -> DataFrame:
        """Role registry: (role, position, column)."""
        roles = {"original": self.original, "information": self.information, "extracted": self.extracted}
        rows = [(role, i, c) for role, names in roles.items() for i, c in enumerate(names)]
        return self.frame.sparkSession.createDataFrame(rows, "role string, position int, column string")


def new_columns(after: list[str], before: list[str]) -> list[str]:
    """Columns present after but not before, in order."""
    known = set(before)
    return [c for c in after if c not in known]


def prepare(
    typed: DataFrame, information: list[str] = INFORMATION, lag: bool = False, classes: list[str] | None = None
) -> Prepared:
    """Features of a typed frame that carries its row id; ``classes`` (all that occur, by default)
    of the opening have a column each.

    Information and features stay in one frame: nothing is ever joined back by row.
    """
    original = [c for c in typed.columns if c != ROW_ID]
    numeric = [c for c in original if c not in information]
    added = derived(classes_of(typed, "clasificacionapertura") if classes is None else classes, lag)
    frame = typed.withColumns(added)
    extracted = new_columns(frame.columns, typed.columns)
    return Prepared(frame, original, list(information), numeric + extracted, extracted)

"""Delimited files, column configs and table definitions."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.functions.text import spec_fields
from claimlens.operators.load import spark_type
from claimlens.session import stage

# Delimiters in order of preference, and the answer when none fits.
DELIMITERS = [",", "\t", ";", " ", ":", "|"]
NO_DELIMITER = "error"


def read_delimited(spark: SparkSession, path: str, schema: str | None = None, sep: str = ";") -> DataFrame:
    """Semicolon-separated files with a header; pass a schema to avoid a second reading."""
    reader = spark.read.options(sep=sep, header=True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def _occurrences(line: Column, mark: str) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of every file below ``path`` with the record that each belongs to, written once:
    (archivo, registro, linea, value, abierta, partes).

    A quote opens and closes a quoted text, so a line begins inside one (``abierta``) if the quotes before it
    in its file are an odd number. That is a prefix sum of parities: over the lines of a split, which is read
    whole by one task anyway, and then over the splits of a file, a row each. A line that begins outside
    starts a record, which ends before the next one; ``partes`` tells whether it has more lines. In a file with
    an odd number of quotes they are no pairs: there each line is a record of its own. ``registro`` counts
    from 0 in each file, ``linea`` orders its lines.
    """
    quotes = (_occurrences(F.col("value"), '"') % 2).cast("int")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("archivo"),
        F.col("_metadata.file_block_start").alias("corte"),
        F.monotonically_increasing_id().alias("linea"),
        "value",
        quotes.alias("impar"),
    )
    lines = stage(lines, "lines")
    per_split = lines.groupBy("archivo", "corte").agg(F.sum("impar").alias("impares"))
    files = Window.partitionBy("archivo").orderBy("corte")
    before = files.rowsBetween(Window.unboundedPreceding, -1)
    per_split = per_split.select(
        "archivo", "corte",
        F.coalesce(F.sum("impares").over(before), F.lit(0)).alias("antes"),
        (F.sum("impares").over(Window.partitionBy("archivo")) % 2 == 0).alias("pares"),
    )
    split = Window.partitionBy("archivo", "corte").orderBy("linea")
    earlier = F.coalesce(F.sum("impar").over(split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = lines.join(per_split, ["archivo", "corte"]).withColumn("abierta", F.col("pares") & ((F.col("antes") + earlier) % 2 == 1))
    inside = Window.partitionBy("archivo", "corte").orderBy("linea").rowsBetween(Window.unboundedPreceding, 0)
    found = stage(found.withColumn("propio", F.count_if(~F.col("abierta")).over(inside)), "line-states")

    starts = found.groupBy("archivo", "corte").agg(F.count_if(~F.col("abierta")).alias("inicios"))
    starts = starts.select("archivo", "corte", F.coalesce(F.sum("inicios").over(before), F.lit(0)).alias("previos"))
    record = F.col("previos") + F.col("propio") - 1
    more = F.col("pares") & (F.col("abierta") | (F.col("impar") == 1))
    return found.join(starts, ["archivo", "corte"]).select(
        "archivo", record.alias("registro"), F.struct("corte", "linea").alias("linea"), "value", "abierta", more.alias("partes")
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(archivo, registro, texto) of every record below ``path``; its lines are joined by line feeds.

    Only lines of records that have several are moved. A file of any size is read by many tasks, which a
    reader of whole files cannot do."""
    lines = numbered_lines(spark, path)
    single = lines.where(~F.col("partes")).select("archivo", "registro", F.col("value").alias("texto"))
    pieces = F.sort_array(F.collect_list(F.struct("linea", "value")))
    joined = lines.where("partes").groupBy("archivo", "registro").agg(F.array_join(pieces["value"], "\n").alias("texto"))
    return single.unionByName(joined)


def read_records(spark: SparkSession, path: str, schema: str, sep: str = ";") -> DataFrame:
    """Delimited files with a header whose quoted values may hold line breaks, delimiters and doubled quotes."""
    rows = records(spark, path).where((F.col("registro") > 0) & (F.trim("texto") != ""))
    options = {"sep": sep, "escape": '"', "multiLine": "true"}
    return rows.select(F.from_csv("texto", schema, options).alias("fila")).select("fila.*")


def detect_delimiters(spark: SparkSession, path: str) -> DataFrame:
    """Delimiter of every file below ``path``: (archivo, delimitador).

    A delimiter occurs equally often, and at least once, in each record outside quotes. All records of
    a file vote that say something there, those of several lines with the sum of their lines; counts meet
    per record as a sum, and per file only as a minimum and a maximum.
    """
    quoted = F.when(F.col("abierta"), F.concat(F.lit('"'), "value")).otherwise(F.col("value"))
    unpaired = F.regexp_replace(quoted, '"[^"]*"', "")
    bare = F.when(F.col("partes"), F.regexp_replace(unpaired, '"[^"]*$', "")).otherwise(unpaired)
    lines = numbered_lines(spark, path).withColumn("line", bare)
    names = [f"n_{i}" for i in range(len(DELIMITERS))]
    marks = [_occurrences(F.col("line"), mark).alias(n) for mark, n in zip(DELIMITERS, names, strict=True)]
    lines = lines.select("archivo", "registro", "partes", (F.trim("line") != "").alias("some"), *marks)
    several = lines.where("partes").groupBy("archivo", "registro").agg(
        F.max("some").alias("some"), *(F.sum(n).cast("int").alias(n) for n in names)
    )
    each = lines.where(~F.col("partes")).drop("partes").unionByName(several)
    votes = each.groupBy("archivo").agg(
        *[F.min(F.when(F.col("some"), F.col(n))).alias(f"low_{i}") for i, n in enumerate(names)],
        *[F.max(F.when(F.col("some"), F.col(n))).alias(f"high_{i}") for i, n in enumerate(names)],
    )
    choice = reduce(
        lambda rule, item: rule.when((F.col(f"low_{item[0]}") > 0) & (F.col(f"low_{item[0]}") == F.col(f"high_{item[0]}")), item[1]),
        enumerate(DELIMITERS),
        F.when(F.lit(False), NO_DELIMITER),
    )
    return votes.select("archivo", choice.otherwise(NO_DELIMITER).alias("delimitador"))


def _lines(spark: SparkSession, path: str) -> list[str]:
    """A definition file, line by line; such files have a line per column or setting."""
    return [row.value for row in spark.read.text(path, wholetext=True).selectExpr("explode(split(value, '\\r?\\n')) as value").where("trim(value) != ''").collect()]


def read_config(spark: SparkSession, path: str) -> dict:
    """A JSON column-type config: column to ``{"dtype": …}``, order kept."""
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def _pairs(spark: SparkSession, path: str) -> dict[str, str]:
    return {parts[0]: parts[1] for parts in (line.strip().split(";") for line in _lines(spark, path))}


def read_table_definition(
    spark: SparkSession, folder: str, settings: str | None = None, read_data: bool = False
) -> dict:
    """A table folder: ``paths.txt``, ``campos.txt`` and optionally ``data.csv``.

    ``configs.txt`` lies beside the table folders unless ``settings`` names it. The declared
    types give the schema of the data, so nothing is inferred.
    """
    fields = {}
    for line in _lines(spark, f"{folder}/campos.txt"):
        name, sqltype, pytype = (part.strip() for part in line.split(";"))
        fields[name] = {"sqltype": sqltype, "pytype": pytype}
    data = None
    if read_data:
        schema = ", ".join(f"{name} {_reading_type(spec['sqltype'])}" for name, spec in fields.items())
        data = read_delimited(spark, f"{folder}/data.csv", schema)
    return {
        "paths": _pairs(spark, f"{folder}/paths.txt"),
        "campos": fields,
        "configs": _pairs(spark, settings or f"{folder}/../configs.txt"),
        "data": data,
    }


def _reading_type(sqltype: str) -> str:
    """Numbers are read as doubles, for they are rounded only when the load is prepared."""
    kind = spark_type(sqltype)
    return "double" if kind == "int" or kind.startswith("decimal") else kind


def spec_lines(lines: DataFrame) -> DataFrame:
    """Definition lines of any number of tables as (campo, sqltype, pytype)."""
    parts = lines.select(spec_fields("value").alias("p"))
    return parts.select(
        F.col("p")[0].alias("campo"), F.col("p")[1].alias("sqltype"), F.col("p")[2].alias("pytype")
    )

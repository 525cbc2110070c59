"""Load a prepared frame into a table: a catalog table, or a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

# Load methods with Spark's save modes.
SAVE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def save_mode(method: str) -> str:
    if method not in SAVE_MODES:
        raise ValueError(f"choose a valid method: {sorted(SAVE_MODES)}")
    return SAVE_MODES[method]


def jdbc_options(url: str, table: list[str], types: str, chunks: int = 0, connections: int = 0) -> dict[str, str]:
    """Writer options; ``table`` is [database, schema, name], ``chunks`` the rows per batch."""
    options = {"url": url, "dbtable": ".".join(f"[{part}]" for part in table)}
    if types:
        options["createTableColumnTypes"] = types
    if chunks:
        options["batchsize"] = str(chunks)
    if connections:
        options["numPartitions"] = str(connections)
    return options


def jdbc_writer(df: DataFrame, method: str, url: str, table: list[str], types: str = "", chunks: int = 0, connections: int = 0) -> DataFrameWriter:
    """Writer that loads every partition over its own connection, at most ``connections`` at once."""
    return df.write.format("jdbc").mode(save_mode(method)).options(**jdbc_options(url, table, types, chunks, connections))


def load_database(df: DataFrame, method: str, url: str, table: list[str], types: str = "", chunks: int = 0, connections: int = 0) -> None:
    jdbc_writer(df, method, url, table, types, chunks, connections).save()


def load_table(df: DataFrame, method: str, table: str, path: str | None = None) -> None:
    """Same methods for a catalog table."""
    writer = df.write.mode(save_mode(method)).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def preview(spark: SparkSession, table: str, rows: int = 5) -> DataFrame:
    """Any five rows of the loaded table."""
    return spark.table(table).limit(rows)

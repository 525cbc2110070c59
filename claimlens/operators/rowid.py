"""Dense row numbers and ids over a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.text import zero_fill
from claimlens.session import stage

# monotonically_increasing_id: partition number above this bit, row position below it.
POSITION_BITS = 33


def number_rows(df: DataFrame, order: list[str], name: str = "registro") -> DataFrame:
    """Number rows 0 … n-1 by ``order``, which must identify a row.

    The rows are range-partitioned and sorted, and each row's slot (partition, position) is
    written with it: a retried task can never renumber rows that others have already read.
    A row's number is its position plus the row count of the partitions before its own.
    """
    slots = df.repartitionByRange(*order).sortWithinPartitions(*order)
    slots = stage(slots.withColumn("_slot", F.monotonically_increasing_id()), "row-order")
    part = F.shiftright("_slot", POSITION_BITS)
    position = F.col("_slot").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))

    # One row per partition: small enough for one task and for a broadcast, whatever the data.
    sizes = slots.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))

    return (
        slots.withColumns({"_part": part, "_position": position})
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_position"))
        .select(*df.columns, name)
    )


def add_row_id(df: DataFrame, order: list[str], name: str = "uniqueid") -> DataFrame:
    """``id_000…`` ids, as wide as the last one; an empty frame stays empty."""
    numbered = number_rows(df, order, "_number")
    width = F.length(numbered.agg(F.max("_number").cast("string")).scalar())
    return numbered.select(*df.columns, F.concat(F.lit("id_"), zero_fill("_number", width)).alias(name))


def number_of_id(name: str = "uniqueid"):
    """The row number inside an id made by ``add_row_id``."""
    return F.substring_index(F.col(name), "_", -1).cast("bigint")

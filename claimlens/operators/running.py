"""Running totals over a total order of values, without a window that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.session import stage


def running_totals(df: DataFrame, group: list[str], order: str, values: list[str], following: str | None = None) -> DataFrame:
    """``df`` with ``<value>_before``: the sum of each value over the rows of the group that come before in
    ``order``, which identifies a row in its group. ``following`` names a column for the next value of
    ``order`` in the group (null in its last row).

    Rows are dealt by ranges of (group, order) and written with the number of their range. Windows reach
    over one range of a group; what the ranges before add is summed over a row per range and group.
    """
    ranged = df.repartitionByRange(*group, order).withColumn("__range", F.spark_partition_id())
    ranged = stage(ranged, "running")
    inside = Window.partitionBy("__range", *group).orderBy(order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(earlier), F.lit(0)) for v in values})
    local = local.withColumn("__next", F.lead(order).over(inside))

    keys = ["__range", *group]
    totals = ranged.groupBy(*keys).agg(*(F.sum(v).alias(v) for v in values), F.min(order).alias("__first"))
    ranges = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    ranges = ranges.orderBy("__range")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *keys,
        *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"__{v}") for v in values),
        F.lead("__first").over(ranges).alias("__after"),
    )
    found = local.join(totals, keys).withColumns({f"{v}_before": F.col(f"{v}_before") + F.col(f"__{v}") for v in values})
    extra = [] if following is None else [F.coalesce("__next", "__after").alias(following)]
    return found.select(*df.columns, *(f"{v}_before" for v in values), *extra)

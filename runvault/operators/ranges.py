"""Work over a global order without a single task: range parts and what they carry.

Rows are dealt to parts by ranges of an order and materialised with their part
number, so a key that holds a third of all rows is spread over many parts.
Only one row a part is gathered, and it goes to the following parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runvault.sinks.publish import cut_lineage

PART = "_part"


def range_parts(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` with ``_part``: all rows of a part come before those of the next one in ``order``.

    Rows equal in ``order`` share a part.  The result is written to the checkpoint
    folder, so the parts stay as they are when a task is run again.
    """
    return cut_lineage(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def prefix_sum(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` (a long) over all rows before this one in ``order``.

    Sums of parts are carried to later parts, and a window adds up inside each
    part.  ``order`` should tell all rows apart.
    """
    parts = range_parts(df.withColumn("_value", value.cast("long")), order)
    sums = parts.groupBy(PART).agg(F.sum("_value").alias("_sum"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    base = sums.select(PART, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (parts.join(F.broadcast(base), PART)
            .withColumn(name, F.col("_base") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
            .drop(PART, "_value", "_base"))

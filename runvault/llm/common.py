"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from runvault.session import ensure_checkpoint_dir

_IN_PARTITION = (1 << 33) - 1


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name (the first if repeated).

    Columns are addressed by position, so extra columns of any name, also ones
    that differ in case only, cannot clash.
    """
    cols = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(cols))])
    return flat.select(*[F.col(f"c{cols.index(n)}").alias(n) for n in names])


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def hinted(df: DataFrame, rows: int, limit: int = 10_000) -> DataFrame:
    """Broadcast hint only when the counted rows are few; else Spark joins by shuffle."""
    return F.broadcast(df) if rows <= limit else df


def with_row_number(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Number all rows 0, 1, 2, ... in ``order``; returns the frame and the row count.

    Range partitions are sorted and materialised, each counted, and a row's
    number is its place plus the rows of earlier partitions.  Only one count
    per partition is gathered.  ``order`` should name every column, so that
    ties are equal rows.
    """
    placed = cut(df.repartitionByRange(*[F.asc_nulls_first(c) for c in order])
                 .sortWithinPartitions(*[F.asc_nulls_first(c) for c in order])
                 .withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(_IN_PARTITION)
    sizes = cut(placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    # one row per partition of the frame: bounded by the partition count
    out = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return out.withColumn(name, F.col("_start") + place).drop("_part", "_start", "_at"), total

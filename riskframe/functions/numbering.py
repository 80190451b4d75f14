"""Gapless numbers along a total order, without one task that sorts everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.sources.tables import stored


def numbered(df: DataFrame, order: Sequence[Column], name: str, rows: int,
             rows_each: int = 500_000) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... along ``order``, which must tell all rows apart.

    ``rows`` is the table's counted size. Rows are dealt by ranges of the order and
    written; a row's number is the count of the ranges before plus its place in its own.
    """
    ranges = max(1, -(-rows // rows_each))
    dealt = stored(df.repartitionByRange(ranges, *order)
                   .withColumn("_range", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("_range").agg(F.count("*").alias("_n"))       # one row for each range
              .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (dealt.withColumn("_place", place).join(starts, "_range")
            .withColumn(name, (F.col("_start") + F.col("_place") - 1).cast("long"))
            .drop("_range", "_place", "_start"))

"""Small helpers the operators of this folder share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskframe.sources.tables import scratch_path, stored

#: White space of every word rule here: space and the characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else, unlike lower()."""
    return F.translate(c, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+")
    return F.filter(parts, lambda w: w != "")


def parts_for(df: DataFrame, rows: int, rows_each: int = 50_000) -> int:
    """Partitions for a table of ``rows`` rows: one per ``rows_each``, and no
    fewer than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // rows_each))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str,
             rows_each: int = 100_000) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... without gaps within each ``group``, by ``order``.

    No group is sorted in one task: rows are dealt by ranges of (group, order),
    equal ones further apart by a draw, and written; a row's number is the count
    of its group's rows in the ranges before, plus its place inside its range.
    ``df`` is read twice, so give a stored table. Nulls come first.
    """
    ranges = parts_for(df, df.count(), rows_each)
    dealt = stored(df.withColumn("_draw", F.rand(7))
                   .repartitionByRange(ranges, *group, *order, "_draw").drop("_draw")
                   .withColumn("_range", F.spark_partition_id()), name)
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
              .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(*group, "_range").orderBy(*order)
    same = F.lit(True)
    for c in [*group, "_range"]:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1)
    return (ranked.alias("a").join(starts.alias("b"), same)
            .select("a.*", (F.col("_start") + F.col("_rank")).alias(name))
            .drop("_range", "_rank"))


def packed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like stored(), but packed more tightly; and where, so that forget() can drop it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def quiet_threads() -> None:
    """One thread for each Python worker: Spark already runs one task per core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("OMP_NUM_THREADS", "1")

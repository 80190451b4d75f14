"""Encoding of categories with any number of values.

The values of a column and their numbers are a table, not a list on the driver: numbered by
falling frequency, ties by value. Rows get their number by joins: the most frequent
values are few and broadcast, which leaves no hot key for the shuffled join of the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.numbering import numbered
from riskframe.sources.tables import stored

#: Values that are broadcast: the first ones, if they are no longer than so many bytes.
HEAVY, HEAVY_BYTES = 1_000, 1_024


@dataclass(frozen=True)
class Dictionary:
    """``entries`` is (value, index, n) of a column's ``size`` values."""

    column: str
    entries: DataFrame
    size: int

    def transform(self, df: DataFrame, output: str | None = None) -> DataFrame:
        """Adds ``{column}_idx``: the row's number, ``size`` for null and unseen values.

        Rows of frequent values stay where they are; the others are shuffled by value, each
        of which holds less than one in ``HEAVY`` rows of the table it was learned on.
        """
        c, output = F.col(f"`{self.column}`"), output or f"{self.column}_idx"
        entry = self.entries.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        frequent = (F.col("_index") < HEAVY) & (F.octet_length(F.col("_value").cast("string")) <= HEAVY_BYTES)
        wanted = [F.col(f"`{x}`") for x in df.columns if x != output]
        number = F.coalesce(F.col("_index"), F.lit(self.size).cast("long")).alias(output)
        met = df.join(F.broadcast(entry.where(frequent)), c == F.col("_value"), "left")  # at most HEAVY rows
        settled = F.col("_index").isNotNull() | c.isNull()
        rest = met.where(~settled).drop("_value", "_index")
        found = rest.join(entry.where(~frequent), c == F.col("_value"), "left")
        return met.where(settled).select(*wanted, number).unionByName(found.select(*wanted, number))

    def one_hot(self, df: DataFrame, output: str | None = None) -> DataFrame:
        """Adds ``{column}_ohe``, a sparse vector as struct<size, indices, values>: one slot
        for each value and one for null and unseen ones."""
        slot, output = "_slot", output or f"{self.column}_ohe"
        sparse = F.struct(F.lit(self.size + 1).cast("long").alias("size"), F.array(F.col(slot)).alias("indices"),
                          F.array(F.lit(1.0)).alias("values"))
        return self.transform(df, slot).withColumn(output, sparse).drop(slot)

    def save(self, path: str) -> str:
        self.entries.withColumn("column", F.lit(self.column)).write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str, column: str) -> Dictionary:
        """A saved dictionary for a column, which may have another name now."""
        entries = spark.read.parquet(path).drop("column")
        return Dictionary(column, entries, entries.count())


def fit_dictionary(df: DataFrame, column: str) -> Dictionary:
    """Number the values of ``column``; nulls are no value. An empty column has none.

    One pre-aggregated pass counts the values, however many; they are numbered by ranges.
    """
    counts = stored(df.select(F.col(f"`{column}`").alias("value")).where("value is not null")
                    .groupBy("value").agg(F.count("*").alias("n")), "values")
    size = counts.count()
    entries = numbered(counts, [F.desc("n"), F.asc("value")], "index", size)
    return Dictionary(column, stored(entries.select("value", "index", "n"), "dictionary"), size)

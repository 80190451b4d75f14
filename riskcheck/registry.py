"""Registry of queries, and the frames they share in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, if given, the SQL that must return the same rows."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- frames ---------------------------------------------------------------------------------

def events_raw(spark, sf_dir) -> DataFrame:
    """Events with the error flag as label; k is zero where it was not measured."""
    return table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_type") == "error").cast("int").alias("y"), "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"), "event_type")


EVENTS_RAW = """raw AS (SELECT event_id, CAST(event_type = 'error' AS INTEGER) AS y, value,
  CAST(props->>'$.k' AS INTEGER) AS k, event_type FROM events)"""


def risk_events(spark, sf_dir) -> DataFrame:
    """The same with missing k as null."""
    return events_raw(spark, sf_dir).withColumn("k", F.nullif(F.col("k"), F.lit(0)))


RISK_EVENTS = EVENTS_RAW + """,
risk AS (SELECT event_id, y, value, nullif(k, 0) AS k, event_type FROM raw)"""


def messy_events(spark, sf_dir) -> DataFrame:
    """Risk events with a padded upper-case category, missing where k is at most 10."""
    padded = F.concat(F.lit(" "), F.upper("event_type"), F.lit(" "))
    return risk_events(spark, sf_dir).withColumn(
        "cat", F.when(F.col("k").isNull() | (F.col("k") > 10), padded))


MESSY_EVENTS = RISK_EVENTS + """,
messy AS (SELECT *, CASE WHEN k IS NULL OR k > 10 THEN ' ' || upper(event_type) || ' ' END AS cat
  FROM risk)"""


def risk_lineitem(spark, sf_dir) -> DataFrame:
    """Line items with the return flag as label; zero discount and tax are missing."""
    zeroed = table(spark, sf_dir, "lineitem")
    return zeroed.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_quantity", "l_extendedprice",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"), "l_linestatus")


RISK_LINEITEM = """risk AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity,
  l_extendedprice, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, l_linestatus
  FROM lineitem)"""


def labelled_docs(spark, sf_dir) -> DataFrame:
    """All documents; the label is null where none was given."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(
        labels, "doc_id", "left")


LABELLED_DOCS = """docs AS (SELECT d.doc_id, d.n_chars, l.quality
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def vectors(spark, sf_dir, dims: int = 4) -> DataFrame:
    """Embedding rows with their first coordinates as columns; label 0 is the rare class."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.col("label") == 0).cast("int").alias("y"),
        *(F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(dims)))


def sql_vectors(dims: int) -> str:
    xs = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(dims))
    return f"vecs AS (SELECT vec_id, CAST(label = 0 AS INTEGER) AS y, {xs} FROM embeddings)"


def judged_events(spark, sf_dir) -> DataFrame:
    """Risk events with a rule's prediction and a score."""
    return risk_events(spark, sf_dir).select(
        "event_id", "y", (F.col("value") > 60).cast("double").alias("prediction"),
        F.col("value").alias("score"))


JUDGED_EVENTS = RISK_EVENTS + """,
judged AS (SELECT event_id, y, CAST(value > 60 AS DOUBLE) AS prediction, value AS score FROM risk)"""


# ---- SQL for the keyed draws ----------------------------------------------------------------

def _digest(seed, parts) -> str:
    text = " || '|' || ".join([f"'{seed}'", *(f"CAST({p} AS VARCHAR)" for p in parts)])
    return f"md5({text})"


def sql_uniform(seed, *parts, start: int = 1) -> str:
    return (f"(CAST(('0x' || substr({_digest(seed, parts)}, {start}, 13)) AS UBIGINT)"
            " / 4503599627370496.0)")


def sql_normal(seed, *parts) -> str:
    return (f"(sqrt(-2.0 * ln(1.0 - {sql_uniform(seed, *parts)}))"
            f" * cos(2.0 * pi() * {sql_uniform(seed, *parts, start=14)}))")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, for comparison across engines."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes))

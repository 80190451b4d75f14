"""Reading and writing tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Mapping
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               null_values: Iterable[str] = (), fmt: str = "csv") -> DataFrame:
    """A table from a CSV with a header (default), Parquet or ORC.

    Without ``schema`` CSV types are inferred, which reads the files twice;
    give a schema for large input. ``null_values`` are texts that mean
    "missing" in the file, such as ``?``; a column is only read as numeric
    once they are gone, so with several of them give a schema.
    """
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    markers = list(null_values)
    reader = spark.read.option("header", True)
    if len(markers) == 1:
        reader = reader.option("nullValue", markers[0])
    if schema is None:
        df = reader.csv(path, inferSchema=True)
        return _blank(df, markers) if len(markers) > 1 else df
    if len(markers) <= 1:
        return reader.csv(path, schema=schema)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    df = _blank(reader.csv(path, schema=texts), markers)
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))


def _blank(df: DataFrame, markers: list[str]) -> DataFrame:
    def cleaned(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(~F.trim(c).isin(markers), c)
        return c.alias(f.name)
    return df.select(*(cleaned(f) for f in df.schema.fields))


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip blanks around the column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write ``df`` to ``path``, replacing what is there.

    Refuses to overwrite a folder the same plan reads from: Spark would delete
    the input before reading it. ``replace_table`` can do that.
    """
    target = _plain(path)
    for source in df.inputFiles():
        source = _plain(source)
        if source == target or source.startswith(target + "/"):
            raise ValueError(f"{path} is read by the table being written; choose another path")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def _plain(path: str) -> str:
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return parsed.path.rstrip("/")
    return path.rstrip("/")


def frame_from_records(spark: SparkSession, records: Iterable[Mapping],
                       schema: T.StructType | str) -> DataFrame:
    """A small DataFrame from dict records, missing fields as null."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = [tuple(r.get(f.name) for f in wanted) for r in records]
    return spark.createDataFrame(rows, schema=wanted)


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """A table in the given shape: columns by name, cast, absent ones null."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
                       .alias(f.name) for f in wanted))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share.

    That folder is ``spark.checkpoint.dir``. Only a local session without the
    setting gets a temporary folder instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="riskframe-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: later passes then start
    from the file, also when an executor that computed it is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Replacing a table, also the one that is being read, without losing either version.

The new rows are written whole beside the table, in ``<path>.new``. Then a manifest
``<path>.swap`` says that they are complete, the old folder moves to ``<path>.old``, the
new one takes its place, and the old folder and the manifest go. A job that ends between
two steps leaves the manifest or not: without it the old table stands, with it
:func:`recover_table` goes on from the step that was reached. The last renames are single
operations of the file system; on object stores, where a rename copies, a reader may see
the table missing in between, and recovery still holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Folders:
    """The few file operations needed, by Hadoop's file system of the path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be moved to {target}")


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write ``df`` to ``path``, which ``df`` itself may read, replacing what is there.

    Afterwards read the table anew: frames that read the old files have lost them. One job
    may replace a path at a time. A table left by an ended job is recovered first.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if recover_table(spark, path):
        raise RuntimeError(f"{path} was left half replaced and is whole again; read it anew")
    folders = Folders(spark, path)
    folders.delete(f"{path}.new")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(f"{path}.new")
    folders.touch(f"{path}.swap")
    _swap(folders, path)
    return path


def recover_table(spark: SparkSession, path: str) -> bool:
    """Finish a replacement that was interrupted; whether there was one.

    Rows written without a manifest are incomplete: they go and the old table stays.
    """
    path = path.rstrip("/")
    folders = Folders(spark, path)
    if not folders.exists(f"{path}.swap"):
        folders.delete(f"{path}.new")
        return False
    _swap(folders, path)
    return True


def _swap(folders: Folders, path: str) -> None:
    """The steps after the manifest, each only if it is still to be done."""
    if folders.exists(f"{path}.new"):
        if folders.exists(path) and not folders.exists(f"{path}.old"):
            folders.move(path, f"{path}.old")
        folders.move(f"{path}.new", path)
    folders.delete(f"{path}.old")
    folders.delete(f"{path}.swap")

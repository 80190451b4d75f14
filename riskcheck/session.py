"""The local session of tests, bench and comparison. Jobs get theirs from the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cpus: str = "8") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName(name)
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark

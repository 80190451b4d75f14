"""Weighted rendezvous sharding.

Every shard bids for every record with a hash of (record key, shard name); the
highest bid, stretched by the shard's weight, takes the record. A record's shard
depends on its key and the shard list alone, so the result is the same under any
partitioning, and a new shard takes records only into itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import numbered
from riskframe.sources.tables import stored


def rendezvous(key: Column, shards: Mapping[int, float]) -> Column:
    """The shard of ``key`` among ``shards`` (number to weight).

    A null key counts as the empty text. Equal bids go to the smaller number.
    """
    if not shards or min(shards.values()) <= 0:
        raise ValueError("give at least one shard, with weights above 0")
    text = F.coalesce(key.cast("string"), F.lit(""))
    bids = []
    for shard, weight in sorted(shards.items()):
        drawn = F.conv(F.substring(F.md5(F.concat(text, F.lit(f"/{shard}"))), 1, 13), 16, 10)
        u = (drawn.cast("bigint") + F.lit(0.5)) / F.lit(float(2 ** 52))
        bids.append(F.struct((F.lit(float(weight)) / -F.log(u)).alias("bid"),
                             F.lit(-shard).alias("shard")))
    best = bids[0] if len(bids) == 1 else F.greatest(*bids)
    return -best["shard"]


def shard_records(df: DataFrame, key: str, shards: Mapping[int, float],
                  text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot) for every row of ``df``.

    ``size`` is the text's UTF-8 bytes plus 1, ``slot`` a number without gaps
    within the shard. Null texts count as empty; rows with the same key go to the
    same shard, each with its own slot; an empty table gives an empty result.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    placed = df.select(F.col(f"`{key}`").alias(key),
                       (F.octet_length(body).cast("long") + 1).alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"),
                       rendezvous(F.col(f"`{key}`"), shards).alias("shard"))
    return numbered(stored(placed, "shards"), ["shard"], [key, "size", "text_crc32"], "slot")


def write_shards(df: DataFrame, path: str, key: str, shards: Mapping[int, float],
                 files_each: int = 1) -> None:
    """Write whole records as ``path/shard=N/``, each shard as ``files_each`` files
    dealt by key, so that one shard is never one task's work."""
    placed = df.withColumn("shard", rendezvous(F.col(f"`{key}`"), shards))
    part = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(files_each))
    (placed.repartition(len(shards) * files_each, "shard", part)
     .write.mode("errorifexists").partitionBy("shard").parquet(path))

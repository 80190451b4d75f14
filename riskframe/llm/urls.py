"""URL verdicts: host and path rules, then a list of known URLs behind a Bloom filter.

The list is kept as a split-block Bloom filter: 64-bit hashes choose a block of
eight 32-bit words and one bit in each. The number of blocks is a parameter, so
the filter has a fixed size however long the list grows and may be broadcast; a
longer list only lets more URLs through to the exact join, which decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import ascii_lower

#: Blocks of the filter, 96 bytes each as Spark rows: 3 MB, good for about 800,000 listed URLs.
BLOCKS = 32_768
#: Odd numbers that give each word of a block its own bit; any fixed odd values do.
SALTS = tuple(2 * (0x9E3779B1 * (i + 1) % 2 ** 29) + 1 for i in range(8))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling per page: no scheme, port 80/443, leading ``www.`` or ``m.``,
    trailing ``.html`` or slash, query or fragment. Null for an empty host."""
    h = F.regexp_replace(F.regexp_replace(host, "(:80|:443)$", ""), "^(www|m)\\.", "")
    p = F.regexp_replace(F.regexp_replace(path, "\\.html$", ""), "/+$", "")
    return F.when(host != "", F.concat(h, p))


def block_and_bits(url: Column, blocks: int) -> list[Column]:
    h = F.xxhash64(url)
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    bits = [F.call_function("shiftleft", F.lit(1), F.pmod(F.shiftright(low * F.lit(s), 27), F.lit(32)).cast("int"))
            for s in SALTS]
    return [F.pmod(F.shiftrightunsigned(h, 32), F.lit(blocks)).cast("int").alias("_block"),
            *(b.cast("int").alias(f"_bit{i}") for i, b in enumerate(bits))]


def bloom_blocks(listed: DataFrame, url: str = "canonical", blocks: int = BLOCKS) -> DataFrame:
    """The filter's blocks that hold anything: at most ``blocks`` rows."""
    bits = listed.select(*block_and_bits(F.col(url), blocks))
    return bits.groupBy("_block").agg(*(F.bit_or(f"_bit{i}").alias(f"_word{i}") for i in range(8)))


def maybe_in(rows: DataFrame, key: str, blocks: DataFrame, count: int = BLOCKS) -> DataFrame:
    """``rows`` with ``maybe_listed``: whether the filter ``blocks``, of ``count`` blocks at
    most, holds ``key``."""
    probed = rows.select("*", *block_and_bits(F.col(key), count)).join(F.broadcast(blocks), "_block", "left")
    inside = F.lit(True)
    for i in range(8):
        inside = inside & (F.col(f"_word{i}").bitwiseAND(F.col(f"_bit{i}")) != 0)
    return probed.select(*rows.columns, (F.coalesce(inside, F.lit(False)) & F.col(key).isNotNull()).alias("maybe_listed"))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]],
               key: str = "page_id", url: str = "url", blocks: int = BLOCKS) -> DataFrame:
    """(key, host, path, rule, verdict, canonical, maybe_listed, listed) of every page.

    ``rules`` are (``host/path``, ``allow`` or ``block``), a few, written into the
    plan; a rule fits its host and all subdomains if the path starts with its path,
    and the longest fitting rule wins. Where none fits, a URL whose canonical
    form is in ``listed`` (column ``canonical``, nulls ignored) is blocked.

    Null URLs and URLs without ``://`` have an empty host and path, fit no rule
    and are allowed. Repeated rows are judged one by one; other columns of
    ``pages`` are not read. Only URLs that pass the filter are joined with the list,
    on the canonical text itself, so false positives are removed.
    """
    own = pages.select(F.col(f"`{key}`").alias(key), F.col(f"`{url}`").alias("_url"))
    own = own.select(key, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    own = own.withColumn("canonical", canonical(F.col("host"), F.col("path")))
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, _, path = name.partition("/")
        fits = (((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host)))
                & F.startswith(F.col("path"), F.lit("/" + path)))
        rule, said = F.when(fits, name).otherwise(rule), F.when(fits, verdict).otherwise(said)
    own = own.withColumn("rule", rule).withColumn("_said", said)
    known = listed.select(F.col("canonical").alias("_known")).where("_known is not null").distinct()
    probed = maybe_in(own, "canonical", bloom_blocks(known, "_known", blocks), blocks)
    hits = probed.where("maybe_listed").select("canonical").distinct().join(
        known, F.col("canonical") == F.col("_known"), "left_semi").withColumnRenamed("canonical", "_hit")
    # the others get keys of their own, so that they are dealt evenly
    passed = F.when(F.col("maybe_listed"), F.col("canonical")).otherwise(
        F.concat(F.lit("\0"), F.xxhash64(key, "host", "path").cast("string")))
    judged = probed.withColumn("_passed", passed).join(hits, F.col("_passed") == F.col("_hit"), "left")
    found = F.col("_hit").isNotNull()
    verdict = F.coalesce(F.col("_said"), F.when(found, "block").otherwise("allow"))
    return judged.select(key, "host", "path", "rule", verdict.alias("verdict"), "canonical",
                         "maybe_listed", found.alias("listed"))

"""Importance resampling towards a target text collection, by hashed n-grams.

Separators of a lower-cased text are collapsed to single spaces; one overlapped regex
scan then finds, at the start of every word, the runs of one to three words that begin
there, and their spans go straight into a CRC. Two counts over buckets, of the corpus and
of the target, give every bucket a gain; a document's weight is the sum of its features'
gains. Adding a keyed Gumbel draw to the weight and keeping the highest sums draws
without replacement in proportion to the exponential of the weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import numbered, packed
from riskframe.sources.tables import stored

#: A-Z as a-z, the other ASCII characters that are neither letters nor digits as blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
             for b in range(256))
#: At a word's start: the word, with the next one, with the next two. Overlapped, so that the
#: search goes on one character after each start, not after each end.
RUNS = regex.compile(rb"(?<![^ ])([^ ]+)(?: ([^ ]+)(?: ([^ ]+))?)?(?![^ ])")
ROWS = 1_000


def collapsed(text: str | None) -> bytes:
    """Lower-cased UTF-8 words with one space between them."""
    return b" ".join((text or "").encode().translate(FOLD).split())


def features(line: bytes, buckets: int) -> tuple[int, list[int]]:
    """How many words a collapsed text has, and the bucket of each of its features."""
    crc, found, n = zlib.crc32, [], 0
    for run in RUNS.finditer(line, overlapped=True):
        n += 1
        start, second, third = run.end(1), run.end(2), run.end(3)
        one = crc(line[run.start():start])
        found.append(one % buckets)
        if second >= 0:
            two = crc(line[start:second], one)  # the CRC goes on over the longer span
            found.append(two % buckets)
            if third >= 0:
                found.append(crc(line[second:third], two) % buckets)
    return n, found


def hashed(df: DataFrame, key: str, text: str, buckets: int) -> DataFrame:
    """(_key, _words, _features): each row's words counted, its buckets as 16-bit numbers."""
    if not 0 < buckets <= 65_536:
        raise ValueError("buckets must be between 1 and 65536")
    own = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                words, found = [], []
                for t in batch.column(1).to_pylist():
                    n, places = features(collapsed(t), buckets)
                    words.append(n)
                    found.append(np.array(places, "<u2").tobytes())
                yield pa.record_batch([batch.column(0), pa.array(words, pa.int64()), pa.array(found, pa.binary())],
                                      names=["_key", "_words", "_features"])

    kind = df.schema[key].dataType.simpleString()
    return own.mapInArrow(scan, f"_key {kind}, _words bigint, _features binary")


def bucket_counts(hashes: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all rows fall into each bucket. Tasks send their sums."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(found, "<u2"), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    sums = hashes.select("_features").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most one row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed target share / smoothed corpus share)) of each bucket."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def resample(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = 5, least_words: int = 20, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """(key, n_features, weight, score, rank) for every row of ``df``; rank is null where
    a row was not drawn.

    Drawn are ``percent`` of the rows with at least ``least_words`` words, rounded down:
    those of the highest scores, ties to the smaller key. The draw belongs to (seed,
    key), a null key counting as the empty text and going first among ties; repeated
    rows are rows of their own, with equal scores. A null or wordless text has no
    features and weight 0, in the target too. An empty table gives none; an empty target
    has only the smoothing. Extra columns are not read.
    """
    spark = df.sparkSession
    hashes, _ = packed(hashed(df, key, text, buckets), "resample-features")
    wanted = hashed(target.withColumn("_nothing", F.lit(0)), "_nothing", target_text, buckets)
    gain = spark.sparkContext.broadcast(gains(bucket_counts(hashes, buckets), bucket_counts(wanted, buckets)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [np.frombuffer(f, "<u2") for f in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([len(p) for p in places], pa.int64()),
                                   pa.array([int(gain.value[p].sum()) for p in places], pa.int64())],
                                  names=["_key", "_words", "n_features", "weight"])

    kind = df.schema[key].dataType.simpleString()
    weighed = hashes.mapInArrow(weigh, f"_key {kind}, _words bigint, n_features bigint, weight bigint")
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_key").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((drawn.cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = stored(weighed.withColumn("score", F.col("weight") + noise), "resample-scores")
    able = scored.where(F.col("_words") >= least_words)
    most = percent * able.count() // 100
    ordered = numbered(able.withColumn("_down", -F.col("score")), [], ["_down", "_key", "n_features"], "_nth")
    ranked = ordered.withColumn("rank", F.when(F.col("_nth") < most, F.col("_nth") + 1).cast("long"))
    rest = scored.where(F.col("_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("_key").alias(key), "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))


def draw(df: DataFrame, target: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``df`` that ``resample`` draws, with all their columns.

    Keys must be unique here: rows that share a drawn key all stay. Rows without a key go.
    """
    drawn = resample(df, target, key, **settings).where(F.col("rank").isNotNull()).select(F.col(key).alias("_drawn"))
    return df.join(drawn.distinct(), F.col(f"`{key}`") == F.col("_drawn"), "left_semi")

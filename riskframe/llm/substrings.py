"""Repeated byte strings of at least a given length, removed from all but their first place.

Texts that are equal are one text from the start. Every window of ``length`` bytes
belongs to the smallest hashed gram inside it, so equal windows anywhere belong to
the same gram; neighbouring windows of one gram form a context. Grams that occur once
are dropped by counting, equal contexts are counted once, and the different contexts
of the same grams meet in blocks of bounded size. Grams with more contexts than a block
holds are split into their windows, which meet by their hashes in an aggregation.

In a block, breadth-first backward extension on the Burrows-Wheeler transform visits
the intervals of ever longer strings and so finds the common prefixes of neighbouring
suffixes by increasing value. It stops at ``length``: borders that were not reached by
then separate suffixes that share at least ``length`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import forget, packed
from riskframe.llm.shingles import mixed, slices, text_bytes
from riskframe.llm.urls import bloom_blocks, maybe_in
from riskframe.sources.tables import stored

GRAM = 20
#: Bytes of contexts in one transform.
BLOCK = 1_000_000
_BASE = 0x9E3779B97F4A7C15
_END = 0xFF  # never a byte of UTF-8
_NULL_FIRST = -(1 << 63)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM = 16 + 4 bytes from every place on."""
    p, powers, width, saved = data.astype(np.uint64) + np.uint64(1), _BASE, 1, None
    while width < 16:
        p = p[:-width] * np.uint64(powers) + p[width:]
        width, powers = 2 * width, powers * powers % (1 << 64)
        if width == 4:
            saved, at_four = p, powers
    n = len(data) - GRAM + 1
    return mixed(p[:n] * np.uint64(at_four) + saved[16:16 + n])


def contexts_of(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text, first, last, gram) of every maximal run of windows with the same smallest gram,
    and (text, gram) of grams that recur so closely that a window may recur in its own run.

    first and last are window starts within the text.
    """
    none, no_grams = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) < length:
        return none, none, none, no_grams, none, no_grams
    every, span = gram_hashes(data), length - GRAM + 1
    low = _sliding(every, span, np.minimum)
    around = np.zeros(span - 1, np.uint64)
    chosen = np.flatnonzero(every == _sliding(np.concatenate([around, low, around]), span, np.maximum))
    close = chosen[1:][(every[chosen[1:]] == every[chosen[:-1]]) & (np.diff(chosen) <= length)]
    windows = len(data) - length + 1
    fits = np.zeros(windows + 1, np.int32)
    begin, end = offsets[:-1], offsets[1:] - length + 1
    some = end > begin
    np.add.at(fits, begin[some], 1)
    np.add.at(fits, end[some], -1)
    inside = np.cumsum(fits[:-1]) > 0
    change = np.ones(windows, bool)
    change[1:] = (low[1:windows] != low[:windows - 1]) | ~inside[:-1]
    first = np.flatnonzero(inside & change)
    stop = np.ones(windows, bool)
    stop[:-1] = change[1:] | ~inside[1:]
    last = np.flatnonzero(inside & stop)
    text = np.searchsorted(offsets, first, "right") - 1
    return (text, first - offsets[text], last - offsets[text], low[first],
            np.searchsorted(offsets, close, "right") - 1, every[close])


def _sliding(values: np.ndarray, span: int, best) -> np.ndarray:
    """The best of every ``span`` neighbours."""
    width = 1
    while 2 * width <= span:
        values, width = best(values[:-width], values[width:]), 2 * width
    return best(values[:-(span - width)], values[span - width:]) if width < span else values


def shared_windows(contexts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each context the runs [from, to] of window starts that also start earlier, that
    is in an earlier context or further left in the same one."""
    sizes = np.array([len(c) for c in contexts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text = np.frombuffer(b"".join(c + b"\xff" for c in contexts), np.uint8)
    order = _sorted_suffixes(text, length)
    reached = _borders(text, order, length)
    group = np.cumsum(reached) - 1
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    place = np.arange(len(text)) - starts[owner]
    window = place + length <= sizes[owner]
    at = np.where(window[order], order, len(text))
    earliest = np.minimum.reduceat(at, np.flatnonzero(reached))[group]
    later = np.zeros(len(text) + 1, np.int8)
    later[order[(at < len(text)) & (at != earliest)]] = 1
    step = np.diff(later, prepend=0)
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
        out[owner[a]].append((a - int(starts[owner[a]]), b - 1 - int(starts[owner[a]])))
    return out


def _sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places by the first ``depth`` bytes from there on, at least; that order is enough
    for intervals of strings up to that length."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i:i + n]
    order = np.argsort(key)
    ranked = key[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    rank = np.empty(n, np.uint64)  # of equal places: one more than their first place in order
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
    known = 8
    while known <= depth:
        # only places that are still equal to others are sorted again, within their slots
        slots = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(slots):
            break
        at = order[slots]
        ahead = np.where(at + known < n, rank[np.minimum(at + known, n - 1)], np.uint64(0))
        key = (rank[at] << np.uint64(32)) | ahead
        by = np.argsort(key)
        at, key = at[by], key[by]
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        order[slots], new[slots] = at, fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0)) + 1
        known *= 2
    return order


def _borders(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in ``order`` shares less than ``length`` bytes with the one before."""
    n = len(text)
    bwt = text[order - 1]
    by_char = np.argsort(bwt, kind="stable")
    back = np.empty(n, np.int32)  # where a place's character stands in the first column
    back[by_char] = np.arange(n, dtype=np.int32)
    chars = bwt[by_char]
    same = chars[1:] == chars[:-1]
    after, before = np.full(n, n, np.int32), np.full(n, -1, np.int32)
    after[by_char[:-1][same]] = by_char[1:][same]
    before[by_char[1:][same]] = by_char[:-1][same]
    reached = np.zeros(n + 1, bool)
    counts = np.bincount(text, minlength=256)
    edges = np.concatenate([[0], np.cumsum(counts[counts > 0])]).astype(np.int32)
    reached[edges] = True
    low, high = edges[:-1], edges[1:]
    for _ in range(1, length):
        if not len(low):
            break
        size = high - low
        number = np.repeat(np.arange(len(low), dtype=np.int32), size)
        shift = (low - np.cumsum(size) + size).astype(np.int32)
        where = np.arange(len(number), dtype=np.int32) + shift[number]
        ends = after[where] >= high[number]
        begins = before[where] < low[number]
        # the k-th character of each interval by value: its first and its last place
        last, first = (back[at[np.argsort(of.astype(np.int64) << 8 | bwt[at], kind="stable")]] for at, of in
                       ((where[ends], number[ends]), (where[begins], number[begins])))
        last += 1
        fresh = ~reached[last]
        low, high = first[fresh], last[fresh]
        reached[high] = True
        high, kept = np.unique(high, return_index=True)
        low = low[kept]
    return reached[:n]


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """(key, n_bytes, spans, kept_sha256) of every row.

    ``spans`` are the maximal byte ranges [start, end) covered by strings of
    ``length`` bytes that also start earlier: in a text with a smaller key, or
    further left in the same text. ``kept_sha256`` is of the bytes outside them.
    Keys are whole numbers; a null key counts as the smallest. Rows with the same key
    and text are one text listed twice and get the same result; rows with the same
    key and other texts follow each other by hash. Null texts are empty.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = df.select(F.col(f"`{key}`").alias("_key"), body.alias("_text"), F.sha2(body.cast("binary"), 256).alias("_sha"))
    own = own.withColumn("_code", F.conv(F.substring("_sha", 1, 15), 16, 10).cast("bigint"))
    order = F.coalesce(F.col("_key").cast("bigint"), F.lit(_NULL_FIRST))
    listed = stored(own.select("_key", order.alias("_order"), "_sha", "_code",
                               F.octet_length("_text").cast("bigint").alias("n_bytes")), "listed")
    texts = listed.groupBy("_sha", "_code").agg(F.min("_order").alias("_first"))

    grams, grams_at = packed(own.select("_code", "_text").mapInArrow(
        _grams(length), "_code bigint, once array<bigint>, twice array<bigint>"), "grams")
    rows = grams.select("_code", F.explode("once").alias("gram"), F.lit(False).alias("again")).unionByName(
        grams.select("_code", F.explode("twice").alias("gram"), F.lit(True).alias("again")))
    common = (rows.groupBy("gram").agg(F.min("_code").alias("a"), F.max("_code").alias("b"), F.max("again").alias("t"))
              .where("a <> b or t").select("gram"))
    common = stored(common, "common")
    # a filter of fixed size leaves few rows for the exact join
    few = maybe_in(rows.select("_code", "gram"), "gram", bloom_blocks(common, "gram")).where("maybe_listed")
    lists = stored(few.join(common, "gram").groupBy("_code").agg(F.collect_set("gram").alias("grams")), "lists")
    forget(df.sparkSession, grams_at)
    wanted = texts.join(lists, "_code").select("_sha", "_first", "grams")
    chosen = own.withColumn("_order", order).join(wanted, "_sha").where(F.col("_order") == F.col("_first"))
    kept, _ = packed(chosen.dropDuplicates(["_sha"]).select("_order", "_code", "grams", "_text"), "repeating")

    found, _ = packed(kept.mapInArrow(_found(length), "gram bigint, print binary, _order bigint, _code bigint, "
                                   "first int, last int, bytes binary"), "contexts")
    heads, _ = packed(found.groupBy("gram", "print").agg(
        F.min(F.struct("_order", "_code", "first")).alias("head"), F.count("*").alias("n"),
        F.max("bytes").alias("bytes")), "heads")
    size = F.sum(F.octet_length("bytes") + 1).alias("size")
    total = heads.agg(size).first()[0] or 0
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (8 * BLOCK)))
    # few buckets of grams hold more than a block; only their grams are summed up one by one
    dealt = heads.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(16 * total // BLOCK + 1)))
    full = dealt.groupBy("bucket").agg(size).where(F.col("size") > BLOCK).select("bucket")
    large = stored(dealt.join(F.broadcast(full), "bucket", "left_semi").groupBy("gram").agg(size)
                   .where(F.col("size") > BLOCK).select("gram"), "large")
    each, crowded = heads.select("gram", "head.*", "bytes"), not large.isEmpty()
    if crowded:  # at most one gram for each BLOCK bytes of contexts
        crowd = each.join(F.broadcast(large), "gram", "left_semi")
        each = each.join(F.broadcast(large), "gram", "left_anti")
    blocks = each.repartition(parts, "gram").sortWithinPartitions("gram")
    first_only = blocks.mapInArrow(_blocks(length), "_order bigint, _code bigint, start int, end int")
    if crowded:
        first_only = first_only.unionByName(_later_windows(crowd, length))
    others = (found.select("gram", "print", "_order", "_code", "first", "last")
              .join(heads.where("n > 1").select("gram", "print", "head"), ["gram", "print"])
              .where("struct(_order, _code, first) <> head")
              .select("_order", "_code", F.col("first").alias("start"), (F.col("last") + length).alias("end")))
    spans = first_only.unionByName(others).groupBy("_order", "_code").agg(
        F.collect_list(F.struct("start", "end")).alias("ranges"))
    cut = kept.select("_order", "_code", "_text").join(spans, ["_order", "_code"]).mapInArrow(
        _cut, "_order bigint, _code bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string")
    told = listed.join(texts.select("_sha", "_first"), "_sha").join(
        cut, ["_order", "_code"], "left")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    copy = (F.col("_order") > F.col("_first")) & (F.col("n_bytes") >= length)
    return told.select(
        F.col("_key").alias(key), "n_bytes",
        F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"))


def _grams(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                text, _, _, gram, *close = contexts_of(*text_bytes(batch.column(1)), length)
                text, gram = np.concatenate([text, close[0]]), np.concatenate([gram, close[1]])
                order = np.lexsort((gram, text))
                text, gram = text[order], gram[order].view(np.int64)
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])
                number = np.cumsum(new) - 1
                twice = np.bincount(number, minlength=int(new.sum())) > 1
                text, gram = text[new], gram[new]
                yield pa.record_batch([batch.column(0), *(_lists(text[m], gram[m], batch.num_rows)
                                                          for m in (~twice, twice))], names=["_code", "once", "twice"])
    return run


def _lists(owner: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _found(length: int):
    """The contexts of the listed grams of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 3):
                data, offsets = text_bytes(batch.column(3))
                text, first, last, gram, _, _ = contexts_of(data, offsets, length)
                lists = batch.column(2)
                wanted = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
                listed = lists.flatten().to_numpy().view(np.uint64)
                pairs = mixed(gram + mixed(text.astype(np.uint64)))  # one number per (text, gram)
                keep = np.isin(pairs, mixed(listed + mixed(wanted.astype(np.uint64))))
                text, first, last, gram = text[keep], first[keep], last[keep], gram[keep]
                raw = data.tobytes()
                parts = [raw[a:b] for a, b in zip((offsets[text] + first).tolist(),
                                                  (offsets[text] + last + length).tolist())]
                prints = [hashlib.blake2b(p, digest_size=16).digest() for p in parts]
                rows = pa.array(text)
                yield pa.record_batch([
                    pa.array(gram.view(np.int64)), pa.array(prints, pa.binary()), batch.column(0).take(rows),
                    batch.column(1).take(rows), pa.array(first, pa.int32()), pa.array(last, pa.int32()),
                    pa.array(parts, pa.binary())],
                    names=["gram", "print", "_order", "_code", "first", "last", "bytes"])
    return run


def _blocks(length: int):
    """Whole grams are gathered into blocks; each block is transformed on its own."""
    def solved(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[1:4])
        out = [(o, c, f + a, f + b + length) for (_, o, c, f, _), runs in
               zip(rows, shared_windows([r[4] for r in rows], length)) for a, b in runs]
        columns = list(zip(*out)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["_order", "_code", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, gram = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > BLOCK and row[0] != gram:
                    yield solved(held)
                    held, size = [], 0
                held.append(row)
                gram, size = row[0], size + len(row[4]) + 1
        if held:
            yield solved(held)
    return run


def _later_windows(crowd: DataFrame, length: int) -> DataFrame:
    """(_order, _code, start, end) of the runs of windows of ``crowd`` that also start earlier.

    Equal windows meet by hash and the earliest is kept, before and after the shuffle, so
    no row count of a gram or a window lands in one task. What is kept goes back to its own
    context, which has at most one row for each of its windows.
    """
    windows = crowd.select("_order", "_code", "first", "bytes").mapInArrow(
        _window_prints(length), "print binary, _order bigint, _code bigint, start int, first int")
    earliest = (windows.groupBy("print").agg(F.min(F.struct("_order", "_code", "start", "first")).alias("w"))
                .groupBy("w._order", "w._code", "w.first").agg(F.collect_list("w.start").alias("starts")))
    last = F.col("first") + F.octet_length("bytes") - length
    later = F.filter(F.sequence("first", last), lambda x: ~F.coalesce(F.array_contains("starts", x), F.lit(False)))
    runs = crowd.select("_order", "_code", "first", "bytes").join(
        earliest, ["_order", "_code", "first"], "left").select("_order", "_code", later.alias("later"))
    ends = F.arrays_zip(F.filter("later", lambda x: ~F.array_contains("later", x - 1)).alias("a"),
                        F.filter("later", lambda x: ~F.array_contains("later", x + 1)).alias("b"))
    return runs.select("_order", "_code", F.explode(ends).alias("run")).select(
        "_order", "_code", F.col("run.a").alias("start"), (F.col("run.b") + length).alias("end"))


def _window_prints(length: int):
    """Every window of every context, as a hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 3):
                contexts = batch.column(3).to_pylist()
                counts = np.array([len(c) - length + 1 for c in contexts], np.int64)
                row = np.repeat(np.arange(len(contexts)), counts)
                place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                prints = [hashlib.blake2b(c[i:i + length], digest_size=16).digest()
                          for c, n in zip(contexts, counts.tolist()) for i in range(n)]
                rows, first = pa.array(row), batch.column(2).to_numpy()
                yield pa.record_batch([
                    pa.array(prints, pa.binary()), batch.column(0).take(rows), batch.column(1).take(rows),
                    pa.array(first[row] + place, pa.int32()), batch.column(2).take(rows)],
                    names=["print", "_order", "_code", "start", "first"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans, sums = [], []
        for text, ranges in zip(batch.column(2), batch.column(3)):
            data, merged = (text.as_py() or "").encode(), []
            for r in sorted((r["start"], r["end"]) for r in ranges.as_py()):
                if merged and r[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], r[1])
                else:
                    merged.append(list(r))
            at, kept = 0, hashlib.sha256()
            for start, end in merged:
                kept.update(data[at:start])
                at = end
            kept.update(data[at:])
            spans.append([{"start": a, "end": b} for a, b in merged])
            sums.append(kept.hexdigest())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(spans, kind), pa.array(sums, pa.string())],
                              names=["_order", "_code", "spans", "kept_sha256"])


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without byte ranges; bytes of a character cut through are dropped."""
    data, at, parts = text.encode(), 0, []
    for start, end in spans:
        parts.append(data[at:start])
        at = end
    return b"".join([*parts, data[at:]]).decode(errors="ignore")

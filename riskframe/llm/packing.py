"""Best-fit packing of tokenised documents by a configuration linear program.

A configuration says how many pieces of each length share one sequence. The
program over the histogram of lengths (at most ``capacity`` numbers, whatever the
corpus) asks for bins of each configuration so that every length's count is
covered with as few bins as possible. Multiplicative weights price the lengths by
how far they lag behind; a knapsack dynamic program finds the dearest
configurations; the fractional bins are rounded down and the rest is packed best
fit on the histogram. Spark numbers the pieces of each length and joins them with
the plan's slots.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import numbered, quiet_threads
from riskframe.sources.tables import stored

#: Words whose token ids a worker remembers, about 250 bytes each.
REMEMBERED = 400_000
ROUNDS, CONFIGURATIONS_EACH, HASTE = 48, 64, 6.0

Config = tuple[tuple[int, int], ...]  # (length, copies), longest first

#: Fixed value: how byte-level tokenizers of this family cut a text before merging.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: long-settled blocks of Unicode, which both libraries cut alike (tested one by one):
#: Latin, Cyrillic, punctuation without its spaces, kana, ideographs.
ALIKE = "\x00-\u024f\u0400-\u0481\u2010-\u2027\u2030-\u205e\u3041-\u3096\u4e00-\u9fa5"
#: Words and white space of more characters than this go to the tokenizer, whose merges stay
#: fast at any length.
LONG = 2000

_encoders: dict[str, Encoder] = {}


def fast_merges(path: str):
    """The same merges in a faster library, and a pattern of what it must not be given.

    (None, None) unless the file is a plain byte-level tokenizer whose ids follow its
    merges. Tokens that their own bytes do not lead to are left out, since the faster
    library would look them up whole.
    """
    import tiktoken
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, cut = told["model"], told["pre_tokenizer"] or {}
    vocab, merges = model.get("vocab"), [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    plain = (model.get("type") == "BPE" and not told["normalizer"] and cut.get("type") == "ByteLevel"
             and not cut.get("add_prefix_space") and cut.get("use_regex") and not told["post_processor"]
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                "end_of_word_suffix", "ignore_merges")))
    if not plain or [vocab.get("".join(m)) for m in merges] != sorted(vocab.get("".join(m), -1) for m in merges):
        return None, None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves, the rest from 256 on
    spelled = {chr(b): b for b in shown}
    spelled.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)})
    added = [a["content"] for a in told["added_tokens"]]
    own = Tokenizer.from_file(path).model
    ranks = {bytes(spelled[c] for c in token): i for token, i in vocab.items()
             if token not in added and [t.id for t in own.tokenize(token)] == [i]}
    if not all(bytes([b]) in ranks for b in range(256)):
        return None, None
    marks = "".join(re.escape(a[0]) for a in added)
    return (tiktoken.Encoding("merges", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})._core_bpe,
            re.compile(f"[^{ALIKE}]" + (f"|[{marks}]" if marks else "")))


class Encoder:
    """Token ids of whole texts.

    Texts of characters in ALIKE, without a sign of an added token or a run over LONG,
    go through fast_merges. The others are taken word by word: the tokenizer never joins characters across a single blank between two
    non-blank characters, so text between such blanks is encoded once and
    remembered. Texts with other white space around a blank are encoded whole.
    """

    def __init__(self, path: str):
        quiet_threads()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.starts_blank = np.zeros(max(names.values()) + 1, bool)
        self.starts_blank[[i for name, i in names.items() if name.startswith("\u0120")]] = True
        self.after_blank: dict[str, bytes | None] = {}
        self.fast, self.unlike = fast_merges(path)

    @staticmethod
    def at(path: str) -> Encoder:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        return _encoders[path]

    def _alike(self, text: str) -> bool:
        if self.fast is None or self.unlike.search(text):
            return False
        words = text.split()
        sizes = [len(w) for w in words]
        return max(sizes, default=0) <= LONG and len(text) - sum(sizes) - len(words) <= LONG

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _each(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each word with a blank before it: encoded in one run and cut
        where a token starts with the blank, which only a word's first token does."""
        for at in range(0, len(words), 5000):
            run = words[at:at + 5000]
            ids = np.array(self.tokenizer.encode(" " + " ".join(run), add_special_tokens=False).ids, "<u4")
            cuts = [*(4 * np.flatnonzero(self.starts_blank[ids])).tolist(), 4 * len(ids)]
            if len(cuts) != len(run) + 1:
                yield from self._whole([" " + w for w in run])
                continue
            data = ids.tobytes()
            yield from (data[a:b] for a, b in zip(cuts, cuts[1:]))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        alike = [self._alike(t) for t in texts]
        others = self._by_words([t for t, a in zip(texts, alike) if not a])
        for text, fast in zip(texts, alike):
            yield np.array(self.fast.encode_ordinary(text), "<u4").tobytes() if fast else next(others)

    def _by_words(self, texts: list[str]) -> Iterator[bytes]:
        known = self.after_blank
        if len(known) > REMEMBERED:
            known.clear()
        split = [t.split(" ") for t in texts]
        new: set[str] = set()
        for parts in split:
            new.update(parts)
        new.difference_update(known)
        sound = [w for w in new if w and not w[0].isspace() and not w[-1].isspace()]
        known.update(dict.fromkeys(new))
        known.update(zip(sound, self._each(sound)))
        heads = self._whole([parts[0] for parts in split])
        for text, parts, head in zip(texts, split, heads):
            try:
                if parts[0] and parts[0][-1].isspace():
                    raise TypeError
                yield head + b"".join([known[w] for w in parts[1:]])
            except TypeError:  # unusual white space
                yield self._whole([text])[0]
        for w in new:
            if len(w) > 40:
                del known[w]


def pieces_of(df: DataFrame, key: str, text: str, tokenizer: str, capacity: int,
              end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): each text's ids and ``end_id``,
    cut only if longer than ``capacity``; then the first piece takes what is over."""
    own = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("_text"))
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int64()))] if with_ids else [])
    tail = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.at(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows, columns = [], [[] for _ in fields]
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for row, ids in enumerate(encoder.encode(texts)):
                    ids += tail
                    n, piece, start = len(ids) // 4, 0, 0
                    end = n if n <= capacity else (n % capacity or capacity)
                    while start < n:
                        part = ids[4 * start:4 * end]
                        rows.append(row)
                        values = [piece, start, end - start, zlib.crc32(part)]
                        if with_ids:
                            values.append(np.frombuffer(part, "<u4").tolist())
                        for column, value in zip(columns, values):
                            column.append(value)
                        piece, start, end = piece + 1, end, end + capacity
                arrays = [pa.array(c, t) for c, (_, t) in zip(columns, fields)]
                yield pa.record_batch([batch.column(0).take(pa.array(rows, pa.int64())), *arrays],
                                      names=[key, *(n for n, _ in fields)])

    kinds = "piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    return own.mapInArrow(cut, f"`{key}` {df.schema[key].dataType.simpleString()}, {kinds}")


def _priced(price: np.ndarray, counts: np.ndarray, capacity: int):
    """Knapsack over all lengths, each at most as often as it occurs: ``last[i, c]`` is the
    last item used among the first i when c tokens are free; items are (length, copies)."""
    items = []
    for length in np.flatnonzero(counts):
        left, copies = min(int(counts[length]), capacity // int(length)), 1
        while left > 0:
            took = min(copies, left)
            items.append((int(length), took))
            left, copies = left - took, copies * 2
    items.sort(key=lambda i: i[0] * i[1])
    best = np.zeros(capacity + 1)
    last = np.full((len(items) + 1, capacity + 1), -1, np.int16)
    for i, (length, copies) in enumerate(items):
        size = length * copies
        if size > capacity:
            last[i + 1] = last[i]
            continue
        with_it = best[:capacity + 1 - size] + price[length] * copies
        better = with_it > best[size:] + 1e-12
        last[i + 1] = last[i]
        last[i + 1, size:][better] = i
        best[size:] = np.where(better, with_it, best[size:])
    return items, last


def _configuration(items, last, must: int, capacity: int) -> Config:
    """The dearest configuration that holds ``must``."""
    got = {must: 1}
    free, i = capacity - must, len(items)
    while free > 0 and (i := last[i, free]) >= 0:
        length, copies = items[i]
        got[length] = got.get(length, 0) + copies
        free -= length * copies
    return tuple(sorted(got.items(), reverse=True))


def plan_bins(histogram: Mapping[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Configurations and how many bins of each; together they hold exactly ``histogram``."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not between 1 and {capacity}")
        counts[length] = n
    plan: list[tuple[Config, int]] = []
    if counts[capacity]:
        plan.append((((capacity, 1),), int(counts[capacity])))
        counts[capacity] = 0
    plans = [_rounded(counts, capacity, full_only) for full_only in (True, False)]
    plans.append(_best_fit(counts.copy(), capacity))
    return plan + min(plans, key=lambda p: sum(bins for _, bins in p))  # the program's, unless it needs more


def _rounded(counts: np.ndarray, capacity: int, full_only: bool) -> list[tuple[Config, int]]:
    """The program's plan, its bins rounded down and the rest packed best fit. ``full_only``
    takes no configuration with room left, which pays while the choice is wide."""
    plan: list[tuple[Config, int]] = []
    sizes = np.arange(capacity + 1)
    volume = float(counts @ sizes) / capacity
    covered = np.zeros(capacity + 1)
    wanted: dict[Config, float] = {}
    for step in range(ROUNDS if volume > 1 else 0):
        lag = (step + 1) / ROUNDS - covered / np.maximum(counts, 1)
        price = np.where(counts > 0, sizes * np.exp(HASTE * lag), 0.0)
        items, last = _priced(price, counts, capacity)
        left, placed = volume / ROUNDS, 0
        for must in np.argsort(np.where(counts > 0, -lag * sizes, np.inf), kind="stable")[:CONFIGURATIONS_EACH * 4]:
            if left <= 1e-9 or placed == CONFIGURATIONS_EACH or counts[must] == 0:
                break
            config = _configuration(items, last, int(must), capacity)
            room = min((counts[n] - covered[n]) / k for n, k in config)
            bins = min(room, max(left / max(1, CONFIGURATIONS_EACH - placed), min(1.0, left)))
            if bins <= 1e-9 or (full_only and sum(n * k for n, k in config) < capacity):
                continue
            wanted[config] = wanted.get(config, 0.0) + bins
            for n, k in config:
                covered[n] += bins * k
            left, placed = left - bins, placed + 1
    left_over = counts.copy()
    for config, bins in sorted(wanted.items(), key=lambda c: -c[1]):
        whole = min([math.floor(bins + 1e-9), *(int(left_over[n]) // k for n, k in config)])
        if whole > 0:
            plan.append((config, whole))
            for n, k in config:
                left_over[n] -= whole * k
    return plan + _best_fit(left_over, capacity)


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Config, int]]:
    """Longest first, each bin topped up with the longest that fits, for whole runs of
    equal bins at once; every step uses up a length, so there are few."""
    plan = []
    while counts.any():
        free, got, most = capacity, {}, capacity
        while len(fit := np.flatnonzero(counts[:min(free, most) + 1])):
            length = int(fit[-1])
            got[length] = min(int(counts[length]), free // length)
            free, most = free - length * got[length], length - 1
        bins = min(int(counts[n]) // k for n, k in got.items())
        for n, k in got.items():
            counts[n] -= bins * k
        plan.append((tuple(sorted(got.items(), reverse=True)), bins))
    return plan


def pack(pieces: DataFrame, key: str, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces`` (key, piece, start, length, ...).

    Pieces of one length are alike to the plan. They are numbered without gaps by
    (key, piece, start, checksum) and the k-th takes the plan's k-th slot, so an
    equal table is packed alike. Repeated rows are pieces of their own. The plan
    has at most a few configurations for each length, so it may be broadcast.
    """
    pieces = stored(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, sequence, used = [], 0, dict.fromkeys(histogram, 0)
    for config, bins in plan_bins(histogram, capacity):
        offset = 0
        for length, copies in config:
            first = used[length]
            used[length] = first + bins * copies
            slots.append((length, first, used[length], copies, offset, sequence))
            offset += length * copies
        sequence += bins
    plan = pieces.sparkSession.createDataFrame(
        slots, "_length bigint, _first bigint, _end bigint, _copies bigint, _offset bigint, _sequence bigint")
    ranked = numbered(pieces, ["length"], [key, "piece", "start", "ids_crc32"], "_nth")
    fits = (F.col("length") == F.col("_length")) & (F.col("_nth") >= F.col("_first")) & (F.col("_nth") < F.col("_end"))
    place = F.col("_nth") - F.col("_first")
    return ranked.join(F.broadcast(plan), fits).select(
        *pieces.columns, (F.col("_sequence") + F.floor(place / F.col("_copies")).cast("long")).alias("sequence_id"),
        (F.col("_offset") + F.pmod(place, F.col("_copies")) * F.col("length")).alias("offset"))


def pack_documents(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                   capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    A null text counts as empty and is a piece of one end id; an empty table gives
    none. Extra columns are not read.
    """
    return pack(pieces_of(df, key, text, tokenizer, capacity, with_ids=with_ids), key, capacity)

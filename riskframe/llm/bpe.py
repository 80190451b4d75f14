"""Byte-pair encoding by a table over prefixes, and decoding.

The encoding of every prefix of a word ends in exactly one token, so one value for each
prefix holds the whole answer. An automaton over the vocabulary lists, at each end, the
tokens that are suffixes there; the one whose start is the word's start, or whose left
neighbour (the last token of the prefix before it) is compatible with it, is that
prefix's last token. Two tokens are compatible when merging their joined bytes gives the
two of them again. Following the last tokens back from the word's end emits the ids.
Words are cut by the tokenizer's own pre-tokenizer; ids come from the table alone.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import quiet_threads

#: Words, and pairs of tokens, that a worker remembers before it lets go of the older half.
REMEMBERED = 150_000
#: Rows encoded at a time, and words cut at a time.
ROWS, RUN = 1_000, 5_000
NEVER = 1 << 60


class Remembered:
    """A dictionary of bounded size that keeps what was used last."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.young, self.old = most, {}, {}

    def turn(self) -> None:
        self.old, self.young = self.young, {}

    def missing(self, keys: Iterable) -> set:
        """Those of ``keys`` to be computed; the others are then all in ``young``."""
        if len(self.young) > self.most:
            self.turn()
        absent = set(keys).difference(self.young)
        again = {k: self.old[k] for k in absent if k in self.old}
        self.young.update(again)
        return absent.difference(again)


class PrefixTable:
    """Ids of single words in the byte alphabet of a vocabulary with ranked merges."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        import ahocorasick
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.ranks[left, right] = rank
            self.parts.setdefault(whole, (left, right, rank))
        self.edges: tuple[dict, dict] = ({}, {})
        self.automaton = ahocorasick.Automaton()
        self.size = max(vocabulary.values()) + 1
        self.length = [0] * self.size
        for name, token in vocabulary.items():
            if self._reachable(token, name):
                self.length[token] = len(name)
                self.automaton.add_word(name, token)
        self.automaton.make_automaton()
        self.pairs = Remembered()

    def _reachable(self, token: int, name: str) -> bool:
        """Whether a token's own bytes encode to that token."""
        if len(name) == 1 or token not in self.parts:
            return len(name) == 1
        left, right, rank = self.parts[token]
        return self._apart(left, right, rank)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that lie at one edge (0 left, 1 right) while ``token`` is built, first
        its outermost byte, each with the rank of the merge that takes it up."""
        known = self.edges[side]
        if token not in known:
            chain, now, taken = [], token, NEVER
            while now is not None:
                chain.append((now, taken))
                grown = self.parts.get(now)
                now, taken = (grown[side], grown[2]) if grown else (None, NEVER)
            known[token] = chain[::-1]
        return known[token]

    def _apart(self, u: int, v: int, until: int = NEVER) -> bool:
        """Whether no merge of rank below ``until`` crosses the border between u and v.

        Merges go by rank, equal ones from the left: a merge across wins only if it
        comes before the merge to its left and not after the one to its right.
        """
        left, right = self._edge(u, 1), self._edge(v, 0)
        i = j = 0
        while True:
            (a, a_taken), (b, b_taken) = left[i], right[j]
            rank = self.ranks.get((a, b), NEVER)
            if rank < until and rank < a_taken and rank <= b_taken:
                return False
            if a_taken == NEVER and b_taken == NEVER:
                return True
            if a_taken <= b_taken:
                i += 1
            else:
                j += 1

    def compatible(self, u: int, v: int) -> bool:
        known, pair = self.pairs, u * self.size + v
        if len(known.young) > known.most:
            known.turn()
        fits = known.old.get(pair)
        fits = known.young[pair] = self._apart(u, v) if fits is None else fits
        return fits

    def ids(self, word: str) -> list[int]:
        last = [-1] * (len(word) + 1)
        length, size, known = self.length, self.size, self.pairs.young
        for end, token in self.automaton.iter(word):
            end += 1
            if last[end] < 0:
                start = end - length[token]
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    fits = known.get(before * size + token)
                    if fits is None:
                        fits = self.compatible(before, token)
                        known = self.pairs.young
                    if not fits:
                        continue
                last[end] = token
        found, at = [], len(word)
        while at > 0:
            if last[at] < 0:
                raise ValueError(f"the vocabulary has no bytes for {word!r}")
            found.append(last[at])
            at -= length[last[at]]
        return found[::-1]


def as_bytes(ids: list[int]) -> bytes:
    """Four little-endian bytes for each id."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


_coders: dict[str, Coder] = {}
_decoders: dict[str, Decoder] = {}


def _read(path: str) -> dict:
    """A tokenizer file, refused unless it is plain byte-level BPE."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
             and not before.get("add_prefix_space") and not spec["normalizer"]
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                "end_of_word_suffix", "ignore_merges")))
    if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    return spec


class Decoder:
    """Texts of ids; holds nothing but each id's bytes.

    The byte alphabet shows printable bytes as themselves and numbers the others, in
    order, from 256 on.
    """

    def __init__(self, path: str):
        spec = _read(path)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        names = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max(names.values()) + 1)
        for name, token in names.items():
            known = all(c in byte for c in name)
            self.bytes_of[token] = bytes(byte[c] for c in name) if known else name.encode()

    @staticmethod
    def at(path: str) -> Decoder:
        if path not in _decoders:
            _decoders[path] = Decoder(path)
        return _decoders[path]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no text become replacement characters, and ids
        beyond the vocabulary are skipped."""
        names, most = self.bytes_of, len(self.bytes_of)
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) and int(numbers.max()) >= most:
            numbers = numbers[numbers < most]
        return b"".join([names[i] for i in numbers.tolist()]).decode("utf-8", "replace")


class Coder:
    """Ids of whole texts as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        quiet_threads()
        from tokenizers import Tokenizer
        spec = _read(path)
        model, added = spec["model"], spec["added_tokens"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.table = PrefixTable(model["vocab"], merges)
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: as_bytes([t["id"]]) for t in added}
        self.special_names = sorted(self.special, key=len, reverse=True)
        self.words, self.chunks = Remembered(), Remembered()

    @staticmethod
    def at(path: str) -> Coder:
        if path not in _coders:
            _coders[path] = Coder(path)
        return _coders[path]

    def _of_words(self, words: list[str]) -> list[bytes]:
        new = self.words.missing(words)
        known, ids = self.words.young, self.table.ids
        for word in new:
            known[word] = as_bytes(ids(word))
        found = [known[w] for w in words]
        for word in new:
            if len(word) > 100:  # long words seldom come again
                del known[word]
        return found

    def _whole(self, text: str) -> bytes:
        return b"".join(self._of_words([w for w, _ in self.cut(text)]))

    def _learn(self, chunks: list[str]) -> None:
        """Ids of chunks that follow a blank. Only a chunk's first word holds a blank, which
        the byte alphabet shows as its 33rd hidden byte, so one run is cut back at it."""
        for at in range(0, len(chunks), RUN):
            run = chunks[at:at + RUN]
            words = [w for w, _ in self.cut(" " + " ".join(run))]
            ids = self._of_words(words)
            starts = [i for i, w in enumerate(words) if w[0] == "Ġ"]
            ends = [*starts[1:], len(ids)]
            self.chunks.young.update(zip(run, [
                ids[a] if b - a == 1 else b"".join(ids[a:b]) for a, b in zip(starts, ends)], strict=True))

    def _segments(self, text: str) -> list[str | bytes]:
        """A text cut at the added tokens, those as their ids, longer names first."""
        parts: list[str | bytes] = [text]
        for name in self.special_names:
            if name in text:
                cut: list[str | bytes] = []
                for part in parts:
                    if isinstance(part, str):
                        first, *others = part.split(name)
                        cut.append(first)
                        for other in others:
                            cut += [self.special[name], other]
                    else:
                        cut.append(part)
                parts = cut
        return parts

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Words never reach across a single blank between two other characters, so the
        chunks between such blanks are encoded once. Segments with other white space
        beside a blank are cut as a whole."""
        cut = [[s if isinstance(s, bytes) else s.split(" ") for s in self._segments(t)] for t in texts]
        used: set[str] = set()
        for segments in cut:
            for s in segments:
                if isinstance(s, list):
                    used.update(s[1:])
        new = self.chunks.missing(used)
        odd = {c for c in new if not c or c[0].isspace() or c[-1].isspace()}
        self._learn(list(new - odd))
        known = self.chunks.young
        for segments in cut:
            out = []
            for s in segments:
                if isinstance(s, bytes):
                    out.append(s)
                elif len(s) > 1 and (not s[0] or s[0][-1].isspace() or not odd.isdisjoint(s)):
                    out.append(self._whole(" ".join(s)))
                else:
                    out.append(self._whole(s[0]))
                    out.extend(map(known.__getitem__, s[1:]))
            yield b"".join(out)
        for c in new:
            if len(c) > 100:  # long chunks seldom come again
                known.pop(c, None)


def encode_texts(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                 decoded: str | None = None) -> DataFrame:
    """(key, ids[, decoded]) for every row: the ids of its whole text, four little-endian
    bytes each, and with ``decoded`` named the text that these ids give.

    Ids are those of the tokenizer file without special tokens added; names of its added
    tokens inside a text become their ids, as in the tokenizers library. A null text
    counts as empty and has no ids. Rows are independent: repeated and null keys stay, an
    empty table gives none, extra columns are not read.
    """
    own = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, decoder = Coder.at(tokenizer), Decoder.at(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids = list(coder.encode([t or "" for t in batch.column(1).to_pylist()]))
                columns, names = [batch.column(0), pa.array(ids, pa.binary())], [key, "ids"]
                if decoded:
                    columns.append(pa.array([decoder.decode(i) for i in ids], pa.string()))
                    names.append(decoded)
                yield pa.record_batch(columns, names=names)

    more = f", `{decoded}` string" if decoded else ""
    return own.mapInArrow(encode, f"`{key}` {df.schema[key].dataType.simpleString()}, ids binary{more}")


def decode_ids(df: DataFrame, tokenizer: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds ``name``, the text of the ids (four little-endian bytes each), special tokens
    included. Null ids give null. ``name`` must not be a column of ``df`` yet."""
    if name in df.columns:
        raise ValueError(f"{name} is a column already")
    columns = df.columns
    place = columns.index(ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder.at(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = [None if i is None else decoder.decode(i) for i in batch.column(place).to_pylist()]
                yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())],
                                      names=[*columns, name])

    wanted = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(decode, f"{wanted}, `{name}` string")

"""Secret scans: patterns, then structural confirmation of encoded candidates.

The base kinds are plain patterns. Structured kinds are reported only when their
content decodes to what it claims to be: base64 or hex whose DER lengths nest
exactly, OpenSSH and public-key blobs whose length fields add up, and signed
tokens whose header is JSON with an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Order of kinds that start at the same place.
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones just don't match
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*(?:KEY|CERTIFICATE)[A-Z0-9 ]*)-----([A-Za-z0-9+/=\s]+?)-----END \1-----")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_HEX_DER = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}(?![0-9A-Fa-f])")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])ey[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
_SSH_TYPES = (b"ssh-", b"ecdsa-", b"sk-")

Span = tuple[str, int, int]


def find_secrets(text: str | None) -> list[Span]:
    """(kind, start, end) of every secret in a text, by start and then kind."""
    if not text:
        return []
    spans: list[Span] = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text)
                         if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)
                  if m.end() - m.start() >= 20]
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    if "-----BEGIN" in text:
        spans += [("pem", m.start(), m.end()) for m in _PEM.finditer(text)
                  if _key_structure(_unbase64("".join(m[2].split())))]
    if "30" in text:
        spans += [("der", m.start(), m.end()) for m in _HEX_DER.finditer(text)
                  if len(m[0]) % 2 == 0 and _der_exact(bytes.fromhex(m[0]))]
    for m in _RUN.finditer(text):
        if kind := _key_structure(_unbase64(m[0])):
            spans.append((kind, m.start(), m.end()))
    if "ey" in text:
        spans += [("jwt", m.start(), m.end()) for m in _JWT.finditer(text) if _signed_token(m[0])]
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _unbase64(run: str) -> bytes:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _key_structure(data: bytes) -> str | None:
    if _der_exact(data):
        return "der"
    return "ssh" if _ssh_exact(data) else None


def _der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """(content start, content end) of the value whose tag stands at ``at``."""
    if at + 2 > len(data):
        return None
    first, start = data[at + 1], at + 2
    if first < 0x80:
        return start, start + first
    n = first & 0x7F
    if not 1 <= n <= 4 or start + n > len(data):
        return None
    size = int.from_bytes(data[start:start + n], "big")
    if size < 0x80 or (n > 1 and data[start] == 0):
        return None  # not the shortest form, which DER demands
    return start + n, start + n + size


def _der_exact(data: bytes) -> bool:
    """One SEQUENCE that fills the data, made of values whose lengths nest exactly,
    with at least one long INTEGER, BIT STRING or OCTET STRING."""
    if len(data) < 32 or data[0] != 0x30:
        return False
    todo, long_value = [(0, len(data), 0)], False
    while todo:
        at, end, depth = todo.pop()
        while at < end:
            span = _der_length(data, at)
            if span is None or span[1] > end or depth > 16:
                return False
            tag = data[at]
            if tag in (0x30, 0x31) or tag & 0xE0 == 0xA0:
                todo.append((span[0], span[1], depth + 1))
            elif tag not in (0x01, 0x02, 0x03, 0x04, 0x05, 0x06, 0x0C, 0x13, 0x14, 0x16, 0x17, 0x18) \
                    and tag & 0xC0 != 0x80:
                return False
            long_value |= tag in (0x02, 0x03, 0x04) and span[1] - span[0] >= 16
            at = span[1]
            if depth == 0 and at != len(data):
                return False
    return long_value


def _ssh_exact(data: bytes) -> bool:
    """The OpenSSH private container, or length-prefixed fields that fill the data."""
    if data.startswith(b"openssh-key-v1\0"):
        return _fields(data, 15, 3) is not None
    if len(data) < 32 or data[:3] != b"\0\0\0":
        return False
    end = _fields(data, 0, None)
    return end == len(data) and data[4:].startswith(_SSH_TYPES)


def _fields(data: bytes, at: int, count: int | None) -> int | None:
    """Where the length-prefixed fields end, or None if one runs over."""
    while at < len(data) and count != 0:
        end = at + 4 + int.from_bytes(data[at:at + 4], "big")
        if at + 4 > len(data) or end > len(data):
            return None
        at, count = end, None if count is None else count - 1
    return at


def _signed_token(token: str) -> bool:
    head, body, signature = token.split(".")[:3]
    try:
        header = json.loads(_unbase64(head))
        json.loads(_unbase64(body))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and (
        bool(signature) or header["alg"].lower() == "none")


def told(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_secrets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) for every row; spans: array of (kind, start, end) in code points.

    Null and empty texts have no spans. Every row is scanned on its own, so
    repeated rows give repeated results, and extra columns are not read.
    """
    own = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("_text"))
    out = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t.as_py())]
                     for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, out)], names=[key, "spans"])

    kind = df.schema[key].dataType.simpleString()
    return own.mapInArrow(scan, f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def mask_secrets(df: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``df`` with every secret in ``text`` replaced by ``[SECRET]``; all else as it was.

    Overlapping spans are replaced as one. Null texts stay null. ``length`` names a
    column that is to hold the new text's code points where the text changed.
    """
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {text: [masked(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]}
            if length:
                olds = batch.column(batch.schema.get_field_index(text)).to_pylist()
                counts = batch.column(batch.schema.get_field_index(length)).to_pylist()
                columns[length] = [n if new == old else len(new)
                                   for n, old, new in zip(counts, olds, columns[text])]
            for name, values in columns.items():
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
            yield batch

    return df.mapInArrow(mask, df.schema)


def masked(text: str | None) -> str | None:
    spans = find_secrets(text)
    if not spans:
        return text
    parts, at = [], 0
    for _, start, end in spans:
        if start >= at:
            parts += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def sha256_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()

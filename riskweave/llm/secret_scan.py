"""Secrets in texts: fixed patterns, and encoded keys and tokens confirmed by their structure.

Base kinds are found by pattern alone: ``assign`` (a name such as password or
token, = or :, a value of 8 or more characters), ``access`` (access key ids)
and ``hex`` (runs of 32 or more hex digits).

Structural kinds are decoded first and reported only if their bytes parse:

* ``key``: base64 or hex text, also the body of a PEM block, whose bytes are a
  DER sequence with consistent nested lengths and the fields of a private key
  (PKCS#1, PKCS#8 or SEC 1), or an OpenSSH private key with its chain of
  length-prefixed strings. Public keys and certificates are no secrets.
  Inside a PEM block escaped line ends, quotes and header lines are no part of
  the body; a block whose headers say it is encrypted counts if its body is whole
  cipher blocks. Base64 may be wrapped over lines (the first of 32 or more
  characters), also with escaped line ends.
* ``jwt``: three dotted base64url parts whose first is a JSON object that names
  an algorithm and whose second is a JSON object.

A block of documents is looked through as bytes for runs and names that any of
the patterns needs; only documents that have some are matched one by one.

Defined cases: null counts as empty; texts of any length are read whole; spans
are code points, end exclusive, sorted by start, then kind as listed; repeated
rows are scanned each by itself; an empty table gives an empty result. Only the
id and the text column are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.textkit import ASCII_LOWER, Texts, blocks, edges

KINDS = ("assign", "access", "hex", "key", "jwt")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX_RUN = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?!-----)[\x00-\x7f])+)-----END \1-----")
_PEM_HEADER = re.compile(r"(?m)^[ \t]*([A-Za-z][A-Za-z0-9-]*):[ \t]*([^\n]*)$")
_ESCAPED = re.compile(r"\\+[rnt]|[\\\"'\r]")
_ENCODED = re.compile(r"(?:(?<![A-Za-z0-9+/_\\-])|(?<=\\[rnt])|(?<=\\)(?![rnt]))[A-Za-z0-9+/_-]{32,}={0,2}")
_LINE_END = re.compile(r"[ \t]*(?:\\*\r?\n|\\+[rn])+[ \t]*")
_WRAPPED = re.compile(rf"{_ENCODED.pattern[:-6]}(?:{_LINE_END.pattern}[A-Za-z0-9+/_-]+)+={{0,2}}")
_HEX_TEXT = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{2}){32,}(?![0-9A-Za-z])")
_JWT = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")

# What a document must hold for any pattern to match in it.
_NAMES = (b"passw", b"secret", b"token", b"api", b"akia", b"private key")
_RUN_BYTES = np.zeros(256, dtype=bool)
_RUN_BYTES[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-.=")] = True
_RUN = 12


def _decoded(text: str) -> bytes | None:
    """Bytes of a base64 text (either alphabet), or None."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, first byte, byte after the last) of the DER element at ``at``; None if its length doesn't fit."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length & 0x80:
        width = length & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        length = int.from_bytes(data[at : at + width], "big")
        at += width
        if length < 0x80:  # DER asks for the short form
            return None
    return (tag, at, at + length) if at + length <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """All elements between two places, if they fill them exactly."""
    out = []
    while at < end:
        part = _element(data, at, end)
        if part is None:
            return None
        out.append(part)
        at = part[2]
    return out


_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_der_private_key(data: bytes) -> bool:
    """PKCS#1: version and eight integers; PKCS#8: version, algorithm, octets; SEC 1: version 1 and octets."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != _SEQUENCE or outer[2] != len(data):
        return False
    parts = _children(data, outer[1], outer[2])
    if not parts or parts[0][0] != _INTEGER or parts[0][2] - parts[0][1] != 1:
        return False
    version, tags = data[parts[0][1]], [t for t, _, _ in parts]
    if version <= 1 and len(parts) >= 9 and all(t == _INTEGER for t in tags[:9]):
        return all(high > low for _, low, high in parts)
    if version <= 1 and tags[1:3] == [_SEQUENCE, _OCTETS]:
        inner = _children(data, parts[1][1], parts[1][2])
        return bool(inner) and inner[0][0] == _OID and parts[2][2] > parts[2][1]
    return version == 1 and tags[1:2] == [_OCTETS] and 16 <= parts[1][2] - parts[1][1] <= 128 and all(t in (0xA0, 0xA1) for t in tags[2:])


def is_openssh_private_key(data: bytes) -> bool:
    return _openssh_end(data) > 0


def _openssh_end(data: bytes) -> int:
    """Bytes of an OpenSSH private key, 0 if it is none: the magic, cipher, kdf and its options, the number of keys, and as many public parts and one private part."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return 0
    at = len(magic)

    def string(at: int) -> int:
        if at + 4 > len(data):
            return -1
        after = at + 4 + int.from_bytes(data[at : at + 4], "big")
        return after if after <= len(data) else -1

    for _ in range(3):
        at = string(at)
        if at < 0:
            return 0
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return 0
    for _ in range(keys + 1):
        at = string(at)
        if at < 0:
            return 0
    return at


def _is_key(data: bytes | None) -> bool:
    return data is not None and len(data) >= 24 and (is_der_private_key(data) or is_openssh_private_key(data))


def _is_pem_key(body: str) -> bool:
    lines = _ESCAPED.sub(lambda m: "\n" if m[0][-1] in "rnt\r" else "", body)
    headers = {m[1].lower(): m[2] for m in _PEM_HEADER.finditer(lines)}
    data = _decoded("".join(_PEM_HEADER.sub("", lines).split()))
    if "ENCRYPTED" in headers.get("proc-type", "") and "dek-info" in headers:
        return data is not None and len(data) >= 24 and len(data) % 8 == 0
    return _is_key(data)


def _wrapped_keys(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of keys whose base64 text goes over several lines; the bytes tell where it ends."""
    for m in _WRAPPED.finditer(text):
        gaps = [(g.start(), g.end()) for g in _LINE_END.finditer(text, m.start(), m.end())]
        runs = list(zip([m.start(), *(e for _, e in gaps)], [*(s for s, _ in gaps), m.end()], strict=True))
        i = 0
        while i < len(runs):
            last = _wrapped_end(text, runs, i)
            if last > i:
                yield runs[i][0], runs[last][1]
            i = max(last, i) + 1


def _wrapped_end(text: str, runs: list[tuple[int, int]], i: int) -> int:
    """The run that ends a key begun by run i; -1 if there is none."""
    head = _decoded(text[runs[i][0] : runs[i][1]][:20]) or b""
    if len(head) < 15 or head[0] != _SEQUENCE and not head.startswith(b"openssh-key-v1"):
        return -1
    joined = "".join(text[s:e] for s, e in runs[i:]).rstrip("=")
    if head[0] == _SEQUENCE:
        width = head[1] & 0x7F if head[1] & 0x80 else 0
        size = 2 + width + (int.from_bytes(head[2 : 2 + width], "big") if width else head[1])
    else:
        size = _openssh_end(_decoded(joined[: len(joined) // 4 * 4]) or b"") or _openssh_end(_decoded(joined) or b"")
    wanted, upto = -(-size * 4 // 3), 0
    for j in range(i, len(runs)):
        upto += len(text[runs[j][0] : runs[j][1]].rstrip("="))
        if upto >= wanted:
            return j if upto == wanted and _is_key(_decoded(joined[:wanted])) else -1
    return -1


def _is_jwt(header: str, payload: str) -> bool:
    parts = []
    for part in (header, payload):
        data = _decoded(part)
        try:
            parts.append(json.loads(data) if data is not None else None)
        except (ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str)


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of every secret, sorted."""
    found = {(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8}
    found |= {(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16}
    found |= {(m.start(), 2, m.end()) for m in _HEX_RUN.finditer(text)}
    key = KINDS.index("key")
    for m in _PEM.finditer(text):
        if _is_pem_key(m[2]):
            found.add((m.start(), key, m.end()))
    pems = [(s, e) for s, k, e in found if k == key]
    found |= {(s, key, e) for s, e in _wrapped_keys(text) if not any(a <= s and e <= b for a, b in pems)}
    covered = [(s, e) for s, k, e in found if k == key]

    def free(m: re.Match) -> bool:
        return not any(s <= m.start() and m.end() <= e for s, e in covered)

    for m in _ENCODED.finditer(text):
        if free(m) and _is_key(_decoded(m[0])):
            found.add((m.start(), key, m.end()))
    for m in _HEX_TEXT.finditer(text):
        if free(m) and _is_key(bytes.fromhex(m[0])):
            found.add((m.start(), key, m.end()))
    found |= {(m.start(), KINDS.index("jwt"), m.end()) for m in _JWT.finditer(text) if _is_jwt(m[1], m[2])}
    return sorted(found)


def candidates(texts: Texts) -> np.ndarray:
    """Which documents of a block hold a name or a run of characters that some pattern needs."""
    n = len(texts)
    out = np.zeros(n, dtype=bool)
    inside = _RUN_BYTES[texts.data]
    first, last = edges(texts)
    begin = np.flatnonzero(inside & (first | ~np.concatenate(([False], inside[:-1]))))
    end = np.flatnonzero(inside & (last | ~np.concatenate((inside[1:], [False])))) + 1
    out[np.searchsorted(texts.offsets, begin[end - begin >= 32], "right") - 1] = True
    lowered = ASCII_LOWER[texts.data].tobytes()
    for name in _NAMES:
        at = lowered.find(name)
        while at >= 0:
            doc = int(np.searchsorted(texts.offsets, at, "right")) - 1
            out[doc] = True
            at = lowered.find(name, int(texts.offsets[doc + 1]))
    # Dotted tokens: a run of _RUN or more with two dots can be shorter than 32.
    dots = np.concatenate(([0], np.cumsum(texts.data == 0x2E)))
    long = (end - begin >= _RUN) & (dots[end] - dots[begin] >= 2)
    out[np.searchsorted(texts.offsets, begin[long], "right") - 1] = True
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


RESULT = T.StructType(
    [T.StructField("spans", T.StringType()), T.StructField("base_spans", T.StringType())] + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
)


@F.arrow_udf(RESULT)
def secrets_in(text: pa.Array) -> pa.Array:
    """text -> spans, base spans and counts by kind."""

    def rows() -> Iterator[tuple[str, str, list[int]]]:
        for low, high, texts in blocks(text):
            marked = candidates(texts)
            own = text.slice(low, high - low)
            for i in range(high - low):
                spans = spans_of(own[i].as_py() or "") if marked[i] else []
                counts = [0] * len(KINDS)
                for _, kind, _ in spans:
                    counts[kind] += 1
                yield _joined(spans), _joined([x for x in spans if x[1] < len(BASE_KINDS)]), counts

    found = list(rows())
    counts = np.array([c for _, _, c in found], dtype=np.int64).reshape(len(found), len(KINDS))
    arrays = [pa.array([s for s, _, _ in found], pa.string()), pa.array([b for _, b, _ in found], pa.string())]
    return pa.StructArray.from_arrays(arrays + [pa.array(counts[:, k]) for k in range(len(KINDS))], names=[f.name for f in RESULT])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, spans (kind:start:end, comma-joined), base_spans, n_<kind>."""
    return docs.select(F.col(id_col), secrets_in(F.col(text_col)).alias("found")).select(id_col, "found.*")



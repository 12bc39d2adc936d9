"""Secrets in texts: pattern matches, and encoded keys and signed tokens that are confirmed by parsing them.

Base spans come from three fixed patterns. The method adds spans only after a candidate has been decoded and its inside
parsed: a private key in a PEM envelope, a bare key in base64 or hex (nested lengths of its DER encoding must add up, or
it must be an OpenSSH key with well-formed fields), and a signed token whose header is JSON that names an algorithm.
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

#: The three base patterns.
ASSIGN = re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # of the runs [0-9a-f]+ those of 16 or more
#: Texts that contain none of these in lower case have no match of ASSIGN.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Lines that open and close an envelope, and runs in which a signed token may lie.
PEM = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*+)-----")
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+)++")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_KEY = re.compile(r"[0-9A-Fa-f]{64,}")
#: Spans at one place are listed in this order.
KINDS = ("assign", "access", "hex", "pem", "signed", "base64key", "hexkey")
BASE_KINDS = KINDS[:3]

FOUND = "kinds array<string>, starts array<bigint>, ends array<bigint>"


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns; leftmost, not overlapping within a kind, too short ones dropped."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS) or not text.isascii():
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return out


def unbase64(s: str) -> bytes | None:
    """Strict base64 in either alphabet, with or without its padding."""
    s = "".join(s.split()).rstrip("=").translate({45: 43, 95: 47})
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, from, to) of the elements that fill data[start:end] exactly, or None where their lengths don't."""
    out = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, start = data[start], data[start + 1], start + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or start + n > end:
                return None
            size, start = int.from_bytes(data[start : start + n], "big"), start + n
            if size < 0x80:
                return None
        if start + size > end:
            return None
        out.append((tag, start, start + size))
        start += size
    return out


def is_der_key(data: bytes) -> bool:
    """One SEQUENCE whose nested lengths add up, laid out as a private key (PKCS#1, PKCS#8, SEC1 or encrypted PKCS#8)."""
    top = der_items(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    inside = der_items(data, *top[0][1:])
    if not inside:
        return False
    tags = [t for t, _, _ in inside]
    if tags[0] == 2 and inside[0][2] - inside[0][1] == 1:
        if len(tags) >= 9 and tags[:9] == [2] * 9:
            return True
        if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 4:
            kind = der_items(data, *inside[1][1:])
            return bool(kind) and kind[0][0] == 6
        return len(tags) >= 2 and tags[1] == 4 and 16 <= inside[1][2] - inside[1][1] <= 80
    if tags == [0x30, 4]:
        kind = der_items(data, *inside[0][1:])
        return bool(kind) and kind[0][0] == 6
    return False


def is_openssh_key(data: bytes) -> bool:
    """The magic, then cipher, derivation and options as length-prefixed fields, a count of keys and the keys."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    names = [field(), field(), field()]
    if None in names or not names[0] or not names[1] or at + 4 > len(data):
        return False
    count = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return 1 <= count <= 64 and all(field() is not None for _ in range(count + 1))


def is_key(data: bytes | None) -> bool:
    return data is not None and len(data) >= 24 and (is_der_key(data) or is_openssh_key(data))


def is_signed(head: str, body: str, sign: str) -> bool:
    """Header and payload decode to JSON objects and the header names its algorithm; unless that is none, a signature follows."""
    try:
        header, payload = (json.loads(unbase64(x) or b"") for x in (head, body))
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(payload, dict) or not isinstance(header.get("alg"), str):
        return False
    signature = unbase64(sign) if sign else b""
    return signature is not None and (bool(signature) or header["alg"].lower() == "none")


def envelopes(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, inside) of every END line with the nearest BEGIN line of the same kind of key before it.

    The lines are gone through once; a BEGIN belongs to one envelope at most, and envelopes do not overlap.
    """
    begun: dict[str, re.Match] = {}
    for m in PEM.finditer(text):
        if not m[2].endswith("PRIVATE KEY"):
            continue
        if m[1] == "BEGIN":
            begun[m[2]] = m
        elif m[2] in begun:
            first = begun[m[2]]
            begun.clear()
            yield first.start(), m.end(), text[first.end() : m.start()]


def signed_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Header, payload and signature of every dotted run, from the first place of a part where a JSON object may begin.

    Each part is decoded at most once in each of the three roles.
    """
    for m in DOTTED.finditer(text):
        if "eyJ" not in m[0]:
            continue
        parts, at, free = m[0].split("."), m.start(), 0
        for i, part in enumerate(parts[:-2]):
            head = part.find("eyJ")
            if head >= 0 and i >= free and len(part) - head >= 14 and parts[i + 1] and is_signed(part[head:], parts[i + 1], parts[i + 2]):
                yield at + head, at + len(part) + len(parts[i + 1]) + len(parts[i + 2]) + 2
                free = i + 3
            at += len(part) + 1


def confirmed_spans(text: str) -> list[tuple[int, str, int]]:
    """Spans that decoding and parsing confirm, found in time in proportion to the text."""
    out, sealed_by = [], []
    if "-----BEGIN " in text:
        for start, end, inside in envelopes(text):
            lines = [x for x in inside.replace("\\n", "\n").splitlines() if ":" not in x]
            sealed = "ENCRYPTED" in inside  # an old envelope that names its cipher holds no readable lengths
            data = unbase64("".join(lines))
            if data and (is_key(data) or sealed and len(data) % 8 == 0):
                out.append((start, "pem", end))
                sealed_by.append((start, end))
    if "eyJ" in text:
        out += [(start, "signed", end) for start, end in signed_tokens(text)]
    passed = 0
    for m in BASE64.finditer(text):
        while passed < len(sealed_by) and sealed_by[passed][1] <= m.start():
            passed += 1
        if not (passed < len(sealed_by) and sealed_by[passed][0] <= m.start()) and is_key(unbase64(m[0])):
            out.append((m.start(), "base64key", m.end()))
    for m in HEX_KEY.finditer(text):
        if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            out.append((m.start(), "hexkey", m.end()))
    return out


def ordered(spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [ordered(base_spans(t) + confirmed_spans(t)) if t else [] for t in batch.column(1).to_pylist()]
        base = [",".join(f"{k}:{s}:{e}" for s, k, e in x if k in BASE_KINDS) for x in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *(pa.array([sum(k == kind for _, k, _ in x) for x in found], pa.int64()) for kind in BASE_KINDS),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                pa.array([",".join(f"{k}:{s}:{e}" for s, k, e in x) for x in found], pa.string()),
            ],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, counts of the base kinds, digest of the base spans, and all spans.

    Whole texts are scanned; a null or empty text has no spans (counts 0, the digest of the empty string). Rows are
    independent: repeated rows give repeated results, a null id stays null, other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(
        _scan, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def _redact(mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = []
            for t in batch.column(at).to_pylist():
                spans = sorted((s, e) for s, _, e in base_spans(t) + confirmed_spans(t)) if t else []
                if spans:
                    parts, done = [], 0
                    for s, e in spans:
                        if e <= done:
                            continue
                        if s >= done:
                            parts += [t[done:s], mark]
                        done = e
                    t = "".join(parts) + t[done:]
                texts.append(t)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return run


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span found in ``text`` replaced by ``mark``; overlapping spans become one mark.

    All rows and columns stay; a column ``n_chars`` is counted anew (null for a null text). Null and empty texts stay.
    """
    out = docs.mapInArrow(_redact(mark), docs.schema)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))

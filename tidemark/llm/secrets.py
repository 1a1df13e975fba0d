"""Secret scans with structural confirmation.

Every text gets the plain patterns (assigned secrets, access keys, long hex).
Beyond them, base64 and hex candidates are decoded and reported only if their
bytes have the structure of a key: DER whose nested lengths add up to a private
key, an OpenSSH key container, or a signed token whose header and payload are
JSON and name an algorithm.  Chance never has such structure, so the added
spans need no entropy threshold.

Defined results: null is the empty text, without spans; offsets are code
points, ends exclusive; repeated rows are answered each; extra columns are not
read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, slices

# fixed values: patterns of the base kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")   # a run of 32 or more is what [0-9a-f]+ finds there

KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")

PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,40})-----")
# any coded head: whether it is the header of a token is for the decoder to say
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,}+)\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++")
CODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
HEXES = re.compile(r"(?:[0-9a-fA-F]{2}){32,}")


def unbase64(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, content start, content end) of the DER element at ``at``, if it fits."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end or not data[at]:
            return None
        size, at = int.from_bytes(data[at:at + n], "big"), at + n
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= end else None


def elements(data: bytes, at: int, end: int, most: int = 16) -> list | None:
    """The elements that fill [at, end) exactly."""
    out = []
    while at < end:
        e = element(data, at, end)
        if e is None or len(out) == most:
            return None
        out.append(e)
        at = e[2]
    return out


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def private_der(data: bytes) -> bool:
    """PKCS#1, PKCS#8, SEC1 or DSA private key with consistent nested lengths."""
    top = element(data, 0, len(data))
    if top is None or top[0] != SEQUENCE or top[2] != len(data):
        return False
    parts = elements(data, top[1], top[2])
    if not parts or parts[0][0] != INTEGER or parts[0][2] - parts[0][1] != 1:
        return False
    tags, version = [p[0] for p in parts], data[parts[0][1]]
    if tags[:9] == [INTEGER] * 9 and version in (0, 1):
        return True                                           # PKCS#1
    if tags == [INTEGER] * 6 and version == 0:
        return True                                           # DSA
    if version in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS]:
        inner = elements(data, parts[1][1], parts[1][2])      # PKCS#8
        return bool(inner) and inner[0][0] == OID
    if version == 1 and tags[1:2] == [OCTETS]:
        return parts[1][2] - parts[1][1] in (20, 24, 28, 32, 48, 66)   # SEC1
    return False


def openssh_key(data: bytes) -> bool:
    """The OpenSSH container: magic, three strings, a key count, a public key blob."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, strings = len(magic), []
    for k in range(4):
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if k == 3:
            return 1 <= size <= 16 and at + 4 <= len(data) and at + 4 + int.from_bytes(data[at:at + 4], "big") <= len(data)
        if at + size > len(data):
            return False
        strings.append(data[at:at + size])
        at += size
    return False


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    if data[0] == SEQUENCE and private_der(data):
        return "der"
    return "ssh" if openssh_key(data) else None


def signed_token(text: str) -> bool:
    head, body, _ = text.split(".", 2)
    try:
        header, claims = json.loads(unbase64(head) or b""), json.loads(unbase64(body) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(claims, dict)


def base_spans(text: str) -> list[tuple]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


class Taken:
    """Places that confirmed spans hold.  A span that starts in another is not added,
    so the spans' ends ascend with their starts."""

    def __init__(self):
        self.starts, self.ends = [], []

    def holds(self, at: int) -> bool:
        k = bisect_right(self.starts, at) - 1
        return k >= 0 and at < self.ends[k]

    def add(self, start: int, end: int) -> None:
        if not self.holds(start):
            k = bisect_right(self.starts, start)
            self.starts.insert(k, start)
            self.ends.insert(k, end)


def confirmed_spans(text: str) -> list[tuple]:
    """Spans whose decoded bytes have the structure of a key or signed token."""
    out, done = [], Taken()
    if "-----BEGIN " in text:
        at, endless = 0, set()
        while m := PEM.search(text, at):
            mark = f"-----END {m[1]}-----"
            end = -1 if mark in endless else text.find(mark, m.end())
            at = m.end()
            if end < 0:
                endless.add(mark)
                continue
            body = text[m.end():end]
            if "\n\n" in body:                   # headers of an encrypted key
                body = body.split("\n\n", 1)[1] if ":" in body.split("\n\n", 1)[0] else body
            data = unbase64("".join(body.replace("\\n", "").split()))
            sealed = "PRIVATE" in m[1] and data is not None and len(data) >= 32 and "ENCRYPTED" in text[m.start():end]
            if key_kind(data) or sealed:
                out.append(("pem", m.start(), end + len(mark)))
                done.add(m.start(), end + len(mark))
                at = end + len(mark)
    at = 0
    while m := JWT.search(text, at):
        if signed_token(m[0]):
            out.append(("jwt", m.start(), m.end()))
            done.add(*m.span())
            at = m.end()
        else:                   # what follows the first dot may be a token
            at = m.end(1) + 1
    for m in CODED.finditer(text):
        if not done.holds(m.start()) and (kind := key_kind(unbase64(m[0]))):
            out.append((kind, m.start(), m.end()))
            done.add(*m.span())
    for m in HEXES.finditer(text):
        if m[0][:2] in ("30", "6f", "6F") and not done.holds(m.start()) and (kind := key_kind(bytes.fromhex(m[0]))):
            out.append((kind, m.start(), m.end()))
    return out


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


_FOUND = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "n_confirmed long")


def _scan(batches):
    for batch in batches:
        for part in slices(batch, "text", 8 << 20):
            rows = []
            for text in pc.fill_null(part.column(1), "").to_pylist():
                base, more = base_spans(text), confirmed_spans(text)
                count = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
                rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [part.column(0)] + [pa.array(c, pa.string() if k in (3, 4) else pa.int64()) for k, c in enumerate(cols)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(_scan, _FOUND)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))

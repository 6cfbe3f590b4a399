"""Secret scan: patterns, and candidates that are reported only if their structure holds."""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from retaloom.llm.common import appended

# The three base kinds. re.ASCII keeps letter case to A-Z.
ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run, so the same as + with a length test

# In the order in which kinds at one place are listed.
KINDS = ("assign", "access", "hex", "der", "jwt", "pem", "ssh")

ENCODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}(?:(?:[ \t]*\r?\n[ \t]*|(?:\\r)?\\n)[A-Za-z0-9+/_-]+={0,2})+")
HEXED = re.compile(r"[0-9A-Fa-f]{48,}")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM = re.compile(
    r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s,:-]|\\[rnt])*?)-----END \1-----")
SSH_MAGIC = b"openssh-key-v1\0"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """assign, access and hex matches that are long enough."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                  if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def _decoded(candidate: str) -> bytes | None:
    """Bytes of a base64 text of either alphabet; None if it is not one."""
    plain = candidate.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end of the DER element at ``at``, within ``end``."""
    if end - at < 2:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        more = size & 0x7F
        if not 1 <= more <= 4 or end - at < more:
            return None
        size = int.from_bytes(data[at:at + more], "big")
        if size < 0x80 or data[at] == 0:  # DER takes the shortest form
            return None
        at += more
    return (tag, at, at + size) if at + size <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill start to end exactly; None if they don't."""
    out = []
    while start < end:
        element = _element(data, start, end)
        if element is None:
            return None
        out.append(element)
        start = element[2]
    return out


def is_private_der(data: bytes) -> bool:
    """Whether nested lengths and tags are those of an RSA, EC, PKCS#8 or encrypted key."""
    top = _element(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _children(data, top[1], top[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    value = lambda p: int.from_bytes(data[p[1]:p[2]], "big")
    algorithm = lambda p: bool((kids := _children(data, p[1], p[2])) and kids[0][0] == 0x06)
    if tags[:1] == [0x02] and value(parts[0]) in (0, 1):
        if len(tags) >= 9 and set(tags[:9]) == {0x02}:  # RSA: version and eight numbers
            return True
        if value(parts[0]) == 0 and tags == [0x02] * 6:  # DSA: version and five numbers
            return True
        if value(parts[0]) == 1 and tags[1:2] == [0x04] and all(t in (0xA0, 0xA1) for t in tags[2:]):
            return True  # EC
        if tags[1:3] == [0x30, 0x04] and algorithm(parts[1]):
            return True  # PKCS#8
    return tags == [0x30, 0x04] and algorithm(parts[0])  # encrypted PKCS#8


def is_ssh_key(data: bytes) -> bool:
    """Whether the OpenSSH layout holds: magic, three strings, a count, public keys, blob."""
    if not data.startswith(SSH_MAGIC):
        return False
    at = len(SSH_MAGIC)

    def string() -> bool:
        nonlocal at
        if len(data) - at < 4:
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        return at <= len(data)

    if not (string() and string() and string()) or len(data) - at < 4:
        return False
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    return 1 <= keys <= 16 and all(string() for _ in range(keys + 1))


def is_signed_token(candidate: str) -> bool:
    """Whether header and claims are JSON objects and the header names its algorithm."""
    head, claims, signature = candidate.split(".")
    try:
        header = json.loads(_decoded(head) or b"")
        body = json.loads(_decoded(claims) or b"")
    except (ValueError, RecursionError):
        return False
    if not (isinstance(header, dict) and isinstance(body, dict)):
        return False
    algorithm = header.get("alg")
    return isinstance(algorithm, str) and (bool(signature) or algorithm.lower() == "none")


def _key_kind(data: bytes | None, depth: int = 1) -> str | None:
    """der, ssh, or pem and jwt one encoding deeper."""
    if not data:
        return None
    if is_private_der(data):
        return "der"
    if is_ssh_key(data):
        return "ssh"
    if depth and data.isascii() and (inner := structural_spans(data.decode(), depth - 1)):
        return inner[0][0]
    return None


def structural_spans(text: str, depth: int = 1) -> list[tuple[str, int, int]]:
    """Encoded keys and signed tokens whose decoded structure holds.

    Found in the order: key blocks with their markers, tokens, bare base64, bare hex. A
    candidate inside an earlier find is part of it and not reported again.
    """
    found: list[tuple[str, int, int]] = []
    free = lambda start, end: all(end <= s or e <= start for _, s, e in found)
    if "-----BEGIN" in text:
        for m in PEM.finditer(text):
            lines = re.sub(r"\\[rnt]", "\n", m[2]).splitlines()  # also line ends as in JSON
            body = "".join(x for x in lines if ":" not in x)
            data = _decoded("".join(body.split()))
            encrypted = "ENCRYPTED" in m[2]  # the old form: only its base64 can be checked
            if data and (is_private_der(data) or is_ssh_key(data) or encrypted):
                found.append(("pem", *m.span()))
    if "eyJ" in text:
        for m in JWT.finditer(text):
            if free(*m.span()) and is_signed_token(m[0]):
                found.append(("jwt", *m.span()))
    for m in WRAPPED.finditer(text):
        # Lines of one length and a shorter last one, as encoders wrap them, are one candidate.
        lines = [x for x in re.split(r"\s+|(?:\\r)?\\n", m[0]) if x]
        size = next((k for k in range(1, len(lines)) if len(lines[k]) != len(lines[0])), len(lines))
        size += size < len(lines) and len(lines[size]) < len(lines[0])
        ends, at = [], m.start()
        for line in lines[:size]:
            at = text.index(line, at) + len(line)
            ends.append(at)
        for k in (size, size - 1):  # the shorter line may be the next text already
            if k > 1 and free(m.start(), ends[k - 1]) and (
                    kind := _key_kind(_decoded("".join(lines[:k])), depth)):
                found.append((kind, m.start(), ends[k - 1]))
                break
    for m in ENCODED.finditer(text):
        if free(*m.span()) and (kind := _key_kind(_decoded(m[0]), depth)):
            found.append((kind, *m.span()))
    for m in HEXED.finditer(text):
        for start in (m.start(), m.start() + 1):  # the run may have a digit too many on either side
            end = m.end() - (m.end() - start) % 2
            if free(start, end) and (kind := _key_kind(bytes.fromhex(text[start:end]), depth)):
                found.append((kind, start, end))
                break
    return found


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed."""
    return sorted(base_spans(text) + structural_spans(text),
                  key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``spans``: kind, start and end (code points, end exclusive) of each find.

    Cases: NULL and empty texts have none. Texts of any length are scanned whole; state is
    one text at a time. A column of docs called spans is replaced.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batch: list[bytes]) -> dict[str, pa.Array]:
        rows = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t.decode())] for t in batch]
        return {"spans": pa.array(rows, kind)}

    return appended(docs, text_col, work, f"spans {SPAN}")

"""WARC archives written from tables and read back as a table of chunks.

A payload never has to be in one piece: it is written and read as rows of a record's identifier,
a chunk number and at most ``chunk_bytes`` bytes. Each row read carries the length and the
SHA-256 of the payload through that chunk, taken from one running hash, so the last row of a record
holds both of the whole payload and a reader that stops early knows what it has.

Writing: equal payloads are found by digest and length over narrow rows, combined before the
exchange; the few that repeat are joined back under a salt. Each task then streams its chunks
into archives of its own, one gzip member a record, and starts a new archive beyond
``archive_bytes``. Only archives named in the manifest count, which is written when their
tasks have ended: what a lost executor left behind is never read.

Defined cases: a null payload is the empty one. Payloads below ``least`` bytes are always
responses. Of equal payloads, every row with the smallest key is a response (repeated rows
too), the others refer to it, also rows without a key; if no row has a key, all are
responses. An archive that breaks off ends with a row whose ``whole`` is false. Other columns
are not read. No row: no archive, no record.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

from retaloom.llm.common import stored
from retaloom.session import shared_folder

LEAST = 100  # bytes from which equal payloads are written once
CHUNK = 1 << 20
ARCHIVE = 1 << 30
SALTS = 16
FLUSH_ROWS, FLUSH_BYTES = 1000, 8 << 20
LINE = 1 << 16  # longest header line
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file string, bytes bigint, records bigint"
CHUNKS = (
    "file string, offset bigint, record_id string, record_type string, target_uri string, "
    "refers_to string, declared_digest string, declared_bytes bigint, chunk int, data binary, "
    "upto bigint, digest string, last boolean, whole boolean")


# Writing

def planned(df: DataFrame, key: str, url: str, payload: str, least: int, chunk_bytes: int) -> DataFrame:
    """Rows (key, url, bytes, digest, refers_to, chunk, data) of a record in order."""
    content = F.coalesce(F.col(f"`{payload}`"), F.lit("").cast(df.schema[payload].dataType)).cast("binary")
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), content.alias("content"))
    measured = lambda: (F.octet_length("content").cast("bigint").alias("bytes"),
                        F.sha2("content", 256).alias("digest"))
    repeated = (
        rows.select("key", *measured()).where(F.col("bytes") >= least)
        .groupBy("digest", "bytes").agg(F.min("key").alias("kept"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and kept is not null").drop("n"))
    repeated = stored(repeated, "warc-repeated").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")
    joined = rows.select("key", "url", "content", *measured(), salt).join(
        repeated, ["digest", "bytes", "salt"], "left")
    again = F.col("kept").isNotNull() & ~F.col("key").eqNullSafe(F.col("kept"))
    pieces = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("bytes") / chunk_bytes) - 1, F.lit(0))),
        lambda i: F.substring(F.col("content"), (i * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes)))
    return joined.select(
        F.col("key").cast("string").alias("key"), "url", "bytes", "digest",
        F.when(again, F.col("kept").cast("string")).alias("refers_to"),
        F.posexplode(F.when(again, F.array(F.lit(b""))).otherwise(pieces)).alias("chunk", "data"))


def _id(space: str, key: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid4()}>" if key is None else f"<urn:{space}:{quote(key, safe='')}>"


def _head(space: str, date: str, row: dict) -> bytes:
    """WARC headers and the HTTP header of a record, up to its payload."""
    kept = row["refers_to"] is None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['bytes']}\r\n\r\n").encode()
    uri = quote(row["url"] or "", safe=":/?#[]@!$&'()*+,;=%-._~") or _id(space, row["key"])[1:-1]
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if kept else 'revisit'}",
        f"WARC-Record-ID: {_id(space, row['key'])}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{row['digest']}"]
    if not kept:
        lines += [f"WARC-Refers-To: {_id(space, row['refers_to'])}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + (row['bytes'] if kept else 0)}", "", ""]
    return "\r\n".join(lines).encode() + http


class _Archive:
    """One open archive; a record is one gzip member."""

    def __init__(self, folder: str, level: int, date: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        system, name = pafs.FileSystem.from_uri(self.path)
        self.sink, self.level = system.open_output_stream(name, compression=None), level
        self.bytes = self.records = 0
        note = b"software: retaloom\r\nformat: WARC File Format 1.1\r\n"
        self.begin((f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
                    f"WARC-Date: {date}\r\nContent-Type: application/warc-fields\r\n"
                    f"Content-Length: {len(note)}\r\n\r\n").encode() + note)
        self.end()
        self.records = 0

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.bytes += len(data)

    def begin(self, head: bytes) -> None:
        self.member = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        self.add(head)

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self._put(self.member.compress(b"\r\n\r\n") + self.member.flush())
        self.records += 1


def write(
    df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
    folder: str | None = None, space: str = "retaloom", least: int = LEAST, chunk_bytes: int = CHUNK,
    archive_bytes: int = ARCHIVE, level: int = 6, date: str | None = None,
) -> DataFrame:
    """Archives the rows and returns the manifest: file, bytes, records."""
    shared = folder or f"{shared_folder(df.sparkSession)}/llm-warc-{uuid.uuid4().hex}"
    shared = shared if re.match(r"[a-z0-9]+:", shared) else f"file://{shared}"
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, archive, within = [], None, False

        def close():
            if within:
                archive.end()
            archive.sink.close()
            done.append((archive.path, archive.bytes, archive.records))

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] == 0:
                    if archive is None:
                        system, name = pafs.FileSystem.from_uri(shared)
                        system.create_dir(name, recursive=True)
                    elif archive.bytes >= archive_bytes:
                        close()
                        archive = None
                    elif within:
                        archive.end()
                    if archive is None:
                        archive = _Archive(shared, level, date)
                    archive.begin(_head(space, date, row))
                    within = True
                archive.add(row["data"])
        if archive is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))],
                names=["file", "bytes", "records"])

    return stored(planned(df, key, url, payload, least, chunk_bytes).mapInArrow(run, MANIFEST), "warc-manifest")


# Reading

class _Stream:
    """Bytes of an archive, plain or of gzip members, in pieces of bounded size."""

    def __init__(self, handle):
        self.handle, self.raw, self.buffer = handle, b"", bytearray()
        self.read = 0  # bytes taken from the file
        self.zipped, self.member, self.broken = None, None, False
        self.starts: list[tuple[int, int]] = []  # of members: place in the text, place in the file
        self.made = self.used = 0  # bytes unpacked, bytes handed out

    def _more(self) -> bool:
        if not self.raw:
            self.raw = self.handle.read(1 << 16)
            self.read += len(self.raw)
        return bool(self.raw)

    def fill(self) -> bool:
        """Unpacks a little more; False at the end."""
        if self.broken or not self._more():
            self.broken |= self.member is not None
            return False
        if self.zipped is None:
            self.zipped = self.raw[:1] == b"\x1f"
        if not self.zipped:
            piece, self.raw = self.raw, b""
        else:
            if self.member is None:
                self.member = zlib.decompressobj(31)
                self.starts.append((self.made, self.read - len(self.raw)))
            try:
                piece = self.member.decompress(self.raw, 1 << 16)
            except zlib.error:
                self.broken = True
                return False
            self.raw = self.member.unconsumed_tail or self.member.unused_data
            if self.member.eof:
                self.member = None
        self.buffer += piece
        self.made += len(piece)
        return True

    def offset(self) -> int:
        """Where in the file the record at hand begins (its member, if packed)."""
        if not self.zipped:
            return self.used
        while len(self.starts) > 1 and self.starts[1][0] <= self.used:
            self.starts.pop(0)
        return self.starts[0][1] if self.starts else 0

    def take(self, n: int) -> bytes:
        """At most n bytes; fewer than there are, but none only at the end."""
        while not self.buffer and self.fill():
            pass
        piece = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.used += len(piece)
        return piece

    def line(self, most: int = LINE) -> bytes | None:
        """The next line with its end; None at the end or where there is none of that length."""
        start = 0
        while True:
            at = self.buffer.find(b"\n", start)
            if at >= 0:
                return self.take(at + 1)
            start = len(self.buffer)
            if start > most or not self.fill():
                return None


@dataclass
class _Record:
    offset: int
    headers: dict[str, str]
    http: dict[str, str]
    left: int  # bytes of the payload


def _fields(stream: _Stream, room: int) -> tuple[dict[str, str], int] | None:
    """Header lines up to an empty one, names in lower case, and the bytes they took."""
    found: dict[str, str] = {}
    name, taken = "", 0
    while True:
        line = stream.line() if taken < room else b""
        if line is None:
            return None
        taken += len(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            return found, taken
        if text[0] in " \t" and name:  # a folded line
            found[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            found.setdefault(name, value.strip())


def _next(stream: _Stream) -> _Record | None:
    """The next record's headers; None at the end of the archive or where it is damaged."""
    version = b"\r\n"
    while version is not None and not version.strip():
        version = stream.line()
    if version is None:
        stream.broken |= bool(stream.buffer)
        return None
    used = stream.used
    stream.used -= len(version)
    offset = stream.offset()
    stream.used = used
    head = _fields(stream, 1 << 20) if version.startswith(b"WARC/") else None
    if head is None or not head[0].get("content-length", "").isdigit():
        stream.broken = True
        return None
    headers, left, http = head[0], int(head[0]["content-length"]), {}
    if headers.get("content-type", "").startswith("application/http") and left:
        inner = _fields(stream, left)
        if inner is None:
            stream.broken = True
            return None
        http, left = inner[0], max(0, left - inner[1])
    return _Record(offset, headers, http, left)


def _rows(file: str, stream: _Stream, chunk_bytes: int, data: bool) -> Iterator[tuple]:
    while (record := _next(stream)) is not None:
        digest, upto, number, left = hashlib.sha256(), 0, 0, record.left
        head = record.headers
        revisit = head.get("warc-type") == "revisit"
        stated = head.get("warc-payload-digest")
        stated = stated.removeprefix("sha256:") if stated and stated.startswith("sha256:") else stated
        length = record.http.get("content-length", "")
        identity = [
            file, record.offset, head.get("warc-record-id"), head.get("warc-type"),
            head.get("warc-target-uri"), head.get("warc-refers-to"), stated,
            int(length) if length.isdigit() else None]
        while True:
            piece = bytearray()
            while len(piece) < min(chunk_bytes, left):
                part = stream.take(min(chunk_bytes, left) - len(piece))
                if not part:
                    break
                piece += part
            short = len(piece) < min(chunk_bytes, left)
            left -= len(piece)
            digest.update(piece)
            upto += len(piece)
            last = left == 0 or short
            whole = not short and (revisit or stated is None or len(stated) != 64
                                   or digest.hexdigest() == stated)
            yield (*identity, number, bytes(piece) if data else None, upto, digest.hexdigest(), last,
                   whole if last else None)
            number += 1
            if last:
                break
        if short:
            return
    if stream.broken:
        yield (file, stream.used if not stream.zipped else stream.read, None, "damaged", None, None, None, None,
               0, None, 0, hashlib.sha256().hexdigest(), True, False)


def chunks(manifest: DataFrame, chunk_bytes: int = CHUNK, data: bool = True) -> DataFrame:
    """The archives of the manifest's ``file`` column as rows of chunks, in the order of each
    archive. Without ``data`` the bytes are hashed but not handed on."""
    files = manifest.select("file")
    n = files.count()
    # Read bytes one archive a task; an archive has a bounded size.
    files = files.repartitionByRange(n, "file") if n > 1 else files
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(CHUNKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                system, name = pafs.FileSystem.from_uri(file)
                with system.open_input_stream(name, compression=None) as handle:
                    held, size = [], 0
                    for row in _rows(file, _Stream(handle), chunk_bytes, data):
                        held.append(row)
                        size += len(row[9] or b"")
                        if len(held) >= FLUSH_ROWS or size >= FLUSH_BYTES:
                            yield _batch(held, schema)
                            held, size = [], 0
                    if held:
                        yield _batch(held, schema)

    return files.mapInArrow(run, CHUNKS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def key_of(identifier: str, space: str = "retaloom") -> Column:
    """The key that ``write`` put into a record identifier; null for others."""
    inner = F.regexp_extract(identifier, f"^<urn:{space}:(.*)>$", 1)
    return F.when(F.col(identifier).rlike(f"^<urn:{space}:"), F.url_decode(inner))


def records(read: DataFrame) -> DataFrame:
    """One row per record out of its last chunk: length and digest of the full payload, for a
    revisit those that it declares, and whether what was read agrees with what was declared."""
    revisit = F.col("record_type") == "revisit"
    return read.where("last").select(
        "file", "offset", "record_id", "record_type", "target_uri", "refers_to",
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("upto")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest")).alias("payload_digest"), "whole")

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from retaloom.llm import warc

BIG = "ñandú <p>" * 40


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(1)
    noise = "".join(rng.choice("abcdef \r\n\n<>") for _ in range(300_000))
    rows = [
        (5, "http://a/x y?q=ü", BIG), (2, "http://b", BIG), (9, None, BIG), (9, "http://again", BIG),
        (2, "http://b", BIG), (None, "http://no-id", BIG), (3, "http://c", "short"), (4, "http://d", "short"),
        (6, "http://e", None), (7, "http://f", ""), (8, "x\r\nInjected: 1", noise), (10, "http://g", noise),
        (11, "http://h", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "z" * 100),
    ]
    return spark.createDataFrame([(*r, "d", 1) for r in rows],
                                 "page_id bigint, url string, html string, digest string, chunk int").repartition(4)


def plain(rows, least=100):
    """page, bytes, digest, type, refers_to by looking at all rows."""
    texts = [(r.page_id, (r.html or "").encode()) for r in rows]
    out = []
    for i, t in texts:
        ids = [j for j, u in texts if u == t and j is not None]
        first = min(ids, default=None)
        again = len(t) >= least and first is not None and i != first
        out.append((i, len(t), hashlib.sha256(t).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def listed(read):
    of = warc.records(read).where("record_type != 'warcinfo'").select(
        warc.key_of("record_id").cast("bigint").alias("k"), "payload_bytes", "payload_digest", "record_type",
        warc.key_of("refers_to").cast("bigint").alias("r"))
    return sorted(map(tuple, of.collect()), key=repr)


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 20])
def test_what_is_written_is_read(spark, pages, chunk):
    manifest = warc.write(pages, chunk_bytes=max(chunk, 100))
    read = warc.chunks(manifest, chunk_bytes=chunk).cache()
    assert listed(read) == plain(pages.collect())
    assert read.where("whole = false").count() == 0
    assert read.agg(F.max(F.length("data"))).first()[0] <= chunk
    by_key = {}
    for r in read.where("record_type = 'response'").orderBy("file", "offset", "chunk").collect():
        by_key.setdefault((r.file, r.offset), []).append(r)
    texts = {hashlib.sha256((r.html or "").encode()).hexdigest() for r in pages.collect()}
    for parts in by_key.values():
        assert [p.chunk for p in parts] == list(range(len(parts)))
        so_far = b""
        for p in parts:
            so_far += p.data
            assert p.upto == len(so_far) and p.digest == hashlib.sha256(so_far).hexdigest()
        assert parts[-1].digest in texts and parts[-1].last
    read.unpersist()


def test_archives_are_plain_gzip_members_and_roll_over(spark, pages):
    manifest = warc.write(pages.coalesce(1), archive_bytes=1000).collect()
    assert len(manifest) > 2 and sum(m.records for m in manifest) == pages.count()
    text = b"".join(gzip.open(m.file.removeprefix("file:")).read() for m in manifest)
    assert text.count(b"WARC-Type: warcinfo") == len(manifest)
    assert b"\r\nInjected: 1" not in text.split(b"HTTP/1.1 200 OK")[0]
    one = spark.createDataFrame([(m.file,) for m in manifest], "file string")
    assert listed(warc.chunks(one, data=False)) == plain(pages.collect())


def test_a_record_opens_at_its_offset(spark, pages):
    read = warc.records(warc.chunks(warc.write(pages.coalesce(1)), data=False)).collect()
    for r in read:
        with open(r.file.removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            first = next(warc._rows(r.file, warc._Stream(f), 1 << 20, False))
        assert first[2] == r.record_id


def test_archives_of_others_and_broken_ones(spark, tmp_path):
    body = b"<html>\r\n\r\nWARC/1.0</html>"
    http = b"HTTP/1.1 200 OK\nContent-Type: text/html\n\n"
    head = lambda n, more=b"": (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\n" + more
                                + b"Content-Type: application/http;\r\n  msgtype=response\r\nContent-Length: "
                                + str(n).encode() + b"\r\n\r\n")
    good = head(len(http + body)) + http + body + b"\r\n\r\n"
    wrong = head(len(http + body), b"WARC-Payload-Digest: sha256:" + b"0" * 64 + b"\r\n") + http + body + b"\r\n\r\n"
    files = {"plain": good * 2, "one-member": gzip.compress(good * 2), "cut": good + good[:-20],
             "cut-gzip": gzip.compress(good)[:-30], "junk": b"no archive\n", "empty": b"", "wrong": wrong}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in files], "file string")
    out = {}
    for r in warc.chunks(rows, chunk_bytes=10).where("last").collect():
        out.setdefault(r.file.rsplit("/", 1)[1], []).append((r.record_type, r.upto, r.whole))
    full = ("response", len(body), True)
    assert out["plain"] == [full] * 2 == out["one-member"]
    assert out["cut"][0] == full and out["cut"][1][2] is False and out["cut"][1][1] < len(body)
    assert out["cut-gzip"][-1][2] is False
    assert out["junk"] == [("damaged", 0, False)] and "empty" not in out
    assert out["wrong"] == [("response", len(body), False)]


def test_no_rows(spark, pages):
    manifest = warc.write(pages.where("false"))
    assert manifest.count() == 0 and warc.chunks(manifest).count() == 0


def test_a_hot_payload_is_spread(spark):
    rows = spark.range(3000).selectExpr(
        "id as page_id", "'u' as url", "if(id % 3 = 0, repeat('x', 200), concat(repeat('y', 200), id)) as html")
    got = listed(warc.chunks(warc.write(rows), data=False))
    assert len(got) == 3000 and sum(r[3] == "revisit" and r[4] == 0 for r in got) == 999

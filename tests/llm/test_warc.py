import base64
import hashlib
import io
import json
import zlib

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from verbalis.llm import warc


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}?a b\r\nX: y", f"<p>page {i}é</p>") for i in range(40)]
    rows += [(100, None, None), (101, "u", ""), (7, "twice", "<p>page 3é</p>"), (50, "u", "<p>page 3é</p>")]
    rows += [(None, "no id", "<p>page 4é</p>"), (200, "long", "x" * 3_000_000), (201, "crlf", "a\r\n\r\nWARC/1.1\r\n\r\n")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_key", F.lit(1)).repartition(3)


def brute(rows, min_bytes=0):
    last = {}
    for r in rows:
        last.setdefault(r.html or "", []).append(r.page_id)
    out = []
    for r in rows:
        ids = [i for i in last[r.html or ""] if i is not None]
        size = len((r.html or "").encode())
        refers = max(ids) if size >= min_bytes and len(last[r.html or ""]) > 1 and max(ids) != r.page_id else None
        out.append((r.page_id, size, digest(r.html), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 1])
def test_round_trip(pages, space, min_bytes):
    out = warc.archived(pages, space, min_bytes=min_bytes)
    rows = out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in rows), key=str) == brute(pages.collect(), min_bytes)


def test_every_record_is_a_member_at_its_offset(pages, space):
    rows = warc.archived(pages, space).collect()
    fs, path = pafs.FileSystem.from_uri(f"{space.path}/warc")
    for r in rows[:10]:
        with fs.open_input_file(f"{path}/{r.archive}.warc.gz") as f:
            f.seek(r.offset)
            member = zlib.decompressobj(31)
            record = member.decompress(f.read(r.length))
            assert member.eof and not member.unused_data
        assert record.startswith(b"WARC/1.1\r\n") and f"sha1:{r.payload_digest}".encode() in record
    one = {r.archive for r in rows}.pop()
    with fs.open_input_stream(f"{path}/{one}.idx", compression=None) as f:
        index = [json.loads(x) for x in f.read().decode().splitlines()]
    assert [(x[0], x[1]) for x in index] == sorted((r.offset, r.length) for r in rows if r.archive == one)


def test_small_archives(pages, space, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    parts = list(warc.archive_writer(f"{space.path}/w", "2020-01-01T00:00:00Z")(
        b for b in pages.select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to")).toArrow().to_batches()
    ))
    assert len(parts) > 5 and sum(p.column("records")[0].as_py() for p in parts) == pages.count()


def test_members_and_broken_streams():
    record = warc.warc_record(1, "u", b"abc", digest("abc"), None, "2020-01-01T00:00:00Z")
    squeeze = lambda x: zlib.compress(x, wbits=31)
    both = io.BytesIO(squeeze(record + record) + squeeze(record))
    assert [r for _, r in warc.records(warc.inflated(both))] == [record] * 3
    with pytest.raises(ValueError):
        list(warc.records(warc.inflated(io.BytesIO(squeeze(record)[:-20]))))
    with pytest.raises(ValueError):
        list(warc.records(iter([record[:-5]])))
    with pytest.raises(ValueError):
        list(warc.records(iter([b"HTTP/1.1 200 OK\r\n\r\n"])))


def test_empty(pages, space):
    assert warc.archived(pages.limit(0), space).count() == 0

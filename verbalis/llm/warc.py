"""WARC archives: written as one gzip stream a file, normalised to one member a record with a sidecar offset index."""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbalis.llm.common import whole_text
from verbalis.session import Workspace

#: Uncompressed bytes after which a writer starts the next archive.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
GZIP = 31  # zlib's window bits for a gzip wrapper
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path there; folders are in storage that all executors share."""
    return pafs.FileSystem.from_uri(folder)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:page:{quote(str(page_id), safe='')}>"


def page_of(value: str | None) -> str | None:
    """The page id in a record id, as text."""
    return None if value is None else unquote(value.strip("<>").removeprefix("urn:page:"))


def warc_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record: a response with its payload, or a revisit that names the response and has only the HTTP header."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: {record_id(page_id)}")
    head += [f"WARC-Date: {date}", f"WARC-Target-URI: {quote(url or '', safe=_URL_SAFE)}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = ":/?#[]@!$&'()*+,;=%"


def archive_writer(folder: str, date: str):
    """A function for ``mapInArrow``: writes the rows of a task as archives, returns the paths of finished ones.

    Every attempt has names of its own and only returned paths are read, so repeated tasks do no harm.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        fs.create_dir(path, recursive=True)
        out = stream = None
        name, size, n = "", 0, 0

        def finished() -> pa.RecordBatch:
            out.write(stream.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([n], pa.int64())})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, stream = fs.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(1, wbits=GZIP)
                payload = (row["html"] or "").encode()
                record = warc_record(row["page_id"], row["url"], payload, payload_digest(payload), row["refers_to"], date)
                out.write(stream.compress(record))
                size, n = size + len(record), n + 1
                if size >= ARCHIVE_BYTES:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return write


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, a chunk at a time; a truncated file raises ``ValueError``."""
    member = zlib.decompressobj(GZIP)
    started = False
    while raw := source.read(CHUNK):
        while raw:
            started = True
            yield member.decompress(raw)
            raw = member.unused_data
            if member.eof:
                member, started = zlib.decompressobj(GZIP), bool(raw)
    if started:
        raise ValueError("truncated gzip stream")


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, whole record) of a WARC stream; one record is held at a time."""
    buffer = bytearray()

    def fill(upto) -> bool:
        while not upto():
            chunk = next(chunks, None)
            if chunk is None:
                return False
            buffer.extend(chunk)
        return True

    while fill(lambda: len(buffer) > 0):
        if not fill(lambda: b"\r\n\r\n" in buffer):
            raise ValueError("a record without end of header")
        head = buffer.index(b"\r\n\r\n") + 4
        lines = bytes(buffer[: head - 4]).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        end = head + int(headers["content-length"]) + 4
        if not fill(lambda: len(buffer) >= end):
            raise ValueError("truncated record")
        yield headers, bytes(buffer[:end])
        del buffer[:end]


def normaliser(folder: str):
    """A function for ``mapInArrow``: each archive is inflated once, and every record becomes a gzip member of its own.

    The sidecar index has one JSON line per record: offset, length, type, page.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                name, at, index, n = uuid.uuid4().hex, 0, [], 0
                with (
                    fs.open_input_stream(f"{path}/{archive}", compression=None) as source,
                    fs.open_output_stream(f"{path}/{name}.warc.gz", compression=None) as out,
                    fs.open_output_stream(f"{path}/{name}.idx", compression=None) as side,
                ):
                    for headers, record in records(inflated(source)):
                        squeeze = zlib.compressobj(6, wbits=GZIP)
                        member = squeeze.compress(record) + squeeze.flush()
                        out.write(member)
                        entry = [at, len(member), headers["warc-type"], page_of(headers.get("warc-record-id"))]
                        index.append(json.dumps(entry))
                        at, n = at + len(member), n + 1
                        if len(index) >= 10_000:
                            side.write(("\n".join(index) + "\n").encode())
                            index = []
                    side.write("".join(x + "\n" for x in index).encode())
                yield pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([n], pa.int64())})

    return rewrite


def reader(folder: str):
    """A function for ``mapInArrow``: reads every record of normalised archives at the place that the index gives."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                with fs.open_input_stream(f"{path}/{archive}.idx", compression=None) as side:
                    index = [json.loads(x) for x in side.read().decode().splitlines()]
                with fs.open_input_file(f"{path}/{archive}.warc.gz") as source:
                    for at in range(0, len(index), 1000):
                        yield _read_records(source, archive, index[at : at + 1000])

    return read


def _read_records(source, archive: str, index: list) -> pa.RecordBatch:
    rows = []
    for offset, length, kind, _ in index:
        source.seek(offset)
        record = zlib.decompress(source.read(length), wbits=GZIP)
        head, _, block = record.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        http, _, payload = block[:-4].partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(http.rpartition(b"Content-Length: ")[2])
        if fields["WARC-Type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
            raise ValueError(f"{archive} at {offset}: the payload does not match its digest")
        refers_to = page_of(fields.get("WARC-Refers-To"))
        rows.append((page_of(fields.get("WARC-Record-ID")), size, digest, kind, refers_to, archive, offset, length))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


RECORD = (
    "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
    "archive string, offset long, length long"
)


def with_revisits(pages: DataFrame, id_col: str, payload: Column, min_bytes: int) -> DataFrame:
    """``page_id, url, html, refers_to``: among equal payloads of at least ``min_bytes`` the largest id is the response."""
    rows = pages.select(F.col(id_col).alias("page_id"), "url", payload.alias("html"))
    rows = rows.withColumn("_key", F.sha2("html", 256)).withColumn("_bytes", F.octet_length("html"))
    sizes = rows.select("page_id", "_key", "_bytes").filter(F.col("_bytes") >= min_bytes).groupBy("_key")
    groups = sizes.agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).filter("_n > 1")
    joined = rows.join(groups, "_key", "left")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    return joined.select("page_id", "url", "html", other.alias("refers_to"))


def archived(
    pages: DataFrame, space: Workspace, id_col: str = "page_id", min_bytes: int = 0, date: str = "2020-01-01T00:00:00Z"
) -> DataFrame:
    """Write ``pages`` (id, url, html) as normalised archives and read them back, one row per page.

    1. Each task writes its pages as WARC records into gzip files of one stream.
    2. Each file is inflated once and rewritten record by record, with a sidecar index of offsets.
    3. Records are read at their offsets; payloads of responses are checked against their digests.

    Files lie in the run's shared folder; lists of finished files are tables there. Null html is empty; a null id is
    smaller than any other and its record has no id; null urls are empty. Rows that repeat an id and a payload are
    responses together or refer to the same one. Empty tables give an empty result; other columns are not read.
    """
    folder = f"{space.path}/warc"
    id_type = pages.schema[id_col].dataType.simpleString()
    manifest = "archive string, records long"
    typed = with_revisits(pages, id_col, whole_text("html"), min_bytes)
    raw = space.keep(typed.mapInArrow(archive_writer(folder, date), manifest), "warc_raw")
    one_each = raw.repartition(max(1, raw.count()))
    clean = space.keep(one_each.mapInArrow(normaliser(folder), manifest), "warc_clean")
    back = clean.repartition(max(1, clean.count())).mapInArrow(reader(folder), RECORD)
    typed_id = [F.col(c).cast(id_type).alias(c) for c in ("page_id", "refers_to")]
    return back.select(typed_id[0], "payload_bytes", "payload_digest", "record_type", typed_id[1], "archive", "offset", "length")


"""WARC archives: write whole-file gzip streams, normalise them to a member per record, read them back.

A crawler that gzips a whole WARC file as one stream makes its records
unreachable without inflating all before them. ``normalise`` inflates such a
file once, as a stream, rewrites every record as a gzip member of its own and
writes a sidecar index (a line per record: offset, length, type, record id,
digest, URI). Records are then read by offset and length alone. On the way,
records whose payload another one holds become revisit records; which they are
is found on digests alone, so no payload is shuffled.

Archives go below a folder that all executors share. A task writes under a name
of its own attempt and its files count only once Spark has committed the rows
that name them, so lost executors and repeated attempts leave no half files in
the result. A task holds one record at a time, beside an Arrow batch of its input, and the id and digest of the
records that its file's revisits name.

Defined cases: a null page is an empty payload; equal payloads, empty ones too,
are stored once, with the smallest id, and others are revisit records; how many
records share a payload doesn't matter, only digests meet. Rows repeated with the
smallest id are all responses; one id may have several payloads. A null id is a revisit unless
its payload has no other id. Ids of any type are percent-encoded in a record's fields and decoded on
reading, so texts keep blanks and line ends; text ids are ordered by code point. Control characters in a URL are percent-encoded. An
empty table writes no file. A file that ends inside a record is an error. Other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh_path, hot_join, remove, table

#: Bytes before compression after which a task starts another file.
FILE_BYTES = 256_000_000
LEVEL = 6
#: Rows of an index that a task holds.
INDEX_ROWS = 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "path string, offset long, length long, record_type string, record_id string, payload_digest string, target_uri string"


def open_fs(uri: str):
    """The file system of a URI, and the path in it."""
    from pyarrow import fs

    if re.match(r"file:/(?!/)", uri):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, 'no page' if page_id is None else f'page:{page_id}')}>"


def id_field(page_id: str) -> str:
    """An id as the value of a header field: nothing that a field could lose or be ended by."""
    return quote(page_id, safe="")


def id_of(field: str | None) -> str | None:
    return None if field is None else unquote(field)


def make_record(page_id: str | None, url: str | None, payload: bytes) -> bytes:
    """One WARC response record, uncompressed."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", "WARC-Type: response", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {id_field(page_id)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def as_revisit(record: bytes, refers_to: str) -> bytes:
    """A response record as a revisit record: its HTTP headers without the payload, and the id of the record that holds it."""
    head, _, block = record.partition(b"\r\n\r\n")
    http = block[: block.index(b"\r\n\r\n") + 4]
    out = []
    for line in head.decode().split("\r\n"):
        name = line.partition(":")[0].lower()
        out.append("WARC-Type: revisit" if name == "warc-type" else f"Content-Length: {len(http)}" if name == "content-length" else line)
    out += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {id_field(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(out).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is left out."""
    out = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip stream of one or more members."""
    z = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            yield z.decompress(chunk)
            chunk = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)
            else:
                break
    yield z.flush()


def split_records(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, raw record) of each record of an uncompressed WARC stream; holds one record."""
    buffer, need, head = bytearray(), 0, None
    for part in parts:
        buffer += part
        while True:
            if head is None:
                at = buffer.find(b"\r\n\r\n")
                if at < 0:
                    break
                head = headers_of(bytes(buffer[:at]))
                need = at + 4 + int(head["content-length"]) + 4
            if len(buffer) < need:
                break
            yield head, bytes(buffer[:need])
            del buffer[:need]
            head = None
    if buffer.strip():
        raise ValueError("the archive ends inside a record")


def write_monolithic(pages: DataFrame, out_dir: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes archives that are one gzip stream each; returns (path, page_id, sha1) of the records in them."""
    rows = pages.select(F.col(id_col).cast("string"), F.col(url_col).cast("string"), F.col(html_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path = None, ""
        for b in batches:
            done = []
            for page, url, raw in ((c.as_py() for c in row) for row in zip(b.column(0), b.column(1), b.column(2).cast(pa.binary()), strict=True)):
                if out is None:
                    path = f"{out_dir}/{uuid.uuid4().hex}.warc.gz"
                    system, inner = open_fs(path)
                    system.create_dir(inner.rpartition("/")[0], recursive=True)
                    out, z, size = system.open_output_stream(inner, compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                record = make_record(page, url, raw or b"")
                out.write(z.compress(record))
                size += len(record)
                done.append((path, page, hashlib.sha1(raw or b"").digest()))
                if size >= file_bytes:
                    out.write(z.flush())
                    out.close()
                    out = None
            cols = list(zip(*done, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.binary()), strict=True)], names=["path", "page_id", "sha1"])
        if out is not None:
            out.write(z.flush())
            out.close()

    return cut(rows.mapInArrow(run, "path string, page_id string, sha1 binary").withColumn("page_id", F.col("page_id").cast(pages.schema[id_col].dataType)))


def find_revisits(written: DataFrame) -> DataFrame:
    """(path, page_id, sha1, refers_to) of the records whose payload a record with a smaller id holds."""
    first = written.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    return hot_join(written, first, ["sha1"], "n", written.count()).where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("path", "page_id", "sha1", "refers_to")


def normalise_file(path: str, out_dir: str, revisits: dict[tuple[str | None, str], str]) -> Iterator[tuple]:
    """Rewrites one archive as a member per record beside a sidecar index; yields the index rows.

    revisits: page id and payload digest (base 32) to the id that the record refers to.
    """
    system, inner = open_fs(path)
    target = f"{out_dir}/{uuid.uuid4().hex}.warc.gz"
    to, to_inner = open_fs(target)
    to.create_dir(to_inner.rpartition("/")[0], recursive=True)
    with system.open_input_stream(inner, compression=None) as src, to.open_output_stream(to_inner, compression=None) as out, to.open_output_stream(to_inner + ".idx", compression=None) as index:
        at = 0
        for head, record in split_records(inflate(iter(lambda: src.read(1 << 20), b""))):
            digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
            refers_to = revisits.get((id_of(head.get("x-page-id")), digest))
            kind = "revisit" if refers_to is not None else head.get("warc-type")
            record = record if refers_to is None else as_revisit(record, refers_to)
            z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            member = z.compress(record) + z.flush()
            out.write(member)
            row = (target, at, len(member), kind, head.get("warc-record-id"), digest, head.get("warc-target-uri"))
            index.write(("\t".join(map(str, row[1:])) + "\n").encode())
            at += len(member)
            yield row


def normalise(written: DataFrame, out_dir: str) -> DataFrame:
    """Normalises the archives that hold the written records; returns the index rows of all sidecars.

    A file's revisits come along as a list; it is as long as the file has records at most.
    """
    revisit = F.struct(F.col("page_id").cast("string").alias("page_id"), "sha1", F.col("refers_to").cast("string").alias("refers_to"))
    own = find_revisits(written).groupBy("path").agg(F.collect_list(revisit).alias("revisits"))
    files = written.select("path").distinct().join(own, "path", "left")
    many = written.select("path").distinct().count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, revisits in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                known = {(x["page_id"], base64.b32encode(x["sha1"]).decode()): x["refers_to"] for x in revisits or []}
                found = normalise_file(path, out_dir, known)
                while rows := list(itertools.islice(found, INDEX_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4], strict=True)], names=["path", "offset", "length", "record_type", "record_id", "payload_digest", "target_uri"])

    return cut(files.repartition(max(1, many)).mapInArrow(run, INDEX))


def read_record(member: bytes) -> tuple:
    """(page id, payload bytes, digest, type, refers to) of one member; a stored payload's digest is verified."""
    (head, record), *rest = split_records(inflate(iter([member])))
    if rest:
        raise ValueError("more than one record in a member")
    block = record[record.index(b"\r\n\r\n") + 4 : -4]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(headers_of(http)["content-length"])
    if head["warc-type"] == "response" and (base32_sha1(payload) != digest or len(payload) != size):
        raise ValueError(f"payload and digest differ: {head['warc-record-id']}")
    return id_of(head.get("x-page-id")), size, digest, head["warc-type"], id_of(head.get("x-refers-to-page-id"))


def read_archives(index: DataFrame) -> DataFrame:
    """Reads every record that the index names, by offset and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, src = None, None
        for b in batches:
            rows = []
            for path, offset, length in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if path != opened:
                    if src is not None:
                        src.close()
                    system, inner = open_fs(path)
                    opened, src = path, system.open_input_file(inner)
                src.seek(offset)
                rows.append(read_record(src.read(length)))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.int64(), *[pa.string()] * 3], strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if src is not None:
            src.close()

    return index.select("path", "offset", "length").mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def op5_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to whole-file archives, normalised, and read back record by record."""
    pages, out = table(spark, sf_dir, "pages"), fresh_path(spark, "warc")
    index = normalise(write_monolithic(pages, f"{out}/whole"), f"{out}/members")
    remove(spark, [f"{out}/whole"])
    records = read_archives(index)
    kind = pages.schema["page_id"].dataType
    return records.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


#: DuckDB has SHA-1 as hex digits only: these are read as 4-bit groups and written again as 5-bit ones.
OP5_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
f as (select html, min(page_id) as first_id from p group by html),
r as (
  select p.page_id, strlen(p.html) as payload_bytes, first_id,
         array_to_string(list_transform(regexp_extract_all(sha1(p.html), '.'), lambda c: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][instr('0123456789abcdef', c)]), '') as bits
  from p join f on p.html = f.html)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_reduce(list_transform(range(5), lambda j: cast(substr(bits, cast(k * 5 + j + 1 as bigint), 1) as integer)), lambda a, b: a * 2 + b), 1)), '') as payload_digest,
       case when page_id is not distinct from first_id then 'response' else 'revisit' end as record_type,
       case when page_id is not distinct from first_id then null else first_id end as refers_to
from r
"""

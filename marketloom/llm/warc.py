"""WARC archives with a two-level capture index.

Writing: every page becomes one record.  Of pages with equal payloads (of at
least ``revisit_from`` bytes) the one with the largest id is stored as a
response, the others as revisit records that refer to it.  Each task writes
archives of gzip members, one per record, under a name of its own in the shared
folder and returns the captures it wrote; only captures of tasks that Spark
committed are read, so a lost or repeated task leaves at most an unread file.

Index: captures are sorted by URL key (reversed host, then the rest) and cut
into compressed blocks; an index file ends with its sparse directory of the
first key and the place of every block.  A lookup goes by the first key of the
index files, then binary-searches the directory, and range-reads only the
blocks whose key range holds the key, then only the records found.

Nulls: a null payload is empty; a null URL has the empty key; pages with a null
id take part with the id null (they can be a response only if no page of their
payload has an id).  Repeated rows with the largest id are all responses.  Empty
tables give no archive.  Only id, URL and payload are read, so extra columns of
any name do no harm.  Records are streamed; a task holds one block at a time."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marketloom.llm.common import text_bytes
from marketloom.sources.tables import shared_dir, write_scratch

BLOCK_CAPTURES = 2_000
ARCHIVE_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"

_CAPTURE = "key string, page_id {id}, file string, offset long, length long"
_TO_FILE = "file string, key string"
_TO_BLOCK = "file string, at long, size long, key string"
_FOOTER = "<QQ8s"
_MAGIC = b"2LVINDEX"


def opened(uri: str):
    """File system and path of a folder that all executors share."""
    if "://" not in uri and uri.startswith("file:"):
        uri = uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def url_key(url: str | None) -> str:
    """Reversed lower-case host, a closing bracket, then path and query."""
    rest = (url or "").partition("://")[2] or (url or "")
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:]


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header(name: str, value: str) -> bytes:
    safe = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)
    return f"{name}: {safe}\r\n".encode()


def record(page_id, url: str | None, payload: bytes, original, digest: str, is_response: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and drops the payload."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    )
    block = http + payload if is_response else http
    identity = lambda i: f"<urn:page:{'' if i is None else i}>"
    head = b"WARC/1.1\r\n"
    head += _header("WARC-Type", "response" if is_response else "revisit")
    head += _header("WARC-Record-ID", identity(page_id)) + _header("WARC-Date", DATE)
    if url:
        head += _header("WARC-Target-URI", url)
    head += _header("WARC-Payload-Digest", "sha1:" + digest)
    if not is_response:
        head += _header(
            "WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        head += _header("WARC-Refers-To", identity(original))
    head += _header("Content-Type", "application/http;msgtype=response")
    head += _header("Content-Length", str(len(block)))
    return head + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; a response's digest is computed from its payload
    and must be the one stated."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))[15:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return {
        "payload_bytes": length, "payload_digest": digest, "record_type": kind,
        "refers_to": refers and (refers[len("<urn:page:") : -1] or None),
        "payload": payload if kind == "response" else None,
    }


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
    payload_col: str = "html", revisit_from: int = 0, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per page; the captures (key, page_id, file, offset, length)."""
    source = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(text_bytes(payload_col), F.lit(b"")).alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    groups = source.groupBy("sha1").agg(F.max("page_id").alias("original"))
    linked = source.join(groups, "sha1").withColumn(
        "is_response",
        (F.octet_length("payload") < revisit_from) | F.col("page_id").eqNullSafe(F.col("original")),
    )
    schema = _CAPTURE.format(id=source.schema["page_id"].dataType.simpleString())
    capture_rows = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        filesystem, base = opened(folder)
        filesystem.create_dir(base, recursive=True)
        sink, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    if sink is None or at >= archive_bytes:
                        if sink is not None:
                            sink.close()
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        sink = filesystem.open_output_stream(f"{base}/{name}", compression=None)
                    digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                    data = record(
                        r["page_id"], r["url"], r["payload"], r["original"], digest, r["is_response"]
                    )
                    member = _gzip(data)
                    sink.write(member)
                    rows.append((url_key(r["url"]), r["page_id"], name, at, len(member)))
                    at += len(member)
                yield _batch(rows, capture_rows)
        finally:
            if sink is not None:
                sink.close()

    needed = linked.select("page_id", "url", "payload", "sha1", "original", "is_response")
    return write_scratch(needed.mapInArrow(run, schema), "captures")


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_index(captures: DataFrame, folder: str, block_captures: int = BLOCK_CAPTURES) -> DataFrame:
    """Sorted index files; one row per file: file, first, last (keys), blocks."""
    spark = captures.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, "key", "page_id").sortWithinPartitions(
        "key", "page_id"
    )

    def run(batches):
        filesystem, base = opened(folder)
        filesystem.create_dir(base, recursive=True)
        name = f"index-{uuid.uuid4().hex}.blocks"
        directory, waiting, at, last = [], [], 0, ""
        with filesystem.open_output_stream(f"{base}/{name}", compression=None) as sink:

            def flush(lines):
                nonlocal at
                block = zlib.compress(json.dumps(lines).encode(), 6)
                sink.write(block)
                directory.append((lines[0][0], at, len(block)))
                at += len(block)

            for batch in batches:
                waiting += zip(*(c.to_pylist() for c in batch.columns))
                while len(waiting) >= block_captures:
                    flush(waiting[:block_captures])
                    last, waiting = waiting[block_captures - 1][0], waiting[block_captures:]
            if waiting:
                flush(waiting)
                last = waiting[-1][0]
            listing = zlib.compress(json.dumps(directory).encode(), 6)
            sink.write(listing + struct.pack(_FOOTER, at, len(listing), _MAGIC))
        if directory:
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "first": [directory[0][0]], "last": [last], "blocks": [len(directory)]}
            )

    names = ["key", "page_id", "file", "offset", "length"]
    files = ordered.select(*names).mapInArrow(run, "file string, first string, last string, blocks long")
    return write_scratch(files, "index-files")


def read_directory(source, size: int) -> list:
    """First key, offset and length of every block of an open index file."""
    tail = struct.calcsize(_FOOTER)
    at, length, magic = struct.unpack(_FOOTER, source.read_at(tail, size - tail))
    if magic != _MAGIC:
        raise ValueError("no capture index")
    return json.loads(zlib.decompress(source.read_at(length, at)))


def lookup(index: DataFrame, folder: str, keys: DataFrame, id_type: str = "bigint") -> DataFrame:
    """All captures whose key is in ``keys`` (a column ``key``; repeats count once).

    The list of index files is as long as the number of range partitions that
    wrote them, so the driver may hold it."""
    spark = index.sparkSession
    files = sorted((r["first"], r["last"], r["file"]) for r in index.collect())
    shared = spark.sparkContext.broadcast(files)
    file_rows, block_rows, capture_rows = (
        to_arrow_schema(T.StructType.fromDDL(x))
        for x in (_TO_FILE, _TO_BLOCK, _CAPTURE.format(id=id_type))
    )

    def to_files(batches):
        firsts = [f for f, _, _ in shared.value]
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                at = bisect_right(firsts, key) - 1
                while at >= 0 and shared.value[at][1] >= key:
                    rows.append((shared.value[at][2], key))
                    at -= 1
            yield _batch(rows, file_rows)

    def to_blocks(batches):
        filesystem, base = opened(folder)
        name, directory, firsts = None, [], []
        for batch in batches:
            rows = []
            for file, key in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    path = f"{base}/{file}"
                    size = filesystem.get_file_info(path).size
                    with filesystem.open_input_file(path) as source:
                        directory = read_directory(source, size)
                    name, firsts = file, [d[0] for d in directory]
                # blocks that start at the key, and the one before them
                for at in range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key)):
                    rows.append((file, directory[at][1], directory[at][2], key))
            yield _batch(rows, block_rows)

    def to_captures(batches):
        filesystem, base = opened(folder)
        place, captures, first = None, [], []
        for batch in batches:
            rows = []
            for file, at, size, key in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, at) != place:
                    with filesystem.open_input_file(f"{base}/{file}") as source:
                        captures = json.loads(zlib.decompress(source.read_at(size, at)))
                    place, first = (file, at), [c[0] for c in captures]
                rows += captures[bisect_left(first, key) : bisect_right(first, key)]
            yield _batch(rows, capture_rows)

    routed = keys.select("key").distinct().mapInArrow(to_files, _TO_FILE)
    by_file = routed.repartition("file").sortWithinPartitions("file")
    blocks = by_file.mapInArrow(to_blocks, _TO_BLOCK)
    by_block = blocks.repartition("file", "at").sortWithinPartitions("file", "at")
    return by_block.mapInArrow(to_captures, _CAPTURE.format(id=id_type))


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def read_records(captures: DataFrame, folder: str, id_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """Range-read the captured records: page_id, payload_bytes, payload_digest,
    record_type, refers_to and on request the payload of responses."""
    slices = F.floor(F.col("offset") / (8 << 20))
    placed = captures.repartition("file", slices).sortWithinPartitions("file", "offset")
    schema = f"page_id {id_type}, payload_bytes long, payload_digest string, record_type string, refers_to {id_type}"
    schema += ", payload binary" if with_payload else ""
    record_rows = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        filesystem, base = opened(folder)
        name, source = None, None
        number = int if id_type in ("bigint", "int") else str
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "file", "offset", "length"))
            for page_id, file, offset, length in zip(*columns):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, filesystem.open_input_file(f"{base}/{file}")
                r = parse(zlib.decompress(source.read_at(length, offset), 31))
                refers = None if r["refers_to"] is None else number(r["refers_to"])
                out.append((page_id, r["payload_bytes"], r["payload_digest"], r["record_type"],
                            refers, *((r["payload"],) if with_payload else ())))
            yield _batch(out, record_rows)
        if source is not None:
            source.close()

    return placed.mapInArrow(run, schema)


def archive_and_read(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    revisit_from: int = 0,
) -> DataFrame:
    """Write all pages, index them, look every URL up and read its records back."""
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex[:12]}"
    id_type = pages.schema[id_col].dataType.simpleString()
    captures = write_archives(pages, folder, id_col, url_col, payload_col, revisit_from)
    index = write_index(captures, folder)
    found = lookup(index, folder, captures.select("key"), id_type)
    return read_records(found, folder, id_type).withColumnRenamed("page_id", id_col)

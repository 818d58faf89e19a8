"""Web archives packed in ZIP files: a writer and an index-driven range reader.

A task writes its rows as ZIP files of two stored members: ``archive/data.warc.gz``
(one gzip member per WARC record) and ``indexes/index.cdxj`` (one line per
record: digest, type, offset and length inside the archive member).  The files
lie in a shared folder that all tasks can open through pyarrow's file systems
(a local or mounted path, or a store it knows); a retried task writes new files,
and only those its successful attempt reports are read.

The reader never unpacks a file.  It range-reads the end record (and the ZIP64
locator and end record where sizes are saturated), the central directory, the
local headers of the members it wants, and the index; then it deals the records'
byte ranges to tasks, which read and check just those bytes.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.llm.common import bounded_broadcast, settle, tasks_for

#: Payloads from this size on are stored once and revisited.
REVISIT_BYTES = 100
#: A task starts a new archive after this many compressed bytes.
ARCHIVE_BYTES = 256 * 1024 * 1024
#: Neighbouring records are read together up to this many bytes.
RANGE_BYTES = 4 * 1024 * 1024
#: Compressed bytes that one reading task takes.
TASK_BYTES = 64 * 1024 * 1024
ARCHIVE_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SATURATED = 0xFFFFFFFF


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """The pyarrow file system of a folder and the folder's path in it."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


# --- records -------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def warc_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC 1.1 record; a revisit (``refers_to`` given) keeps the HTTP head and drops the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        safe = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    body = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_record(raw: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of one record; a wrong digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    stated = fields["warc-payload-digest"].removeprefix("sha256:")
    size = int(_fields(http)["content-length"])
    if fields["warc-type"] == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != stated:
            raise ValueError(f"payload of page {fields.get('x-page-id')} does not match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("x-page-id"), "payload_bytes": size, "payload_digest": stated,
            "record_type": fields["warc-type"], "refers_to": number("x-refers-to-page-id")}


# --- ZIP -----------------------------------------------------------------


def zip_members(read: Callable[[int, int], bytes], size: int) -> dict[str, dict]:
    """name -> method, size, packed, header of every member, from the central directory.

    ``read(offset, length)`` returns bytes of the file; only the tail and the
    directory are read.
    """
    tail_at = max(0, size - (22 + 0xFFFF))
    tail = read(tail_at, size - tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end record: not a ZIP file")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if entries == 0xFFFF or length == _SATURATED or start == _SATURATED:
        locator = read(end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("saturated sizes without a ZIP64 locator")
        record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record where the locator points")
        entries, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, members = read(start, length), 0, {}
    for _ in range(entries):
        if directory[at: at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46: at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name: at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: the saturated fields, in this order
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4: 4 + n // 8 * 8]))
                plain = next(wide) if plain == _SATURATED else plain
                packed = next(wide) if packed == _SATURATED else packed
                header = next(wide) if header == _SATURATED else header
            extra = extra[4 + n:]
        members[name] = {"method": method, "size": plain, "packed": packed, "header": header}
        at += 46 + n_name + n_extra + n_comment
    return members


def stored_at(read: Callable[[int, int], bytes], member: dict) -> int:
    """Offset of a stored member's first byte (its local header may be longer than its directory entry says)."""
    if member["method"] != 0:
        raise ValueError("the member is compressed, so its records have no byte ranges")
    head = read(member["header"], 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header where the directory points")
    return member["header"] + 30 + sum(struct.unpack_from("<HH", head, 26))


# --- Spark ---------------------------------------------------------------


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to of every page."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    large = rows.filter(F.octet_length("payload") >= REVISIT_BYTES).select("page_id", "payload_digest")
    shared = settle(large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    table = bounded_broadcast(shared.select("payload_digest", "first"), 128 * shared.count())
    joined = rows.join(table, "payload_digest", "left")
    # smaller payloads have no entry in the table
    is_first = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(~is_first, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page; returns the manifest (path, bytes, records), computed once.

    Of pages with equal payloads of at least REVISIT_BYTES the one with the
    smallest page_id is a response and the others revisit it (rows that repeat
    that page_id are responses too; null ids revisit).  A null html is an empty
    payload.  An empty table writes nothing.
    """
    rows = payloads(pages)
    open_store(folder)[0].create_dir(open_store(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        records = (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist())
        pending = next(records, None)
        while pending is not None:
            path, index, at = f"{base}/{uuid.uuid4().hex}.wacz", [], 0
            with store.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
                with z.open(ARCHIVE_MEMBER, "w", force_zip64=True) as member:
                    while pending is not None and at < archive_bytes:
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        raw = warc_record(pending["page_id"], pending["url"], pending["payload"], pending["payload_digest"], pending["refers_to"])
                        packed = packer.compress(raw) + packer.flush()
                        member.write(packed)
                        kind = "response" if pending["refers_to"] is None else "revisit"
                        index.append(json.dumps({"digest": pending["payload_digest"], "type": kind, "offset": at, "length": len(packed)}))
                        at += len(packed)
                        pending = next(records, None)
                z.writestr(INDEX_MEMBER, "\n".join(index) + "\n")
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": store.get_file_info(path).size, "records": len(index)}])

    return settle(rows.mapInArrow(run, "path string, bytes long, records long"))


def record_ranges(manifest: DataFrame, folder: str) -> DataFrame:
    """(path, offset, length, records): byte ranges of whole records and their lengths, from each file's index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for b in batches:
            for path in b.column("path").to_pylist():
                with store.open_input_file(path) as f:
                    def read(offset, length, f=f):
                        f.seek(offset)
                        return f.read(length)

                    members = zip_members(read, f.size())
                    base = stored_at(read, members[ARCHIVE_MEMBER])
                    listed = read(stored_at(read, members[INDEX_MEMBER]), members[INDEX_MEMBER]["size"])
                ranges: list[dict] = []
                for line in listed.decode().splitlines():
                    entry = json.loads(line)
                    offset = base + entry["offset"]
                    last = ranges[-1] if ranges else None
                    if last and last["offset"] + last["length"] == offset and last["length"] + entry["length"] <= RANGE_BYTES:
                        last["length"] += entry["length"]
                        last["records"].append(entry["length"])
                    else:
                        ranges.append({"path": path, "offset": offset, "length": entry["length"], "records": [entry["length"]]})
                yield pa.RecordBatch.from_pylist(ranges)

    return manifest.mapInArrow(run, "path string, offset long, length long, records array<long>")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the listed files."""
    ranges = record_ranges(manifest, folder)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for b in batches:
            for r in b.to_pylist():
                with store.open_input_file(r["path"]) as f:
                    f.seek(r["offset"])
                    span = memoryview(f.read(r["length"]))
                rows, at = [], 0
                for length in r["records"]:
                    rows.append(parse_record(zlib.decompress(span[at: at + length], 31)))
                    at += length
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    # the rows are a few numbers each, so the task count follows from the bytes that they stand for
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    return ranges.repartition(tasks_for(manifest.sparkSession, total // TASK_BYTES), "path", "offset").mapInArrow(run, schema)


def drop_archives(folder: str) -> None:
    store, base = open_store(folder)
    store.delete_dir(base)

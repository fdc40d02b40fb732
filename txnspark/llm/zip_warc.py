"""WARC records inside ZIP archives, written by Spark tasks and read back by ranges without extraction.

Writing: one archive per task, in a folder that all executors share. An archive has two stored (uncompressed) members:
``data.warc.gz``, one gzip member per record, and ``index.jsonl``, one line per record with its place. Payloads are hashed
first; among equal payloads of at least ``revisit_from`` bytes the record with the largest id is the response, the
others are revisit records without payload. An archive gets a name of its own per attempt and only the names that
finished tasks return are read, so repeated tasks do no harm.

Reading: the end of each archive leads to its central directory (by the ZIP64 records where the classic fields are
full); stored members are located through their local headers; the index lines of an archive are cut into ranges of a few
megabytes of records, which are dealt to tasks; each task reads only its ranges. No archive is read whole.

Defined results: a NULL payload is written as an empty one; NULL ids and urls come back as NULL; among equal payloads
NULL ids are never the largest, and rows that repeat the largest id are all responses; a table without rows writes no
archive and reads no record; extra columns are not written. Archives with members that are compressed, encrypted or split over
volumes raise an error that names the member. Folders are opened with pyarrow's file systems (local, S3, GCS, HDFS).
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.llm.common import scratch, stored, worker_code

worker_code(__name__)

DATA, INDEX = "data.warc.gz", "index.jsonl"
RANGE_BYTES = 4_000_000
TAIL = 65_557  # longest end record: 22 bytes and a comment of 65,535
LOCATOR, END64 = 20, 56


def _uri(path: str) -> str:
    """Spark's names of an object store as Arrow's."""
    for scheme in ("s3a://", "s3n://"):
        if path.startswith(scheme):
            return "s3://" + path[len(scheme) :]
    return path


def _open(path: str):
    path = _uri(path)
    fs, place = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs, place


# --- directory -----------------------------------------------------------------------------------------------------


def directory(f, size: int) -> dict[str, dict]:
    """Members of an archive by name: method, flags, compressed size, place of the local header. ``f`` can seek and read."""
    start = max(0, size - TAIL - LOCATOR)
    f.seek(start)
    tail = f.read(size - start)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    disk, first_disk, _, entries, length, offset, _ = struct.unpack_from("<4H2LH", tail, at + 4)
    if at >= LOCATOR and tail[at - LOCATOR : at - LOCATOR + 4] == b"PK\x06\x07":
        place = struct.unpack_from("<Q", tail, at - LOCATOR + 8)[0]
        f.seek(place)
        end = f.read(END64)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("ZIP64 locator without its end record")
        disk, first_disk, _, entries, length, offset = struct.unpack_from("<2L4Q", end, 16)
    if disk or first_disk:
        raise ValueError("archive over several volumes")
    f.seek(offset)
    raw = f.read(length)
    members, p = {}, 0
    for _ in range(entries):
        if raw[p : p + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method, _, _, _, packed, plain, n, extra, comment, _, _, _, local = struct.unpack_from("<4H3L5H2L", raw, p + 8)
        name = raw[p + 46 : p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        q, stop = p + 46 + n, p + 46 + n + extra
        while q + 4 <= stop:
            tag, width = struct.unpack_from("<2H", raw, q)
            if tag == 1:  # ZIP64: only the fields that are full, in this order
                at64 = q + 4
                if plain == 0xFFFFFFFF:
                    plain, at64 = struct.unpack_from("<Q", raw, at64)[0], at64 + 8
                if packed == 0xFFFFFFFF:
                    packed, at64 = struct.unpack_from("<Q", raw, at64)[0], at64 + 8
                if local == 0xFFFFFFFF:
                    local = struct.unpack_from("<Q", raw, at64)[0]
            q += 4 + width
        members[name] = {"method": method, "flags": flags, "size": packed, "local": local}
        p = stop + comment
    return members


def located(f, name: str, member: dict) -> int:
    """Place of the first byte of a stored member."""
    if member["method"] or member["flags"] & 1:
        raise ValueError(f"{name}: only stored, unencrypted members can be read by ranges")
    f.seek(member["local"])
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"{name}: no local header")
    n, extra = struct.unpack_from("<2H", head, 26)
    return member["local"] + 30 + n + extra


# --- records -------------------------------------------------------------------------------------------------------


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC record; ``refers_to`` makes it a revisit without payload."""
    body = b"" if refers_to is not None else payload
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", "sha1:" + digest(payload)),
        ("WARC-Payload-Length", str(len(payload))),
        ("WARC-Refers-To", None if refers_to is None else f"<urn:page:{refers_to}>"),
        ("WARC-Profile", None if refers_to is None else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("Content-Length", str(len(body))),
    ]
    # A line break in a field would end it, so such fields are written as JSON strings.
    head = "".join(f"{k}: {json.dumps(v) if any(c in v for c in chr(13) + chr(10)) or v[:1] == chr(34) else v}\r\n" for k, v in lines if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    fields = {k: json.loads(v) if v[:1] == '"' else v for k, v in fields.items()}
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("record with another length than it says")
    name = lambda v: v[len("<urn:page:") : -1] or None
    page = name(fields["WARC-Record-ID"])
    refers = fields.get("WARC-Refers-To")
    payload = rest[:n] if fields["WARC-Type"] == "response" else None
    if payload is not None and "sha1:" + digest(payload) != fields["WARC-Payload-Digest"]:
        raise ValueError("payload with another digest than its record says")
    return {
        "page_id": None if page is None else int(page),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_bytes": int(fields["WARC-Payload-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"][5:],
        "refers_to": None if refers is None else int(name(refers)),
        "payload": payload,
    }


# --- writing -------------------------------------------------------------------------------------------------------


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, offset, index = None, 0, []
        fs, place = _open(folder)
        name = f"{uuid.uuid4().hex}.zip"
        for batch in batches:
            for row in zip(*[batch.column(c) for c in ("page_id", "url", "payload", "refers_to")], strict=True):
                page, url, payload, refers = (x.as_py() for x in row)
                if archive is None:
                    out = fs.open_output_stream(f"{place}/{name}", compression=None)
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                    data = archive.open(DATA, "w", force_zip64=True)
                z = zlib.compressobj(1, zlib.DEFLATED, 31)
                raw = record(page, url, payload, refers)
                packed = z.compress(raw) + z.flush()
                data.write(packed)
                index.append(b'{"offset": %d, "length": %d}\n' % (offset, len(packed)))
                offset += len(packed)
        if archive is not None:
            data.close()
            with archive.open(INDEX, "w") as lines:
                for line in index:
                    lines.write(line)
            archive.close()
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [size]}, pa.schema([("path", pa.string()), ("size", pa.int64())]))

    return run


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", revisit_from: int = 0) -> DataFrame:
    """Write one record per row; returns (path, size) of the archives."""
    spark = pages.sparkSession
    fs, place = _open(folder)
    fs.create_dir(place, recursive=True)
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n"))
    # One small row per payload meets the pages; a payload that a third of all pages share is split by the join.
    last = stored(
        rows.where(F.col("n") >= revisit_from).groupBy("sha", "n").agg(F.max("page_id").alias("last"), F.count("*").alias("rows"))
        .where("rows > 1").select("sha", "n", "last"),
        "repeated-payloads",
    )
    refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    marked = rows.join(last, ["sha", "n"], "left").select("page_id", "url", "payload", refers.alias("refers_to"))
    return stored(marked.mapInArrow(_write(folder), "path string, size bigint"), "archives")


# --- reading -------------------------------------------------------------------------------------------------------


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives to ranges of whole records: path, first byte in the archive, lengths of the records."""
    for batch in batches:
        for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
            fs, place = _open(path)
            with fs.open_input_file(place) as f:
                members = directory(f, size)
                data = located(f, DATA, members[DATA])
                at, left, line_end = located(f, INDEX, members[INDEX]), members[INDEX]["size"], b""
                start, lengths, total = None, [], 0
                while left:
                    f.seek(at)
                    block = f.read(min(left, RANGE_BYTES))
                    at, left = at + len(block), left - len(block)
                    *lines, line_end = (line_end + block).split(b"\n")
                    for line in map(json.loads, lines):
                        start = line["offset"] if start is None else start
                        lengths.append(line["length"])
                        total += line["length"]
                        if total >= RANGE_BYTES:
                            yield _range(path, data + start, lengths)
                            start, lengths, total = None, [], 0
                if lengths:
                    yield _range(path, data + start, lengths)


def _range(path: str, first: int, lengths: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path]), pa.array([first], pa.int64()), pa.array([lengths], pa.list_(pa.int64()))], names=["path", "first", "lengths"]
    )


RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )
    for batch in batches:
        for path, first, lengths in zip(*[batch.column(c).to_pylist() for c in ("path", "first", "lengths")], strict=True):
            fs, place = _open(path)
            with fs.open_input_file(place) as f:
                f.seek(first)
                yield pa.RecordBatch.from_pylist([parsed(zlib.decompress(f.read(n), 31)) for n in lengths], schema)


def read(archives: DataFrame) -> DataFrame:
    """All records of the archives given as (path, size); ``payload`` is NULL for revisits."""
    ranges = archives.repartition("path").mapInArrow(_ranges, "path string, first bigint, lengths array<bigint>")
    return ranges.repartition("path", "first").mapInArrow(_read, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages to the shared folder and read the archives back."""
    folder = scratch(spark, "archives")
    if folder.startswith("/"):
        folder = "file://" + folder
    return read(write(pages, folder))

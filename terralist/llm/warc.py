"""WARC archives: a writer with revisits, and a reader that salvages.

Writing: pages with equal payloads are recorded once, as the response of the
largest id; the others are revisits that refer to it.  Each task writes its own
archives, one gzip member per record, into the shared folder, under names that
no other attempt uses; the manifest lists those of the attempts that counted.

Reading: a task reads a byte range of an archive, from the first record that
starts in it to the last; a pass before makes sure that ranges lead to each other.  A record is taken if its member inflates, its headers
and lengths agree and its digests are right.  After a failed check the reader
searches for the next place where a valid member or a version line starts, goes
on there, and logs the bytes in between as a gap with the reason.

Defined results: a null page is an empty payload; payloads under ``min_bytes``
are always responses; rows of one payload that share its largest id are all
responses, rows without an id come last in the choice; null and odd URLs are
left out or escaped; extra columns are not written; no pages give no archives.
A payload that a third of the pages share is a hot join key, which the join
against the written table of repeats lets Spark split.
"""

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window as Window_, functions as F

from terralist.session import cut_lineage, ensure_checkpoint_dir

#: Fixed values of the two formats.
VERSION = b"WARC/1.1"
VERSION_START = b"WARC/1."
MEMBER_START = b"\x1f\x8b\x08"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"

FILE_BYTES = 64 << 20
SPLIT_BYTES = 32 << 20
READ_BYTES = 1 << 20
ID = "urn:page:"


def open_folder(uri):
    """(file system, path) of a folder or file of any store Arrow can reach."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file:///" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def digest_of(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id, url, payload, refers_to=None):
    """One record; a revisit has the headers of the response and no payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", EPOCH),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~-._%")))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<{ID}{refers_to}>"), ("WARC-Profile", SAME_PAYLOAD)]
    headers += [
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def member(record, level=6):
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def with_origin(pages, page_id="page_id", html="html", min_bytes=0):
    """``pages`` with ``payload`` and ``response_id``: null for responses."""
    rows = pages.withColumn("payload", F.coalesce(F.col(html).cast("binary"), F.lit(b"").cast("binary")))
    rows = rows.withColumn("_digest", F.sha1("payload"))
    repeats = cut_lineage(
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("_digest").agg(F.max(page_id).alias("_largest"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").select("_digest", "_largest")
    )
    joined = rows.join(repeats, "_digest", "left")
    other = F.col("_largest").isNotNull() & ~F.col(page_id).eqNullSafe(F.col("_largest"))
    return joined.withColumn("response_id", F.when(other, F.col("_largest"))).drop("_digest", "_largest")


def write_archives(pages, page_id="page_id", url="url", html="html", min_bytes=0, compress=True, folder=None, file_bytes=FILE_BYTES):
    """Write ``pages``; the manifest: (path, bytes, records), one row per archive."""
    spark = pages.sparkSession
    if folder is None:
        ensure_checkpoint_dir(spark)
        folder = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"
    rows = with_origin(pages, page_id, html, min_bytes)
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
    suffix = ".warc.gz" if compress else ".warc"

    def write(batches):
        store, base = open_folder(folder)
        store.create_dir(base, recursive=True)
        context = TaskContext.get()
        stem, number, out, size, count = f"part-{context.partitionId():06d}-{context.taskAttemptId()}", 0, None, 0, 0
        done = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if out is None:
                    name = f"{stem}-{number:04d}{suffix}"
                    out, size, count = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                data = record_bytes(row[0], row[1], row[2], row[3])
                data = member(data) if compress else data
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, count))
                    out, number = None, number + 1
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], schema=schema)

    manifest = rows.select(
        F.col(page_id).cast("string").alias("id"), F.col(url).alias("url"), "payload", F.col("response_id").cast("string").alias("origin"),
    ).mapInArrow(write, "path string, bytes long, records long")
    return cut_lineage(manifest)


class Broken(Exception):
    """A record that fails a check."""


class Window:
    """A file as bytes that are read when asked for and dropped when passed."""

    def __init__(self, file, size):
        self.file, self.size, self.base, self.data = file, size, 0, b""

    def at(self, offset, length):
        """Bytes from ``offset``, fewer at the end of the file."""
        stop = min(self.size, offset + length)
        if offset < self.base or offset > self.base + len(self.data):
            self.base, self.data = offset, b""
        if stop > self.base + len(self.data):
            self.data = self.data[offset - self.base:]
            self.base = offset
            have = self.base + len(self.data)
            self.file.seek(have)
            self.data += self.file.read(max(READ_BYTES, stop - have))
        return self.data[offset - self.base:offset - self.base + length]


def inflate(window, offset):
    """(content, end) of the gzip member at ``offset``."""
    unpack, parts, at = zlib.decompressobj(31), [], offset
    while not unpack.eof:
        chunk = window.at(at, 1 << 16)
        if not chunk:
            raise Broken("member cut short")
        try:
            parts.append(unpack.decompress(chunk))
        except zlib.error:
            raise Broken("member does not inflate") from None
        at += len(chunk) - len(unpack.unused_data)
        if len(parts) == 1 and not VERSION_START.startswith(parts[0][:7]) and not parts[0].startswith(VERSION_START):
            raise Broken("member is no record")
    return b"".join(parts), at


def parse_head(head):
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise Broken("no version line")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Broken("malformed header")
        fields[name.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        raise Broken("no length")
    return fields


def plain_record(window, offset):
    """(head, block, end) of the uncompressed record at ``offset``."""
    length = 1 << 14
    while (stop := window.at(offset, length).find(b"\r\n\r\n")) < 0:
        if offset + length >= window.size or length > 1 << 20:
            raise Broken("no end of headers")
        length *= 4
    head = window.at(offset, stop)
    size = int(parse_head(head)["content-length"])
    begin = offset + stop + 4
    if begin + size + 4 > window.size:
        raise Broken("record cut short")
    block = window.at(begin, size + 4)
    if not block.endswith(b"\r\n\r\n"):
        raise Broken("length does not fit")
    return head, block[:-4], begin + size + 4


def read_record(window, offset):
    """(fields, payload, end) of a valid record at ``offset``; Broken otherwise."""
    start = window.at(offset, len(VERSION))
    if start.startswith(MEMBER_START):
        content, end = inflate(window, offset)
        head, gap, block = content.partition(b"\r\n\r\n")
        if not gap or not block.endswith(b"\r\n\r\n"):
            raise Broken("record cut short")
        block = block[:-4]
    elif start.startswith(VERSION_START):
        head, block, end = plain_record(window, offset)
    else:
        raise Broken("no record starts here")
    fields = parse_head(head)
    if len(block) != int(fields["content-length"]):
        raise Broken("length does not fit")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest_of(block)}":
        raise Broken("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if fields.get("warc-type") == "response" and "warc-payload-digest" in fields:
        if fields["warc-payload-digest"] != f"sha1:{digest_of(payload)}":
            raise Broken("payload digest differs")
    for line in http.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields.setdefault("http-" + name.strip().lower(), value.strip())
    return fields, payload, end


def next_start(window, offset):
    """First place from ``offset`` on where a valid record starts, or the end."""
    at = offset
    while at < window.size:
        chunk = window.at(at, READ_BYTES)
        finds = [chunk.find(mark) for mark in (MEMBER_START, VERSION_START)]
        found = min((f for f in finds if f >= 0), default=-1)
        if found < 0:
            at += max(1, len(chunk) - len(VERSION_START) + 1)
            if at + len(VERSION_START) > window.size:
                break
            continue
        try:
            read_record(window, at + found)
            return at + found
        except Broken:
            at += found + 1
    return window.size


def read_range(window, start, end):
    """Records that start in [start, end), and gaps after them: (kind, offset, end, ...).

    A gap right after the last record belongs to this range even if it starts
    beyond ``end``: the range it starts in only looks for its first valid record.
    """
    at, after = (start if start == 0 else next_start(window, start)), False
    while at < window.size and (at < end or after):
        try:
            fields, payload, stop = read_record(window, at)
        except Broken as problem:
            resumed = next_start(window, at + 1)
            yield "gap", at, resumed, {"reason": str(problem)}, b""
            at, after = resumed, False
            continue
        if at >= end:
            return
        yield "record", at, stop, fields, payload
        at, after = stop, True


def borders(window, start, end):
    """(first, last): where a range of its own finds its first record, and where the next range would have to go on."""
    at = first = start if start == 0 else next_start(window, start)
    after = False
    while at < window.size and (at < end or after):
        try:
            stop = read_record(window, at)[2]
        except Broken:
            at, after = next_start(window, at + 1), False
            continue
        if at >= end:
            break
        at, after = stop, True
    return first, at


def _ranges(archives, split_bytes):
    """(path, bytes, start, end) of ranges of ``split_bytes``."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    return archives.select("path", "bytes", F.explode(starts).alias("start")).withColumn("end", F.col("start") + F.lit(split_bytes))


def misled(archives, split_bytes):
    """(path): archives in which a range begins at a record that the one before does not lead to.

    A payload may hold whole records, of a WARC in a WARC, where a range that begins
    inside of it takes the first for one of the archive.
    """
    def mark(batches):
        for batch in batches:
            out = []
            for path, size, start, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                store, place = open_folder(path)
                with store.open_input_file(place) as file:
                    out.append((path, start, end, *borders(Window(file, size), start, end)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["path", "start", "end", "first", "last"])

    ranges, count = cut_lineage(_ranges(archives.filter(F.col("bytes") > split_bytes), split_bytes), count=True)
    marks = cut_lineage(ranges.repartition(_tasks(archives, count)).mapInArrow(mark, "path string, start long, end long, first long, last long"))
    # As many rows a file as it has ranges.
    led = F.max("last").over(Window_.partitionBy("path").orderBy("start").rowsBetween(Window_.unboundedPreceding, -1))
    empty = (F.col("led") >= F.col("end")) & (F.col("first") >= F.col("end"))
    return marks.withColumn("led", led).filter((F.col("start") > 0) & (F.col("led") != F.col("first")) & ~empty).select("path").distinct()


def _tasks(archives, count):
    return int(max(1, min(count, 64 * archives.sparkSession.sparkContext.defaultParallelism)))


def read_archives(manifest, payload=True, split_bytes=SPLIT_BYTES):
    """Records and gaps of the archives listed as (path, bytes).

    ``kind`` tells records from gaps; ``offset`` and ``end`` are byte positions.
    Archives over ``split_bytes`` are read in ranges after a pass that checks that each
    range begins where the one before leads; those where one does not are read whole.
    """
    archives = manifest.select("path", "bytes")
    bad = cut_lineage(misled(archives, split_bytes))
    whole = archives.join(bad, "path", "left_semi").select("path", "bytes", F.lit(0).cast("long").alias("start"), F.col("bytes").alias("end"))
    splits, count = cut_lineage(_ranges(archives.join(bad, "path", "left_anti"), split_bytes).unionByName(whole), count=True)
    tasks = _tasks(manifest, count)
    schema = pa.schema([
        ("path", pa.string()), ("offset", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("reason", pa.string()),
        ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("url", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ])

    def bare(value):
        return value[1 + len(ID):-1] if value and value.startswith(f"<{ID}") else value

    def read(batches):
        rows, held = [], 0
        for batch in batches:
            for path, size, start, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                store, place = open_folder(path)
                with store.open_input_file(place) as file:
                    for kind, offset, stop, fields, body in read_range(Window(file, size), start, end):
                        url = fields.get("warc-target-uri")
                        length = fields.get("http-content-length", "")
                        rows.append((
                            path, offset, stop, kind, fields.get("reason"), fields.get("warc-type"), bare(fields.get("warc-record-id")),
                            bare(fields.get("warc-refers-to")), url,
                            int(length) if length.isdigit() else len(body) if kind == "record" else None,
                            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                            body if payload and kind == "record" else None,
                        ))
                        held += len(body) if payload else 100
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return splits.select("path", "bytes", "start", "end").repartition(tasks).mapInArrow(
        read, "path string, offset long, end long, kind string, reason string, record_type string, record_id string, "
        "refers_to string, url string, payload_bytes long, payload_digest string, payload binary",
    )


def archive_sql():
    """What the archives of ``pages`` hold, in DuckDB's SQL."""
    bits = "CAST('0x' || substr(x, (i // 8) * 10 + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))"
    return f"""
WITH s AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
b AS (SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((({bits}) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest FROM s),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to FROM m"""

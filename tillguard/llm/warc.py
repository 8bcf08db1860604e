"""WARC archives: a writer and a splittable reader.

Archives are gzip files with one member for each record.  A reader task has a
byte range: it scans for gzip's magic bytes, takes a candidate as a member if
its first decoded bytes are a WARC header whose record decodes in full, and
owns the records that start within its range, reading the last one past its
end.  Any cut of an archive into ranges gives each record once.

Archives lie in the shared checkpoint folder and are opened through
``pyarrow.fs`` (local, HDFS or object stores).  A file's name holds the task
attempt that wrote it; the manifest lists the attempts that succeeded, so what
a lost task leaves behind is never read.

Defined results: a null html is the empty payload; a null URL leaves the
header out; a null page id is the empty urn, read as null, and its record is
always a response that no other refers to; repeated rows are written each; payloads under ``MIN_REVISIT``
bytes are never revisits; records of any length are kept whole; an empty table
gives no records; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, releasing, scratch, written

#: Least payload that another record may refer to.
MIN_REVISIT = 100
#: A writer task begins a new archive at this size; readers split at that.
ARCHIVE_BYTES, SPLIT_BYTES = 1 << 30, 16 << 20
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str, mode: str):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name) if mode == "r" else store.open_output_stream(name, compression=None)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, not compressed; a revisit keeps the HTTP header only."""
    urn = "<urn:page:>" if page_id is None else f"<urn:page:{page_id}>"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {urn}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Rows (page_id, url, payload, digest, refers_to): of equal payloads of at
    least ``MIN_REVISIT`` bytes, the smallest id's record is referred to.
    Only keys are grouped by digest, so a common payload moves no bodies."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"))
    keys = rows.filter(F.octet_length("payload") >= MIN_REVISIT).select("page_id", "digest")
    first = keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    refs = keys.join(first, "digest").filter(F.col("page_id") != F.col("refers_to")).select(
        F.col("page_id").alias("r_page_id"), F.col("digest").alias("r_digest"), "refers_to").distinct()
    refs = written(refs, "warc-references")
    return rows.join(refs, (F.col("page_id") == F.col("r_page_id")) & (F.col("digest") == F.col("r_digest")), "left").select(
        "page_id", "url", "payload", "digest", "refers_to")


def write(records: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes records (page_id, url, payload, digest, refers_to) to archives
    under ``folder``; returns the manifest (path, bytes, records)."""
    spark = records.sparkSession
    folder = folder or scratch(spark, "warc-archives")
    bound_batches(spark)
    jvm = spark.sparkContext._jvm
    jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:") if folder.startswith(("/", "file:/")) else folder

    def run(batches):
        task = TaskContext.get()
        stem, part = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}", 0
        out, path, size, n, made = None, "", 0, 0, []
        for b in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    path, size, n = f"{stem}-{part:04d}.warc.gz", 0, 0
                    out, part = _open(path, "w"), part + 1
                data = member(record(page_id, url, payload, digest, refers_to))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    out.close()
                    out = made.append((path, size, n))
        if out is not None:
            out.close()
            made.append((path, size, n))
        cols = list(zip(*made)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                                         ["path", "bytes", "records"])

    cols = records.select("page_id", "url", "payload", "digest", "refers_to")
    return written(cols.mapInArrow(releasing(run), "path string, bytes long, records long"), "warc-manifest")


class _Window:
    """Bytes of a file from a moving position, read in blocks."""

    def __init__(self, file, size: int, start: int, block: int = 1 << 20):
        self.file, self.size, self.block = file, size, block
        self.at, self.data = start, b""
        file.seek(start)

    def more(self) -> bool:
        new = self.file.read(min(self.block, self.size - self.at - len(self.data)))
        self.data += new
        return bool(new)

    def skip(self, n: int) -> None:
        self.at, self.data = self.at + n, self.data[n:]


def _member_at(w: _Window, at: int) -> tuple[bytes, int] | None:
    """The record in a member that starts ``at`` bytes into the window, with
    its compressed length; None if no WARC record starts there."""
    d, out, fed = zlib.decompressobj(31), bytearray(), at
    try:
        while not d.eof:
            if fed == len(w.data) and not w.more():
                return None
            step = 256 if fed == at else 1 << 16  # a short look first
            out += d.decompress(w.data[fed:fed + step])
            fed = min(fed + step, len(w.data))
            if len(out) >= 7 and not out.startswith(b"WARC/1."):
                return None
    except zlib.error:
        return None
    head, sep, rest = bytes(out).partition(b"\r\n\r\n")
    length = _header(head).get("content-length", "")
    if not sep or not head.startswith(b"WARC/1.") or not length.isdigit() or len(rest) != int(length) + 4:
        return None
    return bytes(out), fed - len(d.unused_data) - at


def _header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records_in(file, size: int, start: int, end: int):
    """Records whose members start in [start, end) of an archive."""
    w = _Window(file, size, start)
    while w.at < end:
        at = w.data.find(MAGIC)
        if at < 0:
            keep = min(len(w.data), len(MAGIC) - 1)
            w.skip(len(w.data) - keep)
            if not w.more():
                return
        elif w.at + at >= end:
            return
        elif (got := _member_at(w, at)) is None:
            w.skip(at + 1)
        else:
            w.skip(at + got[1])
            yield got[0]


def parse(data: bytes) -> tuple:
    """(page_id, url, payload, payload bytes, digest, type, refers_to) of a
    record; a revisit's payload is null, its length that of the HTTP header."""
    head, _, rest = data.partition(b"\r\n\r\n")
    h = _header(head)
    block = rest[:int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: x.removeprefix("<urn:page:").removesuffix(">")
    page = lambda x: int(number(x)) if number(x) else None
    kind = h["warc-type"]
    if kind == "revisit":
        return (page(h["warc-record-id"]), h.get("warc-target-uri"), None, int(_header(http)["content-length"]),
                h["warc-payload-digest"].removeprefix("sha256:"), kind, page(h["warc-refers-to"]))
    return (page(h["warc-record-id"]), h.get("warc-target-uri"), payload, len(payload), hashlib.sha256(payload).hexdigest(), kind, None)


RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the archives of a manifest (path, bytes, ...)."""
    splits = manifest.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    n = max(1, splits.count())
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def run(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for b in batches:
            for path, size, start in zip(*(c.to_pylist() for c in b.columns)):
                rows, held = [], 0
                with _open(path, "r") as f:
                    for data in records_in(f, size, start, min(size, start + split_bytes)):
                        rows.append(parse(data))
                        held += len(data)
                        if held > 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return splits.repartition(min(n, 100_000)).mapInArrow(releasing(run), RECORDS)


def digest(pages: DataFrame) -> DataFrame:
    return read(write(with_revisits(pages))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

"""WARC archives: written as gzip members, and read back in byte ranges by many tasks.

Every record is a gzip member of its own. A reading task is given a range of bytes of a file. It
looks for the first bytes of a gzip member in its range, takes a place for a member only
if decoding from there gives the head of a WARC record, and reads the records that begin
in its range, also beyond its end. So each record is read by one task, a large file
is read by many, and no index is needed. Bytes that only look like a member, within
another one's compressed data, do not decode to such a head.

Files are opened through ``pyarrow.fs``, by the URI of the folder. Names hold the number of the
task attempt: what a lost attempt has written is never listed, and nothing is overwritten.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.storage import shared_folder, stored

# Payloads shorter than this are written each time they come.
REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
MAGIC = b"\x1f\x8b\x08"
HEAD = b"WARC/1."
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, "
    "refers_to long, path string, offset long"
)


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member with a response record, or with a revisit record if it refers to a page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    own = hashlib.md5(f"{page_id}\n{digest}".encode()).hexdigest()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{own[:8]}-{own[8:12]}-{own[12:16]}-{own[16:20]}-{own[20:]}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def parse(raw: bytes) -> dict:
    """Fields of a decoded record; ``payload`` is None for a revisit record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    number = {k: int(fields[k]) if k in fields else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")}
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": number["X-Page-Id"],
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload": None if revisit else payload,
        "payload_bytes": size if revisit else len(payload),
        "payload_digest": fields["WARC-Payload-Digest"][7:] if revisit else hashlib.sha256(payload).hexdigest(),
        "refers_to": number["X-Refers-To-Page-Id"],
    }


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Page id, url, payload, its size and digest, and the page it refers to if it repeats one.

    Of equal payloads of at least ``least`` bytes the one of least page id is kept. Rows that
    share that id are all kept; a null id is never the least unless all are null, and then
    all rows are kept. A null html is an empty payload.
    """
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    first = (
        rows.filter(F.length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null")
        .drop("n")
    )
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    joined = rows.join(first, "digest", "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``with_revisits`` and list the files: path, bytes, records."""

    def write(batches):
        system, base = _system(folder)
        system.create_dir(base, recursive=True)
        context = TaskContext.get()
        name = f"{base}/part-{context.partitionId():06d}-{context.taskAttemptId()}"
        done, out, size, records = 0, None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{name}-{done:04d}.warc.gz"
                    out, size, records = system.open_output_stream(path, compression=None), 0, 0
                member = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= file_bytes:
                    out.close()
                    yield _listed(path, size, records)
                    done, out = done + 1, None
        if out is not None:
            out.close()
            yield _listed(path, size, records)

    prefix = folder.split("://", 1)[0] + "://" if "://" in folder else ""
    listed = stored(rows.mapInArrow(write, "path string, bytes long, records long"))
    return listed.withColumn("path", F.concat(F.lit(prefix), "path"))


def _listed(path: str, size: int, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": records}])


def _candidates(file, start: int, stop: int, block: int = 1 << 20) -> Iterator[int]:
    """Places in the range where a gzip member may begin."""
    at = start
    while at < stop:
        file.seek(at)
        data = file.read(min(block, stop - at) + len(MAGIC) - 1)
        found = data.find(MAGIC)
        while found >= 0:
            yield at + found
            found = data.find(MAGIC, found + 1)
        at += block


def _member(file, start: int, block: int = 1 << 18) -> tuple[bytes, int] | None:
    """The decoded member at a place and where it ends; None if it is no WARC record."""
    unpacker = zlib.decompressobj(31)
    file.seek(start)
    parts, at, sure = [], start, False
    while not unpacker.eof:
        data = file.read(block if sure else 4096)
        if not data:
            return None
        try:
            parts.append(unpacker.decompress(data))
        except zlib.error:
            return None
        at += len(data)
        if not sure:
            head = b"".join(parts)[: len(HEAD)]
            if not HEAD.startswith(head):
                return None
            sure = len(head) == len(HEAD)
    return (b"".join(parts), at - len(unpacker.unused_data)) if sure else None


def records_in(file, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Place and decoded bytes of every record that begins in a range of an open file."""
    after = start
    for place in _candidates(file, start, stop):
        if place < after:
            continue
        found = _member(file, place)
        if found:
            after = found[1]
            yield place, found[0]


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the listed files (``path``, ``bytes``), read in ranges.

    A file without records, or cut in the middle of one, gives the whole records it has.
    Digests and sizes of responses are taken from the payload as it was read.
    """
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes)))
    ranges = files.select("path", "bytes", starts.alias("start"))
    # A task for each range: so many on purpose, as a range is a few bytes here and much to read.
    total = files.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0]
    ranges = ranges.repartition(max(1, int(total or 0)), F.col("path"), F.col("start"))
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
            ("path", pa.string()), ("offset", pa.int64()),
        ]
    )

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, base = _system(row["path"])
                held, size = [], 0
                with system.open_input_file(base) as file:
                    stop = min(row["start"] + range_bytes, row["bytes"])
                    for place, raw in records_in(file, row["start"], stop):
                        held.append(parse(raw) | {"path": row["path"], "offset": place})
                        size += len(raw)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    return ranges.mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record per page into a shared folder and read all of them back."""
    folder = folder or shared_folder(pages.sparkSession) + "/warc"
    return read_archives(write_archives(with_revisits(pages), folder))

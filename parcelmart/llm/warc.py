"""WARC archives: a writer, and a splittable reader of compressed files.

Every record is a gzip member of its own. A reading task gets a byte range of a file. It scans the
range for the gzip magic, takes a candidate for a record only if it decodes to a WARC header, and
owns the records that start inside its range, to their ends wherever those lie. Ranges need no index
and no look at other ranges, so a lost task is simply run again.

Files are opened through the file system of their URI, in the folder the caller names, which every
executor must reach.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import mapped, written

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = b"\r\n\r\n"

READ_BYTES = 1 << 20
MOST_TASKS = 20_000  # beyond it a task reads several ranges
ARCHIVES = "path string, bytes long, records long"


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + BREAK + block + BREAK


def _page_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page_record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    fields = [("WARC-Record-ID", _page_id(page)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is None:
        return _record("response", fields, http + payload)
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _page_id(refers_to))]
    return _record("revisit", fields, http)


def _write(folder: str, target: int, level: int, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        file = None
        done: dict[str, list] = {"path": [], "bytes": [], "records": []}

        def close() -> None:
            file.close()
            done["path"].append(f"{folder}/{name}")
            done["bytes"].append(size)
            done["records"].append(records)

        def member(data: bytes) -> bytes:
            packer = zlib.compressobj(level, zlib.DEFLATED, 31)
            return packer.compress(data) + packer.flush()

        for batch in batches:
            for page, url, html, digest, refers_to in zip(*batch.columns, strict=True):
                if file is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"  # an attempt that fails leaves a file that no manifest names
                    store.create_dir(top, recursive=True)
                    file = store.open_output_stream(f"{top}/{name}", compression=None)
                    info = _record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date)], b"")
                    size, records = 0, 0
                    size += file.write(member(info))
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                data = _page_record(page.as_py(), url.as_py(), payload, digest.as_py(), refers_to.as_py(), date)
                size += file.write(member(data))
                records += 1
                if size >= target:
                    close()
                    file = None
        if file is not None:
            close()
        yield pa.record_batch(
            [pa.array(done["path"], pa.string()), pa.array(done["bytes"], pa.int64()), pa.array(done["records"], pa.int64())],
            names=["path", "bytes", "records"],
        )

    return write


def write_archives(
    pages: DataFrame,
    folder: str,
    smallest_revisit: int = 1000,
    target_bytes: int = 64 << 20,
    level: int = 3,
    date: str = "2020-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record for each row of ``pages`` (page_id, url, html) under ``folder`` and returns
    the manifest: path, bytes and records (of pages) of each file.

    Of rows with equal payloads of at least ``smallest_revisit`` bytes, those with the largest page_id
    are responses and the others revisits of that id; a null id is below all others, and if all are
    null all are responses. A null html is an empty payload, a null url is left out, and characters
    that a header cannot hold are percent-encoded. Repeated rows of the largest id are each a
    response. Other columns are ignored. An empty table writes no file.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html"))
    copies = (
        rows.filter(F.octet_length("html") >= smallest_revisit)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1 and refers_to is not null")
        .select("digest", "refers_to")
    )
    # only copies are joined back by their digest; a copied digest is one row on the right side
    marked = (
        rows.join(copies, "digest", "left")
        .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("refers_to")), F.col("refers_to")))
        .select("page_id", "url", "html", "digest", "refers_to")
    )
    return written(mapped(marked, _write(folder, target_bytes, level, date), ARCHIVES), "warc-manifest")


class _Range:
    """Reads a file from an offset on, in steps, and keeps what has not been passed yet."""

    def __init__(self, file, start: int):
        self.file, self.at, self.data, self.ended = file, start, b"", False
        file.seek(start)

    def more(self) -> bool:
        got = self.file.read(READ_BYTES)
        self.ended = not got
        self.data += got
        return bool(got)

    def skip(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n

    def next_magic(self, end: int) -> bool:
        """Moves to the next magic that starts before ``end``."""
        while True:
            found = self.data.find(MAGIC)
            if found >= 0:
                self.skip(found)
                return self.at < end
            self.skip(max(0, len(self.data) - len(MAGIC) + 1))
            if self.at >= end or not self.more():
                return False

    def member(self) -> bytes | None:
        """The content of the member here, past which it moves; None if what is here is no member
        that begins with a WARC header, however long that is."""
        unpacker, out, fed, checked = zlib.decompressobj(31), [], 0, False
        head, searched = bytearray(), 0
        while True:
            if fed == len(self.data) and not self.more():
                if checked:
                    raise ValueError(f"a record at byte {self.at} is cut off")
                return None
            try:
                made = unpacker.decompress(self.data[fed:])
            except zlib.error as error:
                if checked:
                    raise ValueError(f"a record at byte {self.at} is damaged") from error
                return None
            fed = len(self.data)
            out.append(made)
            if not checked:
                head += made
                if not head.startswith(b"WARC/1."[: len(head)]):
                    return None
                stop = head.find(BREAK, max(0, searched - len(BREAK)))
                searched = len(head)
                checked = stop >= 0 and re.search(rb"(?i)\r\nContent-Length:[ \t]*[0-9]+[ \t]*\r\n", head[: stop + 2]) is not None
                if not checked and (stop >= 0 or unpacker.eof):
                    return None
            if unpacker.eof:
                self.skip(fed - len(unpacker.unused_data))
                return b"".join(out)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of the records of a member, usually one."""
    at = 0
    while at < len(data):
        stop = data.index(BREAK, at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError("a member goes on with something other than a record")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        begin = stop + len(BREAK)
        end = begin + int(headers["content-length"])
        if end > len(data):
            raise ValueError("a record is shorter than its Content-Length")
        yield headers, data[begin:end]
        at = end
        while data[at : at + 2] == b"\r\n":
            at += 2


RECORDS = (
    "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _fields(headers: dict[str, str], block: bytes) -> tuple:
    kind = headers.get("warc-type")
    head, found, payload = block.partition(BREAK)
    if not headers.get("content-type", "").startswith("application/http") or not found:
        head, payload = b"", block
    told = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        length = re.search(rb"(?i)\r\nContent-Length:[ \t]*([0-9]+)", head)
        size, digest, payload = int(length[1]) if length else None, told or None, None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if re.fullmatch("[0-9a-f]{40}", told) and told != digest:
            raise ValueError(f"the payload of {headers.get('warc-record-id')} does not have its digest")
    return kind, headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-refers-to"), size, digest, payload


def _read(payloads: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, place = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(place) as file:
                    part = _Range(file, start)
                    while part.next_magic(end):
                        at = part.at
                        data = part.member()
                        if data is None:
                            part.skip(1)
                            continue
                        for headers, block in parse_records(data):
                            fields = _fields(headers, block)
                            rows.append((path, at, *(fields if payloads else (*fields[:-1], None))))
                            held += len(block) if payloads else 100
                        if held > 4 * READ_BYTES:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return read


def read_records(archives: DataFrame, split_bytes: int = 4 << 20, payloads: bool = True) -> DataFrame:
    """The records of the files that a manifest (path, bytes) names, but for warcinfo: path, offset,
    record_type, record_id, target_uri, refers_to, payload_bytes, payload_digest (SHA-1 in lower-case
    hexadecimal, of the full payload), payload (null for revisits and without ``payloads``).

    Files are cut into ranges of ``split_bytes``. A payload whose digest is not the one its header
    states, and a record that is cut off or damaged behind its header, raise an error; bytes between
    members are passed over. Empty files give no rows.
    """
    ranges = (
        archives.filter("bytes > 0")
        .select("path", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"))
        .withColumn("end", F.col("start") + split_bytes)
    )
    # rows this small would all be put in one task; a stated number of partitions is kept
    ranges = ranges.repartition(max(1, min(ranges.count(), MOST_TASKS)))
    return mapped(ranges, _read(payloads), RECORDS).filter("record_type <> 'warcinfo'")


def unread_records(archives: DataFrame, records: DataFrame) -> DataFrame:
    """(path, records, found) of the files from which another number of page records was read than the
    manifest of ``write_archives`` states. Only counts by file are compared."""
    found = records.groupBy("path").agg(F.count("*").alias("found"))
    both = archives.select("path", "records").join(found, "path", "full_outer")
    counts = both.select("path", "records", F.coalesce("found", F.lit(0).cast("long")).alias("found"))
    return counts.filter(~F.col("records").eqNullSafe(F.col("found")))

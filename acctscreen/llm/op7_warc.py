"""WARC archives: distributed writer and splittable reader.

Each record is a gzip member.  The reader deals out byte ranges of the
files; a task looks for the magic of gzip in its range, takes a place for a
member only if what it decodes there begins as a WARC record with a length,
and owns the records that start inside its range (it reads past the range's
end to finish the last one).  Files are reached through Arrow's file
systems, so any shared store that has one will do.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctscreen.llm.common import Scratch

MAGIC = b"\x1f\x8b\x08"
RANGE = 4 << 20
BLOCK = 1 << 18
#: Bytes that a member is decoded by: little is decoded or copied beyond its end.
PIECE = 1 << 13
HEAD = b"WARC/1."
PAGE = "urn:x-page:"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(url: str) -> str:
    """No control character may end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record as a gzip member.  A revisit has the headers of
    its payload (digest and length), not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}"]
    head += [f"WARC-Target-URI: {_clean(url)}"] if url else []
    head += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", "Content-Type: application/http;msgtype=response"]
    head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{PAGE}{refers_to}>"] if revisit else []
    head += [f"Content-Length: {len(block)}", "", ""]
    deflate = zlib.compressobj(5, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + deflate.flush()


# -- writer --------------------------------------------------------------------

def record_types(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``revisit`` and ``refers_to``.

    Of pages of equal payload the one with the largest page_id is the
    response (rows that repeat that id too), the others revisit it.  Only the
    digests are grouped: a group of any size comes down to one row in each task."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select("page_id", "url", "html", F.sha1(payload).alias("_digest"))
    # Grouped on a struct, they reach the join by a shuffle of their own, and the pages of a payload can be split over tasks.
    last = p.groupBy(F.struct("_digest").alias("_k")).agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    out = p.join(last.select("_k._digest", "_last"), "_digest", "left")
    revisit = F.col("_last").isNotNull() & ~F.col("_last").eqNullSafe(F.col("page_id"))
    return out.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("_last")).alias("refers_to"))


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        out, name, n = None, f"{path}/{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            for k in range(batch.num_rows):
                page_id, url, html, revisit, refers_to = (batch.column(c)[k].as_py() for c in range(5))
                if out is None:
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(name, compression=None)  # the members are compressed already
                out.write(record(page_id, url, (html or "").encode(), refers_to, revisit))
                n += 1
        if out is not None:
            out.close()
            size = fs.get_file_info(name).size
            yield pa.RecordBatch.from_pydict({"file": [name.rsplit("/", 1)[-1]], "bytes": [size], "records": [n]}, schema=pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return write


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages`` into archives in ``folder`` and returns the stored
    list of them (file, bytes, records).  A task that is run again writes a
    file of another name; only files of tasks that ended well are listed."""
    found = record_types(pages).mapInArrow(_writer(f"{folder}/archives"), "file string, bytes long, records long")
    listed = f"{folder}/listed"
    found.write.parquet(listed)
    return pages.sparkSession.read.schema(found.schema).parquet(listed)


# -- reader --------------------------------------------------------------------

class _Bytes:
    """A file read in blocks, one of which is kept.  What it holds from a place
    on is served first; the file is read on when that is used up."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def get(self, start: int, n: int = BLOCK, least: int = 1) -> bytes:
        """Up to ``n`` bytes from ``start``; ``least`` of them, if the file has so many."""
        k = start - self.at
        if not 0 <= k <= len(self.data) - min(least, max(self.size - start, 0)):
            self.file.seek(start)
            self.at, self.data, k = start, self.file.read(BLOCK), 0
        return self.data[k : k + n]


def _member(source: _Bytes, at: int) -> tuple[bytes, int] | None:
    """The record that begins at ``at`` and the place after its member, or
    None if no whole member with the head of a record is there."""
    inflate, out, size, place, head = zlib.decompressobj(31), [], 0, at, False
    try:
        while not inflate.eof:
            piece = source.get(place, PIECE)
            if not piece:
                return None
            out.append(inflate.decompress(piece))
            size += len(out[-1])
            if not head and (size >= len(HEAD) or inflate.eof):
                head = b"".join(out).startswith(HEAD)
                if not head:
                    return None
            place += len(piece)
    except zlib.error:
        return None
    return b"".join(out), place - len(inflate.unused_data)


def _headers(lines: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:])}


def _id(urn: str | None) -> int | None:
    found = re.fullmatch(rf"<{re.escape(PAGE)}(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def records_in(source: _Bytes, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records that start in [start, end)."""
    at = start
    while at < end:
        piece = source.get(at, BLOCK, len(MAGIC))
        k = piece.find(MAGIC)
        if k < 0:
            if len(piece) < len(MAGIC):
                return
            at += len(piece) - len(MAGIC) + 1
            continue
        at += k
        if at >= end:
            return
        found = _member(source, at)
        if found is not None:
            data, after = found
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = _headers(head)
            length = fields.get("content-length", "")
            if length.isdigit() and len(rest) == int(length) + 4 and "warc-type" in fields:
                yield fields, rest[: int(length)]
                at = after
                continue
        at += 1


SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string"
_FIELDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.string())])


def _reader(folder: str, with_payload: bool):
    def row(fields: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        kind, told = fields["warc-type"], fields.get("warc-payload-digest", "").rpartition(":")[2]
        if kind == "response":
            size, digest = len(payload), base32_sha1(payload)
            if told and told != digest:
                raise ValueError(f"payload of {fields.get('warc-record-id')} is damaged: {digest} is not {told}")
        else:
            size, digest = int(_headers(http)["content-length"]), told
        text = payload.decode() if with_payload and kind == "response" else None
        return _id(fields.get("warc-record-id")), size, digest, kind, _id(fields.get("warc-refers-to")), fields.get("warc-target-uri"), text

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, size, start, end in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                with fs.open_input_file(f"{path}/{name}") as file:
                    rows, held = [], 0
                    for found in records_in(_Bytes(file, size), start, end):
                        rows.append(row(*found))
                        held += len(rows[-1][-1] or "") + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=_FIELDS)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=_FIELDS)

    return read


def read_warc(spark: SparkSession, listed: DataFrame, folder: str, range_bytes: int = RANGE, with_payload: bool = True) -> DataFrame:
    """Records of the listed archives (see SCHEMA).  A response's payload is
    decoded and checked against its digest; a revisit's is null, its size and
    digest come from its headers."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))
    ranges = listed.filter("bytes > 0").select("file", "bytes", F.explode(starts).alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("bytes"), F.col("start") + range_bytes))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(n, "file", "start").mapInArrow(_reader(f"{folder}/archives", with_payload), SCHEMA)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes all of ``pages`` (null html: empty payload), then reads the
    archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    scratch = Scratch(pages.sparkSession, "warc")
    listed = write_warc(pages.select("page_id", "url", "html"), scratch.root)
    out = read_warc(pages.sparkSession, listed, scratch.root, with_payload=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

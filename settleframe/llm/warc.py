"""WARC archives of web pages: a writer run by Spark tasks and a sequential reader.

Writing: one gzip member per record, archives of a bounded size in a shared
folder, and a manifest table naming the archives of the task attempts that
succeeded; files of lost attempts are simply not in it. A page whose payload of
at least ``MIN_REVISIT`` bytes equals that of a page with a smaller id becomes a
``revisit`` record: the HTTP header and the payload's digest, without the payload.

Reading: members are inflated piece by piece (``zlib`` in chunks, never a whole
archive), records are framed by Content-Length, and block and payload digests are
verified. One task reads one archive at a time; only a single record is in memory.

Defined results: null html is the empty payload, a null url has no target header.
The smallest id counts as in SQL ``min`` (null ids last); rows that repeat the
smallest id are all responses. A group whose ids are all null is all responses.
Extra columns are not carried. An empty table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settleframe.llm.workers import ship
from settleframe.session import scratch_path

MIN_REVISIT = 100
ARCHIVE_BYTES = 128 << 20
CHUNK = 1 << 16
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"


def open_shared(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI (``file:``, ``hdfs:``, ``s3:``, ...)."""
    uri = re.sub(r"^file:/(?=[^/])", "file:///", uri)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = DATE) -> bytes:
    """One record as a gzip member; with ``refers_to`` a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=-._~"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{_sha(payload)}",
              f"WARC-Block-Digest: sha256:{_sha(block)}", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class WarcError(ValueError):
    """A damaged archive: cut short, badly framed, or with a wrong digest."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    offset: int                  # of the gzip member in the archive
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""

    @property
    def type(self) -> str:
        return self.headers["warc-type"]

    def page(self, header: str) -> int | None:
        value = self.headers.get(header, "").strip("<>").removeprefix(_ID)
        return int(value) if value else None

    @property
    def payload_bytes(self) -> int:
        """Of the full payload, which a revisit does not hold."""
        return int(self.http["content-length"])

    @property
    def payload_digest(self) -> str:
        return self.headers["warc-payload-digest"].removeprefix("sha256:")


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}


class _Member:
    """Bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, stream: BinaryIO, left: bytes):
        self._stream, self._input, self._inflate, self._ready = stream, left, zlib.decompressobj(31), bytearray()
        self.used = 0

    def _more(self) -> bool:
        if self._inflate.eof:
            return False
        if not self._input:
            self._input = self._stream.read(CHUNK)
            if not self._input:
                raise WarcError("the archive ends inside a gzip member")
        try:
            out = self._inflate.decompress(self._input, CHUNK)
        except zlib.error as e:
            raise WarcError(f"bad gzip member: {e}") from e
        rest = self._inflate.unused_data if self._inflate.eof else self._inflate.unconsumed_tail
        self.used += len(self._input) - len(rest)
        self._input = bytes(rest)
        self._ready += out
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (found := self._ready.find(mark, at)) < 0:
            at = max(0, len(self._ready) - len(mark) + 1)
            if not self._more():
                raise WarcError("a record header does not end")
        out = bytes(self._ready[:found])
        del self._ready[: found + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self._ready) < n:
            if not self._more():
                raise WarcError("a record is shorter than its Content-Length")
        out = bytes(self._ready[:n])
        del self._ready[:n]
        return out

    def finish(self) -> bytes:
        """To the member's end, where nothing may be left; input behind it."""
        while self._more():
            pass
        if self._ready:
            raise WarcError("a gzip member goes on after its record")
        return self._input


def read_records(stream: BinaryIO) -> Iterator[Record]:
    """Records of an archive in order, framed and verified."""
    left, offset = stream.read(CHUNK), 0
    while left:
        member = _Member(stream, left)
        version, *lines = member.until(b"\r\n\r\n").split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise WarcError(f"not a WARC record at {offset}")
        record = Record(_fields(lines), b"", offset)
        record.block = member.exactly(int(record.headers["content-length"]))
        if member.exactly(4) != b"\r\n\r\n":
            raise WarcError(f"the record at {offset} has no end mark")
        if record.headers["warc-block-digest"] != "sha256:" + _sha(record.block):
            raise WarcError(f"the block at {offset} does not match its digest")
        head, mark, record.payload = record.block.partition(b"\r\n\r\n")
        record.http = _fields(head.split(b"\r\n")[1:]) if mark else {}
        if record.type == "response" and (record.payload_digest != _sha(record.payload) or record.payload_bytes != len(record.payload)):
            raise WarcError(f"the payload at {offset} does not match its digest or length")
        yield record
        left = member.finish() or stream.read(CHUNK)
        offset += member.used


def _writer(folder: str, archive_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_shared(folder)
        out = name = None
        size = count = 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [count], "bytes": [size]},
                                              pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                size += out.write(data := record_bytes(page_id.as_py(), url.as_py(), (html.as_py() or "").encode(), refers_to.as_py(), date)) or len(data)
                count += 1
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()
    return run


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = DATE) -> DataFrame:
    """Write the pages to archives in ``folder`` and return the stored manifest
    (archive, records, bytes)."""
    spark = pages.sparkSession
    ship(spark)
    fs, base = open_shared(folder)
    fs.create_dir(base, recursive=True)
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size"))
    # The first page of each payload that occurs again; map-side combined.
    first = (rows.filter(F.col("size") >= min_revisit).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    # Stored, so that its true size is known to the join: a small one is broadcast
    # and no page is shuffled.
    first.write.parquet(f"{folder}/first")
    first = spark.read.schema("digest string, first long").parquet(f"{folder}/first")
    # The equi-join stays free of grouping above it: AQE broadcasts a small side and splits a hot digest.
    dealt = rows.join(first, "digest", "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    schema = "archive string, records long, bytes long"
    dealt.mapInArrow(_writer(folder, archive_bytes, date), schema).write.parquet(f"{folder}/manifest")
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def _reader(folder: str):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_shared(folder)
        for batch in batches:
            for archive, records in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows, read = [], 0
                with fs.open_input_stream(f"{base}/{archive}", compression=None) as stream:
                    for r in read_records(stream):
                        read += 1
                        rows.append((r.page("warc-record-id"), r.payload_bytes, r.payload_digest, r.type,
                                     r.page("warc-refers-to"), archive, r.offset))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                if read != records:
                    raise WarcError(f"{archive} has {read} records, the manifest says {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return run


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type,
    refers_to, archive, offset."""
    ship(spark)
    files = max(1, manifest.count())
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "archive string, offset long")
    # One archive per task: a file is read from its start to its end.
    return manifest.select("archive", "records").repartition(files).mapInArrow(_reader(folder), schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to a fresh folder under the shared work folder and read them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    return read_archives(spark, folder, write_archives(pages, folder))

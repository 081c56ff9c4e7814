"""WARC archives: a writer that stores equal payloads once, and a sequential reader.

Every record is a gzip member of its own. A payload that a later page repeats becomes a revisit record, which keeps the HTTP
header with the length of the full payload and names the record that holds it. The reader takes a stream of bytes in pieces,
inflates one member after another, frames blocks by Content-Length and verifies block and payload digests.

Archives are written by the tasks through :mod:`pyarrow.fs`, so the folder can be on any file system that it knows and all
executors share; a file gets its final name only when it is whole, and a task that runs again writes the same bytes under
the same name. Spark lists the archives to read; the tasks open them through the same module and take them piece by piece,
so that an archive may be of any size: a task holds one record and the rows of one batch.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import scratch

#: Payloads of fewer bytes are always stored whole; an archive is closed when it has this many bytes; pieces for the reader.
LEAST, ARCHIVE, PIECE = 0, 1 << 24, 1 << 16
#: Rows, or bytes of payload, after which the reader hands over what it has read.
ROWS, BATCH = 4_096, 1 << 22
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Damaged(ValueError):
    """An archive that breaks its framing or a digest."""


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["WARC-Type"]

    def http(self) -> tuple[dict[str, str], bytes]:
        """The HTTP header's fields and what follows it."""
        head, mark, payload = self.block.partition(b"\r\n\r\n")
        if not mark:
            raise Damaged("an HTTP block has no end of header")
        return _fields(head.split(b"\r\n")[1:]), payload


def _fields(lines: Iterable[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, mark, value = line.decode().partition(":")
        if not mark:
            raise Damaged(f"not a header field: {line[:80]!r}")
        found[name.strip()] = value.strip()
    return found


def record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def page_of(record: str) -> int | None:
    number = record.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def member(fields: dict[str, str], block: bytes) -> bytes:
    """One record as one gzip member, the same bytes for the same record."""
    head = "".join(f"{k}: {v}\r\n" for k, v in (fields | {"WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Length": str(len(block))}).items())
    tool = zlib.compressobj(6, zlib.DEFLATED, 31)
    return tool.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + tool.flush()


def page_member(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    fields = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(page), "WARC-Date": DATE, "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha1:{digest(payload)}"}
    if url is not None:
        fields["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f-\xa0  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)
    if revisit:
        fields |= {"WARC-Refers-To": record_id(refers_to), "WARC-Profile": PROFILE}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return member(fields, http if revisit else http + payload)


def _members(pieces: Iterable[bytes]) -> Iterator[Iterator[bytes]]:
    """For each gzip member the pieces it inflates to; a member must be taken whole before the next."""
    source, held = iter(pieces), b""
    while True:
        while not held:
            held = next(source, None)
            if held is None:
                return
        tool = zlib.decompressobj(31)

        def inflate(tool: zlib._Decompress = tool) -> Iterator[bytes]:
            nonlocal held
            while not tool.eof:
                if not held and (held := next(source, None) or b"") == b"":
                    raise Damaged("the archive ends within a member")
                try:
                    out = tool.decompress(held, PIECE)
                except zlib.error as error:
                    raise Damaged(str(error)) from error
                held = tool.unused_data if tool.eof else tool.unconsumed_tail
                if out:
                    yield out

        yield inflate()


def read(pieces: Iterable[bytes]) -> Iterator[Record]:
    """The records of an archive given as pieces of bytes of any size, each verified before it is returned."""
    for parts in _members(pieces):
        data = bytearray()
        while (end := data.find(b"\r\n\r\n")) < 0:
            part = next(parts, None)
            if part is None:
                raise Damaged("a record has no end of header")
            data += part
        lines = bytes(data[:end]).split(b"\r\n")
        if not lines[0].startswith(b"WARC/1."):
            raise Damaged(f"not a WARC version: {lines[0][:40]!r}")
        headers = _fields(lines[1:])
        if not headers.get("Content-Length", "").isdigit():
            raise Damaged("a record has no Content-Length")
        start, size = end + 4, int(headers["Content-Length"])
        while len(data) < start + size + 4 and (part := next(parts, None)) is not None:
            data += part
        block = bytes(data[start : start + size])
        if len(block) != size or data[start + size :] != b"\r\n\r\n" or next(parts, None) is not None:
            raise Damaged("a block does not end where its Content-Length says")
        record = Record(headers, block)
        if headers.get("WARC-Block-Digest", "sha1:" + digest(block)) != "sha1:" + digest(block):
            raise Damaged(f"block digest of {headers.get('WARC-Record-ID')}")
        if headers.get("WARC-Type") == "response" and headers.get("WARC-Payload-Digest") not in (None, "sha1:" + digest(record.http()[1])):
            raise Damaged(f"payload digest of {headers.get('WARC-Record-ID')}")
        yield record


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, in which nothing is escaped, and the name there."""
    return fs.FileSystem.from_uri(quote(path, safe="/:@[]!$&'()*+,;=~"))


def marked(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """(id, url, html, refers_to, revisit): which page holds each payload.

    Payloads are known by their SHA-1. Of equal payloads of ``least`` bytes or more the largest id keeps the payload; rows
    that repeat that id all keep it, a null id does so only where no row of that payload has an id.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    key = F.unhex(F.sha1("html"))
    owners = scratch.keep(rows.select("id", key.alias("owner_key")).groupBy("owner_key").agg(F.max("id").alias("owner")), "payload-owners")
    revisit = (F.octet_length("html") >= least) & F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    return rows.withColumn("key", key).join(owners, F.col("key") == F.col("owner_key")).select("id", "url", "html", F.when(revisit, F.col("owner")).alias("refers_to"), revisit.alias("revisit"))


def write(pages: DataFrame, folder: str, least: int = LEAST, archive: int = ARCHIVE, **columns: str) -> DataFrame:
    """Writes archives of about ``archive`` bytes into ``folder`` and returns (path, records, bytes) for each of them.

    A null html is an empty payload, a null url is left out; an empty table makes no archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = located(folder)
        where.create_dir(base, recursive=True)
        part, made, out, count, size = TaskContext.get().partitionId(), [], None, 0, 0

        def close() -> None:
            nonlocal out
            stream, temporary, final = out
            stream.close()
            where.move(temporary, final)
            made.append((final, count, size))
            out = None

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    final = f"{base}/part-{part:06d}-{len(made):04d}.warc.gz"
                    temporary = f"{base}/.{uuid.uuid4().hex}"
                    first = member({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:archive:{part}:{len(made)}>", "WARC-Date": DATE, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
                    out, count, size = (where.open_output_stream(temporary, compression=None), temporary, final), 0, len(first)
                    out[0].write(first)
                data = page_member(row["id"], row["url"], row["html"].encode(), row["refers_to"], row["revisit"])
                out[0].write(data)
                count, size = count + 1, size + len(data)
                if size >= archive:
                    close()
        if out is not None:
            close()
        columns = list(zip(*made, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["path", "records", "bytes"])

    rows = marked(pages, least=least, **columns).sortWithinPartitions("id", "url", "html")
    return scratch.keep(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of all archives below ``folder``.

    ``payload`` is null for revisits, and for all records with ``payloads`` off. Length and digest are those of the full
    payload. A damaged archive is an error.
    """
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def rows(path: str) -> Iterator[tuple]:
        where, name = located(path)
        with where.open_input_stream(name, compression=None) as stream:
            yield from of_records(read(iter(lambda: stream.read(PIECE), b"")))

    def of_records(records: Iterable[Record]) -> Iterator[tuple]:
        for record in records:
            if record.kind in ("response", "revisit"):
                head, payload = record.http()
                whole = record.kind == "response"
                if whole and len(payload) != int(head["Content-Length"]):
                    raise Damaged(f"payload length of {record.headers['WARC-Record-ID']}")
                yield (page_of(record.headers["WARC-Record-ID"]), record.headers.get("WARC-Target-URI"), record.kind, int(head["Content-Length"]), digest(payload) if whole else record.headers["WARC-Payload-Digest"].removeprefix("sha1:"), None if whole else page_of(record.headers["WARC-Refers-To"]), payload if whole and payloads else None)

    def made(part: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in rows(path):
                    part.append(row)
                    size += len(row[-1] or b"")
                    if len(part) >= ROWS or size >= BATCH:
                        yield made(part)
                        part, size = [], 0
        if part:
            yield made(part)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("path").mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")

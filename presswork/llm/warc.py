"""WARC archives of web pages: written by Spark tasks, read back sequentially.

Each record is a gzip member of its own. Of equal payloads the page with the smallest id is
written as a response, the others as revisits of it that carry the payload's digest and length but
not the payload. Which page that is comes from one grouping by SHA-256 of narrow rows, so a payload
that a third of all pages share stays spread out.

A reader walks through a file once: it inflates one member after another from a stream, piece by
piece, frames a record by its content length, and checks lengths and digests as it goes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.files import filesystem, new_file, new_folder, open_in, open_out
from presswork.llm.shared import BROADCAST_ROWS, arrow_rows, names_of
from presswork.plans.lookup import lookup_join
from presswork.plans.stage import staged

LEAST_BYTES = 100
FILE_BYTES = 256 << 20
CHUNK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


class CorruptRecord(ValueError):
    """A record whose framing, length or digest is wrong."""


def record_id(page: str) -> str:
    return f"<urn:page:{page}>"


def _value(text: str) -> str:
    """A header value: blanks, control characters and the escape itself as %XX, so that any text fits a line."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 0x20 or c in "%\x7f" else c for c in text)


def _plain(text: str) -> str:
    out, i = [], 0
    while i < len(text):
        if text[i] == "%":
            out.append(chr(int(text[i + 1 : i + 3], 16)))
            i += 3
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def member(page: str, url: str, payload: bytes, digest: str, refers_to: str | None, level: int = 6) -> bytes:
    """One record as a gzip member. A revisit's block ends with the HTTP header."""
    block = HTTP if refers_to is not None else HTTP + payload
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(_value(page))}",
        f"WARC-Target-URI: {_value(url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(_value(refers_to))}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    parts = [packer.compress("\r\n".join(lines).encode()), packer.compress(block), packer.compress(b"\r\n\r\n"), packer.flush()]
    return b"".join(parts)


@dataclass
class Record:
    page: str
    url: str
    kind: str
    refers_to: str | None
    digest: str
    payload_bytes: int
    payload: bytes | None  # None for a revisit


def inflate(stream, chunk: int = CHUNK) -> Iterator[bytes | None]:
    """Inflated bytes of a gzip stream, piece by piece, with a None after each member."""
    rest, engine = b"", None
    while True:
        data = rest or stream.read(chunk)
        rest = b""
        if not data:
            if engine is not None:
                raise CorruptRecord("a member ends early")
            return
        if engine is None:
            engine = zlib.decompressobj(31)
        try:
            out = engine.decompress(data, 4 * chunk)
        except zlib.error as error:
            raise CorruptRecord(str(error)) from error
        if out:
            yield out
        if engine.eof:
            rest, engine = engine.unused_data, None
            yield None
        else:
            rest = engine.unconsumed_tail


def read_records(stream, chunk: int = CHUNK) -> Iterator[Record]:
    """Records of an archive in order; raises ``CorruptRecord`` where a digest or a length is wrong."""
    head, header, block, got, digest, tail = bytearray(), None, [], 0, None, b""
    for piece in inflate(stream, chunk):
        if piece is None:
            if header is None or got != length or tail != b"\r\n\r\n":
                raise CorruptRecord("content length differs from the block")
            yield _record(header, b"".join(block), digest.hexdigest())
            head, header, block, got, digest, tail = bytearray(), None, [], 0, None, b""
            continue
        if header is None:
            head += piece
            end = head.find(b"\r\n\r\n")
            if end < 0:
                continue
            header, piece = _header(bytes(head[:end])), bytes(head[end + 4 :])
            length, digest = int(header["content-length"]), hashlib.sha256()
        part = piece[: length - got]
        if part:
            block.append(part)
            digest.update(part)
            got += len(part)
        tail += piece[len(part) :]
    if head:
        raise CorruptRecord("a record ends early")


def _header(raw: bytes) -> dict[str, str]:
    version, *lines = raw.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise CorruptRecord("no WARC version line")
    return {name.lower(): value.lstrip(" ") for name, _, value in (line.partition(":") for line in lines)}


def _record(header: dict[str, str], block: bytes, block_digest: str) -> Record:
    kind, digest, size = header["warc-type"], header["warc-payload-digest"], int(header["x-payload-length"])
    if header["warc-block-digest"] != f"sha256:{block_digest}":
        raise CorruptRecord("block digest differs")
    named = lambda x: _plain(x[len("<urn:page:") : -1])
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or digest != f"sha256:{hashlib.sha256(payload).hexdigest()}":
            raise CorruptRecord("payload digest differs")
    refers = header.get("warc-refers-to")
    return Record(named(header["warc-record-id"]), _plain(header["warc-target-uri"]), kind, named(refers) if refers else None, digest.removeprefix("sha256:"), size, payload)


def write_archives(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_BYTES,
    file_bytes: int = FILE_BYTES, folder: str | None = None,
) -> DataFrame:
    """Write one record per row; returns the table of archives: path, records, bytes.

    Payloads are the html in UTF-8, a null one is empty. Payloads of fewer than ``least`` bytes are
    always responses. Rows repeated in full, or that share the smallest id of a payload, are
    responses alike; rows with a null id are responses too and never referred to. A null url is empty.
    """
    names_of(pages, [key, url, html])
    folder = folder or new_folder(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("page"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_enough = (F.octet_length("payload") >= least) & F.col("page").isNotNull()
    groups = rows.where(long_enough).groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = staged(groups, "payloads")
    told = lookup_join(rows, groups, "digest", "left", weight="n", broadcast_rows=BROADCAST_ROWS)
    again = long_enough & (F.col("first") != F.col("page"))
    told = told.select(F.col("page").cast("string"), "url", "payload", "digest", F.when(again, F.col("first").cast("string")).alias("refers"))

    def write(batches):
        out, path, records, size = None, None, 0, 0
        for batch in batches:
            for row in range(len(batch)):
                page, link, body, digest, refers = (batch.column(c)[row].as_py() for c in range(5))
                if out is None:
                    path = new_file(folder, ".warc.gz")
                    out, records, size = open_out(path), 0, 0
                raw = member("" if page is None else page, link, body, digest, refers)
                out.write(raw)
                records, size = records + 1, size + len(raw)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield {"path": [path], "records": [records], "bytes": [size]}
        if out is not None:
            out.close()
            yield {"path": [path], "records": [records], "bytes": [size]}

    return staged(arrow_rows(told, write, "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record: page, url, record_type, refers_to, payload_bytes, payload_digest (, payload).

    A corrupt record, or an archive with another number of records than was written, fails the job.
    """

    def read(batches):
        for batch in batches:
            for one in batch.to_pylist():
                count, rows, size = 0, [], 0
                with open_in(one["path"]) as stream:
                    for record in read_records(stream):
                        count += 1
                        rows.append(record)
                        size += len(record.payload or b"")
                        if len(rows) >= 1000 or size > CHUNK * 64:
                            yield _columns(rows, with_payload)
                            rows, size = [], 0
                if count != one["records"]:
                    raise CorruptRecord(f"{one['path']} has {count} records of {one['records']}")
                if rows:
                    yield _columns(rows, with_payload)

    schema = "page string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string"
    spread = archives.select("path", "records").repartition(max(1, archives.count()), "path")
    return arrow_rows(spread, read, schema + (", payload binary" if with_payload else ""))


def _columns(rows: list[Record], with_payload: bool) -> dict:
    out = {
        "page": [r.page or None for r in rows],
        "url": [r.url for r in rows],
        "record_type": [r.kind for r in rows],
        "refers_to": [r.refers_to for r in rows],
        "payload_bytes": [r.payload_bytes for r in rows],
        "payload_digest": [r.digest for r in rows],
    }
    return out | ({"payload": pa.array([r.payload for r in rows], pa.binary())} if with_payload else {})


def remove(archives: DataFrame) -> None:
    """Delete the archives; what is read from them must have been written elsewhere."""
    for row in archives.select("path").toLocalIterator():
        fs, place = filesystem(row.path)
        fs.delete_file(place)

"""Legacy ARC archives converted to WARC, with repeated payloads kept once.

ARC files of version 1 and 2 and WARC files are written as gzip files of one member per
record. An ARC file opens with a ``filedesc`` record whose second line gives the version
and whose third names the fields of the header lines; each record is a header line, then
as many bytes as the line declares, then a line end. The converter reads both versions by
the fields they name and makes WARC records of them: identifiers from the place in the
archive, ISO times, record types and payload digests.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.blobs import read_blobs, write_blobs
from threadlens.sources.tables import stage

# The fields of header lines by version, and names of the two formats.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location",
        "Offset", "Filename", "Archive-length",
    ],
}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: A file is closed at so many bytes, or at so many before packing, as readers unpack it whole.
FILE_BYTES = 8 << 20
UNPACKED_BYTES = 32 << 20
LEVEL = 3
SMALL = 100


def member(raw: bytes) -> bytes:
    """A gzip member; without a time, so that a task run again writes the same bytes."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


#: An empty member closes every file.
TAIL = member(b"")


def filled(record: bytes, packed: bytes) -> float:
    """The share of a file that a record takes."""
    return max(len(packed) / FILE_BYTES, len(record) / UNPACKED_BYTES)


def unpacked(content: bytes) -> bytes:
    """The bytes of all gzip members of a file."""
    return gzip.GzipFile(fileobj=io.BytesIO(content)).read()


def _field(text: str | None) -> str:
    """A header field: no blanks or control characters, never empty."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text) if text else "-"


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def arc_preamble(version: int, date: str) -> bytes:
    body = f"{version} 0 threadlens\n{' '.join(ARC_FIELDS[version])}\n".encode()
    shared = {"URL": "filedesc://pages.arc", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain"}
    return _arc_record(version, shared, body)


def _arc_record(version: int, values: dict[str, str], body: bytes) -> bytes:
    known = values | {"Archive-length": str(len(body)), "Result-code": values.get("Result-code", "200")}
    line = " ".join(known.get(name, "-") for name in ARC_FIELDS[version])
    return line.encode() + b"\n" + body + b"\n"


def http_block(page_id: int | None, payload: bytes) -> bytes:
    """The answer of a server as an archive holds it; the page's id travels as a header."""
    name = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{name}\r\n".encode() + payload


def split_block(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their blank line, and the payload; other blocks are all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])


def page_of(headers: bytes) -> int | None:
    found = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", headers)
    return int(found[1]) if found else None


def write_arc(pages: DataFrame, version: int = 1, date: str = "20200101000000") -> str:
    """Pages (page_id, url, html) as ARC files; gives the folder. Null html is empty."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0.0
        for batch in batches:
            for page_id, url, html in zip(batch["page_id"].to_pylist(), batch["url"], batch["html"]):
                block = http_block(page_id, (html.as_py() or "").encode())
                shared = {"URL": _field(url.as_py()), "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/html"}
                record = _arc_record(version, shared, block)
                parts.append(member(record))
                size += filled(record, parts[-1])
                if size >= 1:
                    yield _batch(file=pa.array([b"".join([member(arc_preamble(version, date)), *parts])], pa.binary()))
                    parts, size = [], 0.0
        if parts:
            yield _batch(file=pa.array([b"".join([member(arc_preamble(version, date)), *parts])], pa.binary()))

    wanted = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return write_blobs(wanted.mapInArrow(archives, "file binary"), "file", TAIL, "arc")


#: What tells the fields apart: a URL and a content type may hold blanks, an address and a time do not.
_HEADER = re.compile(r"(.+?) ([0-9A-Fa-f.:]+|-) (\d{14}|\d{12}) (.+)")


def header_fields(line: str, names: list[str]) -> dict[str, str] | None:
    """The named fields of a record's header line; None if it has not got them."""
    found, after = _HEADER.fullmatch(line), len(names) - 4
    if found is None:
        return None
    kind = found[4].split(" ")
    if len(kind) <= after or not kind[-1].isdecimal():
        return None
    return dict(zip(names, [*found.groups()[:3], " ".join(kind[:-after]), *kind[-after:]]))


def arc_records(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of the records after the version block."""
    end = raw.index(b"\n")
    first = raw[:end].split(b" ")
    body = raw[end + 1 : end + 1 + int(first[-1])]
    if not first[0].startswith(b"filedesc:"):
        raise ValueError("an ARC file starts with a filedesc record")
    version = int(body.split(b" ", 1)[0])
    names = body.split(b"\n")[1].decode().split(" ")
    if version not in ARC_FIELDS or names != ARC_FIELDS[version]:
        raise ValueError(f"header lines of ARC version {version} with fields {names} are not known")
    at = end + 1 + len(body)
    while at < len(raw):
        if raw[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = raw.index(b"\n", at)
        fields = header_fields(raw[at:end].rstrip(b"\r").decode(errors="replace"), names)
        if fields is None:
            raise ValueError(f"the header line at {at} has not the fields {names}")
        length = int(fields["Archive-length"])
        if end + 1 + length > len(raw):
            raise ValueError(f"the record at {at} is cut off")
        yield at, fields, raw[end + 1 : end + 1 + length]
        at = end + 1 + length


def iso_time(date: str) -> str:
    """``20200101000000`` or the 12-digit form of old archives, in ISO form."""
    return datetime.strptime(date.ljust(14, "0")[:14], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


CONVERTED = "record_id string, page_id bigint, url string, date string, ip string, digest string, n_bytes bigint, packed binary"


def sound_records(content: bytes, path: str, strict: bool) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """The records of a packed file; a damaged one ends it, or the job if ``strict``."""
    try:
        yield from arc_records(unpacked(content))
    except (ValueError, OSError, EOFError) as damage:
        if strict:
            raise ValueError(f"{path}: {damage}") from damage


def damaged_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, n_records, damage) of the ARC files that cannot be read to their end; ``n_records`` can."""

    def damages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                count = 0
                try:
                    for count, _ in enumerate(arc_records(unpacked(content.as_py())), 1):
                        pass
                except (ValueError, OSError, EOFError) as damage:
                    yield pa.RecordBatch.from_pylist([{"path": path, "n_records": count, "damage": str(damage)}])

    return read_blobs(spark, folder).select("path", "content").mapInArrow(damages, "path string, n_records bigint, damage string")


def read_arc(spark: SparkSession, folder: str, blocks: bool = True, strict: bool = True) -> DataFrame:
    """The records of ARC files with what WARC asks for; ``packed`` is the zipped block, if wanted.

    A damaged file ends the job with its path and place, unless not ``strict``: then the
    records before the damage count, and ``damaged_files`` lists what was left out.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                place, rows = path.as_py().rsplit("/", 1)[-1], []
                for at, fields, block in sound_records(content.as_py(), place, strict):
                    headers, payload = split_block(block)
                    rows.append(
                        {
                            "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place}#{at}')}>",
                            "page_id": page_of(headers),
                            "url": _field(fields["URL"]),
                            "date": iso_time(fields["Archive-date"]),
                            "ip": fields["IP-address"],
                            "digest": hashlib.sha256(payload).hexdigest(),
                            "n_bytes": len(payload),
                            "packed": packer.compress(block) if blocks else None,
                        }
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)

    return read_blobs(spark, folder).select("path", "content").mapInArrow(records, CONVERTED)


ARROW = pa.schema(
    [
        ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()),
        ("ip", pa.string()), ("digest", pa.string()), ("n_bytes", pa.int64()), ("packed", pa.binary()),
    ]
)


def with_revisits(records: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The record that each revisit refers to as ``refers_to_id``; null for responses.

    Of equal payloads of at least ``SMALL`` bytes the smallest page_id answers, a null one
    last; among equal page_ids the record id decides. Digests are folded before they are
    shuffled; the join back is one that adaptive execution splits on a hot digest.
    ``index`` holds the same records without their blocks, cheaper to go through first.
    """
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "record_id")
    first = (
        (records if index is None else index)
        .filter(F.col("n_bytes") >= SMALL)
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", F.col("first.record_id").alias("first_id"))
    )
    found = records.join(first, "digest", "left")
    again = F.col("first_id") != F.col("record_id")
    return found.select(*records.columns, F.when(again, F.col("first_id")).alias("refers_to_id"))


def warc_record(row: dict) -> bytes:
    block = zstandard.ZstdDecompressor().decompress(row["packed"])
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if row['refers_to_id'] else 'response'}",
        f"WARC-Record-ID: {row['record_id']}",
        f"WARC-Date: {row['date']}",
        f"WARC-Target-URI: {row['url']}",
        f"WARC-IP-Address: {row['ip']}",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        "Content-Type: application/http; msgtype=response",
    ]
    if row["refers_to_id"]:
        block = split_block(block)[0]
        lines += [f"WARC-Refers-To: {row['refers_to_id']}", f"WARC-Profile: {IDENTICAL}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(records: DataFrame) -> str:
    """Records with ``refers_to_id`` as WARC files; gives the folder."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0.0
        for batch in batches:
            for k in range(batch.num_rows):
                record = warc_record(batch.slice(k, 1).to_pylist()[0])
                parts.append(member(record))
                size += filled(record, parts[-1])
                if size >= 1:
                    yield _batch(file=pa.array([b"".join(parts)], pa.binary()))
                    parts, size = [], 0.0
        if parts:
            yield _batch(file=pa.array([b"".join(parts)], pa.binary()))

    return write_blobs(records.mapInArrow(archives, "file binary"), "file", TAIL, "warc")


def warc_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        length = int(fields["Content-Length"])
        yield fields, raw[end + 4 : end + 4 + length]
        at = end + 4 + length + 4


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """(record_id, record_type, page_id, url, date, digest, n_bytes, refers_to_id, payload); verifies
    digests. n_bytes and payload are those held in the record, so null for revisits; without
    ``payloads`` the payload is null."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for fields, block in warc_records(unpacked(content.as_py())):
                    headers, payload = split_block(block)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                    rows.append(
                        {
                            "record_id": fields["WARC-Record-ID"], "record_type": kind, "page_id": page_of(headers),
                            "url": fields["WARC-Target-URI"], "date": fields["WARC-Date"], "digest": digest,
                            "n_bytes": len(payload) if kind == "response" else None,
                            "refers_to_id": fields.get("WARC-Refers-To"),
                            "payload": payload if payloads and kind == "response" else None,
                        }
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, READ)

    return read_blobs(spark, folder).select("content").mapInArrow(records, READ_COLUMNS)


READ_COLUMNS = (
    "record_id string, record_type string, page_id bigint, url string, date string, digest string, "
    "n_bytes bigint, refers_to_id string, payload binary"
)
READ = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("date", pa.string()), ("digest", pa.string()), ("n_bytes", pa.int64()), ("refers_to_id", pa.string()),
        ("payload", pa.binary()),
    ]
)


def convert(spark: SparkSession, arc_folder: str) -> str:
    """ARC files to WARC files; gives the folder of the WARC files."""
    return write_warc(with_revisits(read_arc(spark, arc_folder), read_arc(spark, arc_folder, blocks=False)))


def page_digests(spark: SparkSession, warc_folders: list[str]) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record read back.

    The files are read once; the few columns needed are written before they are joined.
    """
    frames = [read_warc(spark, folder, payloads=False).drop("payload", "url", "date") for folder in warc_folders]
    found = frames[0]
    for frame in frames[1:]:
        found = found.unionByName(frame)
    found = stage(found, "warc-index")
    answers = found.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("n_bytes").alias("full_bytes")
    )
    return found.join(answers, "refers_to_id", "left").select(
        "page_id",
        F.coalesce("n_bytes", "full_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )

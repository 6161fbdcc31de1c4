"""WARC records in ZIP-packaged archives.

Writing: each task packs gzipped records into archives of bounded size, every archive a ZIP of a
stored WARC member and a stored index. Reading: the directory at the archive's end is parsed, the
ZIP64 one where fields overflow, the stored members are located, and records are read by their
byte ranges; nothing is extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import posixpath
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm.common import rows, small_batches, stored
from gridpulse.session import shared_folder

ARCHIVE_BYTES = 24 << 20  # of compressed records, then a new archive begins
RANGE_BYTES = 4 << 20  # read at once
LEAST_REVISIT = 0  # bytes; smaller payloads are always stored
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Signatures of the ZIP format and the profile of the WARC format.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Member:
    """A member of an archive: where its bytes lie, if stored."""

    name: str
    stored: bool
    size: int
    header: int  # offset of the local header


def directory(file: BinaryIO, size: int) -> list[Member]:
    """The members that the archive's directory lists, ZIP64 fields included."""
    tail = min(size, 65_557 + 20)  # the end record, its longest comment and the ZIP64 locator before it
    file.seek(size - tail)
    data = file.read(tail)
    found, at = [], data.rfind(END)
    while at >= 0:
        if at + 22 + int.from_bytes(data[at + 20 : at + 22], "little") == len(data):
            found.append(at)
        at = data.rfind(END, 0, at)  # what was found may be a signature within the comment
    if not found:
        raise ValueError("not a ZIP archive: no end record")
    ends = [directory_place(file, data, at, size - tail) for at in found]
    # A comment may look like an end record throughout; but a directory ends where its end record begins.
    count, length, start = next((e[:3] for e in ends if e[1] + e[2] == e[3]), ends[0][:3])
    file.seek(start)
    entries, at, members = file.read(length), 0, []
    for _ in range(count):
        if entries[at : at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<HH", entries[at + 8 : at + 12])
        packed, plain, n, extra, comment = struct.unpack("<IIHHH", entries[at + 20 : at + 34])
        header = int.from_bytes(entries[at + 42 : at + 46], "little")
        name = entries[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        fields, i = entries[at + 46 + n : at + 46 + n + extra], 0
        while i + 4 <= len(fields):
            kind, width = struct.unpack("<HH", fields[i : i + 4])
            if kind == 1:  # the 64-bit forms of the fields that overflow, in this order
                wide = iter(struct.unpack(f"<{width // 8}Q", fields[i + 4 : i + 4 + width // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            i += 4 + width
        members.append(Member(name, method == 0, packed, header))
        at += 46 + n + extra + comment
    return members


def directory_place(file: BinaryIO, data: bytes, at: int, before: int) -> tuple[int, int, int, int]:
    """Number of members, length and offset of the directory, and the offset of its end record, from the end record at ``at`` of the tail ``data``."""
    count, length, start = struct.unpack("<HII", data[at + 10 : at + 20])
    if (count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF) and data[max(0, at - 20) : at][:4] == LOCATOR64:
        place = int.from_bytes(data[at - 12 : at - 4], "little")
        file.seek(place)
        record = file.read(56)
        if record[:4] != END64:
            raise ValueError("the ZIP64 end record is not where its locator points")
        return *struct.unpack("<QQQ", record[32:56]), place
    return count, length, start, before + at


def data_start(file: BinaryIO, member: Member) -> int:
    """Offset of a stored member's first byte: its local header has lengths of its own."""
    if not member.stored:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    file.seek(member.header)
    head = file.read(30)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header for {member.name}")
    return member.header + 30 + sum(struct.unpack("<HH", head[26:30]))


def record_ranges(file: BinaryIO, size: int) -> list[tuple[int, int]]:
    """(offset, length) of every record of the archive, from its indexes."""
    members = {m.name: m for m in directory(file, size)}
    found = []
    for name, member in members.items():
        if name.startswith("indexes/"):
            file.seek(data_start(file, member))
            lines = file.read(member.size).decode().splitlines()
            starts = {}
            for line in lines:
                inside, offset, length = line.rsplit(" ", 2)
                if inside not in starts:
                    starts[inside] = data_start(file, members[inside])
                found.append((starts[inside] + int(offset), int(length)))
    return found


def read_records(file: BinaryIO, size: int, at_once: int = RANGE_BYTES) -> Iterator[bytes]:
    """Every record's plain bytes, neighbours fetched in one range."""
    ranges, i = sorted(record_ranges(file, size)), 0
    while i < len(ranges):
        start, end, j = ranges[i][0], sum(ranges[i]), i + 1
        while j < len(ranges) and ranges[j][0] == end and end + ranges[j][1] - start <= at_once:
            end += ranges[j][1]
            j += 1
        file.seek(start)
        data = file.read(end - start)
        for offset, length in ranges[i:j]:
            yield gzip.decompress(data[offset - start : offset - start + length])
        i = j


def headers_of(block: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields after the first line, names in lower case, and what follows the empty line."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in fields}, body


def uri_of(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    value = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit with the response's header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {uri_of(page_id)}"]
    head += ["WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {uri_of(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def pack_archive(records: list[bytes], force_zip64: bool = False) -> bytes:
    """An archive of gzipped records: the stored data member and its stored index."""
    made, offset, lines = io.BytesIO(), 0, []
    with zipfile.ZipFile(made, "w", zipfile.ZIP_STORED) as archive:
        with archive.open(DATA, "w", force_zip64=force_zip64) as member:
            for record in records:
                member.write(record)
                lines.append(f"{DATA} {offset} {len(record)}")
                offset += len(record)
        archive.writestr(INDEX, "\n".join(lines))
    return made.getvalue()


def digests(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html ('' for null), sha, refers_to and revisit of each row.

    Only payloads met more than once are joined back; the smallest page_id of equal payloads is
    the response, also where its row is repeated.
    """
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    size = F.octet_length("html")
    equal = page.where(size >= least).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    equal = stored(equal.where("n > 1 and first is not null").select("sha", "first"), "equal")  # its size decides the join
    found = page.join(equal, "sha", "left")
    revisit = F.col("first").isNotNull() & (size >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.select("page_id", "url", "html", "sha", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) into archives below ``folder``.

    Returns the stored list of archives (archive, bytes, records). ``folder`` must be reachable
    from every executor. An archive's name holds its task attempt, and only attempts that
    succeed are listed: a lost executor leaves files that nobody reads.
    """
    spark = small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        records, total, serial = [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal records, total, serial
            name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{serial}.wacz"
            data = pack_archive(records)
            with fs.open_output_stream(posixpath.join(root, name)) as file:
                file.write(data)
            made = rows(archive=[name], bytes=np.array([len(data)], np.int64), records=np.array([len(records)], np.int64))
            records, total, serial = [], 0, serial + 1
            return made

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, sha, refers_to, revisit = (c[i].as_py() for c in batch.columns)
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                record = gzip.compress(warc_record(page_id, url, html.encode(), digest, refers_to, revisit), 5, mtime=0)
                records.append(record)
                total += len(record)
                if total >= ARCHIVE_BYTES:
                    yield flush()
        if records:
            yield flush()

    listed = digests(pages, least).mapInArrow(run, "archive string, bytes long, records long")
    return stored(listed, "archives")


def read_archives(spark: SparkSession, listed: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the listed archives: page_id, payload_bytes, payload_digest, record_type,
    refers_to; with_payload adds url and payload (null for a revisit). A payload that does not fit its digest is an error."""
    small_batches(spark)
    tasks = max(1, min(listed.count(), 10_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, size in zip(batch.column("archive").to_pylist(), batch.column("bytes").to_pylist()):
                with fs.open_input_file(posixpath.join(root, name)) as file:
                    found = []
                    for record in read_records(file, size):
                        found.append(parsed(record))
                        if len(found) == 500:
                            yield table(found)
                            found = []
                    if found:
                        yield table(found)

    def parsed(record: bytes) -> tuple:
        head, body = headers_of(record)
        http, payload = headers_of(body[: int(head["content-length"])])
        digest, kind = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"]
        if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {head['warc-record-id']} does not fit its digest")
        refers = page_of(head["warc-refers-to"]) if kind == "revisit" else None
        content = payload.decode() if kind == "response" and with_payload else None
        return page_of(head["warc-record-id"]), int(http["content-length"]), digest, kind, refers, head.get("warc-target-uri"), content

    def table(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
        names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload")
        made = {n: pa.array(list(c), k) for n, c, k in zip(names, zip(*found), kinds)}
        return rows(**{n: made[n] for n in names[: 7 if with_payload else 5]})

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    spread = listed.select("archive", "bytes").repartition(tasks)
    return spread.mapInArrow(run, schema + ", url string, payload string" * with_payload)


def round_trip(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write every page into archives in the shared folder and read the records back.

    A null html is an empty payload; empty payloads are equal to each other. A repeated row of
    the smallest page_id is a response again; a null page_id revisits the smallest id of its payload, or
    is a response where there is none. An empty table writes no archive and gives no row.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    return read_archives(spark, write_archives(pages, folder, least), folder)

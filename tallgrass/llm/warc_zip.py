"""WARC records in ZIP packages, written and read back by byte ranges.

A package is a ZIP file with two stored members: records, each a gzip member of its own, and an index with the place of
every record. The reader parses the central directory (ZIP64 too) from the end of the file, finds where the stored
members begin, and reads records, or some neighbours at once, by their ranges; nothing is extracted. It also reads
packages of others, with several archives and indexes.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.workspace import own_folder, stage

ARCHIVES, INDEXES = "archive/", "indexes/"
RECORDS, INDEX = ARCHIVES + "data.warc.gz", INDEXES + "index.cdxj"
#: Bytes that are read at once, where records are neighbours.
WINDOW_BYTES = 1 << 20
#: Payloads below this many bytes are never revisits.
MIN_REVISIT_BYTES = 100
#: A package is closed when its records reach this size.
PACKAGE_BYTES = 32 << 20
#: Groups of equal payloads up to this number are broadcast; more are joined.
BROADCAST_GROUPS = 200_000
SALTS = 64
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Member(NamedTuple):
    name: str
    method: int
    size: int
    header_at: int


def _zip64(extra: bytes, values: list[int]) -> list[int]:
    """Replaces what the 32-bit fields cannot hold by the entries of the ZIP64 extra field, in their order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            body, out = extra[at + 4 : at + 4 + size], []
            for v in values:
                if v == 0xFFFFFFFF:
                    out.append(struct.unpack_from("<Q", body)[0])
                    body = body[8:]
                else:
                    out.append(v)
            return out
        at += 4 + size
    return values


def directory(read: Callable[[int, int], bytes], size: int) -> dict[str, Member]:
    """Members of a ZIP file of ``size`` bytes by name; ``read(offset, length)`` gives a range."""
    tail_at = max(0, size - 65557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of a central directory")
    number, length, start = struct.unpack_from("<H", tail, end + 10)[0], *struct.unpack_from("<II", tail, end + 12)
    if number == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = read(tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of a central directory")
        number, length, start = struct.unpack_from("<QQQ", record, 32)
    data, at, found = read(start, length), 0, {}
    for _ in range(number):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("a broken central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, plain, names, extras, comments = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + names].decode("utf-8")
        plain, packed, header = _zip64(data[at + 46 + names : at + 46 + names + extras], [plain, packed, header])
        found[name] = Member(name, method, packed, header)
        at += 46 + names + extras + comments
    return found


def stored_at(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where the bytes of a stored member begin: behind its local header, whose extra field may differ in length."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed: its records have no byte ranges")
    header = read(member.header_at, 30)
    if header[:4] != b"PK\x03\x04":
        raise ValueError("a broken local header")
    return member.header_at + 30 + sum(struct.unpack_from("<HH", header, 26))


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit has the HTTP header of its payload, with its length, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    block = http if refers_to is not None else http + payload
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record, headers of its HTTP block, and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode("latin-1").split("\r\n")[1:]), payload


class PackageWriter:
    """Gathers records and gives the package's bytes."""

    def __init__(self) -> None:
        self.records, self.index = io.BytesIO(), []

    def add(self, key: int | None, raw: bytes) -> None:
        packed = gzip.compress(raw, 4, mtime=0)
        self.index.append(json.dumps({"page": key, "offset": self.records.tell(), "length": len(packed)}))
        self.records.write(packed)

    def close(self, zip64: bool = False) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
            for name, body in ((RECORDS, self.records.getvalue()), (INDEX, "\n".join(self.index).encode())):
                with package.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as member:
                    member.write(body)
        return out.getvalue()


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def index_lines(text: str) -> Iterator[tuple[str | None, int, int]]:
    """Archive (None where the line does not say), offset and length of the records of an index: JSON lines, with or without a key and a time before them."""
    for line in text.splitlines():
        at = line.find("{")
        if at < 0 or line.startswith("!"):
            continue
        place = json.loads(line[at:])
        if "offset" in place and "length" in place:
            yield place.get("filename"), int(place["offset"]), int(place["length"])


def windows(places: list[tuple[int, int]], most: int = WINDOW_BYTES, gap: int = 4096) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Neighbouring records (offset, length; ascending) that are read at once: the range's offset and length, and its records. A longer record is a range of its own."""
    held: list[tuple[int, int]] = []
    for offset, length in places:
        if held and (offset + length - held[0][0] > most or offset > sum(held[-1]) + gap):
            yield held[0][0], max(map(sum, held)) - held[0][0], held
            held = []
        held.append((offset, length))
    if held:
        yield held[0][0], max(map(sum, held)) - held[0][0], held


def read_package(uri: str) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """All records that the indexes of a package list, archive by archive in the order of their places; neighbours are read in one range.

    Archives are the members under ``archive/``, their records plain or compressed one by one; indexes those under ``indexes/``.
    """
    fs, path = _fs(uri)
    with fs.open_input_file(path) as source:
        read = lambda offset, length: source.read_at(length, offset)
        members = directory(read, source.size())
        archives = {name.removeprefix(ARCHIVES): member for name, member in members.items() if name.startswith(ARCHIVES) and name != ARCHIVES}
        places: dict[str, set[tuple[int, int]]] = {name: set() for name in archives}
        for name, member in members.items():
            if name.startswith(INDEXES) and name != INDEXES:
                text = read(stored_at(read, member), member.size)
                for archive, offset, length in index_lines((gzip.decompress(text) if name.endswith(".gz") else text).decode()):
                    places[next(iter(archives)) if archive is None and len(archives) == 1 else (archive or "").removeprefix(ARCHIVES)].add((offset, length))
        for name, found in places.items():
            base = stored_at(read, archives[name]) if found else 0
            for start, size, records in windows(sorted(found)):
                data = read(base + start, size)
                for offset, length in records:
                    raw = data[offset - start : offset - start + length]
                    yield parse_record(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)


def plan_revisits(pages: DataFrame) -> DataFrame:
    """``id``, ``url``, ``html``, ``digest`` and ``first``: the smallest id of the equal payloads, null where there is no group."""
    rows = pages.withColumn("digest", F.sha2(F.col("html"), 256))
    slim = rows.filter(F.octet_length("html") >= MIN_REVISIT_BYTES)
    groups = slim.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    groups = stage(groups, "payloads")
    if groups.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), "digest", "left")
    # A payload that very many pages share is dealt over SALTS tasks.
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"], "left").drop("salt")


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes ``pages`` to packages in ``folder`` (seen by all executors); gives ``path`` and ``records`` of each.

    The names hold the task's attempt, and only what successful tasks report is read: a task that is run again does no harm.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), html.alias("html"))
    rows = plan_revisits(rows).select("id", "url", "html", "digest", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, writer, part = TaskContext.get(), PackageWriter(), 0
        fs, path = _fs(folder)

        def close() -> pa.RecordBatch:
            nonlocal writer, part
            name = f"{task.partitionId()}-{task.taskAttemptId()}-{part}.wacz"
            with fs.open_output_stream(f"{path}/{name}") as out:
                out.write(writer.close())
            number, writer, part = len(writer.index), PackageWriter(), part + 1
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([number])], ["path", "records"])

        for batch in batches:
            for page, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                refers = first if first is not None and first != page else None
                writer.add(page, record_bytes(page, url, html.encode("utf-8", "surrogatepass"), digest, refers))
                if writer.records.tell() >= PACKAGE_BYTES:
                    yield close()
        if writer.index:
            yield close()

    fs, path = _fs(folder)
    fs.create_dir(path, recursive=True)
    return stage(rows.mapInArrow(write, "path string, records long"), "packages")


def read_packages(packages: DataFrame) -> DataFrame:
    """Records of the packages in ``path``: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``url``.

    A response's digest is computed from its payload and must be the one in its header; a revisit's come from its headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        page = lambda urn: int(x) if (x := urn.removesuffix(">").rpartition(":")[2]) else None
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows = []
                for fields, http, payload in read_package(uri):
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{uri}: a payload differs from its digest")
                    refers = page(fields["WARC-Refers-To"]) if kind == "revisit" else None
                    rows.append((page(fields["WARC-Record-ID"]), int(http["Content-Length"]), digest, kind, refers, fields.get("WARC-Target-URI")))
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    number = max(1, packages.count())
    return packages.select("path").repartition(number).mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def round_trip(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes ``pages`` and reads the records back: one row per page.

    Of pages with equal payloads of ``MIN_REVISIT_BYTES`` at least, those with the smallest identifier are responses and
    the others revisits of it; smaller payloads are all responses. Null HTML is an empty payload; repeated rows of the
    smallest identifier are all responses; a null identifier stays null and refers to the smallest one if there is
    one. An empty table writes nothing and gives an empty result.
    """
    folder = folder or f"{own_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read_packages(write_packages(pages, folder, id_col, url_col, html_col))


#: What the query returns, in DuckDB.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to FROM g
"""

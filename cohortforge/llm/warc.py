"""WARC records in ZIP packages, written and read by ranges.

A package holds stored (uncompressed) members: ``archive/data.warc``,
``indexes/index.cdxj`` (one line for each record: key, offset, length) and a
description.  The reader asks its source for ranges only: the end of the file,
the ZIP64 end record where there is one, the central directory, a member's local
header, the index, and then records at their offsets (neighbouring ones in ranges of about ``RANGE_BYTES``); nothing is unpacked.
``write_files`` puts packages of about ``PACKAGE_BYTES`` into files of the shared folder and ``read_files`` reads them there by
ranges (on local and s3 or s3a paths, and on hdfs where its library is).  Names are new for each attempt, and the stored list holds those of the attempts that counted, so a task that runs again
leaves no package twice.  Where the shared folder's file system is none that Arrow opens, ``write`` and ``read`` keep packages as
rows of a stored table (name, bytes) instead; the query says so in a warning.

Of records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with
the smallest id keeps the payload (response), the others refer to it (revisit).
Rows that repeat id and payload of the response are responses too.  A null payload
is an empty one; a null id never is the smallest, and is kept.  Ids may be of any type that casts to text and back.  Sizes and
digests of revisits are those in their headers, as a revisit has no payload; those of responses are computed from what is read.
"""

from __future__ import annotations

import hashlib
import io
import json
import logging
import struct
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.shared import own_folder, partitions, stored, table

log = logging.getLogger(__name__)
LEAST_REVISIT = 100
PACKAGE_BYTES = 4 << 20
RANGE_BYTES = 1 << 20
DATA, INDEX, ABOUT = "archive/data.warc", "indexes/index.cdxj", "datapackage.json"
LIMIT = 0xFFFFFFFF


# --- ZIP -----------------------------------------------------------------------------------------


def package(members: dict[str, bytes], zip64: bool = True) -> bytes:
    """A ZIP file of stored members, with ZIP64 sizes and directory end if asked for."""
    out, central = io.BytesIO(), []
    for name, data in members.items():
        raw, crc, at = name.encode(), zlib.crc32(data), out.tell()
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if zip64 else b""
        size = LIMIT if zip64 else len(data)
        out.write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(extra)) + raw + extra)
        out.write(data)
        wide = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if zip64 else b""
        central.append(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(wide), 0, 0, 0, 0, LIMIT if zip64 else at) + raw + wide)
    start, directory = out.tell(), b"".join(central)
    out.write(directory)
    n = len(central)
    if zip64:
        end = out.tell()
        out.write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, len(directory), start))
        out.write(struct.pack("<IIQI", 0x07064B50, 0, end, 1))
        out.write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, LIMIT, LIMIT, 0))
    else:
        out.write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, len(directory), start, 0))
    return out.getvalue()


class RangeSource:
    """Ranges of bytes, or of an open seekable file."""

    def __init__(self, of):
        self.view = memoryview(of) if isinstance(of, (bytes, bytearray, memoryview)) else None
        self.file = None if self.view is not None else of
        self.size = len(self.view) if self.view is not None else of.seek(0, 2)

    def range(self, start: int, length: int) -> bytes:
        if start < 0 or length < 0 or start + length > self.size:
            raise ValueError("a range beyond the archive's end")
        if self.view is not None:
            return bytes(self.view[start : start + length])
        self.file.seek(start)
        return self.file.read(length)


class Member:
    def __init__(self, name, method, crc, packed, size, header):
        self.name, self.method, self.crc, self.packed, self.size, self.header = name, method, crc, packed, size, header


class ZipArchive:
    """The central directory of a ZIP file and ranges of its stored members."""

    def __init__(self, source: RangeSource):
        self.source = source
        tail_size = min(source.size, 22 + 0xFFFF)
        tail_at = source.size - tail_size
        tail = source.range(tail_at, tail_size)
        at = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))
        while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(b"PK\x05\x06", 0, at + 3)
        if at < 0:
            raise ValueError("no ZIP archive")
        _, _, _, _, count, size, start, _ = struct.unpack_from("<IHHHHIIH", tail, at)
        if (count == 0xFFFF or LIMIT in (size, start)) and tail_at + at >= 20:
            locator = source.range(tail_at + at - 20, 20)
            if locator[:4] == b"PK\x06\x07":
                end = source.range(struct.unpack_from("<Q", locator, 8)[0], 56)
                if end[:4] != b"PK\x06\x06":
                    raise ValueError("the ZIP64 end record is missing")
                count, size, start = struct.unpack_from("<QQQ", end, 32)
        self.members: dict[str, Member] = {}
        raw, at = source.range(start, size), 0
        for _ in range(count):
            if raw[at : at + 4] != b"PK\x01\x02":
                raise ValueError("the central directory is damaged")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            crc, packed, full, n, m, k = struct.unpack_from("<IIIHHH", raw, at + 16)
            header = struct.unpack_from("<I", raw, at + 42)[0]
            name = raw[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            full, packed, header = self._wide(raw[at + 46 + n : at + 46 + n + m], full, packed, header)
            self.members[name] = Member(name, method, crc, packed, full, header)
            at += 46 + n + m + k

    @staticmethod
    def _wide(extra: bytes, *values):
        out, at = list(values), 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                place = at + 4
                for i, v in enumerate(out):
                    if v == LIMIT:
                        out[i] = struct.unpack_from("<Q", extra, place)[0]
                        place += 8
            at += 4 + size
        return out

    def start(self, name: str) -> int:
        """Where a stored member's data begin."""
        member = self.members[name]
        if member.method != 0:
            raise ValueError(f"{name} is compressed; only stored members are read by range")
        head = self.source.range(member.header, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} has no local header")
        n, m = struct.unpack_from("<HH", head, 26)
        return member.header + 30 + n + m

    def read(self, name: str) -> bytes:
        data = self.source.range(self.start(name), self.members[name].size)
        if zlib.crc32(data) != self.members[name].crc:
            raise ValueError(f"{name} is damaged")
        return data


# --- WARC ----------------------------------------------------------------------------------------


def record(page, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + (payload if refers_to is None else b"")
    url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest} {kind}')}>",
        "WARC-Target-URI": url,
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if page is not None:
        head["X-Page-Id"] = quote(str(page))
    if refers_to is not None:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["X-Refers-To-Page-Id"] = quote(str(refers_to))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def bundle(records: list[tuple[str, bytes]]) -> bytes:
    lines, at = [], 0
    for key, raw in records:
        lines.append(f"{key} {json.dumps({'offset': at, 'length': len(raw), 'filename': 'data.warc'})}")
        at += len(raw)
    about = json.dumps({"profile": "data-package", "resources": [DATA, INDEX]})
    return package({DATA: b"".join(r for _, r in records), INDEX: "\n".join(lines).encode(), ABOUT: about.encode()})


def records_of(source: RangeSource):
    """Each record of a package, by the index and range reads of neighbouring records."""
    archive = ZipArchive(source)
    start, size = archive.start(DATA), archive.members[DATA].size
    places = [json.loads(line.partition(" ")[2]) for line in archive.read(INDEX).decode().splitlines()]
    spans = [(x["offset"], x["offset"] + x["length"]) for x in places]
    if any(a < 0 or b > size for a, b in spans):
        raise ValueError("the index points beyond its archive")
    at = 0
    while at < len(spans):
        to = at + 1
        while to < len(spans) and spans[to][0] == spans[to - 1][1] and spans[to][1] - spans[at][0] <= RANGE_BYTES:
            to += 1
        first = spans[at][0]
        held = source.range(start + first, spans[to - 1][1] - first)
        for a, b in spans[at:to]:
            yield parse(held[a - first : b - first])
        at = to


# --- tables --------------------------------------------------------------------------------------


def verdicts(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with digest and refers_to; texts move by id only, never by digest."""
    pages = pages.select("page_id", "url", "html")
    body = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.select("page_id", F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("size")).where(F.col("size") >= LEAST_REVISIT)
    firsts = stored(keyed.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 and first_id is not null").select("digest", "first_id"))
    small = keyed.select("page_id", "digest").join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("first_id")))
    revisits = stored(small.select("page_id", "digest", F.col("first_id").alias("refers_to")).distinct())
    whole = pages.withColumn("digest", F.sha2(body, 256))
    same = whole["page_id"].eqNullSafe(revisits["page_id"]) & (whole["digest"] == revisits["digest"])
    return whole.join(revisits, same, "left").select(whole["page_id"], "url", "html", whole["digest"], "refers_to")


def _packages(batches):
    """Packages of a bounded size from rows of ``verdicts``."""
    held, size = [], 0
    for batch in batches:
        col = dict(zip(batch.schema.names, batch.columns))
        ids, urls, refers = (col[c].to_pylist() for c in ("page_id", "url", "refers_to"))
        digests = col["digest"].to_pylist()
        for page, url, digest, to, payload in zip(ids, urls, digests, refers, B.texts_of(col["html"])):
            raw = record(page, url, payload, digest, to)
            held.append((f"page{quote(str(page))}", raw))
            size += len(raw)
            if size >= PACKAGE_BYTES:
                yield bundle(held)
                held, size = [], 0
    if held:
        yield bundle(held)


def write(pages: DataFrame) -> DataFrame:
    """A stored table of packages (name, content) that hold all ``pages``."""

    def run(batches):
        for content in _packages(batches):
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(content).hexdigest() + ".wacz"]), pa.array([content], pa.binary())], names=["name", "content"])

    return stored(_as_text(verdicts(pages)).mapInArrow(run, "name string, content binary"))


def _as_text(pages: DataFrame) -> DataFrame:
    return pages.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})


def file_system(folder: str):
    """Arrow's file system and path of a folder, by any worker."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    if folder.startswith("s3a://"):  # Hadoop's name of it
        folder = "s3://" + folder.removeprefix("s3a://")
    return fs.FileSystem.from_uri(folder)


def write_files(pages: DataFrame, folder: str) -> DataFrame:
    """A stored list (path, size) of ZIP files in the folder that hold all ``pages``."""

    def run(batches):
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        for content in _packages(batches):
            name = f"{uuid.uuid4().hex}.wacz"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(content)])], names=["path", "size"])

    return stored(_as_text(verdicts(pages)).mapInArrow(run, "path string, size long"))


_READ = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"


def _read_source(source: RangeSource, with_payload: bool):
    """Batches of a bounded size of a package's records."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    rows: list[tuple] = []
    for head, payload in records_of(source):
        digest, size = head["WARC-Payload-Digest"].partition(":")[2], int(head["X-Payload-Length"])
        if head["WARC-Type"] == "response":
            digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
            if digest != head["WARC-Payload-Digest"].partition(":")[2]:
                raise ValueError("a payload differs from its digest")
        to = head.get("X-Refers-To-Page-Id")
        page, to = (None if x is None else unquote(x) for x in (head.get("X-Page-Id"), to))
        rows.append((page, head["WARC-Target-URI"], size, digest, head["WARC-Type"], to, payload if with_payload and to is None else None))
        if len(rows) == 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _typed(done: DataFrame, kind: str, with_payload: bool) -> DataFrame:
    done = done.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
    return done if with_payload else done.drop("payload")


def read(packages: DataFrame, with_payload: bool = False, kind: str = "long") -> DataFrame:
    """page_id (of the kind), url, payload_bytes, payload_digest, record_type, refers_to of each record (and the payload, for responses)."""

    def run(batches):
        for batch in batches:
            for content in B.texts_of(batch.column(batch.schema.names.index("content"))):
                yield from _read_source(RangeSource(content), with_payload)

    return _typed(packages.mapInArrow(run, _READ), kind, with_payload)


def read_files(files: DataFrame, with_payload: bool = False, kind: str = "long") -> DataFrame:
    """As ``read``, of ZIP files (path), from which only ranges are read."""

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                folder, _, name = path.rpartition("/")
                system, root = file_system(folder)
                with system.open_input_file(f"{root}/{name}") as held:
                    yield from _read_source(RangeSource(held), with_payload)

    paths = files.select("path")
    return _typed(paths.repartition(partitions(files.sparkSession)).mapInArrow(run, _READ), kind, with_payload)


def query(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    kind = dict(pages.dtypes)["page_id"]
    folder = own_folder(spark)
    try:
        file_system(folder)
    except (pa.ArrowInvalid, OSError) as failure:  # a file system of Spark's alone
        log.warning("packages are kept as rows and read whole, as Arrow doesn't open %s: %s", folder, failure)
        done = read(write(pages), kind=kind)
    else:
        done = read_files(write_files(pages, folder), kind=kind)
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, sha256(encode(coalesce(html, ''))) AS digest, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT digest, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.n >= 100
"""

"""WARC records in ZIP-packaged archives: writing, and reading by range without extraction.

Each package is a ZIP file with two stored members: ``archive/data.warc.gz``, in which every record is a
gzip member of its own, and ``indexes/index.cdx``, which has the place of each record. A reader finds the
end record of the ZIP file, with its ZIP64 extension where there is one, walks the central directory,
takes the place of the stored members from their local headers and then reads single records by their
offset and length. Nothing is extracted.

Records with equal payloads are written once: that of the smallest id is the response, others are
revisits that name it. A task writes its package under a name of its own and hands the name on only
when the package is whole; packages of lost attempts are named nowhere and never read.

Defined cases: a null payload is empty; payloads shorter than ``min_revisit`` bytes are always responses;
rows that share both smallest id and payload are all responses; a row without an id revisits a payload
that a row with an id has, and is a response otherwise; an empty table writes no package.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import portions, scratch_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
_LIMIT32, _LIMIT16 = 0xFFFFFFFF, 0xFFFF
_DOS_TIME = (0, (2000 - 1980) << 9 | 1 << 5 | 1)


# --- ZIP: writing stored members as a stream ---------------------------------------------------


class StoredZipWriter:
    """A ZIP file whose members are stored. Sizes follow a member in a data descriptor, so nothing is held."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.members, self.open, self.always64 = out, 0, [], None, zip64

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)
        if self.open is not None:
            self.open["size"] += len(data)
            self.open["crc"] = zlib.crc32(data, self.open["crc"])

    def begin(self, name: str) -> None:
        raw = name.encode()
        member = {"name": raw, "offset": self.at, "size": 0, "crc": 0}
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)  # sizes may take 64 bits: they stand in the descriptor
        self.write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x0808, 0, *_DOS_TIME, 0, _LIMIT32, _LIMIT32, len(raw), len(extra)) + raw + extra)
        self.open = member

    def end(self) -> None:
        member, self.open = self.open, None
        self.write(struct.pack("<IIQQ", 0x08074B50, member["crc"], member["size"], member["size"]))
        self.members.append(member)

    def close(self) -> None:
        begin = self.at
        for m in self.members:
            large = self.always64 or m["size"] >= _LIMIT32 or m["offset"] >= _LIMIT32
            extra = struct.pack("<HHQQQ", 1, 24, m["size"], m["size"], m["offset"]) if large else b""
            size, offset = (_LIMIT32, _LIMIT32) if large else (m["size"], m["offset"])
            self.write(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x0808, 0, *_DOS_TIME, m["crc"], size, size, len(m["name"]), len(extra), 0, 0, 0, 0, offset) + m["name"] + extra)
        size, n = self.at - begin, len(self.members)
        large = self.always64 or n >= _LIMIT16 or size >= _LIMIT32 or begin >= _LIMIT32
        if large:
            at = self.at
            self.write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, begin))
            self.write(struct.pack("<IIQI", 0x07064B50, 0, at, 1))
        self.write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, _LIMIT16 if large else n, _LIMIT16 if large else n, _LIMIT32 if large else size, _LIMIT32 if large else begin, 0))


# --- ZIP: reading by range ---------------------------------------------------------------------


class ZipDirectory:
    """The members of a ZIP file, from its central directory; ``file`` has size() and read_at(n, offset)."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        begin, length, count = self._end()
        self.members: dict[str, dict] = {}
        raw, at = file.read_at(length, begin), 0
        for _ in range(count):
            f = struct.unpack_from("<IHHHHHHIIIHHHHHII", raw, at)
            if f[0] != 0x02014B50:
                raise ValueError("the central directory is damaged")
            name = raw[at + 46 : at + 46 + f[10]]
            extra = raw[at + 46 + f[10] : at + 46 + f[10] + f[11]]
            packed, size, offset = self._wide(extra, f[8], f[9], f[16])
            self.members[name.decode("utf-8" if f[3] & 0x800 else "cp437")] = {"method": f[4], "packed": packed, "size": size, "offset": offset, "crc": f[7]}
            at += 46 + f[10] + f[11] + f[12]

    def _end(self) -> tuple[int, int, int]:
        """Offset, length and entries of the central directory."""
        n = min(self.size, 22 + 0xFFFF)
        tail = self.file.read_at(n, self.size - n)
        at = tail.rfind(b"PK\x05\x06")
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != n:
            at = tail.rfind(b"PK\x05\x06", 0, at)  # the bytes of an end record may stand in the comment
        if at < 0:
            raise ValueError("no end of a central directory")
        _, _, _, _, count, length, begin, _ = struct.unpack_from("<IHHHHIIH", tail, at)
        place = self.size - n + at
        if place >= 20 and (count == _LIMIT16 or length == _LIMIT32 or begin == _LIMIT32):
            locator = self.file.read_at(20, place - 20)
            if locator[:4] == b"PK\x06\x07":
                end = struct.unpack("<IQHHIIQQQQ", self.file.read_at(56, struct.unpack("<IIQI", locator)[2]))
                count, length, begin = end[7], end[8], end[9]
        return begin, length, count

    @staticmethod
    def _wide(extra: bytes, packed: int, size: int, offset: int) -> tuple[int, int, int]:
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:  # only what did not fit, in this order
                values = iter(struct.unpack_from(f"<{min(n, 24) // 8}Q", extra, at + 4))
                size = next(values) if size == _LIMIT32 else size
                packed = next(values) if packed == _LIMIT32 else packed
                offset = next(values) if offset == _LIMIT32 else offset
            at += 4 + n
        return packed, size, offset

    def place(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes."""
        m = self.members[name]
        if m["method"]:
            raise ValueError(f"{name} is not stored")
        head = struct.unpack("<IHHHHHIIIHH", self.file.read_at(30, m["offset"]))
        if head[0] != 0x04034B50:
            raise ValueError(f"{name} has no local header")
        return m["offset"] + 30 + head[9] + head[10], m["size"]


# --- WARC records ------------------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(id: int | None) -> str:
    return f"urn:page:{'' if id is None else id}"


def encode_record(id: int | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record as a gzip member. A revisit has no payload; its digest and length are the response's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    body = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_uri(id)}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{record_uri(refers_to)}>"]
    lines.append(f"Content-Length: {len(body)}")
    coder = zlib.compressobj(1, zlib.DEFLATED, 31)
    return coder.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + coder.flush()


def decode_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record, headers of the HTTP message in it, and its payload."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


class PackageReader:
    """The records of a ZIP-packaged archive, each by one range read."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        self.zip = ZipDirectory(self.file)
        self.begin, self.size = self.zip.place(DATA)

    def index(self, block: int = 1_000_000) -> Iterator[tuple[int, int, str]]:
        """(offset, length, URI of the record) of each record, in order; the index is read in blocks."""
        at, n = self.zip.place(INDEX)
        rest, end = b"", at + n
        while at < end:
            part = self.file.read_at(min(block, end - at), at)
            at += len(part)
            *lines, rest = (rest + part).split(b"\n")
            for line in lines:
                offset, length, record = line.decode().split(" ", 2)
                yield int(offset), int(length), record

    def record(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, self.begin + offset)

    def records(self, block: int = 4_000_000) -> Iterator[bytes]:
        """All records; neighbours share a range read of about ``block`` bytes."""
        group: list[tuple[int, int]] = []
        for offset, length, _ in self.index():
            if group and offset + length - group[0][0] > block:
                yield from self._together(group)
                group = []
            group.append((offset, length))
        if group:
            yield from self._together(group)

    def _together(self, group: list[tuple[int, int]]) -> Iterator[bytes]:
        begin = group[0][0]
        raw = memoryview(self.record(begin, group[-1][0] + group[-1][1] - begin))
        for offset, length in group:
            yield bytes(raw[offset - begin : offset - begin + length])


# --- tables ------------------------------------------------------------------------------------


def mark_revisits(pages: DataFrame, id: str = "page_id", payload: str = "html", min_revisit: int = 0) -> DataFrame:
    """``pages`` as (id, url columns …, payload) with its digest and, for a revisit, the response's id."""
    hashed = pages.withColumn("__digest", F.sha1(F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8")))
    first = hashed.where(F.col(id).isNotNull()).groupBy("__digest").agg(F.min(id).alias("__first"), F.count(F.lit(1)).alias("__n"))
    long_enough = F.octet_length(F.coalesce(F.col(payload).cast("string"), F.lit(""))) >= min_revisit
    return hashed.join(first, "__digest", "left").withColumn("__refers", F.when(long_enough & F.col("__first").isNotNull() & ~F.col(id).eqNullSafe(F.col("__first")), F.col("__first")))


def write_packages(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = 0, date: datetime | None = None, zip64: bool = False) -> DataFrame:
    """Write ``pages`` into packages, one for each task; returns the manifest (uri, n_records)."""
    spark: SparkSession = pages.sparkSession
    target = scratch_dir(spark, "warc")
    stamp = (date or datetime(2024, 1, 1, tzinfo=UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    narrow = pages.select(F.col(id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.col(payload).cast("string").alias("payload"))
    marked = mark_revisits(narrow, "id", "payload", min_revisit).select("id", "url", "payload", "__digest", "__refers")

    def write(batches):
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        uri = f"{target}/{uuid.uuid4().hex}.wacz"
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        index, at = [], 0
        with fs.open_output_stream(path) as out:
            package = StoredZipWriter(out, zip64)
            package.begin(DATA)
            while first is not None:
                for batch in portions([first], "payload"):
                    for page_id, page_url, text, sha1, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                        body = (text or "").encode()
                        record = encode_record(page_id, page_url, body, base64.b32encode(bytes.fromhex(sha1)).decode(), len(body), refers, refers is not None, stamp)
                        package.write(record)
                        index.append(f"{at} {len(record)} {record_uri(page_id)}\n")
                        at += len(record)
                first = next(batches, None)
            package.end()
            package.begin(INDEX)
            package.write("".join(index).encode())
            package.end()
            package.close()
        yield pa.RecordBatch.from_pydict({"uri": [uri], "n_records": [len(index)]})

    # one row for each package: the attempt that Spark counts is the one whose name is told
    return spark.createDataFrame(marked.mapInArrow(write, "uri string, n_records long").collect(), "uri string, n_records long")


def read_packages(manifest: DataFrame, id: str = "page_id") -> DataFrame:
    """One row per record of the packages: id, payload bytes and digest, record type and what it refers to.

    A response's figures are taken from its payload; a revisit's are those that its headers carry.
    """

    def number(uri: str) -> int | None:
        tail = uri.strip("<>").rpartition(":")[2]
        return int(tail) if tail else None

    def rows(uri):
        for raw in PackageReader(uri).records():
            fields, http, payload = decode_record(raw)
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            kind = fields["WARC-Type"]
            if kind == "response" and payload_digest(payload) != digest:
                raise ValueError(f"{fields['WARC-Record-ID']}: the payload's digest differs")
            size = len(payload) if kind == "response" else int(http["Content-Length"])
            yield number(fields["WARC-Record-ID"]), size, digest, kind, number(fields["WARC-Refers-To"]) if kind == "revisit" else None

    schema = pa.schema([(id, pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                block = []
                for row in rows(uri):
                    block.append(row)
                    if len(block) == 5_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block, strict=True), schema.types, strict=True)], schema=schema)
                        block = []
                if block:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*block, strict=True), schema.types, strict=True)], schema=schema)

    n = max(1, min(manifest.count(), 4 * manifest.sparkSession.sparkContext.defaultParallelism))
    return manifest.select("uri").repartition(n).mapInArrow(run, f"`{id}` long, payload_bytes long, payload_digest string, record_type string, refers_to long")

"""WARC archives: a PySpark data source to write and read them, and an export of pages that stores equal payloads once."""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from martloom.llm.common import col, shared_dir

SCHEMA = "record_id string, warc_type string, target_uri string, warc_date string, payload_digest string, payload_length long, refers_to string, payload binary"
#: Column and WARC header, fixed by the format.
HEADERS = {"record_id": "WARC-Record-ID", "warc_type": "WARC-Type", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST, VERSION, MAGIC = "_manifest.json", b"WARC/1.1", b"\x1f\x8b"
HEAD_BYTES, BLOCK = 1 << 12, 1 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def encode_record(row: dict[str, Any]) -> bytes:
    """One record, not compressed. The payload is the body of an HTTP response; a revisit has its header, with the full length, only."""
    payload = row["payload"] or b""
    length = row["payload_length"] if row["payload_length"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    body = b"" if row["warc_type"] == "revisit" else payload
    head = [VERSION.decode()]
    for name, header in HEADERS.items():
        value = row[name]
        if value is not None:
            value = _clean(value)
            head.append(f"{header}: " + (f"<{value}>" if name in ("record_id", "refers_to") else f"sha1:{value}" if name == "payload_digest" else value))
    if row["warc_type"] == "revisit":
        head.append(f"WARC-Profile: {REVISIT}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}", "", ""]
    return "\r\n".join(head).encode() + http + body + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    """A gzip member of one record. Its header's "sl" field has the lengths, so that a reader can skip the record unread."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = z.compress(data) + z.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    total = 10 + 2 + 12 + len(packed) + len(tail)
    if max(total, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff" + packed + tail
    return b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, total, len(data)) + packed + tail


def parse_head(data: bytes) -> tuple[dict[str, str], int] | None:
    """Headers (lower-case names) of a record and where its block starts; None if the head is not complete."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    first, *lines = data[:end].decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, end + 4


def header_row(headers: dict[str, str]) -> dict[str, Any]:
    row: dict[str, Any] = {name: headers.get(header.lower()) for name, header in HEADERS.items()}
    for name in ("record_id", "refers_to"):
        if row[name]:
            row[name] = row[name].removeprefix("<").removesuffix(">")
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].partition(":")[2] or row["payload_digest"]
    return row


def split_block(block: bytes, headers: dict[str, str]) -> tuple[bytes, int]:
    """Payload of a record's block and its full length, which a revisit's HTTP header tells."""
    if not headers.get("content-type", "").startswith("application/http"):
        return block, len(block)
    head, _, body = block.partition(b"\r\n\r\n")
    if headers.get("warc-type") != "revisit":
        return body, len(body)
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return body, int(value)
    return body, len(body)


def accepts(row: dict[str, Any], filters: list[tuple[str, str, Any]]) -> bool:
    """Whether the headers pass all predicates; a missing header passes none."""
    for name, kind, value in filters:
        have = row[name]
        if have is None or kind == "eq" and have != value or kind == "in" and have not in value or kind == "starts" and not have.startswith(value):
            return False
    return True


class _Counted(io.RawIOBase):
    """A seekable file for io.BufferedReader."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def seek(self, offset: int, whence: int = 0) -> int:
        self.file.seek(offset, whence)
        return self.file.tell()

    def tell(self) -> int:
        return self.file.tell()


def _plain_records(f: BinaryIO, size: int, filters: list) -> Iterator[tuple[dict, dict, bytes]]:
    at = 0
    while at < size:
        f.seek(at)
        data, found = b"", None
        while found is None:
            more = f.read(HEAD_BYTES)
            if not more:
                if data.strip():
                    raise ValueError(f"a record ends inside its header at byte {at}")
                return
            data = (data + more).lstrip(b"\r\n") if not data.strip() else data + more
            found = parse_head(data)
        headers, start = found
        start += f.tell() - len(data)
        length = int(headers["content-length"])
        if accepts(row := header_row(headers), filters):
            f.seek(start)
            block = f.read(length)
            if len(block) < length:
                raise ValueError(f"a record ends inside its block at byte {at}")
            yield headers, row, block
        at = start + length


class _Member:
    """The records of one gzip member, decompressed piece by piece."""

    def __init__(self, f: BinaryIO, at: int, piece: int) -> None:
        self.f, self.at, self.piece, self.z, self.data, self.rest = f, at, piece, zlib.decompressobj(31), b"", b""

    def more(self, limit: int) -> bool:
        """Decompress further; False at the end of the member."""
        if self.z.eof:
            return False
        self.rest = self.rest or self.f.read(self.piece)
        self.piece = BLOCK
        if not self.rest:
            raise ValueError(f"a gzip member is cut off at byte {self.at}")
        self.data += self.z.decompress(self.rest, limit)
        self.rest = self.z.unconsumed_tail
        return True

    def head(self) -> dict | None:
        """The headers of the next record, None after the last one."""
        while True:
            self.data = self.data.lstrip(b"\r\n")
            if self.data and (found := parse_head(self.data)):
                headers, start = found
                self.data = self.data[start:]
                return headers
            if not self.more(HEAD_BYTES):
                if self.data:
                    raise ValueError(f"a record ends inside its header at byte {self.at}")
                return None

    def block(self, length: int, wanted: bool) -> bytes:
        """The next ``length`` bytes, which are dropped if not wanted."""
        parts = []
        while True:
            piece, self.data = self.data[:length], self.data[length:]
            length -= len(piece)
            if wanted:
                parts.append(piece)
            if not length:
                return b"".join(parts)
            if not self.more(BLOCK):
                raise ValueError(f"a record ends inside its block at byte {self.at}")

    def end(self) -> int:
        """Where the next member begins."""
        return self.f.tell() - len(self.z.unused_data)


def _gzip_records(f: BinaryIO, size: int, filters: list) -> Iterator[tuple[dict, dict, bytes]]:
    """All records of all members; a member of one record that tells its length is skipped unread if the record is not wanted."""
    at = 0
    while at < size:
        f.seek(at)
        fixed = f.read(24)
        if fixed[:2] != MAGIC:
            raise ValueError(f"no gzip member at byte {at}")
        known = struct.unpack("<I", fixed[16:20])[0] if len(fixed) == 24 and fixed[3] & 4 and fixed[12:14] == b"sl" else None
        f.seek(at)
        member = _Member(f, at, min(known or BLOCK, HEAD_BYTES))
        while headers := member.head():
            wanted = accepts(row := header_row(headers), filters)
            if not wanted and known:
                at += known
                break
            block = member.block(int(headers["content-length"]), wanted)
            if wanted:
                yield headers, row, block
        else:
            at = member.end()


@dataclass
class Files(InputPartition):
    """Archives read by one task: (path, size)."""

    files: list[tuple[str, int]]

    def __init__(self, files: list[tuple[str, int]]) -> None:
        super().__init__(None)
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.path, self.options = options["path"], dict(options)
        self.columns = schema.names
        self.filters: list[tuple[str, str, Any]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Predicates on headers are tested before a block is decoded; those on the payload go back to Spark."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name not in HEADERS:
                yield f
            elif isinstance(f, EqualTo) and f.value is not None:
                self.filters.append((name, "eq", f.value))
            elif isinstance(f, In):
                self.filters.append((name, "in", frozenset(v for v in f.value if v is not None)))
            elif isinstance(f, StringStartsWith):
                self.filters.append((name, "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.filters.append((name, "set", None))
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Archives packed into tasks of about ``partition_bytes``; what a manifest does not name was never committed."""
        fs, root = file_system(self.path)
        found = [x for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.is_file]
        manifests = [x for x in found if x.base_name.endswith(MANIFEST)]
        if manifests:
            names = set()
            for m in manifests:
                with fs.open_input_file(m.path) as f:
                    names |= set(json.loads(f.read()))
            found = [x for x in found if x.base_name in names]
        else:
            found = [x for x in found if x.base_name.endswith((".warc", ".warc.gz"))]
        limit, packs, held = int(self.options.get("partition_bytes", 32 << 20)), [], 0
        for x in sorted(found, key=lambda x: x.path):
            if not packs or held + x.size > limit:
                packs.append([])
                held = 0
            packs[-1].append((x.path, x.size))
            held += x.size
        return [Files(p) for p in packs or [[]]]  # no archive is one task without work

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        verify = self.options.get("verify", "false") == "true"
        types = {"payload": pa.binary(), "payload_length": pa.int64()}
        rows: list[dict] = []
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], types.get(c, pa.string())) for c in self.columns], self.columns)

        for path, size in partition.files:
            with fs.open_input_file(path) as file:
                read = _gzip_records if file.read(2) == MAGIC else _plain_records
                try:
                    for headers, row, block in read(io.BufferedReader(_Counted(file), BLOCK), size, self.filters):
                        payload, row["payload_length"] = split_block(block, headers)
                        row["payload"] = None if row["warc_type"] == "revisit" else payload
                        if verify and row["payload"] is not None and row["payload_digest"] and base32_sha1(payload) != row["payload_digest"]:
                            raise ValueError(f"the payload of {row['record_id']} does not match its digest")
                        rows.append(row)
                        held += len(payload)
                        if len(rows) >= 1000 or held >= 8 << 20:
                            yield batch()
                            rows, held = [], 0
                except (ValueError, KeyError, zlib.error) as e:
                    raise ValueError(f"{path}: {e}") from e
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Every task attempt writes files of its own; those of the attempts that count are named in a manifest at the commit."""

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        if overwrite:
            raise ValueError("archives are appended to; write to a new folder instead of overwriting")
        self.path, self.options = options["path"], dict(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        limit, level = int(self.options.get("max_file_bytes", 64 << 20)), int(self.options.get("level", 3))
        names: list[str] = []
        out, size = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                size += out.write(member := gzip_member(encode_record(row), level)) or len(member)
                if size >= limit:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{uuid.uuid4().hex}{MANIFEST}") as f:
            f.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        for name in (n for m in messages if m for n in m.names):
            fs.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").mode("append").save(folder)``.

    Options: ``partition_bytes`` of archives a task reads (32 MB), ``verify`` digests of decoded payloads, ``max_file_bytes`` of an
    archive (64 MB), ``level`` of compression. Archives of others are read too, gzipped by record, as a whole, or plain.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records_of(pages: DataFrame, *, min_payload: int, date: str) -> DataFrame:
    """Pages as records: of equal payloads the one with the largest page_id is a response, the others revisit it."""
    html = F.coalesce(col("html").cast("string"), F.lit("")).cast("binary")
    p = pages.select(col("page_id").alias("page_id"), col("url").cast("string").alias("target_uri"), html.alias("payload"))
    p = p.withColumn("sha", F.sha1("payload")).withColumn("payload_length", F.octet_length("payload").cast("long"))
    # only ids and digests are grouped; a digest that a third of all pages share is one row a task before the shuffle
    last = p.groupBy("sha").agg(F.max("page_id").alias("last")).withColumnRenamed("sha", "of")
    revisit = ~F.col("page_id").eqNullSafe(F.col("last")) & (F.col("payload_length") >= min_payload)
    p = p.join(last, F.col("sha") == F.col("of")).withColumn("revisit", revisit)
    urn: Column = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    return p.select(
        urn.alias("record_id"), F.when(F.col("revisit"), "revisit").otherwise("response").alias("warc_type"), "target_uri",
        F.lit(date).alias("warc_date"), base32("sha").alias("payload_digest"), "payload_length",
        F.when(F.col("revisit"), F.concat(F.lit("urn:page:"), F.col("last").cast("string"))).alias("refers_to"),
        F.when(~F.col("revisit"), F.col("payload")).alias("payload"))


def base32(sha: str) -> Column:
    """A hex SHA-1 in base 32: every five hex digits are four letters of the alphabet."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = []
    for k in range(0, 40, 5):
        n = F.conv(F.substring(sha, k + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(letters), (F.shiftright(n, s).bitwiseAND(F.lit(31)) + 1), F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def export(pages: DataFrame, folder: str, *, min_payload: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) as WARC archives with revisit records.

    NULL html: an empty payload. NULL url: no target. NULL page_id: the smallest of all, written as "null". Repeated rows of the
    response's page_id and payload are all written as responses. No pages: a folder without archives. Other columns are ignored.
    """
    register(pages.sparkSession)
    records_of(pages, min_payload=min_payload, date=date).write.format("warc").mode("append").save(folder)


def read(spark: SparkSession, folder: str, *, verify: bool = False) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("verify", str(verify).lower()).load(folder)


def page_index(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of the records that ``export`` has written."""
    page = lambda c: F.when(F.col(c) != "urn:page:null", F.substring(c, len("urn:page:") + 1, 20)).cast("long")
    return records.select(page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest",
                          F.col("warc_type").alias("record_type"), page("refers_to").alias("refers_to"))


def round_trip(pages: DataFrame, *, min_payload: int = 0) -> DataFrame:
    """Write the archives to a new shared folder, read them back, and list their records."""
    folder = shared_dir(pages.sparkSession, "warc")
    export(pages, folder, min_payload=min_payload)
    return page_index(read(pages.sparkSession, folder, verify=True))

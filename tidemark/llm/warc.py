"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans one task per bundle of files, takes predicates on record type and header fields, parses the
headers of a record first and decodes its payload only if the record passes and ``payload`` is wanted.
Unwanted blocks are skipped by their length: in plain files by seeking over ``Content-Length``, in files of
gzip members by the skip lengths (``sl``) that the writer stores in the extra field of each member;
members without them are inflated and dropped.

Writing gives each task its own files; the commit publishes a list of them, so what a lost or repeated
task left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull,
                                    WriterCommitMessage)

SCHEMA = ("record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
          "payload_length bigint, headers map<string,string>, payload binary, file string, offset bigint")
#: Columns that predicates are taken for, with their header fields.
FIELDS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
          "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_files.json"
_CHUNK = 1 << 16
_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("refers_to", pa.string()),
                    ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
                    ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64())])


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take predicates."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all machines see; Hadoop's names of S3 stand for the plain one.

    A path without a scheme is on the machine itself, so it is of use to local sessions only.
    """
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", re.sub("^file:/+", "file:///", uri)))
    return fs.LocalFileSystem(), uri


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes, level: int = 6) -> bytes:
    """``data`` as a gzip member that tells how far to skip."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    size = 10 + 14 + len(body) + 8
    if max(size, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00" + bytes(5) + b"\xff" + body + tail
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data)) + body + tail


class _Member:
    """Reads one gzip member piecewise."""

    def __init__(self, source: io.BufferedReader, start: int):
        self.source, self.start, self.skip = source, start, None
        head = source.read(10)
        if len(head) < 10 or head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at {start}")
        flags = head[3]
        if flags & 4:
            extra = source.read(struct.unpack("<H", source.read(2))[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.skip = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size:]
        for flag in (8, 16):
            while flags & flag and source.read(1) not in (b"\x00", b""):
                pass
        source.read(2 if flags & 2 else 0)
        self.inflate, self.fed = zlib.decompressobj(-15), source.tell()

    def read(self, size: int = _CHUNK) -> bytes:
        """At most ``size`` bytes; none at the end."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.source.read(_CHUNK // 4)
            if not data:
                raise ValueError(f"member at {self.start} is cut short")
            out = self.inflate.decompress(data, size)
            if out:
                return out
        return b""

    def leave(self) -> int:
        """Place of the next member."""
        if self.skip is not None:
            return self.start + self.skip
        while self.read():
            pass
        return self.source.tell() - len(self.inflate.unused_data) + 8


class _Plain:
    """Reads a record of a plain file; its end is set when its length is known."""

    def __init__(self, source: io.BufferedReader, start: int):
        self.source, self.end = source, None

    def read(self, size: int = _CHUNK) -> bytes:
        return self.source.read(min(size, 4096) if self.end is None else max(0, min(size, self.end - self.source.tell())))

    def leave(self) -> int:
        return self.end


def _split_head(data: bytes) -> dict[str, str]:
    lines = re.sub(rb"\r\n[ \t]+", b" ", data).decode("utf-8", "replace").split("\r\n")
    pairs = [line.partition(":") for line in lines[1:] if ":" in line]
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def records(source: io.BufferedReader, compressed: bool, accept, payload: bool) -> Iterator[tuple[int, dict[str, str], dict[str, str], bytes | None]]:
    """``offset, headers, HTTP headers, payload`` of the records whose headers ``accept`` takes."""
    start = 0
    while True:
        source.seek(start)
        if not source.peek(1):
            return
        record, data = (_Member if compressed else _Plain)(source, start), b""
        while b"\r\n\r\n" not in data and (more := record.read()):
            data += more
        head, found, rest = data.partition(b"\r\n\r\n")
        if not found:
            if head.strip(b"\r\n"):
                raise ValueError(f"record at {start} has no end of its headers")
            return
        headers = _split_head(head)
        length = int(headers.get("content-length", 0))
        if not compressed:
            record.end = start + len(head) + 4 + length
        if accept(headers):
            http, body = {}, None
            # an HTTP message in a response or revisit: its headers stand before the payload
            wanted = length if payload else 0
            is_http = headers.get("content-type", "").startswith("application/http")
            parts, size = [rest], len(rest)
            while size < length and (size < wanted or is_http and b"\r\n\r\n" not in rest):
                more = record.read()
                if not more:
                    raise ValueError(f"record at {start} is cut short")
                parts.append(more)
                size += len(more)
                if not payload:
                    rest += more
            block = b"".join(parts)[:length]
            if is_http:
                http_head, _, body = block.partition(b"\r\n\r\n")
                http = _split_head(http_head)
            else:
                body = block
            yield start, headers, http, body if payload else None
        start = record.leave() + (0 if compressed else 4)


@dataclass
class Files(InputPartition):
    names: list[str]

    def __init__(self, names: list[str]):
        self.names = names


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.bundle = int(options.get("bundlebytes", 128 << 20))
        # option header.<Name>: the field must have this value
        self.tests = [(name[7:].lower(), (value,)) for name, value in options.items() if name.lower().startswith("header.")]
        self.present: list[str] = []

    def pushFilters(self, filters):
        for test in filters:
            field = FIELDS.get(".".join(test.attribute)) if isinstance(test, (EqualTo, In, IsNotNull)) else None
            if field is None:
                yield test
            elif isinstance(test, IsNotNull):
                self.present.append(field)
            else:
                self.tests.append((field, tuple(test.value) if isinstance(test, In) else (test.value,)))

    def partitions(self) -> list[Files]:
        system, path = open_folder(self.path)
        listed = {x.base_name: x.size for x in system.get_file_info(fs.FileSelector(path)) if x.base_name.endswith((".warc", ".warc.gz"))}
        if system.get_file_info(f"{path}/{MANIFEST}").type == fs.FileType.File:
            with system.open_input_stream(f"{path}/{MANIFEST}") as f:
                listed = {name: listed[name] for name in json.loads(f.read())}
        out, size = [], 0
        for name, own in sorted(listed.items()):
            if not out or size + own > self.bundle:
                out.append([])
                size = 0
            out[-1].append(name)
            size += own
        return [Files(names) for names in out] or [Files([])]

    def _accept(self, headers: dict[str, str]) -> bool:
        return all(headers.get(field) in values for field, values in self.tests) and all(field in headers for field in self.present)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(self.path)
        rows, size = [], 0
        for name in partition.names:
            with io.BufferedReader(system.open_input_file(f"{path}/{name}"), _CHUNK) as source:
                for offset, headers, http, body in records(source, name.endswith(".gz"), self._accept, self.payload):
                    digest = headers.get("warc-payload-digest")
                    if self.verify and body is not None and headers.get("warc-type") == "response" and digest != f"sha1:{sha1_base32(body)}":
                        raise ValueError(f"{name} at {offset}: the payload does not have its digest")
                    length = int(http["content-length"]) if http.get("content-length", "").isdigit() else None if body is None else len(body)
                    rows.append([*(headers.get(field) for field in FIELDS.values()), length, list(headers.items()), body, name, offset])
                    size += len(body or b"") + 500
                    if size > 8 << 20:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), _ARROW)], schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Takes ``record_id, record_type, target_uri, refers_to, payload``; a revisit keeps the HTTP headers of its payload only."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.file_bytes = int(options.get("filebytes", 1 << 30))

    def _record(self, row: dict) -> bytes:
        line = lambda text: re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text or "")
        payload = row["payload"] or b""
        revisit = row["record_type"] == "revisit"
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
        head = [("WARC-Type", line(row["record_type"])), ("WARC-Record-ID", line(row["record_id"])), ("WARC-Date", self.date), ("WARC-Target-URI", line(row["target_uri"])),
                ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
        if revisit:
            head += [("WARC-Refers-To", line(row["refers_to"])), ("WARC-Profile", PROFILE)]
        data = ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"
        return member(data) if self.gzip else data

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = open_folder(self.path)
        system.create_dir(path, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip)
                        out, size = system.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                    data = self._record(row)
                    out.write(data)
                    size += len(data)
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = open_folder(self.path)
        system.create_dir(path, recursive=True)
        place, before = f"{path}/{MANIFEST}", []
        if system.get_file_info(place).type == fs.FileType.File:
            with system.open_input_stream(place) as f:
                before = json.loads(f.read())
        names = [n for m in messages if m for n in m.names] + ([] if self.overwrite else before)
        own = f"{place}.{uuid.uuid4().hex}"
        with system.open_output_stream(own) as f:
            f.write(json.dumps(sorted(names)).encode())
        system.move(own, place)
        if self.overwrite:
            self._drop(before)

    def abort(self, messages: list[Written | None]) -> None:
        self._drop([n for m in messages if m for n in m.names])

    def _drop(self, names: list[str]) -> None:
        system, path = open_folder(self.path)
        for name in names:
            if system.get_file_info(f"{path}/{name}").type == fs.FileType.File:
                system.delete_file(f"{path}/{name}")


class WarcDataSource(DataSource):
    """Options: ``path``; reading: ``payload`` (true), ``verify`` (false), ``bundleBytes``, ``header.<Name>``;
    writing: ``date``, ``compression`` (gzip or none), ``fileBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)

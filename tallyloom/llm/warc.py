"""WARC archives as a Spark data source, read and written in plain Python.

Reading: the driver plans file splits.  Each task parses the header of a record
first; type, address, digest and id predicates are tested on the header,
and a record they rule out is skipped by its length, its payload never inflated.
With option ``payload`` false no payload is inflated at all.

Writing: one gzip member per record, its compressed and full length in the
member's extra field, so readers can skip.  Each task writes files of its own
names; the commit lists them, with places where a split may begin, in a manifest.
What a lost or repeated task left behind is in no manifest and is never read.

Nulls: a null header value is left out and read back as null; a null payload is
written as an empty one.  An empty table makes an archive without records.
Repeated rows become repeated records.  Line breaks in header values are percent-encoded.
"""

from __future__ import annotations

import io
import json
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tallyloom.session import shared_folder

MANIFEST = "_manifest.json"
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
    "content_length long, payload_bytes long, payload binary"
)
#: Fixed values of the format.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAYLOAD_LENGTH = "X-Payload-Length"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
IN_BRACKETS = ("record_id", "refers_to")
ARROW = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (x.split() for x in SCHEMA.split(", "))])


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = f"file://{uri.removeprefix('file:')}"
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def safe(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record(row: dict, now: str) -> bytes:
    """One record, not compressed."""
    kind, payload = row.get("record_type") or "resource", row.get("payload") or b""
    block = HTTP % len(payload) + payload if kind == "response" else b"" if kind == "revisit" else payload
    head = ["WARC/1.1"]
    for name, field in HEADERS.items():
        value = row.get(name) if name != "date" else row.get(name) or now
        if value is not None:
            value = safe(str(value))
            head.append(f"{field}: <{value}>" if name in IN_BRACKETS else f"{field}: {value}")
    size = row.get("payload_bytes")
    head.append(f"{PAYLOAD_LENGTH}: {len(payload) if size is None else size}")
    if kind == "revisit":
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
    head.append(f"Content-Type: {'application/http; msgtype=response' if kind == 'response' else 'application/octet-stream'}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member whose extra field ``sl`` holds its own length and that of its content."""
    pack = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    total = 24 + len(body) + 8
    extra = struct.pack("<2sHII", b"sl", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return struct.pack("<4BIBBH", 31, 139, 8, 4, 0, 0, 255, len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parsed(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return fields


class Records:
    """Records of a stretch of an open file: header first, the content on demand."""

    def __init__(self, file, start: int, end: int | None):
        self.file, self.at, self.end = file, start, end
        file.seek(start)

    def __iter__(self) -> Iterator[tuple[dict[str, str], object]]:
        while self.end is None or self.at < self.end:
            self.file.seek(self.at)
            mark = self.file.read(24)
            if not mark.strip(b"\r\n"):
                return
            if mark[:2] == b"\x1f\x8b":
                known = struct.unpack("<I", mark[16:20])[0] if mark[3] & 4 and mark[12:14] == b"sl" else 0
                yield from self._compressed(known)
            else:
                yield from self._plain()

    def _compressed(self, known: int):
        self.file.seek(self.at)
        unpack, out, taken = zlib.decompressobj(31), b"", 0
        while b"\r\n\r\n" not in out and not unpack.eof:
            chunk = unpack.unconsumed_tail or self.file.read(min(1 << 14, known - taken) if known else 1 << 14)
            if not chunk:
                break
            taken += 0 if unpack.unconsumed_tail else len(chunk)
            out += unpack.decompress(chunk, 1 << 13)
        head, _, begun = out.partition(b"\r\n\r\n")
        state = {"taken": taken, "out": begun}

        def rest(wanted: bool = True) -> bytes:
            parts = [state["out"]]
            while not unpack.eof:
                tail = unpack.unconsumed_tail
                chunk = tail or self.file.read(known - state["taken"] if known else 1 << 16)
                if not chunk:
                    break
                state["taken"] += 0 if tail else len(chunk)
                got = unpack.decompress(chunk)
                if wanted:
                    parts.append(got)
            state["out"] = b""
            return b"".join(parts)

        fields = parsed(head)
        yield fields, lambda: rest()[: int(fields.get("content-length", 0))]
        if known:
            self.at += known
        else:
            if not unpack.eof:
                rest(False)
            self.at += state["taken"] - len(unpack.unused_data)

    def _plain(self):
        self.file.seek(self.at)
        out = b""
        while b"\r\n\r\n" not in out:
            chunk = self.file.read(1 << 13)
            if not chunk:
                self.at = 1 << 62
                return
            out += chunk
        head, _, begun = out.lstrip(b"\r\n").partition(b"\r\n\r\n")
        fields = parsed(head)
        size = int(fields.get("content-length", 0))
        body = self.at + len(out) - len(begun)

        def content() -> bytes:
            if size <= len(begun):
                return begun[:size]
            self.file.seek(body)
            return self.file.read(size)

        yield fields, content
        self.at = body + size + 4


@dataclass
class Split(InputPartition):
    parts: list[tuple[str, int, int | None]]


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class WarcReader(DataSourceReader):
    TESTED = {"record_type", "target_uri", "payload_digest", "record_id", "refers_to"}

    def __init__(self, options: dict):
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.split_bytes = int(options.get("splitBytes", 64 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in self.TESTED and isinstance(f, EqualTo):
                self.tests.append((name, "in", (f.value,)))
            elif name in self.TESTED and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name in self.TESTED and isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", f.value))
            else:
                yield f

    def partitions(self) -> list[Split]:
        fs, path = opened(self.path)
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=False))
        listed = {f.base_name: f for f in found if f.is_file}
        stretches: list[tuple[str, int, int | None, int]] = []
        if MANIFEST in listed:
            with fs.open_input_stream(listed[MANIFEST].path) as file:
                for x in json.loads(file.read())["files"]:
                    starts = x["starts"]
                    for a, b in zip(starts, [*starts[1:], x["bytes"]], strict=True):
                        stretches.append((f"{path}/{x['name']}", a, b, b - a))
        else:
            stretches = [(f.path, 0, None, f.size) for n, f in sorted(listed.items()) if n.endswith((".warc", ".warc.gz"))]
        splits, held = [Split([])], 0
        for name, a, b, size in stretches:
            if held and held + size > self.split_bytes:
                splits.append(Split([]))
                held = 0
            splits[-1].parts.append((name, a, b))
            held += size
        return splits

    def _passes(self, row: dict) -> bool:
        for name, how, wanted in self.tests:
            value = row[name]
            if value is None or (value not in wanted if how == "in" else not value.startswith(wanted)):
                return False
        return True

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.path)
        rows: list[dict] = []
        held = 0
        for name, start, end in partition.parts:
            with fs.open_input_file(name) as raw:
                file = io.BufferedReader(raw, 1 << 18)
                for fields, content in Records(file, start, end):
                    row = {n: fields.get(f.lower()) for n, f in HEADERS.items()}
                    for n in IN_BRACKETS:
                        row[n] = row[n] and row[n].removeprefix("<").removesuffix(">")
                    if not self._passes(row):
                        continue
                    size = fields.get(PAYLOAD_LENGTH.lower())
                    row |= {"content_length": int(fields.get("content-length", 0)), "payload_bytes": int(size) if size else None, "payload": None}
                    if self.with_payload and row["record_type"] != "revisit":
                        data = content()
                        if fields.get("content-type", "").startswith("application/http"):
                            data = data.partition(b"\r\n\r\n")[2]
                        row |= {"payload": data, "payload_bytes": len(data)}
                        held += len(data)
                    rows.append(row)
                    if held > 8 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.file_bytes = int(options.get("fileBytes", 1 << 30))
        self.chapter = int(options.get("chapterBytes", 16 << 20))
        self.level = int(options.get("level", 4))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, path = opened(self.path)
        fs.create_dir(path, recursive=True)
        files, out, now = [], None, time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append({"name": f"part-{uuid.uuid4().hex}.warc.gz", "bytes": 0, "records": 0, "starts": [0]})
                    out = fs.open_output_stream(f"{path}/{files[-1]['name']}", compression=None)
                own = files[-1]
                if own["bytes"] - own["starts"][-1] >= self.chapter:
                    own["starts"].append(own["bytes"])
                own["bytes"] += out.write(member(record(row, now), self.level))
                own["records"] += 1
                if own["bytes"] >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = opened(self.path)
        fs.create_dir(path, recursive=True)
        files = [x for m in messages if m is not None for x in m.files]
        if not self.overwrite and fs.get_file_info(f"{path}/{MANIFEST}").is_file:
            with fs.open_input_stream(f"{path}/{MANIFEST}") as file:
                files = json.loads(file.read())["files"] + files
        with fs.open_output_stream(f"{path}/{MANIFEST}", compression=None) as file:
            file.write(json.dumps({"files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing to undo: files without a manifest entry are never read."""


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least: int = 1000) -> DataFrame:
    """Records to write, one per page: of equal payloads of ``least`` bytes or more the largest id is the response, the others revisit it.

    Rows without an id revisit the response of their payload, if one has an id.
    """
    payload = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    own = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("target_uri"), payload.alias("payload"))
    own = own.withColumn("payload_bytes", F.length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    copies = own.where(F.col("payload_bytes") >= least).groupBy("digest", "payload_bytes").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = copies.where((F.col("n") > 1) & F.col("first").isNotNull()).drop("n")
    joined = own.join(copies, ["digest", "payload_bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return joined.select(
        urn("id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit(None).cast("string").alias("date"), F.when(revisit, urn("first")).alias("refers_to"), F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.lit(None).cast("long").alias("content_length"), "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archived(records: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the records and reads the archive back."""
    spark = records.sparkSession
    register(spark)
    path = path or shared_folder(spark, "warc")
    records.write.format("warc").mode("append").save(path)
    return spark.read.format("warc").load(path)

"""WARC archives as a PySpark Python data source, and page tables written to and read from them."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    WriterCommitMessage)

from millrace.llm.common import table
from millrace.session import scratch_dir, staged

# Header names and texts of the format.
TYPE, RECORD_ID, URI, DATE, DIGEST, REFERS, LENGTH = (
    "WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest", "WARC-Refers-To",
    "Content-Length")
FULL_LENGTH = "X-Payload-Length"  # extension field: a revisit's block is empty, this is the payload it stands for
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

SCHEMA = T.StructType([T.StructField(n, kind) for n, kind in [
    ("record_type", T.StringType()), ("record_id", T.StringType()), ("target_uri", T.StringType()),
    ("date", T.StringType()), ("payload_digest", T.StringType()), ("refers_to", T.StringType()),
    ("content_length", T.LongType()), ("payload_length", T.LongType()), ("payload", T.BinaryType())]])
HEADER_OF = {"record_type": TYPE, "record_id": RECORD_ID, "target_uri": URI, "date": DATE, "payload_digest": DIGEST,
             "refers_to": REFERS}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def _record(row: dict) -> bytes:
    block = RESPONSE_HEAD + row["payload"] if row["record_type"] == "response" else b""
    head = [("WARC/1.1", None), (TYPE, row["record_type"]), (RECORD_ID, f"<{row['record_id']}>"),
            (DATE, row["date"]), (URI, row["target_uri"]),
            (DIGEST, "sha1:" + base64.b32encode(bytes.fromhex(row["payload_sha1"])).decode()),
            (FULL_LENGTH, str(row["payload_length"]))]
    if row["record_type"] == "revisit":
        head += [(REFERS, f"<{row['refers_to']}>"), ("WARC-Profile", PROFILE)]
    else:
        head.append(("Content-Type", "application/http; msgtype=response"))
    head.append((LENGTH, str(len(block))))
    lines = [k if v is None and k.startswith("WARC/") else f"{k}: {_clean(v)}" for k, v in head
             if v is not None or k.startswith("WARC/")]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    """One gzip member; its extra field 'sl' holds the sizes, packed and not, so that a reader can seek past it."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    size = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF,
                                                            len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Each task writes archives of up to ``file_bytes``; the driver then lists the files of the tasks that succeeded.

    A lost or repeated task leaves files that no list names, and readers go by the lists.
    """

    def __init__(self, options: dict, overwrite: bool):
        if overwrite:
            raise ValueError("archives are only appended; choose a new folder")
        self.path = options["path"]
        self.file_bytes = int(options.get("file_bytes", 128 << 20))
        self.level = int(options.get("level", 5))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    data = _member(_record(row), self.level)
                    if out is not None and size + len(data) > self.file_bytes:
                        out.close()
                        files[-1][1], out = size, None
                    if out is None:
                        files.append([f"{uuid.uuid4().hex}.warc.gz", 0])
                        out, size = store.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
                    out.write(data)
                    size += len(data)
        if out is not None:
            out.close()
            files[-1][1] = size
        return Written(files)

    def commit(self, messages: list) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{root}/_files-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        """Nothing names the files of a failed job."""


@dataclass
class Files(InputPartition):
    paths: list


class _Archive:
    """Records of one file, in order: parsed headers first, the block only when asked for."""

    def __init__(self, stream):
        self.stream, self.buffer = stream, b""

    def _fill(self, n: int) -> bool:
        while len(self.buffer) < n:
            more = self.stream.read(max(1 << 16, n - len(self.buffer)))
            if not more:
                return False
            self.buffer += more
        return True

    def _skip(self, n: int) -> None:
        if n <= len(self.buffer):
            self.buffer = self.buffer[n:]
        else:
            self.stream.seek(n - len(self.buffer), 1)
            self.buffer = b""

    def records(self):
        """Yields (headers, block) with block a function; it must be called, if at all, before the next record."""
        while self._fill(2) or self.buffer:
            if self.buffer[:1] in b"\r\n":  # what separates plain records
                self._skip(1)
                continue
            yield from self._packed() if self.buffer[:2] == b"\x1f\x8b" else self._plain()

    def _plain(self):
        end = self._head_end()
        head = _headers(self.buffer[:end])
        self._skip(end + 4)
        left = [int(head.get(LENGTH.lower(), 0))]

        def block() -> bytes:
            n, left[0] = left[0], 0
            if not self._fill(n):
                raise ValueError("the archive ends within a record")
            data, self.buffer = self.buffer[:n], self.buffer[n:]
            return data

        yield head, block
        self._skip(left[0])

    def _head_end(self) -> int:
        at = 0
        while (end := self.buffer.find(b"\r\n\r\n", max(0, at - 3))) < 0:
            at = len(self.buffer)
            if not self._fill(at + 1):
                raise ValueError("the archive ends within a header")
        return end

    def _member_size(self) -> int:
        """From the extra field, 0 where the archive has none."""
        self._fill(24)
        h = self.buffer
        if len(h) >= 24 and h[3] & 4 and h[10:16] == struct.pack("<H2sH", 12, b"sl", 8):
            return struct.unpack("<I", h[16:20])[0]
        return 0

    def _packed(self):
        size, z = self._member_size(), zlib.decompressobj(31)
        if size:
            part, used = b"", 0
            while (end := part.find(b"\r\n\r\n")) < 0 and used < size:  # no more of a member than its headers
                n = min(size, used + 2048)
                self._fill(n)
                part += z.decompress(self.buffer[used:n])
                used = n
            if end < 0:
                raise ValueError("the archive ends within a header")
            head = _headers(part[:end])

            def block() -> bytes:
                if not self._fill(size):
                    raise ValueError("the archive ends within a record")
                data = part + z.decompress(self.buffer[used:size]) + z.flush()
                return data[end + 4:end + 4 + int(head.get(LENGTH.lower(), 0))]

            yield head, block
            self._skip(size)
            return
        data = bytearray()  # archives of others: the member must be unpacked to find its end
        while not z.eof:
            if not self._fill(1):
                raise ValueError("the archive ends within a record")
            data += z.decompress(self.buffer)
            self.buffer = z.unused_data
        end = data.index(b"\r\n\r\n")
        head = _headers(bytes(data[:end]))
        yield head, lambda: bytes(data[end + 4:end + 4 + int(head.get(LENGTH.lower(), 0))])


def _headers(data: bytes) -> dict[str, str]:
    out = {}
    for line in data.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _field(head: dict[str, str], column: str) -> str | None:
    value = head.get(HEADER_OF[column].lower())
    if value is None:
        return None
    if column in ("record_id", "refers_to"):
        return value.removeprefix("<").removesuffix(">")
    return value.removeprefix("sha1:") if column == "payload_digest" else value


class WarcReader(DataSourceReader):
    """Plans groups of files, tests headers against the pushed filters, and unpacks only payloads that are asked for."""

    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema = options["path"], schema
        self.partition_bytes = int(options.get("partition_bytes", 32 << 20))
        self.verify = options.get("verify", "false").lower() == "true"
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list):
        """Equality and IN over header columns are tested here, all else by Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in HEADER_OF:
                self.wanted.append((f.attribute[0], frozenset([f.value])))
            elif isinstance(f, In) and len(f.attribute) == 1 and f.attribute[0] in HEADER_OF:
                self.wanted.append((f.attribute[0], frozenset(f.value)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        lists = [f.path for f in found if f.base_name.startswith("_files-")]
        if lists:
            files = [(f"{root}/{name}", size) for p in lists
                     for name, size in json.loads(store.open_input_stream(p).read())]
        else:
            files = [(f.path, f.size) for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz"))]
        groups, held = [[]], 0
        for path, size in sorted(files):
            if held and held + size > self.partition_bytes:
                groups.append([])
                held = 0
            groups[-1].append(path)
            held += size
        return [Files(g) for g in groups]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        names = self.schema.fieldNames()
        arrow = pa.schema([(n, {"content_length": pa.int64(), "payload_length": pa.int64(),
                                "payload": pa.binary()}.get(n, pa.string())) for n in names])
        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as stream:
                for head, block in _Archive(stream).records():
                    if any(_field(head, c) not in values for c, values in self.wanted):
                        continue
                    row = self._row(names, head, block)
                    rows.append(row)
                    held += len(row.get("payload") or b"") + 300
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    def _row(self, names: list[str], head: dict, block) -> dict:
        payload, kind = None, head.get(TYPE.lower())
        if "payload" in names or self.verify and kind == "response":
            payload = block()
            if head.get("content-type", "").startswith("application/http"):
                payload = payload.partition(b"\r\n\r\n")[2]
            if self.verify and kind == "response" and base32_sha1(payload) != _field(head, "payload_digest"):
                raise ValueError(f"payload and digest of {head.get(RECORD_ID.lower())} differ")
        own = {"content_length": int(head.get(LENGTH.lower(), 0)), "payload": payload,
               "payload_length": len(payload) if payload is not None and kind == "response"
               else int(head[FULL_LENGTH.lower()]) if FULL_LENGTH.lower() in head else None}
        return {n: own[n] if n in own else _field(head, n) for n in names}


class WarcSource(DataSource):
    """Format ``warc``. Options: path; reading: partition_bytes, verify; writing: file_bytes, level.

    A schema with fewer columns (``.schema(...)``) leaves the others undecoded; without ``payload`` and ``verify`` no
    payload is unpacked at all.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, columns: list[str] | None = None, verify: bool = False) -> DataFrame:
    """Records of all archives under ``path``, with only ``columns`` decoded."""
    register(spark)
    schema = SCHEMA if columns is None else T.StructType([SCHEMA[c] for c in columns])
    return spark.read.format("warc").schema(schema).option("verify", str(verify).lower()).load(path)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """One record per row of ``pages`` (page_id, url, html): the payload is the html in UTF-8.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id becomes the response
    and the others revisit it; smaller payloads are always responses. Null html is an empty payload, a null url leaves
    out the URI, null ids count as smallest, and rows that repeat the largest id are all responses. An empty table
    writes an empty archive list. Other columns are ignored.

    The largest id of each digest is found from digests alone; payloads are shuffled once, by digest, in a join whose
    inputs Spark can split when one payload has very many copies.
    """
    spark = pages.sparkSession
    register(spark)
    rows = pages.select("page_id", F.col("url").alias("target_uri"),
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("payload_sha1"), F.length("payload").cast("long").alias("payload_length"))
    first = staged(rows.groupBy("payload_sha1").agg(F.max("page_id").alias("top")), "warc-first")
    revisit = (F.col("payload_length") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("top"))
    records = rows.join(first, "payload_sha1").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        _record_id(F.col("page_id")).alias("record_id"), "target_uri", F.lit(date).alias("date"),
        F.when(revisit, _record_id(F.col("top"))).alias("refers_to"), "payload_sha1", "payload_length",
        F.when(revisit, F.lit(None)).otherwise(F.col("payload")).alias("payload"))
    records.write.format("warc").mode("append").save(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """Page records as rows (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Payloads of responses are unpacked and held against their digest; a mismatch fails the job.
    """
    records = read(spark, path, ["record_type", "record_id", "payload_digest", "refers_to", "payload_length"], verify=True)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    return records.select(number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
                          "payload_digest", "record_type", number("refers_to").alias("refers_to"))


def query(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    write(table(spark, root, "pages"), path, min_bytes=0)
    return page_records(spark, path)


# Base 32 takes five bits a letter: five hex digits make four letters.
SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
top AS (SELECT hex, max(page_id) AS top FROM p GROUP BY hex)
SELECT page_id, octet_length(payload) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) % 32 + 1, 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM p JOIN top USING (hex)
"""

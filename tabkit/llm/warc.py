"""WARC archives as a Spark data source, and pages written with repeated payloads as revisits.

``spark.dataSource.register(WarcDataSource)``, then ``format("warc")``, or ``read_archive``. Each file is one partition. Equality and
null tests on header columns are pushed into the reader, which parses a record's headers first and passes over the
payload of a record that is not wanted: in a plain file by seeking, in a gzip file by inflating past it.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    WriterCommitMessage,
)

from ..session import ensure_checkpoint_dir, fits_broadcast, written

REVISIT_BYTES = 1000
CHUNK = 1 << 20

COLUMNS = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, payload_bytes long, payload binary"
# The names of the header fields behind the columns, and the profile of a revisit.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
# What stands before the id in a record id.
PREFIX = "urn:record:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _location(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def record(kind: str, id: str, uri: str | None, digest: str, size: int, payload: bytes | None, refers_to: str | None) -> bytes:
    """One record; its block is an HTTP answer, of a revisit only the HTTP headers."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in uri))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class _Plain:
    """A file read forward. What has been read and not used begins at a place in one buffer."""

    def __init__(self, file):
        self.file, self.held, self.at = file, bytearray(), 0

    def more(self) -> bool:
        data = self.file.read(CHUNK)
        self.held += data
        return bool(data)

    def used(self, n: int) -> None:
        self.at += n
        if self.at > len(self.held) // 2:  # each byte is moved about once
            del self.held[: self.at]
            self.at = 0

    def until(self, end: bytes) -> bytes | None:
        begin = self.at
        while (found := self.held.find(end, begin)) < 0:
            begin = max(self.at, len(self.held) - len(end))
            if not self.more():
                return None
        out = bytes(self.held[self.at : found])
        self.used(len(out) + len(end))
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) - self.at < n:
            if not self.more():
                raise ValueError("the archive ends within a record")
        out = bytes(memoryview(self.held)[self.at : self.at + n])
        self.used(n)
        return out

    def skip(self, n: int) -> None:
        held = len(self.held) - self.at
        if n > held:
            self.file.seek(n - held, 1)
        self.used(min(n, held))


class _Inflated(_Plain):
    """A file of gzip members read forward."""

    def __init__(self, file):
        super().__init__(file)
        self.inflate, self.raw = zlib.decompressobj(31), b""

    def more(self) -> bool:
        while True:
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            data = self.raw or self.file.read(CHUNK)
            self.raw = b""
            if not data:
                return False
            out = self.inflate.decompress(data)
            if out:
                self.held += out
                return True

    def skip(self, n: int) -> None:
        while (held := len(self.held) - self.at) < n:
            n -= held
            self.used(held)
            if not self.more():
                raise ValueError("the archive ends within a record")
        self.used(n)


def _fields(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def _bare(value: str | None) -> str | None:
    return None if value is None else value.removeprefix("<").removesuffix(">")


def _digest(value: str | None) -> str | None:
    """Bare lower-case hex of a SHA-1 digest in base 32."""
    if value is None or not value.lower().startswith("sha1:"):
        return value
    return base64.b32decode(value[5:].upper()).hex()


def records(file, compressed: bool, wanted, payloads: bool) -> Iterator[tuple]:
    """Rows of the records whose header columns satisfy ``wanted``."""
    source = _Inflated(file) if compressed else _Plain(file)
    while (head := source.until(b"\r\n\r\n")) is not None:
        fields = _fields(head.lstrip(b"\r\n"))
        size = int(fields.get("content-length", 0))
        row = {column: fields.get(name) for column, name in HEADERS.items()}
        row |= {c: _bare(row[c]) for c in ("record_id", "refers_to")} | {"payload_digest": _digest(row["payload_digest"])}
        if not wanted(row):
            source.skip(size + 4)
            continue
        if payloads or size < CHUNK:
            block = source.take(size)
            source.skip(4)
        else:
            block = source.take(CHUNK)
            source.skip(size - CHUNK + 4)
        http, parted, body = block.partition(b"\r\n\r\n")
        is_http = parted and fields.get("content-type", "").startswith("application/http")
        held = int(_fields(http).get("content-length", len(body))) if is_http else size
        payload = body if is_http else block
        keep = payloads and row["record_type"] != "revisit"
        yield (*row.values(), held, payload if keep else None)


@dataclass
class WarcFile(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payloads = options["path"], options.get("payload", "true").lower() == "true"
        self.tests: list[tuple[str, list | None, bool]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, (EqualTo, EqualNullSafe)):
                self.tests.append((column, [f.value], True))
            elif isinstance(f, In):
                self.tests.append((column, list(f.value), True))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, None, False))
            elif isinstance(f, IsNull):
                self.tests.append((column, None, True))
            else:
                yield f

    def partitions(self) -> list[WarcFile]:
        system, path = _location(self.path)
        found = system.get_file_info(fs.FileSelector(path, recursive=True)) if system.get_file_info(path).type == fs.FileType.Directory else [system.get_file_info(path)]
        names = sorted(f.path for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz")) and not f.base_name.startswith(("_", ".")))
        return [WarcFile(name) for name in names] or [WarcFile("")]

    def wanted(self, row: dict) -> bool:
        for column, values, same in self.tests:
            if (row[column] in values) if values is not None else ((row[column] is None) == same):
                continue
            return False
        return True

    def read(self, partition: WarcFile) -> Iterator[tuple]:
        if partition.path:
            system, _ = _location(self.path)
            with system.open_input_file(partition.path) as file:
                yield from records(file, partition.path.endswith(".gz"), self.wanted, self.payloads)


@dataclass
class Written(WriterCommitMessage):
    path: str


class WarcWriter(DataSourceArrowWriter):
    """A file per task, under a hidden name until all tasks have ended."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.compressed = options["path"], options.get("compressed", "true").lower() == "true"
        system, path = _location(self.path)
        if system.get_file_info(path).type == fs.FileType.Directory and system.get_file_info(fs.FileSelector(path)):
            if not overwrite:
                raise ValueError(f"{self.path} is not empty")
            system.delete_dir_contents(path)
        system.create_dir(path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = _location(self.path)
        name = f"{path}/_part-{uuid4()}.warc" + (".gz" if self.compressed else "")
        with system.open_output_stream(name, compression=None) as file:
            for batch in iterator:
                columns = ["record_type", "record_id", "target_uri", "payload_digest", "payload_bytes", "payload", "refers_to"]
                for values in zip(*[batch[c] for c in columns]):
                    data = record(*[v.as_py() for v in values])
                    if self.compressed:
                        deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                        data = deflate.compress(data) + deflate.flush()
                    file.write(data)
        return Written(name)

    def commit(self, messages) -> None:
        system, _ = _location(self.path)
        for message in messages:
            folder, _, name = message.path.rpartition("/")
            system.move(message.path, f"{folder}/{name[1:]}")

    def abort(self, messages) -> None:
        system, _ = _location(self.path)
        for message in messages:
            if message is not None:
                system.delete_file(message.path)


class WarcDataSource(DataSource):
    """Options: ``path``; reading, ``payload`` (false leaves it null); writing, ``compressed``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def archive(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html", revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write a record per row of ``pages`` under ``path``; the payload is the html in UTF-8.

    Of rows with equal payloads of at least ``revisit_bytes``, the one with the largest id is the response and
    the others are revisits of it; smaller payloads are all responses. A null html is an empty payload. An id that is
    text is percent-encoded in its record id; a null or empty one has an empty record id and is the response only if all equal rows have null ids; rows that repeat the
    largest id are all responses. Other columns are not read, whatever their names.

    Digests are grouped after partial aggregation. Only revisits are joined back to the rows: broadcast if
    their count shows that they fit, else by a shuffled join.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcDataSource)
    rows = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("target_uri"), F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    small = written(rows.filter(F.col("payload_bytes") >= revisit_bytes).select("id", "payload_digest", "payload_bytes"))
    last = small.groupBy("payload_digest", "payload_bytes").agg(F.max("id").alias("last"), F.count("*").alias("n")).filter("n > 1").drop("n")
    repeated = small.join(last, ["payload_digest", "payload_bytes"]).filter(~F.col("id").eqNullSafe(F.col("last")))
    repeated = written(repeated.select("id", "payload_digest", "last").distinct())
    repeated = F.broadcast(repeated) if fits_broadcast(repeated.count(), 3) else repeated
    found = rows.join(
        repeated.select(F.col("id").alias("r_id"), F.col("payload_digest").alias("r_digest"), "last"),
        F.col("id").eqNullSafe(F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest")),
        "left",
    )
    again = F.col("r_digest").isNotNull()
    named = lambda c: F.concat(F.lit(PREFIX), F.coalesce(F.url_encode(F.col(c).cast("string")), F.lit("")))
    out = found.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        named("id").alias("record_id"),
        "target_uri",
        "payload_digest",
        F.when(again, named("last")).alias("refers_to"),
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )
    out.write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under ``path``. Spark's push-down into Python sources is turned on for the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def warc_round_trip(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` archived in the checkpoint folder and read back: ``id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Size and digest of a response are those of the payload that was read, of a revisit those its headers give.
    """
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid4()}"
    archive(pages, path, id, url, html)
    kind = pages.schema[id].dataType
    given = lambda c: F.url_decode(F.substr(F.col(c), F.lit(len(PREFIX) + 1)))
    number = lambda c: F.nullif(given(c), F.lit("")).cast(kind)
    # A scan that reads payloads, and one that passes over them.
    responses = read_archive(spark, path).filter("record_type = 'response'")
    others = read_archive(spark, path, payload=False).filter("record_type = 'revisit'")
    size, digest = F.octet_length("payload").cast("long"), F.sha1("payload")

    def rows(found: DataFrame, payload_bytes, payload_digest) -> DataFrame:
        return found.select(
            number("record_id").alias(id),
            payload_bytes.alias("payload_bytes"),
            payload_digest.alias("payload_digest"),
            "record_type",
            number("refers_to").alias("refers_to"),
        )

    return rows(responses, size, digest).unionByName(rows(others, F.col("payload_bytes"), F.col("payload_digest")))

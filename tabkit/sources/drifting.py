"""Folders of CSV files whose headers differ from file to file.

Spark takes the header of one file and reads all others by position, so two
files with swapped columns come back wrong without any error. Here the header
line of every file is read first, files are grouped by header, each group is
scanned once with its own column names, and the groups are united by name.
"""

from __future__ import annotations

import bz2
import csv
import zlib
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# One scan task per file, never split: the header pass stops after the first line.
_WHOLE_FILE = str(1 << 50)
_PIECE = 1 << 20
_REASONS = pa.schema([("file_path", pa.string()), ("reason", pa.string())])


def _first_line(batches):
    for batch in batches:
        if len(batch):
            yield batch.head(1)
            return


def header_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file_path, header)`` for each non-empty file; a task reads one buffer of its file."""
    scan = spark.newSession()
    scan.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILE)
    scan.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILE)
    scan.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = scan.read.option("ignoreCorruptFiles", True).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("header")
    ).mapInPandas(_first_line, "file_path string, header string")


def _reason(name: str, content: bytes) -> str | None:
    """Why a compressed file cannot be read to its end, None if it can."""
    new = (lambda: zlib.decompressobj(31)) if name.endswith(".gz") else bz2.BZ2Decompressor
    try:
        data = memoryview(content)
        while len(data):
            reader = new()
            while not reader.eof and len(data):
                reader.decompress(data[:_PIECE])
                data = data[_PIECE:]
            if not reader.eof:
                return "it breaks off"
            data = memoryview(reader.unused_data + bytes(data))
    except (zlib.error, OSError, EOFError) as error:
        return str(error)
    return None


def damaged_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file_path, reason)`` of the compressed files under ``path`` that cannot be read to their end.

    Many files are proved in one task, one after the other; a file's bytes are held, not what they unpack to. Files that
    are not compressed have no end to miss.
    """
    scan = spark.newSession()
    scan.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    files = scan.read.format("binaryFile").option("pathGlobFilter", "*.{gz,bz2}").load(path)

    def run(batches):
        for batch in batches:
            found = [(name, _reason(name, content)) for name, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist())]
            found = [f for f in found if f[1] is not None]
            yield pa.RecordBatch.from_pydict({"file_path": [f[0] for f in found], "reason": [f[1] for f in found]}, schema=_REASONS)

    return files.select("path", "content").mapInArrow(run, "file_path string, reason string")


def _columns_of(header: str) -> tuple[str, ...]:
    """Names in a header line; blank and repeated ones are told apart by their position."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header.lstrip("\ufeff")]))):
        name = name or f"_c{i}"
        names.append(f"{name}_{i}" if name in names else name)
    return tuple(names)


def _plain(uri: str) -> str:
    """A listed file as a path Spark can read again, whichever way its URI was written."""
    parts = urlsplit(uri)
    return f"{parts.scheme}://{parts.netloc}{unquote(parts.path)}"


def _headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Column names by file; one header line per file reaches the driver, like the listing itself."""
    found = header_lines(spark, path).collect()
    return {_plain(row.file_path): _columns_of(row.header) for row in found}


def drift_report(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file_path, columns, reason)`` of every file; NULL columns mean it has no header, a reason that it is damaged."""
    headers, damaged = _headers(spark, path), _damaged(spark, path)
    listed = [_plain(name) for name in spark.read.text(path).inputFiles()]
    rows = [(name, list(headers[name]) if name in headers else None, damaged.get(name)) for name in listed]
    return spark.createDataFrame(rows, "file_path string, columns array<string>, reason string")


def _damaged(spark: SparkSession, path: str | Sequence[str]) -> dict[str, str]:
    return {_plain(row.file_path): row.reason for row in damaged_files(spark, path).collect()}


def _scan(spark: SparkSession, names: Sequence[str], files: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(sorted(files))
    )


def read_drifting(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    skip_damaged: bool = False,
) -> DataFrame:
    """All CSV rows under ``path`` as strings, united by column name.

    With ``columns`` only those names are kept, absent ones as NULL, and files
    that agree on the positions of these columns share one scan whatever else
    they hold. Files without a header line add no rows, nor do files that cannot be
    read from the start. A compressed file that breaks off later fails the job, unless ``skip_damaged``
    is given: then every compressed file is read to its end first, and a damaged one gives no rows at all;
    ``drift_report`` names it with the reason.
    """
    groups: dict[tuple, list[str]] = defaultdict(list)
    damaged = _damaged(spark, path) if skip_damaged else {}
    for file_path, names in _headers(spark, path).items():
        if file_path in damaged:
            continue
        if columns is None:
            groups[names].append(file_path)
        else:
            places = tuple(names.index(c) if c in names else -1 for c in columns)
            groups[places].append(file_path)
    if not groups:
        schema = [T.StructField(name, T.StringType()) for name in columns or ()]
        return spark.createDataFrame([], T.StructType(schema))
    if columns is None:
        scans = [_scan(spark, names, groups[names]) for names in sorted(groups)]
    else:
        scans = [
            _scan(spark, [f"_c{i}" for i in range(max(*places, 0) + 1)], groups[places]).select(
                *[
                    (F.lit(None).cast("string") if at < 0 else F.col(f"_c{at}")).alias(c)
                    for c, at in zip(columns, places)
                ]
            )
            for places in sorted(groups)
        ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read_folder(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, skip_damaged: bool = False
) -> DataFrame:
    """Every CSV under ``path``, all strings, columns matched by name."""
    return read_drifting(spark, path, columns, skip_damaged)

"""First lines of files: a data source with one read per file.

Header discovery needs the first line of each file and nothing else. The
source opens a file, reads at most one block and stops at the first line end;
compressed files are decompressed as far as that block. Files are reached
through Arrow's file systems (local, hdfs, s3, gcs); for other stores
``readable`` is false and the caller scans with Spark instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK_BYTES = 64 << 10
FILES_PER_TASK = 256


def _filesystem(uri: str):
    """(file system, path in it) of a file's address as Spark lists it."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path)
    return fs.FileSystem.from_uri(uri)


def readable(uri: str) -> bool:
    """Whether Arrow has a file system for the address."""
    return urlparse(uri).scheme in ("", "file", "hdfs", "s3", "s3a", "gs")


def first_line(uri: str) -> tuple[str, int]:
    """(first line without its end, bytes read). A line that does not end
    within a block is an error, since no header is so long."""
    filesystem, path = _filesystem(uri.replace("s3a://", "s3://", 1))
    with filesystem.open_input_stream(path, compression="detect") as stream:
        block = stream.read(BLOCK_BYTES)
    line, end, _ = block.partition(b"\n")
    if not end and len(block) == BLOCK_BYTES:
        raise ValueError(f"no line end within {BLOCK_BYTES} bytes of {uri}")
    return line.decode("utf-8-sig", "replace").rstrip("\r"), len(block)


class FirstLines(DataSource):
    """``file string, line string, bytes int`` of the files in option ``files``
    (a JSON list)."""

    @classmethod
    def name(cls) -> str:
        return "first_lines"

    def schema(self) -> str:
        return "file string, line string, bytes int"

    def reader(self, schema) -> DataSourceReader:
        return FirstLinesReader(json.loads(self.options["files"]))


class FirstLinesReader(DataSourceReader):
    def __init__(self, files: list[str]):
        self.files = files

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.files[i:i + FILES_PER_TASK]) for i in range(0, len(self.files), FILES_PER_TASK)]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str, int]]:
        for file in partition.value:
            yield (file, *first_line(file))


def first_lines(spark: SparkSession, files: list[str]):
    """The files' first lines as a DataFrame, read by as many tasks as there
    are groups of FILES_PER_TASK files."""
    spark.dataSource.register(FirstLines)
    return spark.read.format(FirstLines.name()).option("files", json.dumps(files)).load()

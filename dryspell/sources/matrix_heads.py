"""The first lines of many text files as one job: a Python data source.

The file list is dealt to tasks, one partition per group of files; a task opens each
of its files, reads as far as the wanted lines and stops. Nothing but the list is
on the driver, and the files' text is not scanned. Files are opened through Arrow's
file systems, which know the schemes in ``SCHEMES``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMES = ("", "file", "hdfs", "viewfs", "s3", "s3a", "gs")

SCHEMA = "block string, field int, value string"

#: Files read by one task, and bytes read at a time.
FILES_PER_TASK = 64
CHUNK = 1 << 18


def block_name(uri: str) -> str:
    """A file's name as Spark's ``_metadata.file_path`` has it."""
    return "file:" + uri[len("file://"):] if uri.startswith("file:///") else uri


def first_lines(uri: str, n: int) -> list[str]:
    """The first ``n`` lines of a file (fewer if it ends before), without their line ends."""
    from pyarrow import fs

    at = urlsplit(uri)
    path = unquote(at.path)
    if at.scheme in ("", "file"):
        system = fs.LocalFileSystem()
    else:
        scheme = "s3" if at.scheme == "s3a" else at.scheme
        system, base = fs.FileSystem.from_uri(f"{scheme}://{at.netloc}")
        path = base.rstrip("/") + path
    data = b""
    with system.open_input_stream(path) as stream:
        while len(data.splitlines()) <= n:
            more = stream.read(CHUNK)
            if not more:
                break
            data += more
    lines = data.splitlines()[:n]
    if lines:
        lines[0] = lines[0].removeprefix(b"\xef\xbb\xbf")
    return [line.decode("utf-8") for line in lines]


class Group(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class HeadReader(DataSourceReader):
    def __init__(self, files: list[str], n: int):
        self.files, self.n = files, n

    def partitions(self) -> list[Group]:
        return [Group(self.files[i:i + FILES_PER_TASK]) for i in range(0, len(self.files), FILES_PER_TASK)]

    def read(self, partition: Group) -> Iterator[tuple]:
        for uri in partition.files:
            for i, line in enumerate(first_lines(uri, self.n)):
                yield block_name(uri), i, line


class MatrixHeads(DataSource):
    """Options: ``files``, a JSON list of URIs, and ``lines``, how many lines of each."""

    @classmethod
    def name(cls) -> str:
        return "matrix_heads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HeadReader:
        return HeadReader(json.loads(self.options["files"]), int(self.options["lines"]))

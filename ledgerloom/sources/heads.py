"""First lines and character sets of many files, a bounded number of bytes read from each.

A Python data source: its partitions are runs of files, so a folder of any number of files is looked at by
all tasks, and of each file only its first line and a few slices spread over the rest are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Spark decodes this name right; its aliases map some vendor characters wrongly.
JAPANESE = "windows-31j"
SLICE_BYTES = 1 << 14
SLICES = 8
_FILES_PER_PARTITION = 64
_PYTHON_NAMES = {JAPANESE: "cp932"}


def decode(raw: bytes, encoding: str) -> str:
    return raw.decode(_PYTHON_NAMES.get(encoding, encoding))


def _open(uri: str):
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return open(unquote(parsed.path), "rb")
    from pyarrow import fs

    files, name = fs.FileSystem.from_uri(uri.replace("s3a:", "s3:", 1))
    return files.open_input_file(name)


def first_line(source) -> bytes:
    """The first line without its line break, read in slices."""
    source.seek(0)
    found = b""
    while b"\n" not in found:
        part = source.read(SLICE_BYTES)
        if not part:
            break
        found += part
    return found.split(b"\n", 1)[0].rstrip(b"\r")


def samples(source, size: int) -> list[bytes]:
    """Whole lines of slices spread evenly over the file; the first begins at its start, the last ends at its end."""
    last = max(size - SLICE_BYTES, 0)
    found = []
    for at in sorted({last * i // (SLICES - 1) for i in range(SLICES)}):
        source.seek(at)
        part = source.read(SLICE_BYTES)
        if at:  # the first line of a slice may have lost its beginning
            part = part.split(b"\n", 1)[1] if b"\n" in part else b""
        if at + SLICE_BYTES < size:  # and the last one its end
            part = part.rsplit(b"\n", 1)[0] if b"\n" in part else b""
        found.append(part)
    return found


def fitting(parts: Sequence[bytes], encodings: Sequence[str]) -> list[str]:
    """The encodings that can decode all parts, in their order; where it counts, UTF-8 first, as little else is valid by chance."""
    fits = []
    for encoding in encodings:
        try:
            for part in parts:
                decode(part, encoding)
        except UnicodeDecodeError:
            continue
        fits.append(encoding)
    if any(not part.isascii() for part in parts):
        fits.sort(key=lambda e: e.upper() != "UTF-8")
    return fits


class _Files(InputPartition):
    def __init__(self, uris: list[str]):
        self.uris = uris


class _HeadReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uris, self.encodings = json.loads(options["files"]), json.loads(options["encodings"])

    def partitions(self) -> Sequence[InputPartition]:
        return [_Files(self.uris[i : i + _FILES_PER_PARTITION]) for i in range(0, len(self.uris), _FILES_PER_PARTITION)]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for uri in partition.uris:
            with _open(uri) as source:
                size = source.seek(0, 2)
                size = source.tell() if size is None else size
                head = first_line(source)
                yield uri, head, fitting([head, *samples(source, size)], self.encodings)


class FileHeads(DataSource):
    """(file, head, encodings) of the files listed in option ``files``; see :func:`file_heads`."""

    @classmethod
    def name(cls) -> str:
        return "file_heads"

    def schema(self) -> str:
        return "file string, head binary, encodings array<string>"

    def reader(self, schema) -> DataSourceReader:
        return _HeadReader(self.options)


def file_heads(spark: SparkSession, path: str | Sequence[str], encodings: Sequence[str]) -> DataFrame:
    """(file, head, encodings): the first line of every file, and which of the encodings fit it and samples of its body.

    The driver lists the files, as for any read.
    """
    files = sorted(spark.read.format("binaryFile").load(path).inputFiles())
    spark.dataSource.register(FileHeads)
    return spark.read.format("file_heads").options(files=json.dumps(files), encodings=json.dumps(list(encodings))).load()

"""Text lines of files whose compression is told by their first bytes (SRC-9)."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

# The first bytes of a gzip stream.
GZIP = b"\x1f\x8b"
#: Bytes of a plain file that a partition takes, and lines of a batch.
SPLIT, LINES = 64 << 20, 10_000
SCHEMA = StructType([StructField("path", StringType()), StructField("at", LongType()), StructField("value", StringType())])


class Part(InputPartition):
    def __init__(self, uri: str, start: int, end: int | None) -> None:
        self.uri, self.start, self.end = uri, start, end


class MagicReader(DataSourceReader):
    """One partition for each compressed file, and for each SPLIT bytes of a plain one."""

    def __init__(self, options: dict) -> None:
        self.root, self.split = options["path"], int(options.get("splitBytes", SPLIT))

    def partitions(self) -> list[Part]:
        system, root = fs.FileSystem.from_uri(self.root)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.root)
        found = [info] if info.type == fs.FileType.File else [f for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.type == fs.FileType.File and f.base_name[:1] not in "._"]
        parts = []
        for f in sorted(found, key=lambda f: f.path):
            with system.open_input_stream(f.path, compression=None) as stream:  # not by name
                packed = stream.read(2) == GZIP
            parts += [Part(f.path, 0, None)] if packed else [Part(f.path, k, k + self.split) for k in range(0, f.size, self.split)]
        return parts

    def read(self, part: Part | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no partitions: the files are empty
            return
        system, _ = fs.FileSystem.from_uri(self.root)
        places, values = [], []
        for at, value in self._lines(system, part):
            places.append(at)
            values.append(value)
            if len(values) == LINES:
                yield self._batch(part, places, values)
                places, values = [], []
        if values:
            yield self._batch(part, places, values)

    @staticmethod
    def _batch(part: Part, places: list[int], values: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part.uri] * len(values)), pa.array(places, pa.int64()), pa.array(values)], names=["path", "at", "value"])

    @staticmethod
    def _lines(system: fs.FileSystem, part: Part) -> Iterator[tuple[int, str]]:
        """Lines that start in the part, with the place of their first byte (in the text, if it was compressed)."""
        with system.open_input_file(part.uri) as raw:
            handle = io.BufferedReader(raw, 1 << 20) if part.end is not None else gzip.GzipFile(fileobj=raw, mode="rb")
            at = part.start
            if at:
                handle.seek(at - 1)
                at += len(handle.readline()) - 1  # the rest of a line that the part before has
            while part.end is None or at < part.end:
                line = handle.readline()
                if not line:
                    return
                yield at, (line.removeprefix(b"\xef\xbb\xbf") if at == 0 else line).rstrip(b"\r\n").decode("utf-8", "replace")
                at += len(line)


class MagicText(DataSource):
    """``spark.read.format("magic_text").load(path)``: (path, at, value) lines of a file, or of all files in a folder, gzip or plain under any name.

    Files are streamed line by line, and large plain ones read by many tasks; an empty
    file has no lines.  The path needs a file system that pyarrow opens (local, HDFS, S3,
    GCS, Azure); others raise.
    """

    @classmethod
    def name(cls) -> str:
        return "magic_text"

    def schema(self) -> StructType:
        return SCHEMA

    def reader(self, schema: StructType) -> MagicReader:
        return MagicReader(self.options)

"""One file from many tasks: bytes whose places are known before they are written."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Bytes that are copied at once when the parts are joined.
BUFFER = 8 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or of an absolute path."""
    return fs.FileSystem.from_uri(path)


@dataclass
class Part(WriterCommitMessage):
    """A stretch of the file that one task has written: its place, its length and where it lies."""

    pieces: list[tuple[int, int, str]]


class OrderedWriter(DataSourceWriter):
    """Rows ``offset, data``, sorted in each task, become one file.

    Each task writes each stretch of neighbouring rows as a part of its own. Only parts of
    tasks that Spark has committed are joined, in the order of their places, so a task that
    is lost, repeated or late leaves nothing behind in the file. Places that are missing or
    taken twice are an error, and the file appears whole, by one rename, or not at all.
    """

    def __init__(self, path: str) -> None:
        self.path, self.folder = path, f"{path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Part:
        store, folder = opened(self.folder)
        store.create_dir(folder)
        pieces: list[tuple[int, int, str]] = []
        out, begin, end = None, 0, -1
        for row in iterator:
            if row["offset"] != end:
                if out is not None:
                    out.close()
                    pieces.append((begin, end - begin, name))
                begin = end = row["offset"]
                name = f"{folder}/{begin:020d}-{uuid.uuid4().hex}"
                out = store.open_output_stream(name)
            out.write(bytes(row["data"]))
            end += len(row["data"])
        if out is not None:
            out.close()
            pieces.append((begin, end - begin, name))
        return Part(pieces)

    def commit(self, messages: list[Part | None]) -> None:
        store, path = opened(self.path)
        whole, end = f"{path}.{uuid.uuid4().hex}.whole", 0
        with store.open_output_stream(whole) as out:
            for begin, size, name in sorted(x for m in messages if m for x in m.pieces):
                if begin != end:
                    raise ValueError(f"the bytes from {min(begin, end)} to {max(begin, end)} are {'missing' if begin > end else 'there twice'}")
                with store.open_input_stream(name) as part:
                    while block := part.read(BUFFER):
                        out.write(block)
                end += size
        store.move(whole, path)
        self._clear()

    def abort(self, messages: list[Part | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        store, folder = opened(self.folder)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


class OrderedFile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidegrid_ordered"

    def schema(self) -> str:
        return "offset long, data binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return OrderedWriter(self.options["path"])


def write_ordered(rows: DataFrame, path: str) -> None:
    """Write rows ``offset, data``, which cover a file without gaps, as that file, replacing what is there."""
    rows.sparkSession.dataSource.register(OrderedFile)
    dealt = rows.select("offset", "data").repartitionByRange("offset").sortWithinPartitions("offset")
    dealt.write.format("tidegrid_ordered").mode("append").save(path)

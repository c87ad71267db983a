"""A line source over growing files that can be restarted.

``spark.readStream.format("lines").load(folder)`` gives one row ``value`` per
line of the files in ``folder``, new lines as the files grow.  An offset is the
number of bytes read of each file, always at a line's end, and is kept in the
query's checkpoint: a restarted query goes on at that byte, and a batch that is
run again reads the same bytes.  The last line of a file counts once its line end
is written.  A batch is read in ranges of ``rangeBytes`` (64 MB), a task each; a
line belongs to the range in which it begins.

Files may be added at any time and only grow: one that has become shorter than
what was read of it fails the query, and one that was removed and comes back after a
restart is a new file.  Files that begin with ``_`` or ``.`` and sub-folders are not
read.  Line ends are LF or CR LF; bytes that are no UTF-8 become U+FFFD.
The folder must be on a filesystem that the driver and all executors reach
(local, HDFS or an object store through ``pyarrow.fs``); offsets grow with the
number of files, so rotated files should be moved away once they are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..session import arrow_fs, list_dir

RANGE_BYTES = 64 << 20
_READ_BYTES = 4 << 20
_TAIL_BYTES = 64 << 10


@dataclass
class LineRange(InputPartition):
    """The lines that begin in bytes ``start`` to ``end`` - 1 of a file; ``first``
    is a line's beginning, and ``last`` the end of the batch's lines."""

    name: str
    start: int
    end: int
    first: int
    last: int


def complete_bytes(stream, size: int, known: int) -> int:
    """Bytes up to the last line end of a file of this size; ``known`` is one."""
    at = size
    while at > known:
        lo = max(known, at - _TAIL_BYTES)
        stream.seek(lo)
        found = stream.read(at - lo).rfind(b"\n")
        if found >= 0:
            return lo + found + 1
        at = lo
    return known


def read_lines(stream, part: LineRange) -> Iterator[list[bytes]]:
    """The lines of a range, in blocks."""
    at = part.start
    if at > part.first:
        at -= 1                     # a line begins at ``start`` if one ends just before
        stream.seek(at)
        while at < part.last:
            block = stream.read(min(_TAIL_BYTES, part.last - at))
            found = block.find(b"\n")
            if found >= 0:
                at += found + 1
                break
            at += len(block)
    rest = b""
    stream.seek(at)
    begins = at                     # where ``rest`` begins
    while begins < part.end and at < part.last:
        block = stream.read(min(_READ_BYTES, part.last - at))
        if not block:
            raise EOFError(f"{part.name} ends at byte {at}, before its lines up to {part.last}")
        at += len(block)
        lines = (rest + block).split(b"\n")
        rest = lines.pop()
        out = []
        for line in lines:
            if begins >= part.end:
                break
            out.append(line)
            begins += len(line) + 1
        if out:
            yield out


class LineFilesReader(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes
        self.known: dict[str, int] = {}     # line ends found so far: no byte is looked at twice

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        fs, _ = arrow_fs(self.path)
        for info in list_dir(self.path):
            if info.is_file and not info.base_name.startswith(("_", ".")):
                known = self.known.get(info.base_name, 0)
                if info.size < known:
                    raise ValueError(f"{info.base_name} was read up to byte {known} and now has {info.size}")
                if info.size > known:
                    with fs.open_input_file(info.path) as f:
                        self.known[info.base_name] = complete_bytes(f, info.size, known)
        return {"files": {k: v for k, v in sorted(self.known.items()) if v}}

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        out = []
        for name, last in sorted(end["files"].items()):
            first = start["files"].get(name, 0)
            if last < first:
                raise ValueError(f"{name} was read up to byte {first} and now has lines up to {last} only")
            for at in range(first, last, self.range_bytes):
                out.append(LineRange(name, at, min(at + self.range_bytes, last), first, last))
        return out

    def read(self, part: LineRange):
        import pyarrow as pa
        fs, base = arrow_fs(self.path)
        with fs.open_input_file(f"{base}/{part.name}") as f:
            for lines in read_lines(f, part):
                texts = [(v[:-1] if v.endswith(b"\r") else v).decode("utf-8", "replace") for v in lines]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the checkpoint."""


class LineFiles(DataSource):
    """Streaming source ``lines``: option ``path`` (a folder) and ``rangeBytes``."""

    @classmethod
    def name(cls):
        return "lines"

    def schema(self):
        return "value string"

    def streamReader(self, schema):
        path = self.options.get("path")
        if not path:
            raise ValueError("lines needs a folder")
        return LineFilesReader(path.rstrip("/"), int(self.options.get("rangeBytes", RANGE_BYTES)))


def register(spark) -> None:
    spark.dataSource.register(LineFiles)

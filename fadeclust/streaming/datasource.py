"""A named streaming sink built on the Python Data Source API (K5, K7).

``spark.dataSource.register(JsonLinesSink)`` makes
``df.writeStream.format("jsonl_points").option("path", p).start()`` work.
Each task writes its rows (one string column, normally ``to_json`` output made
on the JVM side) to a file of its own under ``p/data``; the driver's
``commit`` publishes ``p/_batches/N.json``, the list of batch N's files, in one
step, replacing the list of an earlier attempt.  Files are never moved, and
:func:`read_committed` reads listed files alone, so what a failed or repeated
task leaves behind is never seen.  The path must be on a filesystem all
executors and the driver reach (local, HDFS or an object store through
``pyarrow.fs``).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import (DataSource, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)

from ..session import arrow_fs, list_dir, read_small_text, write_small_text


@dataclass
class _Written(WriterCommitMessage):
    files: list


class JsonLinesStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, column: str | None):
        self.path = path.rstrip("/")
        self.column = column

    def write(self, iterator):
        import pyarrow as pa
        import pyarrow.compute as pc

        fs, base = arrow_fs(self.path)
        fs.create_dir(f"{base}/data", recursive=True)
        name = f"part-{uuid.uuid4().hex}.jsonl"
        rows = 0
        with fs.open_output_stream(f"{base}/data/{name}") as fh:
            for batch in iterator:
                col = batch.column(self.column) if self.column else batch.column(0)
                if len(col):
                    lines = pc.fill_null(col.cast(pa.string()), "")
                    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(lines)], lines), "\n")
                    fh.write(joined[0].as_buffer())
                    fh.write(b"\n")
                    rows += len(col)
        return _Written([name] if rows else [])

    def commit(self, messages, batchId) -> None:
        files = sorted(f for m in messages if m is not None for f in m.files)
        write_small_text(self.path, f"_batches/{int(batchId)}.json", json.dumps(files))

    def abort(self, messages, batchId) -> None:
        """Files of a failed batch are in no list."""


def read_committed(spark, path: str):
    """The lines (``value``) of all committed batches."""
    names = []
    for info in list_dir(f"{path.rstrip('/')}/_batches"):
        names += json.loads(read_small_text(f"{path.rstrip('/')}/_batches/{info.base_name}"))
    if not names:
        return spark.createDataFrame([], "value string")
    return spark.read.text([f"{path.rstrip('/')}/data/{n}" for n in names])


class JsonLinesSink(DataSource):
    """Streaming sink ``jsonl_points``: options ``path`` and ``column``."""

    @classmethod
    def name(cls):
        return "jsonl_points"

    def schema(self):
        return "value string"

    def streamWriter(self, schema, overwrite):
        path = self.options.get("path")
        if not path:
            raise ValueError("jsonl_points needs option path")
        return JsonLinesStreamWriter(path, self.options.get("column"))


def register(spark) -> None:
    spark.dataSource.register(JsonLinesSink)

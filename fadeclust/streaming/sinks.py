"""Sinks (K1-K8, U4, U5).

Batch functions ``(df, batch_id) -> None`` are used with ``foreachBatch``;
each writes under ``batch_id=N`` with overwrite, so a re-run batch replaces
its own output.  ``LineWriter`` is the row-at-a-time ``foreach`` writer: the
slow path, kept for line-oriented receivers; bulk outputs should use
:func:`write_lines_batch`, which stays a distributed Spark write.
"""

from __future__ import annotations

import json
import re
import socket
import uuid

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import arrow_fs, list_dir, write_small_text

DISTINCT_SCHEMA = StructType([StructField("batch_id", LongType(), False),
                              StructField("distinct_count", LongType(), False)])

# Rows shown per batch by ``print_sample`` (the DStream ``print()`` default).
SAMPLE_ROWS = 10
# Rows shown per batch by ``console`` (the console sink's default).
CONSOLE_ROWS = 20


def console(df: DataFrame, truncate: bool = False, trigger: dict | None = None,
            numRows: int = CONSOLE_ROWS, **start_kw):
    """K1: print the first ``numRows`` rows of each batch, untruncated.  Every row
    is computed, but only the first ``numRows + 1`` of each task come to the driver
    (Spark's own console sink sends it the whole batch)."""
    numRows = int(numRows)

    def show(batch: DataFrame, batch_id: int) -> None:
        line = "-" * 43
        print(f"{line}\nBatch: {batch_id}\n{line}")
        first = batch.withColumn("__row", F.monotonically_increasing_id()).orderBy("__row").limit(numRows + 1)
        first.drop("__row").show(numRows, truncate)

    w = df.writeStream.foreachBatch(show)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(**start_kw)


def run_batches(df: DataFrame, func, checkpoint: str, query_name: str | None = None,
                trigger: dict | None = None):
    """Call ``func(batch_df, batch_id)`` for each micro-batch."""
    w = df.writeStream.foreachBatch(func).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def print_sample(n: int = SAMPLE_ROWS):
    """K8: show the first ``n`` rows of each batch."""
    def show(df: DataFrame, batch_id: int) -> None:
        print(f"-------- batch {batch_id} --------")
        df.show(n, truncate=False)
    return show


def write_lines_batch(path: str, col: str = "value"):
    """K3: write one text line per row to ``path/batch_id=N`` (distributed,
    nothing collected to the driver)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.select(col).write.mode("overwrite").text(f"{path}/batch_id={int(batch_id)}")
    return write


def batch_distinct_count(path: str):
    """K6/A3: record ``(batch_id, distinct_count)`` for each batch in the JSON
    table at ``path`` (partition ``batch_id=N``, replaced on replay).  The count
    is one Spark job (distinct with map-side partial aggregation); the one-row
    result is published from the driver without a second job."""
    def count(df: DataFrame, batch_id: int) -> None:
        n = df.distinct().count()
        write_small_text(path, f"batch_id={int(batch_id)}/part-00000.json",
                         json.dumps({"distinct_count": int(n)}) + "\n")
    return count


def read_distinct_counts(spark, path: str) -> DataFrame:
    """The table written by :func:`batch_distinct_count`."""
    return spark.read.schema(DISTINCT_SCHEMA).json(path).select("batch_id", "distinct_count")


def fan_out(*funcs, persist: bool = True):
    """Hand one batch to several sinks, computing it once."""
    def run(df: DataFrame, batch_id: int) -> None:
        d = df.persist() if persist else df
        try:
            for f in funcs:
                f(d, batch_id)
        finally:
            if persist:
                d.unpersist()
    return run


# ---- K2: row writer ------------------------------------------------------------

class FileLineTransport:
    """Lines to ``<dir>/epoch=<epoch>/<run>-part-<partition>.txt`` on a shared
    filesystem (local, HDFS or object store through ``pyarrow.fs``).

    Written to a ``_``-prefixed name (which readers skip) and moved on success,
    so a retried task replaces its own file and a failed one leaves nothing
    visible.  The run is the streaming query's run id: when an epoch is run
    again after a restart, its tasks remove what the run before left there, so
    a re-run with fewer partitions leaves no stale rows."""

    def __init__(self, directory: str):
        self.directory = directory

    def open(self, partition_id: int, epoch_id: int):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        run = (ctx.getLocalProperty("spark.jobGroup.id") if ctx else None) or "run"
        run = "".join(c for c in run if c.isalnum())
        self._fs, base = arrow_fs(self.directory)
        folder = f"{base}/epoch={epoch_id:09d}"
        self._fs.create_dir(folder, recursive=True)
        for info in list_dir(f"{self.directory}/epoch={epoch_id:09d}"):
            if not info.base_name.startswith(("_", run)):
                try:
                    self._fs.delete_file(info.path)
                except FileNotFoundError:
                    pass        # another task of this run was faster
        self._final = f"{folder}/{run}-part-{partition_id:05d}.txt"
        self._tmp = f"{folder}/_{uuid.uuid4().hex}"
        self._fh = self._fs.open_output_stream(self._tmp)

    def send(self, data: bytes) -> None:
        self._fh.write(data)

    def close(self, error) -> None:
        self._fh.close()
        if error is None:
            self._fs.move(self._tmp, self._final)
        else:
            self._fs.delete_file(self._tmp)


class SocketLineTransport:
    """Lines to a TCP receiver (``host:port``), one connection per partition."""

    def __init__(self, host: str, port: int, timeout: float = 10.0):
        self.host, self.port, self.timeout = host, int(port), timeout

    def open(self, partition_id: int, epoch_id: int):
        self._sock = socket.create_connection((self.host, self.port), self.timeout)

    def send(self, data: bytes) -> None:
        self._sock.sendall(data)

    def close(self, error) -> None:
        self._sock.close()


class LineWriter:
    """K2/U4: ``writeStream.foreach(LineWriter(transport))`` writes each row as
    one UTF-8 line (a single-column row gives its value, otherwise the row as
    JSON).  Failing to open the transport raises, so Spark retries the task
    instead of dropping the partition's rows."""

    def __init__(self, transport):
        self.transport = transport

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.transport.open(partition_id, epoch_id)
        return True

    def process(self, row: Row) -> None:
        if len(row) == 1:
            text = "" if row[0] is None else str(row[0])
        else:
            text = json.dumps(row.asDict(recursive=True), default=str)
        self.transport.send((text + "\n").encode("utf-8"))

    def close(self, error) -> None:
        self.transport.close(error)


def write_rows(transport, to_value=None):
    """K2 as a batch function: each partition of the batch goes row by row
    through :class:`LineWriter`."""
    def write(df: DataFrame, batch_id: int) -> None:
        def send(rows):
            from pyspark import TaskContext
            writer = LineWriter(transport)
            writer.open(TaskContext.get().partitionId(), int(batch_id))
            error = None
            try:
                for row in rows:
                    writer.process(row)
            except Exception as e:
                error = e
                raise
            finally:
                writer.close(error)
        (to_value(df) if to_value else df).foreachPartition(send)
    return write


# ---- W1/W2 on a stream: rolling display tables ---------------------------------

def display_window(path: str, order_cols, n: int = 90, label_col: str = "prediction",
                   center_col: str = "center"):
    """W1/W2 as a ``foreachBatch`` sink: after batch N, ``path/points/batch_id=N``
    holds the ``n`` newest rows seen so far and ``path/centers/batch_id=N`` the
    latest center of every label.

    Each batch contributes only its own top ``n`` (TakeOrdered: per-task top
    rows, no full sort) and one ``max_by`` row per label; they are merged with
    the previous window, which is bounded by ``n`` rows plus one row per label.
    Window N is computed from window N-1 and batch N only and written with
    overwrite, so a re-run batch rewrites the same files.
    """
    from ..operators.views import latest_n

    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)

    def previous(spark, kind: str, batch_id: int):
        ids = [i for i in _window_ids(f"{path}/{kind}") if i < batch_id]
        return spark.read.parquet(f"{path}/{kind}/batch_id={ids[-1]}") if ids else None

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        batch_id = int(batch_id)
        points = latest_n(df, order_cols, n)
        seq = F.struct(*order_cols)
        centers = df.groupBy(label_col).agg(
            F.max_by(center_col, seq).alias(center_col), F.max(seq).alias("__seq"))
        prev_p = previous(spark, "points", batch_id)
        prev_c = previous(spark, "centers", batch_id)
        if prev_p is not None:
            points = latest_n(prev_p.unionByName(points), order_cols, n)
        if prev_c is not None:
            both = prev_c.unionByName(centers)
            centers = both.groupBy(label_col).agg(
                F.max_by(center_col, "__seq").alias(center_col),
                F.max("__seq").alias("__seq"))
        points.coalesce(1).write.mode("overwrite").parquet(f"{path}/points/batch_id={batch_id}")
        centers.coalesce(1).write.mode("overwrite").parquet(f"{path}/centers/batch_id={batch_id}")

    return write


def _window_ids(path: str) -> list[int]:
    """Batches whose window was written whole (Spark's ``_SUCCESS`` is there)."""
    done = (re.search(r"/batch_id=(\d+)/_SUCCESS$", i.path) for i in list_dir(path, recursive=True))
    return sorted(int(m[1]) for m in done if m)


def read_display(spark, path: str, batch_id: int | None = None):
    """``(points, centers)`` of the display window after ``batch_id``
    (default: the newest)."""
    b = _window_ids(f"{path}/centers")[-1] if batch_id is None else int(batch_id)
    return (spark.read.parquet(f"{path}/points/batch_id={b}"),
            spark.read.parquet(f"{path}/centers/batch_id={b}").drop("__seq"))

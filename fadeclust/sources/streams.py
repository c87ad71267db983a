"""Streaming sources.

``read_lines_stream`` opens any line source as a streaming frame with one
``value STRING`` column (``lines``: growing files, with byte offsets, see
:mod:`fadeclust.sources.lines`).  ``KeyedBatches`` makes a bounded table an
ordered stream of micro-batches, one per batch key.
"""

from __future__ import annotations

import json
import time
import urllib.parse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.points import REASON_COL, check_points, parse_valid_points
from ..session import arrow_fs, fresh_dir, list_dir, write_small_text
from . import lines as _lines


def read_lines_stream(spark: SparkSession, fmt: str = "socket",
                      path: str | None = None, **options) -> DataFrame:
    """A streaming frame of text lines in column ``value``.

    ``fmt`` is any line-shaped source: ``lines`` (a folder of growing line files,
    restartable at any byte), ``socket`` (host, port; cannot be restarted),
    ``text`` (a folder of finished files), ``kafka`` (value cast to string),
    ``rate`` (value as text).
    """
    if fmt == "lines":
        _lines.register(spark)
    reader = spark.readStream.format(fmt).options(**options)
    df = reader.load(path) if path is not None else reader.load()
    if fmt == "kafka":
        return df.select(F.col("value").cast("string").alias("value"))
    if fmt == "rate":
        return df.select(F.col("value").cast("string").alias("value"))
    return df.select("value")


def points_stream(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Parsed, valid points with ``features = [x, y]`` (stream or batch)."""
    return parse_valid_points(lines, line_col).withColumn(
        "features", F.array("x", "y"))


def checked_points(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Every line, with ``x``, ``y``, ``features`` and ``reject_reason`` (NULL
    for a valid point): the input of a training query with a reject output."""
    return check_points(lines, line_col).withColumn(
        "features", F.when(F.col(REASON_COL).isNull(), F.array("x", "y")))


_STAGE_COL = "__batch"
# Rows of a staged file: a key of more rows is read by several tasks.
KEY_FILE_ROWS = 50_000
_LISTED = "seq BIGINT, path STRING"


class KeyedBatches:
    """S3: a table as an ordered stream of micro-batches, one per value of
    ``batch_col`` in ascending order, admitted by Spark's file source.

    The table is written once partitioned by the key (``rebalance``: a hot key
    is written by several tasks), in files of ``file_rows`` rows at most (0: no
    limit), so that a key's rows are read by as many tasks as it has files.  Beside it lies one small file per key that names the
    key's folder; the stream reads these files, in the order in which they were
    published, ``keys_per_trigger`` at a time, and :meth:`each` hands a batch
    function the rows of each key that a micro-batch names.  Order, progress and
    restart are the file source's own; nothing is moved and no loop feeds it.

    >>> kb = KeyedBatches(df, "day")
    >>> q, trainer = train_stream(kb.stream(8), init, params, batches=kb.each,
    ...                           trigger={"availableNow": True})
    """

    def __init__(self, df: DataFrame, batch_col: str, path: str | None = None, publish: int | None = None,
                 file_rows: int = KEY_FILE_ROWS):
        self.spark = df.sparkSession
        self.path = path or fresh_dir(self.spark, "keyed")
        self.listed = f"{self.path}/listed"
        key_type = df.schema[batch_col].dataType.typeName()
        if key_type not in ("integer", "long", "short", "byte", "date", "string"):
            raise TypeError(f"batch key must be an integer, date or string, not {key_type}")
        (df.withColumn(_STAGE_COL, F.col(batch_col))
           .hint("rebalance", _STAGE_COL)
           .write.mode("overwrite").option("maxRecordsPerFile", file_rows)
           .partitionBy(_STAGE_COL).parquet(f"{self.path}/staged"))
        self.schema = df.schema
        self._folders = []
        for info in list_dir(f"{self.path}/staged"):
            if info.base_name.startswith(_STAGE_COL + "="):
                raw = urllib.parse.unquote(info.base_name.split("=", 1)[1])
                if raw == "__HIVE_DEFAULT_PARTITION__":
                    raise ValueError(f"batch key {batch_col} must not be NULL")
                self._folders.append((int(raw) if key_type in ("integer", "long", "short", "byte") else raw, info.base_name))
        self._folders.sort()
        fs, base = arrow_fs(self.listed)
        fs.create_dir(base, recursive=True)
        self.published = self._written = 0
        self.publish(publish)

    @property
    def keys(self) -> list:
        return [k for k, _ in self._folders]

    def publish(self, upto: int | None = None) -> None:
        """Let the stream see the first ``upto`` keys (default: all).  The file
        source orders files by time, so each is written until its time (ms) is
        above the one's before."""
        fs, base = arrow_fs(self.listed)
        for i, (_, folder) in enumerate(self._folders[:upto]):
            if i < self.published:
                continue
            wait = 0.001
            while True:
                row = {"seq": i, "path": f"{self.path}/staged/{folder}", "written": time.time_ns()}
                write_small_text(self.listed, f"{i:09d}.json", json.dumps(row) + "\n")
                written = fs.get_file_info(f"{base}/{i:09d}.json").mtime_ns // 1_000_000
                if written > self._written:
                    break
                time.sleep(wait)
                wait = min(2 * wait, 1.0)
            self._written, self.published = written, i + 1

    def stream(self, keys_per_trigger: int = 1) -> DataFrame:
        """The streaming frame of published keys (``seq, path``)."""
        return (self.spark.readStream.schema(_LISTED).option("maxFilesPerTrigger", keys_per_trigger)
                .json(self.listed).select("seq", "path"))

    def each(self, func, transform=None):
        """A batch function on :meth:`stream` that calls ``func(rows, n)`` for each
        key that a micro-batch names, in order; n is the key's number.  Only the
        folders' names come to the driver, as many as one trigger admits.

        If ``func`` knows the newest batch it has committed (``newest_batch()``) and
        that is one of these keys, the micro-batch is run again after a failure:
        the keys before it are whole and are left out."""
        newest = getattr(func, "newest_batch", lambda: None)

        def run(listed: DataFrame, batch_id: int) -> None:
            named = sorted((r["seq"], r["path"]) for r in listed.collect())
            if not named:
                return
            first, last = named[0][0], named[-1][0]
            if [i for i, _ in named] != list(range(first, last + 1)):
                raise ValueError(f"micro-batch {batch_id} names keys {[i for i, _ in named]}, which do not follow one another")
            done = newest()
            for i, path in named:
                if done is not None and first <= done <= last and i < done:
                    continue
                rows = self.spark.read.schema(self.schema).parquet(path)
                func(transform(rows) if transform else rows, i)

        return run

    def all_rows(self) -> DataFrame:
        """The whole staged table, to be read without the stream."""
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/staged/{f}" for _, f in self._folders])

    def row_stream(self, files_per_trigger: int | None = None) -> DataFrame:
        """The staged rows themselves as a stream of the file source, for sinks
        that take rows and need no batch per key."""
        reader = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return reader.parquet(f"{self.path}/staged")

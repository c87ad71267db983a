"""The model state table.

One file per micro-batch, ``<path>/batch_id=N/part-00000.json``, holds the k
rows ``(label, center, weight)`` of the model after batch N (JSON lines,
doubles written with their shortest exact representation).  State N is
computed from state N-1 and batch N only.  A file is written under
``<path>/_tmp`` and moved to its place in one step, so a reader sees a whole
model or none, and a batch that is replayed after a failure leaves the same
rows.  Only such files count as committed: whatever else a crash leaves in the
folder is skipped.

With ``retain=n`` only the newest n models are kept (a query that runs for
years in short batches needs the last one alone); without it all are kept and
:meth:`StateTable.history` reads every batch.

With ``roll=n`` models older than the newest n are rolled, n or more at a time, by a
Spark job into a plain Parquet folder ``rolled/<first>-<last>``, sorted by batch; it
counts once Spark's ``_SUCCESS`` is there.  The small files of rolled models are
removed at a later roll, ``ROLL_GRACE`` seconds or more after theirs, so that a
reader that has listed them can still read them.  The folder then holds about 3 n
small files, or those of that time, and one file for every n batches.
"""

from __future__ import annotations

import json
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.model import HISTORY_SCHEMA, STATE_SCHEMA, ModelState
from ..session import arrow_fs, list_dir, read_small_text, remove_dir, write_small_text

ROLL_GRACE = 600
_PART = "part-00000.json"
_ROLLED = re.compile(r"/rolled/(\d+)-(\d+)/_SUCCESS$")
_COMMITTED = re.compile(rf"/batch_id=(-?\d+)/{re.escape(_PART)}$")


class StateTable:
    def __init__(self, spark: SparkSession, path: str, retain: int | None = None, roll: int | None = None):
        if retain is not None and retain < 1:
            raise ValueError("retain must be 1 or more")
        if roll is not None and (roll < 1 or retain is not None):
            raise ValueError("roll must be 1 or more, and goes without retain")
        self.spark = spark
        self.path = path.rstrip("/")
        self.retain = retain
        self.roll = roll

    def write(self, state: ModelState) -> None:
        n = int(state.batch_id)
        lines = "".join(
            json.dumps({"label": lab, "center": c, "weight": w}) + "\n"
            for lab, c, w in state.to_rows())
        write_small_text(self.path, f"batch_id={n}/{_PART}", lines)
        if self.retain is not None:
            for old in self._listed()[0]:
                if old <= n - self.retain:
                    remove_dir(f"{self.path}/batch_id={old}")
        if self.roll is not None and n % self.roll == 0:
            self._roll(n - self.roll)

    def _listed(self) -> tuple[list[int], list[tuple[int, int]]]:
        """Batches with a small file, and the ranges that are rolled (one listing;
        a range inside another one is left out)."""
        small, ranges = [], []
        for i in list_dir(self.path, recursive=True):
            if m := _COMMITTED.search(i.path):
                small.append(int(m[1]))
            elif m := _ROLLED.search(i.path):
                ranges.append((int(m[1]), int(m[2])))
        whole, reach = [], -1
        for lo, hi in sorted(ranges, key=lambda r: (r[0], -r[1])):
            if hi > reach:
                whole.append((lo, hi))
                reach = hi
        return sorted(small), whole

    def _roll(self, last: int) -> None:
        """Roll the models up to ``last`` that are not yet, if there are enough."""
        small, ranges = self._listed()
        reach = max((hi for _, hi in ranges), default=-1)
        aged = max((hi for lo, hi in ranges if self._age(lo, hi) >= ROLL_GRACE), default=-1)
        for i in small:
            if 0 <= i <= aged:
                remove_dir(f"{self.path}/batch_id={i}")
        old = [i for i in small if reach < i <= last]
        if len(old) < self.roll:
            return
        if old != list(range(old[0], last + 1)):
            raise ValueError(f"state table {self.path} lacks models between {old[0]} and {last}")
        (self._small_rows(old).repartitionByRange(1 + len(old) // 100_000, "batch_id").sortWithinPartitions("batch_id", "label")
             .write.mode("overwrite").parquet(f"{self.path}/rolled/{old[0]}-{last}"))

    def _age(self, lo: int, hi: int) -> float:
        """Seconds since a range was rolled."""
        fs, base = arrow_fs(f"{self.path}/rolled/{lo}-{hi}/_SUCCESS")
        return time.time() - fs.get_file_info(base).mtime_ns / 1e9

    def batch_ids(self) -> list[int]:
        """Committed batch ids (folder listing, no job)."""
        small, ranges = self._listed()
        return sorted({*small, *(i for lo, hi in ranges for i in range(lo, hi + 1))})

    def read(self, batch_id: int) -> ModelState:
        """The model after ``batch_id`` (k rows read on the driver; no job unless
        it is rolled)."""
        text = read_small_text(f"{self.path}/batch_id={int(batch_id)}/{_PART}")
        if text is not None:
            return ModelState.from_rows([json.loads(line) for line in text.splitlines() if line.strip()], batch_id=batch_id)
        for lo, hi in self._listed()[1]:
            if lo <= batch_id <= hi:
                rows = self._rolled_rows(lo, hi).where(F.col("batch_id") == int(batch_id)).collect()
                return ModelState.from_rows([r.asDict() for r in rows], batch_id=batch_id)
        raise FileNotFoundError(f"no model of batch {batch_id} in {self.path}")

    def latest_before(self, batch_id: int) -> ModelState | None:
        ids = [i for i in self.batch_ids() if i < batch_id]
        return self.read(ids[-1]) if ids else None

    def _rolled_rows(self, lo: int, hi: int) -> DataFrame:
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(f"{self.path}/rolled/{lo}-{hi}")

    def _small_rows(self, ids: list[int], may_go: bool = False) -> DataFrame:
        schema = StructType(STATE_SCHEMA.fields + [StructField("batch_id", LongType())])
        reader = self.spark.read.schema(schema).option("basePath", self.path).option("ignoreMissingFiles", str(may_go).lower())
        files = [f"{self.path}/batch_id={i}/{_PART}" for i in ids]
        # by a pattern: Spark refuses a named file that has gone since it was listed; of the
        # batch folders alone: a first roll may end meanwhile, whose folder has no batch_id
        rows = reader.json(files) if not may_go else reader.option("pathGlobFilter", _PART).json(f"{self.path}/batch_id=*")
        return rows.select(F.col("batch_id").cast("long").alias("batch_id"), "label", "center", "weight")

    def history(self) -> DataFrame:
        """``(batch_id, label, center, weight)`` of every committed batch.  Models
        that ``retain`` removes meanwhile may be missing."""
        small, ranges = self._listed()
        parts = [self._rolled_rows(lo, hi) for lo, hi in ranges]
        reach = max((hi for _, hi in ranges), default=None)
        if reach is not None:
            small = [i for i in small if i > reach or i < 0]
        if small:
            rows = self._small_rows(small, may_go=not ranges)
            parts.append(rows.where((F.col("batch_id") >= small[0]) & (F.col("batch_id") <= small[-1])))
        if not parts:
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

"""Scoring on a stream of its own, beside a training query (T4).

The scoring query reads the training query's state table.  Each of its
micro-batches is scored with one model version: the newest that is committed
when the batch first runs.  Before any row is scored the version is *pinned*:
``<pins>/batch_id=N.json`` is published whole with the version and the model.  A
batch that Spark runs again after a failure finds its pin and gives the same
labels, however far training has gone on meanwhile, and even if the training
query has retired that version.  Models of earlier batches' pins are dropped
(those batches are committed); their versions stay as the log ``batch ->
version``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.points import REASON_COL
from ..operators.assign import assign_nearest, attach_center
from ..operators.model import ModelState
from ..session import fresh_dir, list_dir, read_small_text, write_small_text
from .state import StateTable
from .train import _start

_PINS_SCHEMA = "batch_id BIGINT, version BIGINT"


class StreamScorer:
    """The ``foreachBatch`` function of a scoring query."""

    def __init__(self, spark: SparkSession, state_path: str, pins_path: str, outputs, initial: ModelState | None = None,
                 features_col: str = "features", prediction_col: str = "prediction", center_col: str = "center",
                 version_col: str | None = None, score_invalid: str = "keep", method: str = "auto", rejects=None):
        self.spark = spark
        self.table = StateTable(spark, state_path)
        self.pins_path = pins_path.rstrip("/")
        self.outputs = list(outputs)
        self.initial = ModelState(initial.centers, initial.weights, -1) if initial is not None else None
        self.features_col, self.prediction_col, self.center_col = features_col, prediction_col, center_col
        self.version_col = version_col
        self.score_invalid, self.method = score_invalid, method
        self.rejects = rejects

    def newest(self) -> ModelState:
        """The newest committed model; the initial one before the first commit."""
        while ids := self.table.batch_ids():
            try:
                return self.table.read(ids[-1])
            except FileNotFoundError:
                continue        # retired between listing and reading: a newer one is there
        if self.initial is None:
            raise ValueError(f"state table {self.table.path} has no model yet and no initial one is given")
        return self.initial

    def pinned(self, batch_id: int) -> ModelState:
        """The model of a batch: its pin's, else the newest, which is then pinned."""
        name = f"batch_id={int(batch_id)}.json"
        text = read_small_text(f"{self.pins_path}/{name}")
        pin = json.loads(text) if text is not None else None
        if pin is not None and "model" in pin:
            return ModelState.from_rows(pin["model"], pin["version"])
        if pin is not None:
            raise ValueError(f"batch {batch_id} was committed before, its pin in {self.pins_path} has no model; "
                             "use the checkpoint that wrote it or a new pins path")
        model = self.newest()
        rows = [{"label": i, "center": c, "weight": w} for i, c, w in model.to_rows()]
        write_small_text(self.pins_path, name, json.dumps({"version": model.batch_id, "model": rows}))
        self._drop_model(batch_id - 1)
        return model

    def _drop_model(self, batch_id: int) -> None:
        """Of a committed batch the pin keeps the version alone."""
        name = f"batch_id={batch_id}.json"
        text = read_small_text(f"{self.pins_path}/{name}")
        if text is not None:
            write_small_text(self.pins_path, name, json.dumps({"version": json.loads(text)["version"]}))

    def score(self, df: DataFrame, model: ModelState) -> DataFrame:
        lab = assign_nearest(df, model, self.features_col, self.prediction_col, method=self.method, handle_invalid=self.score_invalid)
        lab = attach_center(lab, model, self.prediction_col, self.center_col)
        return lab.withColumn(self.version_col, F.lit(model.batch_id).cast("long")) if self.version_col else lab

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        model = self.pinned(int(batch_id))
        if REASON_COL in df.columns:
            if self.rejects is not None:
                self.rejects(df.filter(F.col(REASON_COL).isNotNull()), int(batch_id))
            df = df.filter(F.col(REASON_COL).isNull()).drop(REASON_COL)
        scored = self.score(df, model)
        for out in self.outputs:
            out(scored, int(batch_id))

    def versions(self) -> DataFrame:
        """The log ``(batch_id, version)``: which model scored which micro-batch."""
        found = []
        for info in list_dir(self.pins_path):
            if info.is_file and info.base_name.startswith("batch_id="):
                text = read_small_text(f"{self.pins_path}/{info.base_name}")
                found.append((int(info.base_name[len("batch_id="):-len(".json")]), json.loads(text)["version"]))
        return self.spark.createDataFrame(sorted(found), _PINS_SCHEMA)


def score_stream(df: DataFrame, state_path: str, outputs, pins_path: str | None = None, checkpoint: str | None = None,
                 initial: ModelState | None = None, trigger: dict | None = None, query_name: str | None = None, batches=None, **options):
    """T4: start a query that labels the points of ``df`` with the newest model of
    the state table at ``state_path`` while another query trains it.  Returns
    ``(query, scorer)``; every output function receives the labelled batch."""
    spark = df.sparkSession
    scorer = StreamScorer(spark, state_path, pins_path or fresh_dir(spark, "pins"), outputs, initial, **options)
    return _start(df, scorer, checkpoint, trigger, query_name or f"fadeclust-scoring-{uuid.uuid4().hex[:8]}", batches), scorer

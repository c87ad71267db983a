"""Training and scoring on a stream.

One streaming query with one ``foreachBatch`` function does, per micro-batch N:

1. load the model after batch N-1 (kept in memory when it is the one just
   written, else read from the state table: a restart resumes from the table);
2. assign the batch to those centers and aggregate the k statistics (one Spark
   job, k rows to the driver), apply the update;
3. overwrite the state partition ``batch_id=N``;
4. optionally score the batch with the model before or after the update and
   hand the labelled frame to output functions ``(df, batch_id)``.

Lines that do not parse into a point (see ``sources.streams.checked_points``) are
handed to the ``rejects`` function with their reason; rows with a NULL or NaN
feature are labelled like any other (``score_invalid="keep"``) and left out of
the update alone.

Everything written is keyed by N and overwritten, so a batch that Spark
re-runs after a failure (same N, same data) yields the same files.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.points import REASON_COL
from ..operators.assign import assign_nearest, attach_center
from ..operators.model import ModelState
from ..operators.update import UpdateParams, train_step
from ..session import fresh_dir, write_small_text
from .state import StateTable


class StreamTrainer:
    """The ``foreachBatch`` function of a training (and scoring) query."""

    def __init__(self, spark, initial: ModelState, params: UpdateParams,
                 state_path: str, features_col: str = "features",
                 outputs=(), score_with: str = "after",
                 prediction_col: str = "prediction", center_col: str = "center",
                 persist_batch: bool = False, rejects=None,
                 score_invalid: str = "keep", retain: int | None = None,
                 log=None, progress_path: str | None = None, roll: int | None = None):
        if score_with not in ("after", "before"):
            raise ValueError("score_with must be 'after' or 'before'")
        self.spark = spark
        self.initial = ModelState(initial.centers, initial.weights, -1)
        self.params = params
        self.table = StateTable(spark, state_path, retain, roll)
        self.progress_path = progress_path
        self.features_col = features_col
        self.outputs = list(outputs)
        self.score_with = score_with
        self.prediction_col = prediction_col
        self.center_col = center_col
        self.persist_batch = persist_batch
        self.rejects = rejects
        self.score_invalid = score_invalid
        self.log = log
        self._last: ModelState | None = None

    def state_before(self, batch_id: int) -> ModelState:
        if self._last is not None and self._last.batch_id == batch_id - 1:
            return self._last
        ids = self.table.batch_ids()
        if ids and ids[-1] > batch_id:
            # a re-run of batch N finds at most N in the table; more means the
            # query's checkpoint was replaced under an existing state table
            raise ValueError(
                f"state table {self.table.path} holds batches up to {ids[-1]} but the "
                f"query is at batch {batch_id}; use the checkpoint that wrote it or a "
                "new state path")
        if batch_id == 0:
            return self.initial
        if batch_id - 1 not in ids:
            raise ValueError(
                f"state table {self.table.path} has no model of batch {batch_id - 1}; "
                "training on from an older one would lose that batch's update")
        return self.table.read(batch_id - 1)

    def _note(self, state: ModelState, figures: dict) -> None:
        """The batch's figures, which came with its own job."""
        row = {"rows": figures["rows"], "cost": figures["cost"], "weights": [w for _, _, w in state.to_rows()]}
        write_small_text(self.progress_path, f"batch_id={state.batch_id}/part-00000.json", json.dumps(row) + "\n")

    def newest_batch(self) -> int | None:
        """The newest batch whose model is committed."""
        if self._last is not None:
            return self._last.batch_id
        ids = self.table.batch_ids()
        return ids[-1] if ids else None

    def score(self, df: DataFrame, model: ModelState) -> DataFrame:
        lab = assign_nearest(df, model, self.features_col, self.prediction_col,
                             method=self.params.method, handle_invalid=self.score_invalid)
        return attach_center(lab, model, self.prediction_col, self.center_col)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        batch_id = int(batch_id)
        prev = self.state_before(batch_id)
        persist = self.persist_batch and bool(self.outputs or self.rejects)
        if persist:
            df = df.persist()
        try:
            good = df
            if REASON_COL in df.columns:
                # lines that failed the parse go to the reject output, not to the model
                good = df.filter(F.col(REASON_COL).isNull()).drop(REASON_COL)
                if self.rejects is not None:
                    self.rejects(df.filter(F.col(REASON_COL).isNotNull()), batch_id)
            observed = Observation() if self.progress_path is not None else None
            new = train_step(good, prev, self.params, self.features_col, batch_id, observed)
            self.table.write(new)
            if observed is not None:
                self._note(new, observed.get)
            self._last = new
            if self.log is not None:
                self.log(update_line(new))
            if self.outputs:
                scored = self.score(good, new if self.score_with == "after" else prev)
                for out in self.outputs:
                    out(scored, batch_id)
        finally:
            if persist:
                df.unpersist()


def update_line(state: ModelState, shown: int = 100) -> str:
    """One log line per update: batch, weights and (cut) centers."""
    centers = "; ".join(
        f"{i}: w={w:.6g} [" + ",".join(f"{v:.6g}" for v in c[:shown]) + ("..." if len(c) > shown else "") + "]"
        for i, c, w in state.to_rows())
    return f"batch {state.batch_id}: {centers}"


def read_progress(spark, path: str) -> DataFrame:
    """``(batch_id, rows, cost, weights)`` of every batch of a query that was
    started with ``progress_path``."""
    return spark.read.schema("batch_id BIGINT, rows BIGINT, cost DOUBLE, weights ARRAY<DOUBLE>").json(path) \
        .select("batch_id", "rows", "cost", "weights")


def _start(df: DataFrame, fn, checkpoint: str | None, trigger: dict | None,
           query_name: str | None, batches=None):
    spark = df.sparkSession
    if batches is not None:
        fn = batches(fn)
    w = (df.writeStream.foreachBatch(fn).outputMode("append")
         .option("checkpointLocation", checkpoint or fresh_dir(spark, "checkpoint")))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def train_stream(df: DataFrame, initial: ModelState, params: UpdateParams,
                 state_path: str | None = None, checkpoint: str | None = None,
                 features_col: str = "features", trigger: dict | None = None,
                 query_name: str | None = None, rejects=None,
                 retain: int | None = None, log=None, batches=None,
                 progress_path: str | None = None, roll: int | None = None):
    """Start a query that trains on ``df`` and keeps the model in a state
    table.  Returns ``(query, trainer)``; ``trainer.table`` reads the state.
    ``batches`` makes the batch function of a stream whose micro-batches only name
    the batches (``KeyedBatches.each``).  ``progress_path``: the rows, the cost (to
    the centers before the update) and the weights of every batch are observed in
    the batch's own job and kept there (:func:`read_progress`).  ``retain`` and
    ``roll``: see :class:`~fadeclust.streaming.state.StateTable`."""
    spark = df.sparkSession
    trainer = StreamTrainer(spark, initial, params,
                            state_path or fresh_dir(spark, "state"), features_col,
                            rejects=rejects, retain=retain, log=log,
                            progress_path=progress_path, roll=roll)
    name = query_name or f"fadeclust-train-{uuid.uuid4().hex[:8]}"
    return _start(df, trainer, checkpoint, trigger, name, batches), trainer


def train_and_score_stream(df: DataFrame, initial: ModelState,
                           params: UpdateParams, outputs,
                           score_with: str = "after",
                           state_path: str | None = None,
                           checkpoint: str | None = None,
                           features_col: str = "features",
                           trigger: dict | None = None,
                           query_name: str | None = None,
                           persist_batch: bool = True, rejects=None,
                           score_invalid: str = "keep",
                           retain: int | None = None, log=None, batches=None,
                 progress_path: str | None = None, roll: int | None = None):
    """Train and label each batch in one query; every output
    function receives the labelled batch (``prediction``, ``center``).
    ``batches`` as in :func:`train_stream`."""
    spark = df.sparkSession
    trainer = StreamTrainer(spark, initial, params,
                            state_path or fresh_dir(spark, "state"), features_col,
                            outputs=outputs, score_with=score_with,
                            persist_batch=persist_batch, rejects=rejects,
                            score_invalid=score_invalid, retain=retain, log=log)
    name = query_name or f"fadeclust-score-{uuid.uuid4().hex[:8]}"
    return _start(df, trainer, checkpoint, trigger, name, batches), trainer


def labelled_json(df: DataFrame, x: str = "x", y: str = "y",
                  prediction_col: str = "prediction", center_col: str = "center",
                  extra=()) -> DataFrame:
    """P7/P8 on a scored frame: one JSON text per row in ``value``
    (``{"point":{..},"center":{..},"label":..}``, extra fields first)."""
    rec = F.struct(
        *[F.col(c) for c in extra],
        F.struct(F.col(x).alias("x"), F.col(y).alias("y")).alias("point"),
        F.struct(F.col(center_col)[0].alias("x"), F.col(center_col)[1].alias("y")).alias("center"),
        F.col(prediction_col).cast("int").alias("label"))
    return df.select(F.to_json(rec).alias("value"))

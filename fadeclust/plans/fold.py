"""Training over ordered batches of a bounded table (T1 fold, T3, M7, T4/T5).

The update of batch b needs the model after batch b-1, so batches run one
after another.  A batch whose work is worth a job is one Spark job (assign +
partial aggregation + a shuffle of at most k rows per task) and only k rows come
back.  Smaller batches are taken in blocks of neighbours of bounded work: a job
for each block, whose task folds the block's rows in batch order and returns the
models.  The input is staged once, partitioned by block (a ``rebalance`` hint
lets AQE split a hot one into several files), so a job reads only its own folder
instead of the whole table; the staging write also cuts the lineage.  A table
that is staged by batch already is read by its folders, named after the key's
text.  The key itself stays an ordinary column, so any type and value (``'01'``,
``''``) comes back as it was.

Scoring a table against the history is map-only: a batch number is joined on
the key (broadcast, one row per batch) and the tasks hold the models of a block
of batches; a history above ``BLOCK_HISTORY_VALUES`` is scored in blocks of
consecutive keys, each of which reads only its own range of keys.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField,
                               StructType)

from ..functions.vectors import to_array
from ..operators.assign import finite_rows, feature_matrix, nearest_rows
from ..operators.model import HISTORY_SCHEMA, ModelState
from ..operators.stats import label_sums
from ..operators.update import UpdateParams, apply_update, train_step
from ..session import arrow_fs, fresh_dir, read_small_text, remove_dir, write_small_text

# Most batches a fold accepts (the keys are collected to order them).
MAX_BATCHES = 1_000_000
# History values (batches x k x dim) that a task holds while scoring: 64 MB.
BLOCK_HISTORY_VALUES = 8_000_000
# Folder column of a staged table: the key's text after a letter.
STAGE_COL = "__batch"
# Rows of a staged file: a batch of more is read by several tasks.
STAGE_FILE_ROWS = 100_000
# Multiplications (rows x k x dim) up to which a batch is folded in one task with
# its neighbours: what a task does in the time that a job of its own costs.
SMALL_BATCH_WORK = 8_000_000
# Multiplications that a row counts as at least: it is read and sorted, too.
ROW_WORK = 64
# Multiplications of a block of such batches.
BLOCK_WORK = 4 * SMALL_BATCH_WORK
# Most batches of a block, and most model values (batches x k x dim) it returns.
BLOCK_BATCHES, BLOCK_MODEL_VALUES = 10_000, 2_000_000
# Folder column of rows staged by block.
BLOCK_COL = "__block"


def batch_keys(df: DataFrame, batch_col: str) -> list:
    """The distinct batch keys in ascending order (bounded by MAX_BATCHES)."""
    return sorted(r[0] for r in _bounded_keys(df.select(batch_col).distinct(), batch_col))


def _bounded_keys(keys: DataFrame, batch_col: str) -> list:
    rows = keys.limit(MAX_BATCHES + 1).collect()
    if len(rows) > MAX_BATCHES:
        raise ValueError(f"more than {MAX_BATCHES} batches")
    if any(r[0] is None for r in rows):
        raise ValueError(f"batch key {batch_col} must not be NULL")
    return rows


@dataclass(frozen=True)
class Block:
    """Batches ``first`` .. ``last`` (numbers), which one job folds; ``small``: in one task."""
    first: int
    last: int
    small: bool


def fold_blocks(rows: list[int], k: int, dim: int) -> list[Block]:
    """The jobs of a fold over batches of so many ``rows``."""
    out, open_work = [], 0
    most = max(1, min(BLOCK_BATCHES, BLOCK_MODEL_VALUES // (k * dim)))
    for i, n in enumerate(rows):
        work = n * max(k * dim, ROW_WORK)
        small = work <= SMALL_BATCH_WORK
        if small and out and out[-1].small and i - out[-1].first < most and open_work + work <= BLOCK_WORK:
            out[-1] = Block(out[-1].first, i, True)
            open_work += work
        else:
            out.append(Block(i, i, small))
            open_work = work
    return out


def _stage_name(key) -> "F.Column":
    return F.concat(F.lit("k"), (F.col(key) if isinstance(key, str) else key).cast("string"))


def stage_by_batch(df: DataFrame, batch_col: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once partitioned by ``batch_col`` and read it back with its
    own schema (plus ``__batch``, the folder).  A given ``path`` that already
    holds a committed copy (``_SUCCESS``) is reused, so a restarted fold does
    not stage again."""
    spark = df.sparkSession
    path = path or fresh_dir(spark, "staged")
    out = df.withColumn(STAGE_COL, _stage_name(batch_col))
    fs, base = arrow_fs(path)
    if fs.get_file_info(f"{base}/_SUCCESS").type == 0:
        (out.hint("rebalance", STAGE_COL)
            .write.mode("overwrite").option("maxRecordsPerFile", STAGE_FILE_ROWS)
            .partitionBy(STAGE_COL).parquet(path))
    return spark.read.schema(out.schema).parquet(path).select(*df.columns, STAGE_COL)


def _batch_of(df: DataFrame, batch_col: str, key) -> DataFrame:
    """The rows of one batch; a staged table is pruned to its folder."""
    lit = F.lit(key).cast(df.schema[batch_col].dataType)
    rows = df.filter(F.col(batch_col) == lit)
    return rows.filter(F.col(STAGE_COL) == _stage_name(lit)) if STAGE_COL in df.columns else rows


def _numbered(df: DataFrame, batch_col: str, side: list, columns: str) -> DataFrame:
    """``df`` with the columns that ``side`` (key, ...) has for each batch key."""
    names = columns.split(", ")
    schema = StructType([StructField(batch_col, df.schema[batch_col].dataType)] + [StructField(c, IntegerType()) for c in names])
    joined = df.join(F.broadcast(df.sparkSession.createDataFrame(side, schema)), on=batch_col, how="left")
    lost = F.raise_error(F.concat(F.lit("the batch keys differ from those read before: "),
                                  F.coalesce(F.col(batch_col).cast("string"), F.lit("NULL")))).cast("int")
    return joined.withColumns({c: F.coalesce(c, lost) for c in names})


def _stage_by_block(src: DataFrame, batch_col: str, features_col: str, keys: list,
                    blocks: list[Block], path: str) -> list[DataFrame]:
    """Write ``src`` once partitioned by block; the rows of each block with their
    batch number ``__seq``."""
    side = [(keys[i], i, b) for b, block in enumerate(blocks) for i in range(block.first, block.last + 1)]
    out = _numbered(src, batch_col, side, f"__seq, {BLOCK_COL}").select("__seq", features_col, BLOCK_COL)
    (out.hint("rebalance", BLOCK_COL)
        .write.option("maxRecordsPerFile", STAGE_FILE_ROWS).partitionBy(BLOCK_COL).parquet(path))
    reader = src.sparkSession.read.schema(out.drop(BLOCK_COL).schema)
    return [reader.parquet(f"{path}/{BLOCK_COL}={b}") for b in range(len(blocks))]


def _staged_block(src: DataFrame, batch_col: str, features_col: str, keys: list,
                  folders: list[list[str]], block: Block) -> DataFrame:
    """The rows of a block of a table that is staged by batch."""
    side = [(keys[i], i) for i in range(block.first, block.last + 1)]
    rows = src.filter(F.col(STAGE_COL).isin([f for _, i in side for f in folders[i]]))
    return _numbered(rows, batch_col, side, "__seq").select("__seq", features_col)


def _fold_task(state: ModelState, params: UpdateParams, last_only: bool):
    """The fold over rows ``(batch number, features)`` in batch order; holds the
    rows of one batch.  The update is :func:`apply_update`, the assignment and the
    sums are those of the Arrow forms of :func:`train_step`."""
    centers, weights, dim = state.centers, state.weights, state.dim

    def run(batches):
        import pyarrow as pa
        model, at, held = ModelState(centers, weights), None, []
        schema = pa.schema([("batch_id", pa.int64()), ("label", pa.int32()), ("center", pa.list_(pa.float64())), ("weight", pa.float64())])

        def updated():
            X = np.concatenate(held) if len(held) > 1 else held[0]
            return apply_update(model, label_sums(nearest_rows(X, model.centers)[0], X), params, at)

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array([model.batch_id] * model.k, pa.int64()), pa.array(range(model.k), pa.int32()),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, (model.k + 1) * dim, dim), pa.int32()), pa.array(model.centers.ravel())),
                 pa.array(model.weights)], schema=schema)

        for batch in batches:
            seq, feats = batch.columns
            seq = seq.to_numpy(zero_copy_only=False)
            ok = finite_rows(feats)
            if params.handle_invalid == "error" and not ok.all():
                raise ValueError("features contain NULL, NaN or Inf")
            X = feature_matrix(feats.filter(pa.array(ok)), dim)[0]
            upto = np.concatenate([[0], np.cumsum(ok)])           # rows of X before each row
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]]) if len(seq) else []
            for a, b in zip(starts, [*starts[1:], len(seq)]):
                if at is not None and seq[a] != at:
                    model = updated()
                    if not last_only:
                        yield rows()
                    held.clear()
                at = int(seq[a])
                held.append(X[upto[a]:upto[b]])
        if at is not None:
            model = updated()
            yield rows()

    return run


def _fold_block(rows: DataFrame, state: ModelState, params: UpdateParams, features_col: str,
                last_only: bool, last: int, path: str | None) -> list[ModelState]:
    """The models after each batch of a block (``last_only``: after its last), by
    one task; at most k rows a batch come back.  With a ``path`` the task writes
    them there, and those of batch ``last`` alone come back."""
    f = F.col(features_col)
    if rows.schema[features_col].dataType.typeName() != "array":
        f = to_array(features_col)
    ordered = rows.select("__seq", f.cast("array<double>").alias("__f")).coalesce(1).sortWithinPartitions("__seq")
    folded = ordered.mapInArrow(_fold_task(state, params, last_only), HISTORY_SCHEMA)
    if path:
        folded.write.parquet(path)
        folded = rows.sparkSession.read.schema(HISTORY_SCHEMA).parquet(path).filter(F.col("batch_id") == last)
    models: dict = {}
    for r in folded.collect():
        models.setdefault(r["batch_id"], []).append(r)
    return [ModelState.from_rows(models[i], i) for i in sorted(models)]


def fold_batches(df: DataFrame, batch_col: str, state: ModelState,
                 params: UpdateParams, features_col: str = "features",
                 stage: bool = True,
                 checkpoint_dir: str | None = None) -> list[ModelState]:
    """Fold the update over the batches of ``df`` in key order.

    Returns the model after every batch (``batch_id`` = 0, 1, ...).  With
    ``stage=False`` the input must already be laid out by ``batch_col`` (for
    example a table partitioned by day), or every batch scans it all.
    """
    return fit_fold(df, batch_col, state, params, features_col, stage, checkpoint_dir)[1]


def fold_history(df: DataFrame, batch_col: str, state: ModelState, params: UpdateParams,
                 features_col: str = "features") -> DataFrame:
    """The model after every batch as rows ``(batch_id, label, center, weight)``.
    Blocks of small batches write theirs to a folder, so the driver holds the models
    of large batches (one a job) and of each block's last batch alone."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, "history")
    if not _in_blocks(params):
        return history_df(spark, fit_fold(df, batch_col, state, params, features_col)[1])
    history, written = _fit_blocks(df, batch_col, state, params, features_col, True, path)[1:]
    parts = [history_df(spark, history)] if history or not written else []
    if written:
        parts.append(spark.read.schema(HISTORY_SCHEMA).parquet(*written))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def history_df(spark, history: list[ModelState]) -> DataFrame:
    """``(batch_id, label, center, weight)`` for every model in ``history``."""
    rows = [(int(s.batch_id),) + r for s in history for r in s.to_rows()]
    return spark.createDataFrame(rows, HISTORY_SCHEMA)


def history_long(spark, history: list[ModelState] | DataFrame) -> DataFrame:
    """``(batch_id, label, dim, center, weight)`` - one row per coordinate."""
    rows = history if isinstance(history, DataFrame) else history_df(spark, history)
    return rows.select(
        "batch_id", "label", F.posexplode("center").alias("dim", "center"), "weight"
    ).select("batch_id", "label", F.col("dim").cast("int").alias("dim"),
             "center", "weight")


def _fingerprint(df: DataFrame, batch_col: str, features_col: str, state: ModelState,
                 params: UpdateParams) -> str:
    """What a resumed fold must have in common with the one it resumes: schema,
    parameters, initial model, and number and hash sum of the input rows."""
    n, h = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(batch_col, features_col).cast("decimal(38,0)"))).first()
    model = hashlib.sha256(state.centers.tobytes() + state.weights.tobytes()).hexdigest()
    return json.dumps({
        "schema": [[f.name, f.dataType.simpleString()] for f in df.schema.fields],
        "batch_col": batch_col, "params": asdict(params), "initial": [state.k, state.dim, model],
        "rows": int(n), "hash": str(h)}, sort_keys=True)


def fit_fold(df: DataFrame, batch_col: str, state: ModelState,
             params: UpdateParams, features_col: str = "features",
             stage: bool = True,
             checkpoint_dir: str | None = None,
             keep_history: bool = True) -> tuple[list, list[ModelState]]:
    """Like :func:`fold_batches` but also returns the batch keys in order.

    With ``checkpoint_dir`` (a shared folder) the fold survives a driver
    restart: the staged input is kept under ``<dir>/staged`` and the model
    after every batch under ``<dir>/state`` (one atomic publish per batch); a
    rerun reuses both and resumes after the last committed batch.  It is
    refused if schema, parameters, initial model or input rows (a late batch,
    say) differ from those of the first run.  Otherwise the staged copy is
    removed at the end.

    The history is one model per batch on the driver; ``keep_history=False``
    returns the last one alone (the others are in the state table, if any), and
    :func:`fold_history` gives it as a table.

    With ``checkpoint_dir``, ``stage=False``, a form of assignment or sums other
    than ``auto``, or invalid rows kept, every batch is a job of its own.
    """
    if stage and not checkpoint_dir and _in_blocks(params):
        return _fit_blocks(df, batch_col, state, params, features_col, keep_history)[:2]
    src = df.select(batch_col, features_col, *([STAGE_COL] if STAGE_COL in df.columns else []))
    table, done, staged = None, set(), None
    if checkpoint_dir:
        from ..streaming.state import StateTable
        mark = _fingerprint(src, batch_col, features_col, state, params)
        before = read_small_text(f"{checkpoint_dir}/fold.json")
        if before is not None and before != mark:
            old, new = json.loads(before), json.loads(mark)
            raise ValueError(f"{checkpoint_dir} belongs to another fold: "
                             + ", ".join(k for k in new if old.get(k) != new[k]) + " changed")
        write_small_text(checkpoint_dir, "fold.json", mark)
        table = StateTable(df.sparkSession, f"{checkpoint_dir}/state")
        done = set(table.batch_ids())
    if stage and STAGE_COL not in df.columns:
        staged = f"{checkpoint_dir}/staged" if checkpoint_dir else fresh_dir(df.sparkSession, "staged")
        src = stage_by_batch(src, batch_col, staged)
    keys = batch_keys(src, batch_col)
    history = []
    for i, key in enumerate(keys):
        if i in done:
            state = table.read(i)
        else:
            state = train_step(_batch_of(src, batch_col, key), state,
                               params, features_col, batch_id=i)
            if table is not None:
                table.write(state)
        if not keep_history:
            history.clear()
        history.append(state)
    if staged and not checkpoint_dir:
        remove_dir(staged)
    return keys, history


def _in_blocks(params: UpdateParams) -> bool:
    return params.method == params.stats_form == "auto" and params.handle_invalid != "keep"


def _fit_blocks(df: DataFrame, batch_col: str, state: ModelState, params: UpdateParams, features_col: str,
                keep_history: bool, path: str | None = None) -> tuple[list, list[ModelState], list[str]]:
    """:func:`fit_fold` with a job for each block of batches.  With a ``path`` the
    models of small batches are written below it and not returned; the folders are."""
    is_staged = STAGE_COL in df.columns
    src = df.select(batch_col, features_col, *([STAGE_COL] if is_staged else []))
    folders = F.collect_set(STAGE_COL) if is_staged else F.array()
    by_key = src.groupBy(batch_col).agg(F.count(F.lit(1)).alias("__n"), folders.alias("__folders"))
    sizes = sorted(_bounded_keys(by_key, batch_col), key=lambda r: r[0])
    keys, folders = [r[0] for r in sizes], [r["__folders"] for r in sizes]
    blocks = fold_blocks([r["__n"] for r in sizes], state.k, state.dim)
    history, written, staged = [], [], None
    if not is_staged and blocks:
        staged = fresh_dir(df.sparkSession, "staged")
        parts = _stage_by_block(src, batch_col, features_col, keys, blocks, staged)
    for b, block in enumerate(blocks):
        if not block.small:
            rows = parts[b] if staged else _batch_of(src, batch_col, keys[block.first])
            models = [train_step(rows, state, params, features_col, batch_id=block.first)]
        else:
            rows = parts[b] if staged else _staged_block(src, batch_col, features_col, keys, folders, block)
            to = f"{path}/{b}" if path else None
            models = _fold_block(rows, state, params, features_col, not keep_history, block.last, to)
        state = models[-1]
        if not keep_history:
            history.clear()
        if path and block.small:
            written.append(to)
        else:
            history.extend(models)
    if staged:
        remove_dir(staged)
    return keys, history, written


def _history_arrow_udf(H: np.ndarray):
    """Arrow UDF ``(features, batch index) -> struct<prediction, center>``
    against the per-batch centers ``H`` (B x k x dim), shipped with the
    function (its size is bounded by the caller).  A running minimum over the
    centers keeps one distance and one label per row."""
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    dim = H.shape[2]

    def nearest(feats, bidx):
        import pyarrow as pa_

        from ..operators.assign import feature_matrix, nearest_rows
        n = len(feats)
        X, valid = feature_matrix(feats, dim)
        B = bidx.to_numpy(zero_copy_only=False)
        pred = np.zeros(n, dtype=np.int32)
        for b in np.unique(B[valid]):
            rows = np.flatnonzero(valid & (B == b))
            pred[rows] = nearest_rows(X[rows], H[int(b)])[0]
        centers = pa_.ListArray.from_arrays(
            pa_.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32)),
            pa_.array(H[B, pred].ravel()))
        return pa_.StructArray.from_arrays(
            [pa_.array(pred, pa_.int32()), centers], names=["prediction", "center"])

    nearest.__annotations__ = {"feats": pa.Array, "bidx": pa.Array, "return": pa.Array}
    return arrow_udf(nearest, "struct<prediction:int,center:array<double>>")


def score_with_history(df: DataFrame, batch_col: str, keys: list,
                       initial: ModelState, history: list[ModelState],
                       score_with: str = "after", features_col: str = "features",
                       prediction_col: str = "prediction",
                       center_col: str = "center", method: str = "auto") -> DataFrame:
    """T4/T5: label every row with the model of its batch; no row is dropped.

    ``after``: the model updated by the row's own batch (the DStream order);
    ``before``: the model in force when the batch arrived.  ``hof`` computes
    the distances with higher-order functions against the joined centers;
    ``arrow`` joins only a batch index and evaluates an Arrow UDF against the
    models; ``auto`` picks by k * dim.  Both follow one rule: NULL features, or
    NaN or NULL among them, give label 0 and its center; another number of
    features than the model's fails, as does a row whose batch has no model.
    """
    if score_with not in ("after", "before"):
        raise ValueError("score_with must be 'after' or 'before'")
    models = history if score_with == "after" else [initial] + history[:-1]
    if len(models) != len(keys):
        raise ValueError(f"{len(keys)} batches but {len(models)} models")
    k, dim = initial.k, initial.dim
    if method == "auto":
        from ..operators.assign import AUTO_UNROLL_MAX
        method = "hof" if k * dim <= AUTO_UNROLL_MAX else "arrow"
    if method not in ("hof", "arrow"):
        raise ValueError("method must be auto, hof or arrow")
    columns = [c for c in df.columns if c != STAGE_COL]
    per_block = max(1, BLOCK_HISTORY_VALUES // (k * dim))
    out = None
    for at in range(0, max(1, len(keys)), per_block):
        block = keys[at:at + per_block]
        part = df
        key = F.col(batch_col)
        if at:                                   # later blocks: a range of keys each
            part = part.filter(key > F.lit(keys[at - 1]))
        if at + per_block < len(keys):
            below = key <= F.lit(block[-1])
            part = part.filter(below | key.isNull() if not at else below)
        scored = _score_block(part, batch_col, block, models[at:at + per_block], dim, features_col,
                              prediction_col, center_col, method).select(*columns, prediction_col, center_col)
        out = scored if out is None else out.unionByName(scored)
    return out


def _score_block(df: DataFrame, batch_col: str, keys: list, models: list[ModelState], dim: int,
                 features_col: str, prediction_col: str, center_col: str, method: str) -> DataFrame:
    key_type = df.schema[batch_col].dataType
    spark = df.sparkSession
    f = F.col(features_col).cast("array<double>")
    lost = F.raise_error(F.concat(F.lit("no model for batch "), F.coalesce(F.col(batch_col).cast("string"), F.lit("NULL"))))
    if method == "arrow":
        side = spark.createDataFrame(
            [(key, i) for i, key in enumerate(keys)],
            StructType([StructField(batch_col, key_type, True),
                        StructField("__bi", IntegerType(), True)]))
        H = np.stack([m.centers for m in models]) if models else np.zeros((1, 1, dim))
        joined = df.join(F.broadcast(side), on=batch_col, how="left")
        index = F.when(F.col("__bi").isNull(), lost.cast("int")).otherwise(F.col("__bi"))
        return (joined.withColumn("__r", _history_arrow_udf(H)(f, index))
                .withColumn(prediction_col, F.col("__r.prediction"))
                .withColumn(center_col, F.col("__r.center")))
    schema = StructType([
        StructField(batch_col, key_type, True),
        StructField("__cs", ArrayType(ArrayType(DoubleType(), False), False), True),
    ])
    rows = [(key, [[float(v) for v in c] for c in m.centers])
            for key, m in zip(keys, models)]
    side = spark.createDataFrame(rows, schema)
    joined = df.join(F.broadcast(side), on=batch_col, how="left").withColumn(
        "__cs", F.when(F.col("__cs").isNull(), lost.cast(schema["__cs"].dataType)).otherwise(F.col("__cs")))
    checked = F.when(f.isNull() | (F.size(f) == dim), f).otherwise(
        F.raise_error(F.lit(f"features must have {dim} entries")).cast("array<double>"))
    dists = F.transform(
        F.col("__cs"),
        lambda c: F.aggregate(F.zip_with(F.col("__f"), c, lambda x, y: (x - y) * (x - y)),
                              F.lit(0.0).cast("double"), lambda a, v: a + v))
    joined = joined.withColumn("__f", checked).withColumn("__d", dists)
    best = F.array_min("__d")
    label = F.coalesce(F.when(~F.isnan(best), F.array_position("__d", best) - 1).cast("int"), F.lit(0))
    return (joined.withColumn(prediction_col, label)
            .withColumn(center_col, F.element_at("__cs", F.col(prediction_col) + 1)))


def as_state(centers, weights, batch_id: int = -1) -> ModelState:
    return ModelState(np.asarray(centers, dtype=np.float64),
                      np.asarray(weights, dtype=np.float64), batch_id)


__all__ = ["batch_keys", "stage_by_batch", "fold_batches", "fit_fold", "fold_history",
           "history_df", "history_long", "score_with_history", "as_state"]

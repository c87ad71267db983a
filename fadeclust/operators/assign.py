"""Nearest-center assignment.

Each point is compared with the k centers of a bounded model; the lowest index
wins a tie (strict ``<``), a point whose distances are all NaN gets label 0 and
distance +Inf.  This is a map-only projection: no shuffle, no join against the
data.  The centers travel to the tasks in one of three physical forms:

``unrolled``  the k x dim distance sums written out as literal arithmetic,
              fully inside whole-stage codegen (best for small k * dim);
``hof``       centers as one literal ``ARRAY<ARRAY<DOUBLE>>`` and higher-order
              functions (``transform`` / ``zip_with`` / ``aggregate``);
``arrow``     an Arrow UDF: the feature column arrives as one flat buffer per
              batch and numpy computes the k distances (large k * dim); with many
              centers an exact index over them is searched instead.

All forms add squared differences left to right, so they agree bit for bit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .center_index import TRIAL_POINTS, CenterIndex
from .model import ModelState, centers_array

# k * dim up to which the literal-unrolled expression is used by ``auto``
# (measured on 600k rows: unrolled wins up to 24, then the generated code
# grows past what the JIT compiles and the Arrow form is 5-20x faster).
AUTO_UNROLL_MAX = 24
# Centers (values) attached as one literal; larger models are joined.
LITERAL_MAX_VALUES = 256
# A centers table up to this many bytes is broadcast, a larger one shuffled.
ATTACH_BROADCAST_BYTES = 64 << 20

INVALID_MODES = ("keep", "skip", "error")


def sql_double(v: float) -> str:
    """A SQL double literal that parses back to exactly ``v``."""
    v = float(v)
    if np.isnan(v):
        return "double('NaN')"
    if np.isinf(v):
        return "double('Infinity')" if v > 0 else "double('-Infinity')"
    return f"({v!r}D)"


def _unrolled_sql(f: str, C: np.ndarray) -> str:
    k, dim = C.shape
    rows = []
    for j in range(k):
        terms = []
        for i in range(dim):
            c = sql_double(C[j, i])
            terms.append(f"(({f}[{i}] - {c}) * ({f}[{i}] - {c}))")
        rows.append(" + ".join(terms))
    return "array(" + ", ".join(rows) + ")"


def _hof_sql(f: str, C: np.ndarray) -> str:
    lit = "array(" + ", ".join(
        "array(" + ", ".join(sql_double(v) for v in row) + ")" for row in C) + ")"
    return (f"transform({lit}, c -> aggregate(zip_with({f}, c, (x, y) -> (x - y) * (x - y)), "
            f"0D, (a, v) -> a + v))")


def _guarded_sql(f: str, dim: int, arr: str) -> str:
    return (f"CASE WHEN {f} IS NULL THEN NULL WHEN size({f}) = {dim} THEN {arr} "
            f"ELSE raise_error(concat('features must have {dim} entries, got ', "
            f"cast(size({f}) AS STRING))) END")


def _argmin(dists: Column) -> tuple[Column, Column]:
    """Label (first minimum; NaN is larger than any number) and distance.
    ``dists`` should be a column reference so the array is computed once."""
    best = F.array_min(dists)
    label = (F.array_position(dists, best) - 1).cast("int")
    dist = F.when(F.isnan(best), F.lit(float("inf"))).otherwise(best)
    return label, dist


def feature_matrix(feats, dim: int):
    """``(n x dim matrix, valid)`` of an Arrow list column; NULL rows are zeros
    and not valid, NULL entries are NaN, another length raises."""
    import pyarrow as pa
    import pyarrow.compute as pc

    n = len(feats)
    valid = ~np.asarray(feats.is_null().to_numpy(zero_copy_only=False))
    lengths = pc.list_value_length(feats).to_numpy(zero_copy_only=False)
    bad = valid & (lengths != dim)
    if np.any(bad):
        raise ValueError(f"features must have {dim} entries, got {int(lengths[bad][0])}")
    X = np.zeros((n, dim))
    if n:
        flat = feats.filter(pa.array(valid)).flatten().to_numpy(zero_copy_only=False)
        X[valid] = flat.astype(np.float64, copy=False).reshape(-1, dim)
    return X, valid


def finite_rows(feats) -> np.ndarray:
    """The rows of an Arrow list column that training takes: neither NULL nor empty,
    with no NULL, NaN or infinite entry."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(feats), 0).to_numpy(zero_copy_only=False)
    flat = feats.flatten().to_numpy(zero_copy_only=False)       # NULL entries are NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ends = np.cumsum(lengths)
    return (lengths > 0) & (bad[ends] == bad[ends - lengths])


# Centers from which a norm bound is tried before a distance is computed, and
# from which the index over centers is tried.
PRUNE_MIN_CENTERS = 16
INDEX_MIN_CENTERS = 64


def nearest_rows(X: np.ndarray, centers: np.ndarray):
    """Label and squared distance of each row: a running minimum over the
    centers, so memory does not depend on k.

    With many centers, rows whose norm bound ``(|x| - |c|)^2`` (V3, less a
    margin for rounding) already exceeds their minimum are skipped; the result
    is the same.  NaN distances count as infinite; ties keep the lowest index.
    """
    n = len(X)
    best = np.full(n, np.inf)
    label = np.zeros(n, dtype=np.int32)
    prune = len(centers) >= PRUNE_MIN_CENTERS
    if prune:
        xn, cn = np.sqrt((X * X).sum(axis=1)), np.sqrt((centers * centers).sum(axis=1))
    for j, c in enumerate(centers):
        rows = None
        if prune and j:
            bound = (xn - cn[j]) ** 2 - 1e-12 * (xn * xn + cn[j] * cn[j])
            rows = np.flatnonzero(~(bound > best))
            if len(rows) == n:
                rows = None
        diff = (X if rows is None else X[rows]) - c
        diff *= diff
        # cumulative sum = left-to-right order, as the JVM forms add
        d = np.cumsum(diff, axis=1, out=diff)[:, -1]
        if rows is None:
            closer = d < best
            best[closer] = d[closer]
            label[closer] = j
        else:
            less = d < best[rows]
            best[rows[less]] = d[less]
            label[rows[less]] = j
    return label, best


def _arrow_assign(C: np.ndarray) -> "callable":
    """An Arrow UDF returning ``struct<prediction:int, distance:double>``.  The
    centers travel with the function (Spark ships a large one as a broadcast
    of its own and frees it with the function)."""
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    dim = C.shape[1]
    held = C.copy()
    made: list[CenterIndex] = []        # one index per task, made with its first batch

    def nearest(feats):
        import pyarrow as pa_
        X, valid = feature_matrix(feats, dim)
        if len(held) >= INDEX_MIN_CENTERS and not made:
            made.append(CenterIndex(held))
        if made and made[0].useful:
            parts = [made[0].nearest(X[a:a + TRIAL_POINTS]) if made[0].useful else nearest_rows(X[a:a + TRIAL_POINTS], held)
                     for a in range(0, len(X), TRIAL_POINTS)] or [nearest_rows(X, held)]
            lab, dist = (np.concatenate(p) for p in zip(*parts))
        else:
            lab, dist = nearest_rows(X, held)
        return pa_.StructArray.from_arrays(
            [pa_.array(lab, pa_.int32(), mask=~valid),
             pa_.array(dist, pa_.float64(), mask=~valid)],
            names=["prediction", "distance"])

    nearest.__annotations__ = {"feats": pa.Array, "return": pa.Array}
    return arrow_udf(nearest, "struct<prediction:int,distance:double>")


def choose_method(k: int, dim: int, method: str = "auto") -> str:
    if method == "auto":
        return "unrolled" if k * dim <= AUTO_UNROLL_MAX else "arrow"
    if method not in ("unrolled", "hof", "arrow"):
        raise ValueError(f"unknown assignment method {method!r}")
    return method


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def distance_sql(features: str, C: np.ndarray, method: str = "unrolled") -> str:
    """SQL text of the k squared distances of column ``features`` (an
    ``ARRAY<DOUBLE>`` column name) to the centers, as one array."""
    f = _quote(features)
    arr = _unrolled_sql(f, C) if method == "unrolled" else _hof_sql(f, C)
    return _guarded_sql(f, C.shape[1], arr)


def nearest_columns(features: str, C: np.ndarray, method: str = "auto",
                    spark=None) -> tuple[Column, Column]:
    """``(label, squared distance)`` Column expressions for an ``ARRAY<DOUBLE>``
    column ``features``.  Convenience for ad-hoc projections;
    :func:`assign_nearest` evaluates the distance array once."""
    k, dim = C.shape
    method = choose_method(k, dim, method)
    if method == "arrow":
        res = _arrow_assign(C)(F.col(features))
        return res["prediction"], res["distance"]
    return _argmin(F.expr(distance_sql(features, C, method)))


def assign_nearest(df: DataFrame, centers, features_col: str = "features",
                   prediction_col: str = "prediction",
                   distance_col: str | None = None, method: str = "auto",
                   handle_invalid: str = "keep") -> DataFrame:
    """Add ``prediction_col`` (INT, nearest center) and optionally
    ``distance_col`` (squared Euclidean distance).

    ``centers`` is a :class:`ModelState`, a k x dim matrix, or a centers table
    ``(label, center)`` (read back with a size check).  ``handle_invalid``:
    ``keep`` labels rows with NULL/NaN features 0 (distance +Inf), ``skip``
    drops them, ``error`` fails the query.  Works on streaming frames.
    """
    if handle_invalid not in INVALID_MODES:
        raise ValueError(f"handle_invalid must be one of {INVALID_MODES}")
    schema = df.schema
    names = schema.names
    if prediction_col in names:
        raise ValueError(f"Prediction column {prediction_col} already exists")
    C = centers_array(centers)
    k, dim = C.shape
    ftype = schema[features_col].dataType
    fname = features_col
    if ftype.typeName() != "array" or ftype.elementType.typeName() != "double":
        from ..functions.vectors import to_array
        fname = "__features"
        conv = (to_array(features_col) if ftype.typeName() != "array"
                else F.col(features_col).cast("array<double>"))
        df = df.withColumn(fname, conv)
    fq = _quote(fname)
    finite = (f"coalesce({fq} IS NOT NULL AND size({fq}) > 0 AND NOT exists({fq}, x -> "
              f"x IS NULL OR isnan(x) OR x = double('Infinity') OR x = double('-Infinity')), false)")
    if handle_invalid == "skip":
        df = df.filter(F.expr(finite))
    elif handle_invalid == "error":
        df = df.filter(F.expr(
            f"CASE WHEN {finite} THEN true ELSE "
            f"raise_error('features contain NULL, NaN or Inf') END"))
    method = choose_method(k, dim, method)
    tmp = "__nearest"
    if method == "arrow":
        res = _arrow_assign(C)(F.col(fname))
        staged = df.select(*names, res.alias(tmp))
        pred = f"{tmp}.prediction"
        dist = f"{tmp}.distance"
    else:
        staged = df.select(*names, F.expr(distance_sql(fname, C, method)).alias(tmp))
        pred = f"cast(array_position({tmp}, array_min({tmp})) - 1 AS INT)"
        dist = f"CASE WHEN isnan(array_min({tmp})) THEN double('Infinity') ELSE array_min({tmp}) END"
    if handle_invalid == "keep":
        pred = f"coalesce({pred}, 0)"
        dist = f"coalesce({dist}, double('Infinity'))"
    outs = [f"cast({pred} AS INT) AS {_quote(prediction_col)}"]
    if distance_col:
        outs.append(f"{dist} AS {_quote(distance_col)}")
    return staged.selectExpr(*[_quote(n) for n in names], *outs)


def predict_point(centers, point) -> int:
    """Driver-side label of one point (same rule as the Column forms)."""
    C = centers_array(centers)
    p = np.asarray(point, dtype=np.float64)
    if p.shape != (C.shape[1],):
        raise ValueError(f"point must have {C.shape[1]} entries")
    d = np.cumsum((C - p) ** 2, axis=1)[:, -1]
    d = np.where(np.isnan(d), np.inf, d)
    return int(np.argmin(d))


def attach_center(df: DataFrame, centers, label_col: str = "prediction",
                  out: str = "center") -> DataFrame:
    """The center of each row's label as an ``ARRAY<DOUBLE>`` column.

    A small model is attached as one literal array; a larger one, or a centers
    *table*, is joined on the label: with a broadcast hash join up to
    ``ATTACH_BROADCAST_BYTES`` (a model is always below it), else with a shuffle
    join.  A table that repeats a label is refused, as it would repeat rows.
    """
    if isinstance(centers, DataFrame):
        side = centers.select(F.col("label").alias(label_col), F.col("center").alias(out))
        n, labels, values = side.agg(F.count(label_col), F.count_distinct(label_col), F.sum(F.size(out))).first()
        if n != labels:
            raise ValueError(f"the centers table repeats labels: {n} rows, {labels} labels")
        small = 8 * (values or 0) + 64 * n <= ATTACH_BROADCAST_BYTES
        return df.join(F.broadcast(side) if small else side, on=label_col, how="left")
    C = centers.centers if isinstance(centers, ModelState) else centers_array(centers)
    if C.size <= LITERAL_MAX_VALUES:
        lit_centers = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in C])
        return df.withColumn(out, F.try_element_at(lit_centers,
                                                    F.col(label_col).cast("int") + 1))
    names = df.columns
    side = df.sparkSession.createDataFrame(
        [(i, [float(v) for v in row]) for i, row in enumerate(C)], f"`{label_col}` int, `{out}` array<double>")
    return df.join(F.broadcast(side), on=label_col, how="left").select(*[_quote(c) for c in names], _quote(out))


def cluster_cost(df: DataFrame, label_col: str = "prediction",
                 distance_col: str = "distance") -> DataFrame:
    """A5: per label, the number of points and the sum of squared distances
    (partial aggregation map-side, k rows per task to shuffle)."""
    return df.groupBy(F.col(label_col).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(distance_col).alias("cost"))

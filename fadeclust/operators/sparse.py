"""Nearest center of sparse vectors without making them dense.

The points are ML vectors; their indices and values reach the task as they are
stored.  A squared distance is first taken by the norm expansion

    |x|^2 + |c|^2 - 2 sum over x's indices of x_i c_i,

whose cost is the number of stored values.  Its rounding error is at most
``(terms + 8) eps (|x| + |c|)^2``; a center that this bound leaves behind the best
one cannot be the nearest.  Where several are left (ties and near ties) they are
compared by the exact difference form, and so is the distance that is returned: a
center's coordinates, less the point's values at its indices, added up from left
to right.  Labels and distances are those of the dense form, bit for bit.

Memory per task is the model, the stored values of a batch and one vector of the
centers' size; no dense copy of the points is made.  Dense ML vectors in the same
column are taken with the dense form.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .assign import nearest_rows
from .model import centers_array

# rows whose products with one center are held at once (stored values)
VALUE_BLOCK = 1 << 20
_EPS = float(np.finfo(np.float64).eps)


class SparseCenters:
    """The centers with what the expansion needs, made once per task."""

    def __init__(self, centers: np.ndarray):
        self.centers = np.ascontiguousarray(centers, dtype=np.float64)
        self.square = (self.centers * self.centers).sum(axis=1)
        self.norm = np.sqrt(self.square)
        self.finite = bool(np.isfinite(self.centers).all())
        self.exact = 0              # exact distances computed so far

    def distance(self, indices: np.ndarray, values: np.ndarray, j: int) -> float:
        """Exact difference form of one point and one center."""
        self.exact += 1
        diff = self.centers[j].copy()
        diff[indices] = values - diff[indices]
        diff *= diff
        return float(np.cumsum(diff, out=diff)[-1])

    def nearest(self, offsets: np.ndarray, indices: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label and squared distance of each row of a compressed matrix."""
        n, k = len(offsets) - 1, len(self.centers)
        label, best = np.zeros(n, dtype=np.int32), np.full(n, np.inf)
        start = 0
        while start < n:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + max(1, VALUE_BLOCK // k), side="right")) - 1)
            self._block(offsets[start:end + 1], indices, values, label[start:end], best[start:end])
            start = end
        return label, best

    def _block(self, offsets, indices, values, label, best) -> None:
        lo, hi = int(offsets[0]), int(offsets[-1])
        idx, val, own = indices[lo:hi], values[lo:hi], offsets - lo
        n, k = len(own) - 1, len(self.centers)
        terms = np.diff(own)
        full = np.flatnonzero(terms)
        square, dots = np.zeros(n), np.zeros((n, k))
        if len(full):
            square[full] = np.add.reduceat(val * val, own[full])
            for j in range(k):
                dots[full, j] = np.add.reduceat(val * self.centers[j][idx], own[full])
        about = square[:, None] + self.square - 2 * dots
        error = (terms + self.centers.shape[1] + 8)[:, None] * _EPS * (np.sqrt(square)[:, None] + self.norm) ** 2
        if not self.finite:
            about, error = np.zeros((n, k)), np.full((n, k), np.inf)
        least = (about + error).min(axis=1)
        possible = ~(about - error > least[:, None])
        odd = ~np.isfinite(square)
        for i in range(n):
            a, b = int(own[i]), int(own[i + 1])
            for j in range(k) if odd[i] else np.flatnonzero(possible[i]).tolist():
                d = self.distance(idx[a:b], val[a:b], j)
                if d < best[i]:
                    best[i], label[i] = d, j


def _sparse_assign(C: np.ndarray):
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    held = C.copy()
    made: list[SparseCenters] = []

    def nearest(vectors):
        import pyarrow as pa_
        if not made:
            made.append(SparseCenters(held))
        dim, n = held.shape[1], len(vectors)
        null = vectors.is_null().to_numpy(zero_copy_only=False)
        kind, size, indices, values = vectors.flatten()
        kind = np.where(null, -1, kind.fill_null(-1).to_numpy(zero_copy_only=False))
        label, best = np.zeros(n, dtype=np.int32), np.full(n, np.inf)
        some = np.flatnonzero(kind == 0)
        sizes = size.fill_null(0).to_numpy(zero_copy_only=False)[some]
        if np.any(sizes != dim):
            raise ValueError(f"features must have {dim} entries, got {int(sizes[sizes != dim][0])}")
        if len(some):
            at, val = indices.take(pa_.array(some)), values.take(pa_.array(some))
            offsets = np.concatenate([[0], np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = (at.flatten().to_numpy(zero_copy_only=False), val.flatten().to_numpy(zero_copy_only=False))
            label[some], best[some] = made[0].nearest(offsets, *flat)
        dense = np.flatnonzero(kind == 1)
        if len(dense):
            val = values.take(pa_.array(dense))
            lengths = val.value_lengths().to_numpy(zero_copy_only=False)
            if np.any(lengths != dim):
                raise ValueError(f"features must have {dim} entries, got {int(lengths[lengths != dim][0])}")
            label[dense], best[dense] = nearest_rows(val.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), held)
        return pa_.StructArray.from_arrays([pa_.array(label, pa_.int32()), pa_.array(best, pa_.float64())], names=["prediction", "distance"])

    nearest.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return arrow_udf(nearest, "struct<prediction:int,distance:double>")


def assign_sparse(df: DataFrame, centers, vector_col: str = "features", prediction_col: str = "prediction",
                  distance_col: str | None = None) -> DataFrame:
    """J1 on a column of ML vectors, sparse or dense, as they are.  ``centers`` as
    for :func:`~fadeclust.operators.assign.assign_nearest`; a null vector gets
    label 0 and distance +Inf."""
    if prediction_col in df.columns:
        raise ValueError(f"Prediction column {prediction_col} already exists")
    found = _sparse_assign(centers_array(centers))(F.unwrap_udt(F.col(vector_col)))
    out = df.select("*", found.alias("__nearest"))
    columns = [F.col("__nearest.prediction").alias(prediction_col)]
    if distance_col:
        columns.append(F.col("__nearest.distance").alias(distance_col))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *columns)

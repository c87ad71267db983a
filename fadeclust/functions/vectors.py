"""Vector maths as Column expressions over ``ARRAY<DOUBLE>`` (V1-V8).

Every function returns a Column, so the work runs inside Spark's projection
(JVM side) on whatever partitioning the input already has.  Arrays of unequal
length raise an error instead of being padded with NULL (``zip_with`` would pad
silently); a NULL vector gives NULL.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def _checked(a: Column, b: Column, expr: Column, what: str) -> Column:
    """``expr`` when both arrays have one length, NULL for a NULL input,
    an error otherwise."""
    return (F.when(a.isNull() | b.isNull(), F.lit(None))
            .when(F.size(a) == F.size(b), expr)
            .otherwise(F.raise_error(F.lit(f"{what}: vectors differ in size"))))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def vec_dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    """V4: sum_i a_i * b_i."""
    a, b = _c(a), _c(b)
    return _checked(a, b, _sum(F.zip_with(a, b, lambda x, y: x * y)), "vec_dot")


def vec_norm(a: ColumnOrName) -> Column:
    """V1: Euclidean (L2) norm."""
    a = _c(a)
    return F.sqrt(_sum(F.transform(a, lambda x: x * x)))


def vec_sqdist(a: ColumnOrName, b: ColumnOrName) -> Column:
    """V2: squared Euclidean distance, exact difference form."""
    a, b = _c(a), _c(b)
    return _checked(
        a, b, _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))), "vec_sqdist")


def vec_sqdist_lower_bound(norm_a: ColumnOrName, norm_b: ColumnOrName) -> Column:
    """V3: ``(|a| - |b|)^2``, a lower bound of the squared distance."""
    d = _c(norm_a) - _c(norm_b)
    return d * d


def vec_axpy(alpha, x: ColumnOrName, y: ColumnOrName) -> Column:
    """V5: ``alpha * x + y`` element-wise (returns a new array)."""
    x, y = _c(x), _c(y)
    a = _lit_or_col(alpha)
    return _checked(x, y, F.zip_with(x, y, lambda u, v: a * u + v), "vec_axpy")


def vec_scale(alpha, x: ColumnOrName) -> Column:
    """V6: ``alpha * x``."""
    a = _lit_or_col(alpha)
    return F.transform(_c(x), lambda u: a * u)


def vec_zeros(dim) -> Column:
    """V7: an all-zero vector of length ``dim`` (int or Column)."""
    d = dim if isinstance(dim, Column) else F.lit(int(dim))
    return F.array_repeat(F.lit(0.0).cast("double"), d)


def vec_add(x: ColumnOrName, y: ColumnOrName) -> Column:
    """``x + y`` element-wise."""
    return vec_axpy(1.0, x, y)


def to_double_array(col: ColumnOrName) -> Column:
    """Any numeric array (e.g. ``ARRAY<FLOAT>``) as ``ARRAY<DOUBLE>``."""
    return _c(col).cast("array<double>")


def to_array(col: ColumnOrName) -> Column:
    """V8: ML vector (dense or sparse) to a dense ``ARRAY<DOUBLE>``."""
    return vector_to_array(_c(col), "float64")


def to_vector(col: ColumnOrName) -> Column:
    """V8: ``ARRAY<DOUBLE>`` to a dense ML vector (VectorUDT)."""
    return array_to_vector(_c(col))


def to_dense(col: ColumnOrName) -> Column:
    """V8: any ML vector as a dense ML vector."""
    return array_to_vector(vector_to_array(_c(col), "float64"))


def is_finite_vector(col: ColumnOrName) -> Column:
    """True when the array is non-NULL, non-empty and every entry is a finite,
    non-NULL number."""
    a = _c(col)
    bad = F.exists(a, lambda x: x.isNull() | F.isnan(x)
                   | (x == float("inf")) | (x == float("-inf")))
    return F.coalesce(a.isNotNull() & (F.size(a) > 0) & ~bad, F.lit(False))

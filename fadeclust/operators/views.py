"""Display views over labelled output.

``latest_n`` is a top-k (TakeOrderedAndProject: each task keeps its own n best
rows, the driver merges tasks x n rows), ``latest_center`` a ``max_by`` per
label with partial aggregation; neither collects a group into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The display keeps the last 90 points and prints at most
# 100 coordinates of a center, then "...".
DISPLAY_POINTS = 90
DISPLAY_COORDS = 100


def latest_n(df: DataFrame, order_cols, n: int = DISPLAY_POINTS) -> DataFrame:
    """The ``n`` rows latest by ``order_cols`` (descending)."""
    if isinstance(order_cols, str):
        order_cols = [order_cols]
    return df.orderBy(*[F.col(c).desc() for c in order_cols]).limit(n)


def latest_center(df: DataFrame, label_col: str = "label",
                  order_cols=("seq",), center_col: str = "center") -> DataFrame:
    """Per label, the center of the latest row (last write wins)."""
    if isinstance(order_cols, str):
        order_cols = [order_cols]
    order = F.struct(*[F.col(c) for c in order_cols])
    return df.groupBy(label_col).agg(F.max_by(F.col(center_col), order).alias(center_col))


def center_display(center: str | Column = "center",
                   limit: int = DISPLAY_COORDS, decimals: int | None = None) -> Column:
    """``[c0,c1,...]`` text, cut after ``limit`` coordinates with
    ``...`` in place of the closing bracket.  Coordinates print as the
    shortest exact double text, or with ``decimals`` fixed places."""
    c = F.col(center) if isinstance(center, str) else center
    if decimals is None:
        fmt = lambda v: v.cast("string")
    else:
        fmt = lambda v: F.format_string(f"%.{int(decimals)}f", v)
    shown = F.array_join(F.transform(F.slice(c, 1, limit), fmt), ",")
    return F.when(F.size(c) > limit, F.concat(F.lit("["), shown, F.lit("...")))\
        .otherwise(F.concat(F.lit("["), shown, F.lit("]")))

"""The model: k centers and k weights, bounded by the model, not by the data.

The model is the only thing that ever reaches the driver (k rows).  Its size is
checked whenever it is built, because it is shipped to every task (as
literals, a UDF closure or a broadcast variable).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType,
                               StructField, StructType)

# Largest model (8 * k * dim bytes) that may be shipped to tasks.  A larger one
# is refused rather than silently broadcast: every task holds the whole model.
MAX_MODEL_BYTES = 32 << 20
# Largest k read back from a centers table (one double each at least).
MAX_CENTERS = MAX_MODEL_BYTES // 8

STATE_SCHEMA = StructType([
    StructField("label", IntegerType(), False),
    StructField("center", ArrayType(DoubleType(), False), False),
    StructField("weight", DoubleType(), False),
])

HISTORY_SCHEMA = StructType([StructField("batch_id", LongType(), False)]
                            + STATE_SCHEMA.fields)


def check_model_size(k: int, dim: int) -> None:
    if k <= 0 or dim <= 0:
        raise ValueError(f"model needs k > 0 and dim > 0, got k={k} dim={dim}")
    if 8 * k * dim > MAX_MODEL_BYTES:
        raise ValueError(
            f"model of k={k} x dim={dim} exceeds {MAX_MODEL_BYTES} bytes; "
            "it is shipped to every task and must stay bounded")


@dataclass
class ModelState:
    """Centers ``(k, dim)`` and weights ``(k,)`` after batch ``batch_id``
    (``-1`` = the initial model)."""

    centers: np.ndarray
    weights: np.ndarray
    batch_id: int = -1
    _frozen: bool = field(default=True, repr=False)

    def __post_init__(self):
        c = np.array(self.centers, dtype=np.float64, copy=True)
        w = np.array(self.weights, dtype=np.float64, copy=True).reshape(-1)
        if c.ndim != 2:
            raise ValueError("centers must be a k x dim matrix")
        if c.shape[0] != w.shape[0]:
            raise ValueError(
                f"{c.shape[0]} centers need as many weights, got {w.shape[0]}")
        if np.any(w < 0) or np.any(np.isnan(w)):
            raise ValueError(f"weights must be >= 0, got {w.tolist()}")
        check_model_size(c.shape[0], c.shape[1])
        c.setflags(write=False)
        w.setflags(write=False)
        self.centers, self.weights = c, w

    @property
    def k(self) -> int:
        return self.centers.shape[0]

    @property
    def dim(self) -> int:
        return self.centers.shape[1]

    def to_rows(self):
        return [(i, [float(v) for v in self.centers[i]], float(self.weights[i]))
                for i in range(self.k)]

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The k-row state frame ``(label, center, weight)``."""
        return spark.createDataFrame(self.to_rows(), STATE_SCHEMA)

    @staticmethod
    def from_rows(rows, batch_id: int = -1) -> "ModelState":
        rows = sorted(rows, key=lambda r: r["label"])
        labels = [r["label"] for r in rows]
        if labels != list(range(len(labels))):
            raise ValueError(f"state labels must be 0..k-1, got {labels}")
        return ModelState(np.array([r["center"] for r in rows], dtype=np.float64),
                          np.array([r["weight"] for r in rows], dtype=np.float64),
                          batch_id)

    @staticmethod
    def from_df(df: DataFrame, batch_id: int = -1,
                max_k: int = MAX_CENTERS) -> "ModelState":
        """Read a ``(label, center, weight)`` frame, refusing more than
        ``max_k`` rows (the size check happens before anything is collected)."""
        n, values = df.agg(F.count(F.lit(1)), F.sum(F.size("center"))).first()
        if n > max_k or 8 * (values or 0) > MAX_MODEL_BYTES:
            raise ValueError(f"centers table holds {n} rows and {8 * (values or 0)} bytes; "
                             f"at most {max_k} rows and {MAX_MODEL_BYTES} bytes can be a model")
        rows = df.select("label", "center", "weight").collect()
        return ModelState.from_rows(rows, batch_id)


def centers_array(centers) -> np.ndarray:
    """Accept a ModelState, a matrix / list of vectors, or a centers frame
    ``(label, center[, weight])`` and return a ``(k, dim)`` float64 matrix."""
    if isinstance(centers, ModelState):
        return centers.centers
    if isinstance(centers, DataFrame):
        df = centers
        if "weight" not in df.columns:
            df = df.withColumn("weight", F.lit(0.0))
        return ModelState.from_df(df).centers
    c = np.asarray([np.asarray(v, dtype=np.float64) for v in centers])
    if c.ndim != 2:
        raise ValueError("centers must all have one dimension")
    check_model_size(c.shape[0], c.shape[1])
    return c


def initial_state_from_first(df: DataFrame, k: int, order_col,
                             features_col: str = "features",
                             weight: float = 0.0) -> ModelState:
    """Initial model = features of the ``k`` rows with the smallest
    ``order_col`` (a top-k: TakeOrderedAndProject, k rows to the driver)."""
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    rows = (df.select(*order, features_col)
            .orderBy(*[F.col(c).asc() for c in order]).limit(k).collect())
    if len(rows) < k:
        raise ValueError(f"need {k} rows for the initial centers, got {len(rows)}")
    return ModelState(np.array([r[features_col] for r in rows], dtype=np.float64),
                      np.full(k, float(weight)))


def random_state(spark: SparkSession, k: int, dim: int, weight: float,
                 seed: int) -> ModelState:
    """M6/V9: k centers with N(0, 1) entries drawn by Spark (``randn`` with a
    seed, so a given seed and layout always gives the same centers)."""
    if dim <= 0:
        raise ValueError(f"dim must be > 0, got {dim}")
    if weight < 0:
        raise ValueError(f"weight must be >= 0, got {weight}")
    check_model_size(k, dim)
    rows = (spark.range(0, k * dim, 1, 1)
            .select("id", F.randn(seed).alias("v")).orderBy("id").collect())
    vals = np.array([r["v"] for r in rows], dtype=np.float64).reshape(k, dim)
    return ModelState(vals, np.full(k, float(weight)))

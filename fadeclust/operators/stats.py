"""Per-cluster count and vector sum.

Each task adds its points into at most k rows and sends only those to the
shuffle, so a label holding a third of all points costs no more than any other.
Three physical forms of the same sums:

``wide``   ``sum(f[0]) .. sum(f[dim-1])`` as codegen'd HashAggregate
           (low dimension);
``long``   ``posexplode`` then ``groupBy(label, pos)`` (any dimension);
``arrow``  Arrow batches added up per task in row order, one row per label and
           task; these are added up in two levels (high dimension, or not
           known): first per label and salt, then per label, so that no merge
           task reads more than 1 / ``MERGE_FAN`` of a label's partial rows, or
           ``MERGE_FAN`` rows of each of its labels.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# dimension up to which ``auto`` uses the wide form (measured on 600k rows,
# k=3: wide 0.5-5.4 s for 2-128 dims, long 0.7-27 s); above it, or when dim is
# unknown, ``auto`` uses the Arrow form
AUTO_WIDE_MAX_DIM = 128
# salts per label of the first merge level of the Arrow form
MERGE_FAN = 64


def _features(df: DataFrame, features_col: str):
    t = df.schema[features_col].dataType
    f = F.col(features_col)
    if t.typeName() != "array":
        return vector_to_array(f, "float64")
    if t.elementType.typeName() != "double":
        return f.cast("array<double>")
    return f


def cluster_stats(df: DataFrame, label_col: str = "prediction",
                  features_col: str = "features", dim: int | None = None,
                  form: str = "auto") -> DataFrame:
    """``(label INT, n BIGINT, s ARRAY<DOUBLE>)``, one row per non-empty label."""
    f = _features(df, features_col)
    if form == "auto":
        form = "wide" if dim is not None and dim <= AUTO_WIDE_MAX_DIM else "arrow"
    label = F.col(label_col).cast("int").alias("label")
    if form == "wide":
        if dim is None:
            raise ValueError("the wide form needs dim")
        sums = ", ".join(f"sum(__f[{i}])" for i in range(dim))
        return (df.select(label, f.alias("__f"))
                .groupBy("label")
                .agg(F.expr("count(1)").alias("n"), F.expr(f"array({sums})").alias("s")))
    if form == "long":
        per_dim = (df.select(label, F.posexplode(f).alias("pos", "v"))
                   .groupBy("label", "pos")
                   .agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v")))
        # k * dim rows at most: re-assemble each label's vector in order
        return (per_dim.groupBy("label")
                .agg(F.max("n").alias("n"),
                     F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("__pv"))
                .select("label", "n", F.transform("__pv", lambda e: e["v"]).alias("s")))
    if form == "arrow":
        schema = "label int, n bigint, s array<double>"
        part = df.select(label, F.lit(1).cast("bigint").alias("n"), f.alias("s")).mapInArrow(_add_rows, schema)
        salted = part.withColumn("__salt", F.spark_partition_id() % MERGE_FAN).repartition("label", "__salt").drop("__salt")
        return salted.mapInArrow(_add_rows, schema).repartition("label").mapInArrow(_add_rows, schema)
    raise ValueError(f"unknown stats form {form!r}")


def _add_rows(batches):
    """Sum of ``n`` and ``s`` per label over a partition, in row order."""
    import pyarrow as pa
    total: dict = {}
    for batch in batches:
        labels, counts, vectors = batch.columns
        vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
        lab = np.array([-1 if v is None else v for v in labels.to_pylist()], dtype=np.int64)
        n = counts.to_numpy(zero_copy_only=False)
        offsets = vectors.offsets.to_numpy()
        flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        for value in np.unique(lab):
            rows = np.flatnonzero(lab == value)
            dim = int(offsets[rows[0] + 1] - offsets[rows[0]])
            if np.any(offsets[rows + 1] - offsets[rows] != dim):
                raise ValueError("features of one label differ in size")
            seen, acc = total.get(int(value), (0, np.zeros(dim)))
            if len(acc) != dim:
                raise ValueError("features of one label differ in size")
            x = flat[offsets[rows][:, None] + np.arange(dim)]
            total[int(value)] = (seen + int(n[rows].sum()), np.add.accumulate(np.vstack([acc, x]), axis=0)[-1])
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array([None if v < 0 else v for v in total], pa.int32()), pa.array([t[0] for t in total.values()], pa.int64()),
             pa.array([t[1] for t in total.values()], pa.list_(pa.float64()))], ["label", "n", "s"])


def label_sums(labels: np.ndarray, X: np.ndarray) -> list:
    """``[(label, n, sum)]`` of the rows of a matrix, added up in row order."""
    out = []
    for label in np.unique(labels):
        x = X[labels == label]
        out.append((int(label), len(x), np.add.accumulate(np.vstack([np.zeros(X.shape[1]), x]), axis=0)[-1]))
    return out


def stats_long(stats: DataFrame) -> DataFrame:
    """``(label, dim, s, n)``: one row per label and coordinate."""
    return stats.select("label", "n", F.posexplode("s").alias("dim", "s")) \
        .select("label", F.col("dim").cast("int").alias("dim"), "s", "n")


def collect_stats(stats: DataFrame, k: int):
    """Bring the stats rows to the driver.  Labels come from an argmin over k
    centers, so there are at most k rows by construction (no limit needed,
    which would add incremental take jobs)."""
    rows = stats.collect()
    if len(rows) > k:
        raise ValueError(f"more than k={k} labels in a batch")
    return [(int(r["label"]), int(r["n"]), list(r["s"])) for r in rows]

"""Written intermediate tables and size-checked joins for the operators here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fadeclust.session import fresh_dir

BROADCAST_BYTES = 8 << 20  # a side above this is joined by a shuffle
BATCH_ROWS = 512           # rows of text that are held at once between a scan, the JVM and Python


def lean_batches(spark: SparkSession) -> None:
    """Let this session's scans and Arrow tasks hold at most ``BATCH_ROWS`` rows at
    once (lower settings stay): Spark's 4,096 and 10,000 rows are a few MB of
    numbers, but tens of MB of texts, several times over in each running task."""
    for name in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"):
        rows = int(spark.conf.get(name))
        if rows <= 0 or rows > BATCH_ROWS:
            spark.conf.set(name, BATCH_ROWS)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that later jobs neither
    recompute it nor depend on any executor that made it."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_side(rows: DataFrame, side: DataFrame, on: str, payload: str, how: str = "left") -> DataFrame:
    """Join a written side table with one binary or array payload per key.

    The side is broadcast only if its measured bytes are below
    ``BROADCAST_BYTES``; otherwise both are shuffled on the key.
    """
    col = F.col(payload)
    kind = dict(side.dtypes)[payload]
    size = F.octet_length(col) if kind == "binary" else F.lit(24) * F.size(col) if kind.startswith("array") else F.lit(8)
    n = side.agg(F.sum(size + F.lit(48)).alias("n")).first()["n"] or 0
    return rows.join(F.broadcast(side) if n <= BROADCAST_BYTES else side.hint("merge"), on, how)


def bounded(side: DataFrame, row_bytes: int = 100) -> DataFrame:
    """A written table of short rows, to be broadcast only if it is small."""
    return F.broadcast(side) if row_bytes * side.count() <= BROADCAST_BYTES else side.hint("merge")


def semi_join(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among those of a table that grows with the input, by a
    shuffle (one plan at every size; adaptive execution splits hot keys)."""
    return rows.join(keys.hint("merge"), on, "left_semi")


def without_ids(rows: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose id is not among those of a written one-column table."""
    small = 16 * ids.count() <= BROADCAST_BYTES
    return rows.join(F.broadcast(ids) if small else ids.hint("merge"), on, "left_anti")


def numbered(rows: DataFrame, *columns: str) -> DataFrame:
    """The named columns under fixed aliases c0, c1, ... so that other columns
    of the input, whatever their names, cannot clash with an operator's own."""
    return rows.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])

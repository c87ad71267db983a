"""Batch inputs: the driver tables and the point frames derived from them.

Every reader selects only the columns it needs, so the parquet scan prunes
to them (``ReadSchema``), and filters stay above the scan for pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.points import parse_valid_points


# Row keys of the driver tables (used to spread a scan that has too few splits).
TABLE_KEYS = {
    "events": ("event_id",),
    "embeddings": ("vec_id",),
    "lineitem": ("l_orderkey", "l_linenumber"),
}
# ``spread`` is applied where the per-row work is heavy (building and parsing
# JSON lines); for cheap arithmetic the extra shuffle costs more than it saves
# (measured at sf0.1: lineitem/embeddings queries 0.4-0.7 s slower).


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Splits up to which ``spread`` may shuffle: at the default split size of
# 128 MB a table of 1 GB at most.
SPREAD_MAX_SPLITS = 8


def spread(df: DataFrame, keys) -> DataFrame:
    """Parallelism floor for small tables: a scan of at most
    ``SPREAD_MAX_SPLITS`` splits, and fewer than the cluster's default
    parallelism, is hash-partitioned by its row key so CPU-heavy projections
    use every core.  Larger inputs are left as they are (no shuffle); their
    splits follow ``spark.sql.files.maxPartitionBytes``."""
    want = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if keys and splits < want and splits <= SPREAD_MAX_SPLITS:
        return df.repartition(want, *[F.col(k) for k in keys])
    return df


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, features ARRAY<DOUBLE>)`` from ``embeddings``."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("features"))


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-D points ``[quantity, extendedprice, discount, tax]`` per line item."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.array(*[F.col(c).cast("double") for c in cols]).alias("features"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON point line per event: ``{"x": value, "y": props.k}``
    (spread over all cores when the scan has fewer splits than that).

    Sign-up events carry ``x`` as a quoted string and error events carry only
    their raw ``props`` (no coordinates), so both are rejected by the parser;
    they are the bad records of the point stream.
    """
    ev = spread(table(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "value", "props"), TABLE_KEYS["events"])
    k = F.get_json_object("props", "$.k")
    good = F.concat(F.lit('{"x":'), F.col("value").cast("string"),
                    F.lit(',"y":'), k, F.lit("}"))
    quoted = F.concat(F.lit('{"x":"'), F.col("value").cast("string"),
                      F.lit('","y":'), k, F.lit("}"))
    line = (F.when(F.col("event_type") == "error", F.col("props"))
            .when(F.col("event_type") == "signup", quoted)
            .otherwise(good))
    return ev.select("event_id", "ts", F.to_date("ts").alias("day"),
                     "event_type", line.alias("value"))


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid 2-D points of the event stream with ``features = [x, y]``."""
    lines = event_lines(spark, sf_dir)
    pts = parse_valid_points(lines, "value")
    return pts.withColumn("features", F.array("x", "y"))

"""The display views as state of a streaming query.

``latest_points_stream`` keeps the n newest rows seen so far, and
``latest_centers_stream`` the newest center of every label, in Spark's state
store (``transformWithState``, RocksDB).  Rows are dealt by a hash of their order
columns to ``SALTS`` keys (per label for the centers), so no key holds more than a
share of the rows, and the state is bounded: ``SALTS`` times n rows, or ``SALTS``
rows a label, whatever the length of the stream.  The views are read from the
state by Spark's state-store reader and reduced once more; nothing is written
besides the checkpoint, and a restarted query goes on with its state.

Rows whose order columns are NULL are older than any other.  Equal order values
are broken by the remaining columns' text, so the views do not depend on the order
of arrival.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import fresh_dir

SALTS = 8
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SPOT = "seq STRING, row STRING"


class _Newest(StatefulProcessor):
    """Per key the ``n`` newest ``(seq, row)`` pairs, newest first."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", _SPOT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd
        held = [(r[0], r[1]) for r in self.kept.get()]
        for frame in rows:
            held += list(zip(frame["seq"], frame["row"]))
            held = sorted(set(held), reverse=True)[:self.n]
        self.kept.put(held)
        yield pd.DataFrame({"kept": [len(held)]})

    def close(self) -> None:
        pass


def _sortable(c: str, kind: str):
    """A text of an order column that sorts as the column does, NULL first."""
    x = F.col(f"`{c}`")
    if kind.startswith("timestamp"):
        x, kind = F.unix_micros(x.cast("timestamp")), "bigint"
    elif kind == "date":
        x, kind = F.unix_date(x), "bigint"
    if kind in ("tinyint", "smallint", "int", "bigint"):
        # shifted to be positive: 20 digits hold any 64-bit number
        return F.coalesce(F.lpad((x.cast("decimal(20,0)") + F.lit("9223372036854775809").cast("decimal(20,0)")).cast("string"), 20, "0"), F.lit(""))
    if kind == "string":
        return F.coalesce(F.concat(F.lit("s"), x), F.lit(""))
    raise TypeError(f"order column {c} must be an integer, date, timestamp or string, not {kind}")


@contextmanager
def _rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _start(df: DataFrame, keys: list[str], order_cols, n: int, checkpoint: str, trigger: dict | None):
    spark = df.sparkSession
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    kinds = dict(df.dtypes)
    seq = F.concat_ws("\u0001", *[_sortable(c, kinds[c]) for c in order])
    rest = [c for c in df.columns if c not in keys]
    keyed = df.select(*[F.col(f"`{k}`") for k in keys], F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in order]), F.lit(SALTS)).cast("int").alias("salt"),
                      seq.alias("seq"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("row"))
    state = keyed.groupBy(*keys, "salt").transformWithStateInPandas(_Newest(n), "kept long", "Update", "None")
    with _rocksdb(spark):
        w = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        return (w.trigger(**trigger) if trigger else w).start()


def _state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``key``, ``seq`` and ``row`` of everything that is kept."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "kept").load()
    return held.select("key.*", F.col("list_element.seq").alias("seq"), F.col("list_element.row").alias("row"))


def latest_points_stream(df: DataFrame, order_cols, n: int = 90, checkpoint: str | None = None, trigger: dict | None = None):
    """Start a query that keeps the ``n`` newest rows of ``df``.  Returns
    ``(query, checkpoint)``; :func:`read_latest_points` reads them."""
    checkpoint = checkpoint or fresh_dir(df.sparkSession, "latest")
    return _start(df, [], order_cols, n, checkpoint, trigger), checkpoint


def read_latest_points(spark: SparkSession, checkpoint: str, schema, n: int = 90) -> DataFrame:
    """The ``n`` newest rows of all batches committed so far."""
    newest = _state(spark, checkpoint).orderBy(F.desc("seq"), F.desc("row")).limit(n)
    return newest.select(F.from_json("row", schema).alias("r")).select("r.*")


def latest_centers_stream(df: DataFrame, order_cols, label_col: str = "prediction", checkpoint: str | None = None, trigger: dict | None = None):
    """Start a query that keeps the newest row of every label."""
    checkpoint = checkpoint or fresh_dir(df.sparkSession, "latest")
    return _start(df, [label_col], order_cols, 1, checkpoint, trigger), checkpoint


def read_latest_centers(spark: SparkSession, checkpoint: str, schema, label_col: str = "prediction") -> DataFrame:
    """``label_col`` and the other columns of each label's newest row."""
    newest = _state(spark, checkpoint).groupBy(label_col).agg(F.max_by("row", F.struct("seq", "row")).alias("row"))
    return newest.select(label_col, F.from_json("row", schema).alias("r")).select(label_col, "r.*")

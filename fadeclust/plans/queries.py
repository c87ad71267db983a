"""The registered query set: one Spark query per operator, with its SQL.

Each query takes ``(spark, sf_dir)``, reads the driver tables (or data Spark
derives from them) in full and returns a DataFrame in long form with doubles
rounded to 6 places, so that results compare by value against the SQL text in
:data:`ORACLE`.  A query whose semantics SQL cannot state (a streaming run,
the estimator) has no SQL entry and is checked by rows and by the tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..estimator import StreamingKMeans
from ..functions.points import (REASON_COL, features_to_xy, label_color, label_points,
                                parse_labelled, parse_points, points_to_json,
                                rejected_points)
from ..functions.vectors import (to_array, to_vector, vec_axpy, vec_dot,
                                 vec_norm, vec_scale, vec_sqdist,
                                 vec_sqdist_lower_bound, vec_zeros)
from ..operators.assign import assign_nearest, attach_center, cluster_cost
from ..operators.model import initial_state_from_first
from ..operators.sparse import assign_sparse
from ..operators.stats import cluster_stats, stats_long
from ..operators.update import UpdateParams, train_step
from ..operators.views import center_display, latest_center, latest_n
from ..session import fresh_dir
from ..sources.streams import (KEY_FILE_ROWS, KeyedBatches, checked_points, points_stream,
                               read_lines_stream)
from ..sources.tables import (embedding_points, event_lines, event_points,
                              lineitem_points, table)
from ..streaming import datasource as _ds
from ..streaming.score import score_stream
from ..streaming.sinks import (FileLineTransport, LineWriter,
                               batch_distinct_count, console, fan_out,
                               print_sample, read_distinct_counts, run_batches,
                               write_lines_batch)
from ..streaming.train import (labelled_json, read_progress,
                               train_and_score_stream, train_stream)
from ..streaming.views import (latest_centers_stream, latest_points_stream,
                               read_latest_centers, read_latest_points)
from . import oracle as sql
from .fold import fit_fold, fold_history, history_long, score_with_history, stage_by_batch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed model settings of the two demo jobs: k = 3 clusters, decay 0.3,
# initial weight 0.01; the numpy demo uses decay 0.2.
K = 3
DECAY = 0.3
W0 = 0.01
# Points per replayed batch of the embeddings table.
EMB_BATCH = 200


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


def _rounded_history(df: DataFrame) -> DataFrame:
    return df.select("batch_id", "label", "dim", r6("center").alias("center"),
                     r6("weight").alias("weight"))


# ---- T1 / M9: one update -------------------------------------------------

def _one_batch(spark, sf_dir, decay):
    pts = embedding_points(spark, sf_dir)
    init = initial_state_from_first(pts, K, "vec_id", weight=W0)
    state = train_step(pts, init, UpdateParams(decay=decay), batch_id=0)
    return _rounded_history(history_long(spark, [state]))


def _one_batch_sql(decay):
    return f"""WITH RECURSIVE pts AS (SELECT id, 0 AS b, f FROM ({sql.EMB_POINTS})),
{sql.fold_ctes(K, W0, decay)}
{sql.history_long_select()}"""


@register("update_one_batch", _one_batch_sql(DECAY))
def update_one_batch(spark, sf_dir):
    return _one_batch(spark, sf_dir, DECAY)


@register("update_decay_0", _one_batch_sql(0.0))
def update_decay_0(spark, sf_dir):
    return _one_batch(spark, sf_dir, 0.0)


@register("update_decay_1", _one_batch_sql(1.0))
def update_decay_1(spark, sf_dir):
    return _one_batch(spark, sf_dir, 1.0)


# ---- T1 fold over batches --------------------------------------------------

def _emb_batches(spark, sf_dir):
    return embedding_points(spark, sf_dir).withColumn(
        "batch", F.floor(F.col("vec_id") / EMB_BATCH))


EMB_BATCHED_PTS = (f"pts AS (SELECT id, CAST(dense_rank() OVER (ORDER BY id // {EMB_BATCH}) - 1 "
                   f"AS INTEGER) AS b, f FROM ({sql.EMB_POINTS}))")


def _emb_fold(spark, sf_dir, params, w0=W0):
    pts = _emb_batches(spark, sf_dir)
    init = initial_state_from_first(pts, K, "vec_id", weight=w0)
    return _rounded_history(history_long(spark, fold_history(pts, "batch", init, params)))


@register("train_replay", f"""WITH RECURSIVE {EMB_BATCHED_PTS},
{sql.fold_ctes(K, W0, DECAY)}
{sql.history_long_select()}""")
def train_replay(spark, sf_dir):
    return _emb_fold(spark, sf_dir, UpdateParams(decay=DECAY))


# ---- P1-P6: parse, validate, assemble ---------------------------------------


PROPS_SCHEMA = "k BIGINT"


@register("parse_props", """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events""")
def parse_props(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return parse_points(ev, "props", PROPS_SCHEMA).select("event_id", "k")


@register("valid_points", f"""
SELECT id AS event_id, {sql.r6('x')} AS x, {sql.r6('y')} AS y FROM ({sql.EVENT_POINTS})""")
def valid_points_q(spark, sf_dir):
    return event_points(spark, sf_dir).select("event_id", r6("x").alias("x"),
                                              r6("y").alias("y"))


@register("rejected_points", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'no_point' ELSE 'bad_field' END AS reason
FROM events WHERE event_type IN ('signup', 'error')""")
def rejected_points_q(spark, sf_dir):
    parsed = parse_points(event_lines(spark, sf_dir), "value")
    return rejected_points(parsed, "value").select("event_id", "reason")


@register("assemble_features", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS f0, l_extendedprice AS f1,
       l_discount AS f2, l_tax AS f3 FROM lineitem""")
def assemble_features_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    from ..functions.points import assemble_features
    v = assemble_features(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                          out="vec", as_vector=True)
    arr = to_array("vec")
    return v.select("l_orderkey", "l_linenumber",
                    *[arr[i].alias(f"f{i}") for i in range(4)])


@register("features_to_xy", f"""
SELECT id AS event_id, {sql.r6('x')} AS x, {sql.r6('y')} AS y FROM ({sql.EVENT_POINTS})""")
def features_to_xy_q(spark, sf_dir):
    pts = event_points(spark, sf_dir).select(
        "event_id", to_vector("features").alias("vec"))
    out = features_to_xy(pts, "vec", "px", "py")
    return out.select("event_id", r6("px").alias("x"), r6("py").alias("y"))


# ---- J1 / A5: nearest center -------------------------------------------------

def _first_centers_sql(pts: str, k: int, order: str = "id") -> str:
    return f"(SELECT list(f ORDER BY {order}) FROM (SELECT * FROM ({pts}) ORDER BY {order} LIMIT {k}))"


def _assign_sql(pts: str, cs: str, cols: str, order: str = "id") -> str:
    """Rows of ``pts`` with ``lbl`` (1-based) and ``d`` against centers ``cs``."""
    return f"""SELECT {cols}, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS prediction,
       list_min(d) AS distance
FROM (SELECT *, {sql.dists_to('cs')} AS d
      FROM ({pts}) p, (SELECT {cs} AS cs) c)"""


@register("assign_nearest", f"""
SELECT vec_id, prediction, {sql.r6('distance')} AS distance FROM (
{_assign_sql(sql.EMB_POINTS, _first_centers_sql(sql.EMB_POINTS, K), 'id AS vec_id')})""")
def assign_nearest_q(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    init = initial_state_from_first(pts, K, "vec_id")
    out = assign_nearest(pts, init, distance_col="distance")
    return out.select("vec_id", "prediction", r6("distance").alias("distance"))


LI_K = 4


@register("assign_distance", f"""
SELECT l_orderkey, l_linenumber, prediction, round(distance, 4) + 0.0 AS distance FROM (
{_assign_sql(sql.LINEITEM_POINTS, _first_centers_sql(sql.LINEITEM_POINTS, LI_K, 'l_orderkey, l_linenumber'), 'l_orderkey, l_linenumber')})""")
def assign_distance_q(spark, sf_dir):
    pts = lineitem_points(spark, sf_dir)
    init = initial_state_from_first(pts, LI_K, ["l_orderkey", "l_linenumber"])
    out = assign_nearest(pts, init, distance_col="distance", method="unrolled")
    return out.select("l_orderkey", "l_linenumber", "prediction",
                      (F.round("distance", 4) + F.lit(0.0)).alias("distance"))


def _label_means(pts: DataFrame) -> DataFrame:
    """Centers table: per-label mean embedding (label, center)."""
    st = cluster_stats(pts, "label", "features", 64)
    return st.select("label", F.transform("s", lambda v: v / F.col("n")).alias("center"))


LABEL_MEANS_SQL = f"""SELECT label, list_transform({sql.vec_sum_agg()}, lambda v: v / count(*)) AS center
FROM ({sql.EMB_POINTS}) GROUP BY label"""


@register("assign_center_table", f"""
SELECT vec_id, label, prediction, {sql.r6('distance')} AS distance FROM (
{_assign_sql(sql.EMB_POINTS, f'(SELECT list(center ORDER BY label) FROM ({LABEL_MEANS_SQL}))', 'id AS vec_id, label')})""")
def assign_center_table_q(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    out = assign_nearest(pts, _label_means(pts), distance_col="distance")
    return out.select("vec_id", "label", "prediction", r6("distance").alias("distance"))


EVT_FIRST = _first_centers_sql(sql.EVENT_POINTS, K)


@register("attach_center", f"""
SELECT event_id, prediction, {sql.r6('cs[prediction + 1][1]')} AS cx,
       {sql.r6('cs[prediction + 1][2]')} AS cy FROM (
{_assign_sql(sql.EVENT_POINTS, EVT_FIRST, 'id AS event_id, cs')})""")
def attach_center_q(spark, sf_dir):
    pts = event_points(spark, sf_dir)
    init = initial_state_from_first(pts, K, "event_id")
    out = attach_center(assign_nearest(pts, init), init, "prediction", "center")
    return out.select("event_id", "prediction", r6(F.col("center")[0]).alias("cx"),
                      r6(F.col("center")[1]).alias("cy"))


@register("cluster_cost", f"""
SELECT CAST(prediction AS INTEGER) AS label, count(*) AS n, {sql.r6('sum(distance)')} AS cost FROM (
{_assign_sql(sql.EMB_POINTS, _first_centers_sql(sql.EMB_POINTS, K), 'id')}) GROUP BY prediction""")
def cluster_cost_q(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    init = initial_state_from_first(pts, K, "vec_id")
    cost = cluster_cost(assign_nearest(pts, init, distance_col="distance"))
    return cost.select("label", "n", r6("cost").alias("cost"))


# ---- P7-P11: labelled records ---------------------------------------------------

@register("labelled_roundtrip", f"""
SELECT event_id, {sql.r6('p[1]')} AS px, {sql.r6('p[2]')} AS py,
       {sql.r6('cs[prediction + 1][1]')} AS cx, {sql.r6('cs[prediction + 1][2]')} AS cy,
       prediction AS label FROM (
{_assign_sql(sql.EVENT_POINTS, EVT_FIRST, 'id AS event_id, f AS p, cs')})""")
def labelled_roundtrip(spark, sf_dir):
    pts = event_points(spark, sf_dir)
    init = initial_state_from_first(pts, K, "event_id")
    lab = attach_center(assign_nearest(pts, init), init, "prediction", "center")
    lab = lab.withColumn("cx", F.col("center")[0]).withColumn("cy", F.col("center")[1])
    lines = lab.select("event_id", points_to_json(label_points()).alias("value"))
    back = parse_labelled(lines, "value")
    return back.select("event_id", r6("point.x").alias("px"), r6("point.y").alias("py"),
                       r6("center.x").alias("cx"), r6("center.y").alias("cy"), "label")


@register("label_color", f"""
SELECT event_id, prediction AS label, ['#0072B2', '#E69F00', '#F0E442'][prediction + 1] AS color FROM (
{_assign_sql(sql.EVENT_POINTS, EVT_FIRST, 'id AS event_id')})""")
def label_color_q(spark, sf_dir):
    pts = event_points(spark, sf_dir)
    init = initial_state_from_first(pts, K, "event_id")
    lab = assign_nearest(pts, init)
    return lab.select("event_id", F.col("prediction").alias("label"),
                      label_color("prediction").alias("color"))


# ---- A1: cluster statistics --------------------------------------------------------

@register("cluster_stats_wide", f"""
SELECT prediction AS label, count(*) AS n,
       round(sum(f[1]), 2) + 0.0 AS s0, round(sum(f[2]), 2) + 0.0 AS s1,
       round(sum(f[3]), 2) + 0.0 AS s2, round(sum(f[4]), 2) + 0.0 AS s3 FROM (
{_assign_sql(sql.LINEITEM_POINTS, _first_centers_sql(sql.LINEITEM_POINTS, LI_K, 'l_orderkey, l_linenumber'), 'f')})
GROUP BY prediction""")
def cluster_stats_wide(spark, sf_dir):
    pts = lineitem_points(spark, sf_dir)
    init = initial_state_from_first(pts, LI_K, ["l_orderkey", "l_linenumber"])
    st = cluster_stats(assign_nearest(pts, init), "prediction", "features", 4, "wide")
    return st.select("label", "n", *[(F.round(F.col("s")[i], 2) + F.lit(0.0)).alias(f"s{i}")
                                      for i in range(4)])


@register("cluster_stats_long", f"""
SELECT CAST(prediction AS INTEGER) AS label, CAST(j - 1 AS INTEGER) AS dim,
       {sql.r6('sum(v)')} AS s, count(*) AS n FROM (
  SELECT prediction, unnest(f) AS v, generate_subscripts(f, 1) AS j FROM (
{_assign_sql(sql.EMB_POINTS, _first_centers_sql(sql.EMB_POINTS, K), 'f')}))
GROUP BY prediction, j""")
def cluster_stats_long(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    init = initial_state_from_first(pts, K, "vec_id")
    st = cluster_stats(assign_nearest(pts, init), "prediction", "features", 64, "long")
    return stats_long(st).select("label", "dim", r6("s").alias("s"), "n")


# ---- V1-V7: vector functions ---------------------------------------------------------

def _with_label_mean(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    return attach_center(pts, _label_means(pts), "label", "mean")


EMB_WITH_MEAN = f"""SELECT p.id AS vec_id, p.f, m.center AS mean FROM ({sql.EMB_POINTS}) p
JOIN ({LABEL_MEANS_SQL}) m ON m.label = p.label"""


@register("vec_norm", f"""
SELECT id AS vec_id, {sql.r6('sqrt(list_sum(list_transform(f, lambda x: x * x)))')} AS norm
FROM ({sql.EMB_POINTS})""")
def vec_norm_q(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    return pts.select("vec_id", r6(vec_norm("features")).alias("norm"))


@register("vec_dot", f"""
SELECT vec_id, {sql.r6('list_sum(list_transform(list_zip(f, mean), lambda z: z[1] * z[2]))')} AS dot
FROM ({EMB_WITH_MEAN})""")
def vec_dot_q(spark, sf_dir):
    df = _with_label_mean(spark, sf_dir)
    return df.select("vec_id", r6(vec_dot("features", "mean")).alias("dot"))


@register("vec_sqdist", f"""
SELECT vec_id, {sql.r6(sql.sqdist('f', 'mean'))} AS sqdist FROM ({EMB_WITH_MEAN})""")
def vec_sqdist_q(spark, sf_dir):
    df = _with_label_mean(spark, sf_dir)
    return df.select("vec_id", r6(vec_sqdist("features", "mean")).alias("sqdist"))


@register("vec_axpy", f"""
SELECT vec_id, CAST(j - 1 AS INTEGER) AS dim, {sql.r6('v')} AS value FROM (
  SELECT vec_id, unnest(list_transform(list_zip(f, mean), lambda z: 0.5 * z[1] + z[2])) AS v,
         generate_subscripts(f, 1) AS j FROM ({EMB_WITH_MEAN}))""")
def vec_axpy_q(spark, sf_dir):
    df = _with_label_mean(spark, sf_dir)
    out = df.select("vec_id", F.posexplode(vec_axpy(0.5, "features", "mean")).alias("dim", "v"))
    return out.select("vec_id", F.col("dim").cast("int").alias("dim"), r6("v").alias("value"))


@register("vec_scale", f"""
SELECT id AS vec_id, CAST(j - 1 AS INTEGER) AS dim, {sql.r6('v')} AS value FROM (
  SELECT id, unnest(list_transform(f, lambda x: -2.5 * x)) AS v, generate_subscripts(f, 1) AS j
  FROM ({sql.EMB_POINTS}))""")
def vec_scale_q(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    out = pts.select("vec_id", F.posexplode(vec_scale(-2.5, "features")).alias("dim", "v"))
    return out.select("vec_id", F.col("dim").cast("int").alias("dim"), r6("v").alias("value"))


@register("vec_zeros", f"""
SELECT id AS vec_id, CAST(len(f) AS INTEGER) AS n, {sql.r6('list_sum(f)')} AS total
FROM ({sql.EMB_POINTS})""")
def vec_zeros_q(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    z = vec_zeros(F.size("features"))
    acc = vec_axpy(1.0, "features", z)           # x + 0 = x, accumulated from zero
    return pts.select("vec_id", F.size(z).cast("int").alias("n"),
                      r6(F.aggregate(acc, F.lit(0.0), lambda a, v: a + v)).alias("total"))


# ---- W1: latest points ---------------------------------------------------------------

@register("latest_n", f"""
SELECT id AS event_id, {sql.r6('x')} AS x, {sql.r6('y')} AS y FROM ({sql.EVENT_POINTS})
ORDER BY ts DESC, id DESC LIMIT 90""")
def latest_n_q(spark, sf_dir):
    pts = event_points(spark, sf_dir)
    return latest_n(pts, ["ts", "event_id"], 90).select(
        "event_id", r6("x").alias("x"), r6("y").alias("y"))


# ---- T1 fold on the 2-D event stream, train-and-score (T4/T5) ---------------------------

EVT_BATCHED_PTS = (f"pts AS (SELECT id, ts, x, y, CAST(dense_rank() OVER (ORDER BY day) - 1 "
                   f"AS INTEGER) AS b, f FROM ({sql.EVENT_POINTS}))")


def _events_fold(spark, sf_dir, params=None, w0=W0, k=K):
    """Events parsed and staged once; initial centers, batches and scores all
    read the staged points."""
    pts = stage_by_batch(event_points(spark, sf_dir).select("event_id", "ts", "day", "x", "y", "features"), "day")
    init = initial_state_from_first(pts, k, "event_id", weight=w0)
    keys, hist = fit_fold(pts, "day", init, params or UpdateParams(decay=DECAY))
    return pts, init, keys, hist


def _history_2d(spark, hist):
    h = history_long(spark, hist)
    return _rounded_history(h)


@register("train_replay_events", f"""WITH RECURSIVE {EVT_BATCHED_PTS},
{sql.fold_ctes(K, W0, DECAY)}
{sql.history_long_select()}""")
def train_replay_events(spark, sf_dir):
    _, _, _, hist = _events_fold(spark, sf_dir)
    return _history_2d(spark, hist)


def _score_sql(which: str) -> str:
    shift = "st.b = pts.b" if which == "after" else "st.b = pts.b - 1"
    return f"""WITH RECURSIVE {EVT_BATCHED_PTS},
{sql.fold_ctes(K, W0, DECAY)}
SELECT event_id, prediction, {sql.r6('cs[prediction + 1][1]')} AS cx,
       {sql.r6('cs[prediction + 1][2]')} AS cy FROM (
  SELECT pts.id AS event_id, st.cs,
         CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS prediction
  FROM (SELECT pts.*, st.cs, {sql.dists_to('st.cs', 'pts.f')} AS d
        FROM pts JOIN st ON {shift}) pts JOIN st ON {shift})"""


def _score(spark, sf_dir, which):
    pts, init, keys, hist = _events_fold(spark, sf_dir)
    out = score_with_history(pts, "day", keys, init, hist, which)
    return out.select("event_id", "prediction", r6(F.col("center")[0]).alias("cx"),
                      r6(F.col("center")[1]).alias("cy"))


@register("train_and_score_after", _score_sql("after"))
def train_and_score_after(spark, sf_dir):
    return _score(spark, sf_dir, "after")


@register("train_and_score_before", _score_sql("before"))
def train_and_score_before(spark, sf_dir):
    return _score(spark, sf_dir, "before")


@register("latest_center", f"""WITH RECURSIVE {EVT_BATCHED_PTS},
{sql.fold_ctes(K, W0, DECAY)}
SELECT prediction AS label, {sql.r6('arg_max(cs[prediction + 1][1], struct_pack(ts := ts, id := id))')} AS cx,
       {sql.r6('arg_max(cs[prediction + 1][2], struct_pack(ts := ts, id := id))')} AS cy FROM (
  SELECT pts.id, pts.ts, st.cs,
         CAST(list_position({sql.dists_to('st.cs', 'pts.f')}, list_min({sql.dists_to('st.cs', 'pts.f')})) - 1 AS INTEGER) AS prediction
  FROM pts JOIN st ON st.b = pts.b) GROUP BY prediction""")
def latest_center_q(spark, sf_dir):
    pts, init, keys, hist = _events_fold(spark, sf_dir)
    scored = score_with_history(pts, "day", keys, init, hist, "after")
    lc = latest_center(scored, "prediction", ["ts", "event_id"], "center")
    return lc.select(F.col("prediction").alias("label"),
                     r6(F.col("center")[0]).alias("cx"), r6(F.col("center")[1]).alias("cy"))


# ---- T11: dying-cluster split and point-based decay --------------------------------------

SPLIT_K = 5


@register("split_dying", f"""WITH RECURSIVE {EVT_BATCHED_PTS},
{sql.fold_ctes(SPLIT_K, 0.0, DECAY, split=True, init_order='x DESC, id')}
{sql.history_long_select()}""")
def split_dying(spark, sf_dir):
    """T11 with the DStream job's settings (w0 = 0, split on): the centers
    start at the k points with the largest x, so most attract no points at
    first, die and are split off the heaviest cluster, one per batch."""
    pts = stage_by_batch(event_points(spark, sf_dir).select("event_id", "day", "x", "features"), "day")
    init = initial_state_from_first(pts.withColumn("__o", -F.col("x")), SPLIT_K,
                                    ["__o", "event_id"], weight=0.0)
    _, hist = fit_fold(pts, "day", init, UpdateParams(decay=DECAY, split_dying=True))
    return _history_2d(spark, hist)


@register("time_unit_points", f"""WITH RECURSIVE {EMB_BATCHED_PTS},
{sql.fold_ctes(K, W0, 0.999, time_unit='points')}
{sql.history_long_select()}""")
def time_unit_points(spark, sf_dir):
    return _emb_fold(spark, sf_dir, UpdateParams(decay=0.999, time_unit="points"))


# ---- Streaming: replayed event stream (S1-S3, T2-T10, K1-K9) -------------------------


NOW = {"availableNow": True}


def _run_to_end(query) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


def _keyed_events(spark, sf_dir, publish=None, file_rows=KEY_FILE_ROWS):
    """The event lines (bad records included), one day per micro-batch."""
    return KeyedBatches(event_lines(spark, sf_dir), "day", publish=publish, file_rows=file_rows)


def _by_key(kb):
    """The points of one key after the other as batches."""
    return lambda func: kb.each(func, points_stream)


# Keys that one trigger admits.
KEYS_PER_TRIGGER = 10


def _initial_events(spark, sf_dir, k=K, w0=W0):
    return initial_state_from_first(event_points(spark, sf_dir), k, "event_id", weight=w0)


def _stream_history(trainer):
    h = trainer.table.history().select(
        "batch_id", "label", F.posexplode("center").alias("dim", "center"), "weight")
    return _rounded_history(h.withColumn("dim", F.col("dim").cast("int")))


@register("train_stream", ORACLE["train_replay_events"])
def train_stream_q(spark, sf_dir):
    kb = _keyed_events(spark, sf_dir)
    init = initial_state_from_first(points_stream(kb.all_rows()), K, "event_id", weight=W0)
    q, trainer = train_stream(kb.stream(KEYS_PER_TRIGGER), init, UpdateParams(decay=DECAY), batches=_by_key(kb), trigger=NOW)
    _run_to_end(q)
    return _stream_history(trainer)


@register("batch_progress", f"""WITH RECURSIVE {EVT_BATCHED_PTS},
{sql.fold_ctes(K, W0, DECAY)},
d AS (SELECT pts.b, list_min({sql.dists_to('st.cs', 'pts.f')}) AS d FROM pts JOIN st ON st.b = pts.b - 1)
SELECT CAST(d.b AS BIGINT) AS batch_id, count(*) AS rows, round(sum(d), 3) + 0.0 AS cost,
       any_value({sql.r6('list_sum(st.ws)')}) AS weight FROM d JOIN st ON st.b = d.b GROUP BY d.b""")
def batch_progress_q(spark, sf_dir):
    """Rows, cost and total weight of every batch, observed in the job
    that trains it; the models' history is rolled meanwhile."""
    kb = _keyed_events(spark, sf_dir)
    init = initial_state_from_first(points_stream(kb.all_rows()), K, "event_id", weight=W0)
    path = fresh_dir(spark, "progress")
    _run_to_end(train_stream(kb.stream(KEYS_PER_TRIGGER), init, UpdateParams(decay=DECAY), batches=_by_key(kb), trigger=NOW,
                             progress_path=path, roll=8)[0])
    return read_progress(spark, path).select("batch_id", "rows", (F.round("cost", 3) + F.lit(0.0)).alias("cost"),
                                             r6(F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)).alias("weight"))


@register("batch_distinct_count", """
SELECT CAST(dense_rank() OVER (ORDER BY day) - 1 AS BIGINT) AS batch_id, distinct_count FROM (
  SELECT day, count(*) AS distinct_count FROM (
    SELECT DISTINCT CAST(ts AS DATE) AS day, user_id, event_type FROM events) GROUP BY day)""")
def batch_distinct_count_q(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), "user_id", "event_type")
    kb = KeyedBatches(ev, "day")
    out = fresh_dir(spark, "distinct")
    count = batch_distinct_count(out)
    _run_to_end(run_batches(kb.stream(KEYS_PER_TRIGGER), kb.each(lambda d, i: count(d.select("user_id", "event_type"), i)),
                            fresh_dir(spark, "checkpoint"), "fadeclust-distinct", NOW))
    return read_distinct_counts(spark, out)


SCORE_AFTER_SQL = _score_sql("after")


def _run_fan_out(spark, sf_dir):
    """One query, two sinks; returns the folders of the lines and the counts."""
    kb = _keyed_events(spark, sf_dir)
    lines_dir = fresh_dir(spark, "labelled")
    counts_dir = fresh_dir(spark, "labelled-distinct")

    def as_lines(sink):
        return lambda d, i: sink(labelled_json(d, extra=["event_id"]), i)

    outputs = [fan_out(as_lines(write_lines_batch(lines_dir)),
                       batch_distinct_count(counts_dir))]
    init = initial_state_from_first(points_stream(kb.all_rows()), K, "event_id", weight=W0)
    q, _ = train_and_score_stream(kb.stream(KEYS_PER_TRIGGER), init, UpdateParams(decay=DECAY), outputs, score_with="after",
                                  persist_batch=False, batches=_by_key(kb), trigger=NOW)
    _run_to_end(q)
    return lines_dir, counts_dir


@register("fan_out", f"""
SELECT event_id, {sql.r6('f[1]')} AS px, {sql.r6('f[2]')} AS py, cx, cy, prediction AS label
FROM ({SCORE_AFTER_SQL}) s JOIN ({sql.EVENT_POINTS}) p ON p.id = s.event_id""")
def fan_out_q(spark, sf_dir):
    lines_dir, _ = _run_fan_out(spark, sf_dir)
    back = parse_labelled(
        spark.read.text(lines_dir).select("value"), "value")
    back = back.withColumn("event_id", F.get_json_object("value", "$.event_id").cast("long"))
    return back.select("event_id", r6("point.x").alias("px"), r6("point.y").alias("py"),
                       r6("center.x").alias("cx"), r6("center.y").alias("cy"), "label")


@register("fan_out_counts", f"""
SELECT CAST(dense_rank() OVER (ORDER BY day) - 1 AS BIGINT) AS batch_id, n AS distinct_count
FROM (SELECT day, count(*) AS n FROM ({sql.EVENT_POINTS}) GROUP BY day)""")
def fan_out_counts_q(spark, sf_dir):
    """The second sink of the same run (event ids make every row distinct)."""
    _, counts_dir = _run_fan_out(spark, sf_dir)
    return read_distinct_counts(spark, counts_dir)


def _points_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("event_id", "x", "y")).alias("value"))


def _points_of_json(lines: DataFrame) -> DataFrame:
    back = lines.select(F.from_json("value", "event_id BIGINT, x DOUBLE, y DOUBLE").alias("p"))
    return back.select("p.event_id", r6("p.x").alias("x"), r6("p.y").alias("y"))


def _read_points_json(spark, path: str) -> DataFrame:
    return _points_of_json(spark.read.text(path).select("value"))


@register("line_sink", ORACLE["valid_points"])
def line_sink_q(spark, sf_dir):
    out = fresh_dir(spark, "lines")
    q = (_points_json(points_stream(_keyed_events(spark, sf_dir, publish=0, file_rows=0).row_stream())).writeStream
         .foreach(LineWriter(FileLineTransport(out)))
         .option("checkpointLocation", fresh_dir(spark, "checkpoint"))
         .trigger(**NOW).queryName("fadeclust-lines").start())
    _run_to_end(q)
    return _read_points_json(spark, out)


@register("datasource_sink", ORACLE["valid_points"])
def datasource_sink_q(spark, sf_dir):
    """The named sink over several micro-batches (ten files each)."""
    _ds.register(spark)
    out = fresh_dir(spark, "jsonl")
    q = (_points_json(points_stream(_keyed_events(spark, sf_dir, publish=0, file_rows=0).row_stream(10))).writeStream
         .format("jsonl_points").option("path", out)
         .option("checkpointLocation", fresh_dir(spark, "checkpoint"))
         .trigger(**NOW).queryName("fadeclust-jsonl").start())
    _run_to_end(q)
    return _points_of_json(_ds.read_committed(spark, out))


# ---- W1 W2 as streaming state -----------------------------------------------------------


def _in_three(spark, df, path: str):
    """``df`` in a folder that grows between three runs of a query."""
    for part in range(3):
        df.where(F.col("event_id") % 3 == part).write.mode("append").parquet(path)
        yield spark.readStream.schema(df.schema).parquet(path)


@register("latest_n_stream", ORACLE["latest_n"])
def latest_n_stream_q(spark, sf_dir):
    """The newest 90 points, kept as state over three runs of a query."""
    pts = event_points(spark, sf_dir).select("event_id", "ts", "x", "y")
    checkpoint = fresh_dir(spark, "latest")
    for stream in _in_three(spark, pts, fresh_dir(spark, "points")):
        _run_to_end(latest_points_stream(stream, ["ts", "event_id"], 90, checkpoint, NOW)[0])
    out = read_latest_points(spark, checkpoint, "event_id BIGINT, x DOUBLE, y DOUBLE", 90)
    return out.select("event_id", r6("x").alias("x"), r6("y").alias("y"))


@register("latest_center_stream", ORACLE["latest_center"])
def latest_center_stream_q(spark, sf_dir):
    """The newest center of every label, kept as state."""
    pts, init, keys, hist = _events_fold(spark, sf_dir)
    scored = score_with_history(pts, "day", keys, init, hist, "after").select("event_id", "ts", "prediction", "center")
    checkpoint = fresh_dir(spark, "latest")
    for stream in _in_three(spark, scored, fresh_dir(spark, "scored")):
        _run_to_end(latest_centers_stream(stream, ["ts", "event_id"], "prediction", checkpoint, NOW)[0])
    out = read_latest_centers(spark, checkpoint, "center ARRAY<DOUBLE>")
    return out.select(F.col("prediction").alias("label"), r6(F.col("center")[0]).alias("cx"), r6(F.col("center")[1]).alias("cy"))


# ---- T4: scoring by a query of its own ---------------------------------------------------


@register("score_stream", f"""WITH RECURSIVE {EVT_BATCHED_PTS},
{sql.fold_ctes(K, W0, DECAY)},
n AS (SELECT max(b) AS last FROM pts)
SELECT event_id, CAST(version AS BIGINT) AS version, prediction, {sql.r6('cs[prediction + 1][1]')} AS cx,
       {sql.r6('cs[prediction + 1][2]')} AS cy FROM (
  SELECT pts.id AS event_id, st.b AS version, st.cs,
         CAST(list_position({sql.dists_to('st.cs', 'pts.f')}, list_min({sql.dists_to('st.cs', 'pts.f')})) - 1 AS INTEGER) AS prediction
  FROM pts, n, st WHERE st.b = CASE WHEN pts.id % 2 = 0 THEN (last + 1) // 2 - 1 ELSE last END)""")
def score_stream_q(spark, sf_dir):
    """Two queries: one trains day by day, one scores.  The even events are
    scored when half of the days are trained, the odd ones, a second micro-batch
    of the restarted scoring query, when all are."""
    kb = _keyed_events(spark, sf_dir, publish=0)
    init = initial_state_from_first(points_stream(kb.all_rows()), K, "event_id", weight=W0)
    state, training, scoring, pins = (fresh_dir(spark, x) for x in ("state", "checkpoint", "checkpoint", "pins"))
    incoming, scored = fresh_dir(spark, "incoming"), fresh_dir(spark, "scored")
    lines = kb.all_rows().select("event_id", "value")

    def save(d, i):
        d.select("event_id", "version", "prediction", "center").write.mode("overwrite").parquet(f"{scored}/batch_id={i}")

    for half, days in enumerate((len(kb.keys) // 2, None)):
        kb.publish(days)
        _run_to_end(train_stream(kb.stream(KEYS_PER_TRIGGER), init, UpdateParams(decay=DECAY), state, training, batches=_by_key(kb), trigger=NOW)[0])
        lines.where(F.col("event_id") % 2 == half).write.mode("append").parquet(incoming)
        arriving = points_stream(spark.readStream.schema(lines.schema).parquet(incoming))
        _run_to_end(score_stream(arriving, state, [save], pins, scoring, trigger=NOW, version_col="version")[0])
    return spark.read.parquet(scored).select("event_id", "version", "prediction", r6(F.col("center")[0]).alias("cx"), r6(F.col("center")[1]).alias("cy"))


# ---- M1-M16: estimator / model ---------------------------------------------------------


@register("model_transform", f"""WITH RECURSIVE {EMB_BATCHED_PTS},
{sql.fold_ctes(K, W0, DECAY)}
SELECT pts.id AS vec_id,
       CAST(list_position({sql.dists_to('st.cs', 'pts.f')}, list_min({sql.dists_to('st.cs', 'pts.f')})) - 1 AS INTEGER) AS prediction
FROM pts, st WHERE st.b = (SELECT max(b) FROM pts)""")
def model_transform(spark, sf_dir):
    """Estimator path: initial centers, fit over batches, transform."""
    pts = _emb_batches(spark, sf_dir)
    init = initial_state_from_first(pts, K, "vec_id", weight=W0)
    km = StreamingKMeans(k=K, decayFactor=DECAY).setInitialCenters(init.centers, init.weights)
    model = km.fit_batches(pts, "batch")
    return model.transform(pts.drop("label")).select("vec_id", "prediction")


# ---- W3: center display ------------------------------------------------------------------


def _display_sql(c: str, limit: int) -> str:
    return (f"'[' || array_to_string(list_transform({c}[1:{limit}], lambda v: printf('%.6f', v)), ',')"
            f" || CASE WHEN len({c}) > {limit} THEN '...' ELSE ']' END")


@register("center_display", f"""WITH RECURSIVE {EMB_BATCHED_PTS},
{sql.fold_ctes(K, W0, DECAY)}
SELECT CAST(i - 1 AS INTEGER) AS label, {_display_sql('c', 100)} AS display,
       {_display_sql('c', 10)} AS display_10
FROM (SELECT unnest(cs) AS c, generate_subscripts(cs, 1) AS i FROM st
      WHERE b = (SELECT max(b) FROM pts))""")
def center_display_q(spark, sf_dir):
    """Display text of the final embeddings model: the full center (64 < 100
    coordinates) and the form cut after 10 coordinates."""
    pts = _emb_batches(spark, sf_dir)
    init = initial_state_from_first(pts, K, "vec_id", weight=W0)
    _, hist = fit_fold(pts, "batch", init, UpdateParams(decay=DECAY), keep_history=False)
    return hist[-1].to_df(spark).select(
        "label", center_display("center", 100, 6).alias("display"),
        center_display("center", 10, 6).alias("display_10"))


# ---- T1 on empty batches ------------------------------------------------------------------

@register("update_empty_batch", f"""WITH RECURSIVE pts AS (
  SELECT id, b, f FROM (
    SELECT p.*, CAST(dense_rank() OVER (ORDER BY e.event_type) - 1 AS INTEGER) AS b, e.event_type
    FROM events e LEFT JOIN ({sql.EVENT_POINTS}) p ON p.id = e.event_id)
  WHERE event_type NOT IN ('signup', 'error')),
{sql.fold_ctes(K, W0, DECAY)}
{sql.history_long_select()}""")
def update_empty_batch(spark, sf_dir):
    """Batches by event type over *all* lines, training on the valid points
    only: the error and sign-up batches hold nothing but rejected records, so
    their update is decay alone (weights shrink, centers stay)."""
    parsed = parse_points(event_lines(spark, sf_dir), "value")
    pts = stage_by_batch(parsed.select("event_id", "event_type", F.when(
        F.col("x").isNotNull() & F.col("y").isNotNull(), F.array("x", "y")).alias("features")), "event_type")
    init = initial_state_from_first(pts.filter(F.col("features").isNotNull()), K,
                                    "event_id", weight=W0)
    _, hist = fit_fold(pts, "event_type", init, UpdateParams(decay=DECAY))
    return _history_2d(spark, hist)


# ---- keys and rows that are easily lost ----------------------------------------------------

_STRING_KEY_SQL = ("CASE dayofmonth(day) % 3 WHEN 0 THEN '1' WHEN 1 THEN '01' ELSE '2' END")


@register("fold_string_keys", f"""WITH RECURSIVE pts AS (
  SELECT id, CAST(dense_rank() OVER (ORDER BY key) - 1 AS INTEGER) AS b, key, f
  FROM (SELECT *, {_STRING_KEY_SQL} AS key FROM ({sql.EVENT_POINTS}))),
{sql.fold_ctes(K, W0, DECAY)}
SELECT event_id, key, prediction, {sql.r6('cs[prediction + 1][1]')} AS cx FROM (
  SELECT pts.id AS event_id, pts.key, st.cs,
         CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS prediction
  FROM (SELECT pts.*, st.cs, {sql.dists_to('st.cs', 'pts.f')} AS d
        FROM pts JOIN st ON st.b = pts.b) pts JOIN st ON st.b = pts.b)""")
def fold_string_keys(spark, sf_dir):
    """String batch keys that look like numbers ('1' and '01' are two batches)."""
    day = F.dayofmonth("day") % 3
    pts = event_points(spark, sf_dir).withColumn(
        "key", F.when(day == 0, "1").when(day == 1, "01").otherwise("2"))
    pts = stage_by_batch(pts.select("event_id", "key", "features"), "key")
    init = initial_state_from_first(pts, K, "event_id", weight=W0)
    keys, hist = fit_fold(pts, "key", init, UpdateParams(decay=DECAY))
    out = score_with_history(pts, "key", keys, init, hist, "after")
    return out.select("event_id", "key", "prediction", r6(F.col("center")[0]).alias("cx"))


_INVALID_PTS = f"""raw AS (SELECT id, CAST(dense_rank() OVER (ORDER BY day) - 1 AS INTEGER) AS b,
  CASE WHEN id % 11 = 0 THEN 'null' WHEN id % 13 = 0 THEN 'nan' ELSE 'ok' END AS kind, f FROM ({sql.EVENT_POINTS})),
pts AS (SELECT id, b, f FROM raw WHERE kind = 'ok')"""


def _score_invalid_sql() -> str:
    def one(which, shift):
        return f"""SELECT raw.id AS event_id, raw.kind, '{which}' AS which,
    CASE WHEN kind = 'ok' THEN CAST(list_position({sql.dists_to('st.cs', 'raw.f')}, list_min({sql.dists_to('st.cs', 'raw.f')})) - 1 AS INTEGER)
         ELSE 0 END AS prediction, st.cs
    FROM raw JOIN st ON st.b = raw.b{shift}"""
    return f"""WITH RECURSIVE {_INVALID_PTS},
{sql.fold_ctes(K, W0, DECAY)}
SELECT event_id, kind, which, m.method, prediction, {sql.r6('cs[prediction + 1][1]')} AS cx
FROM ({one('after', '')} UNION ALL {one('before', ' - 1')}), (VALUES ('hof'), ('arrow')) m(method)"""


@register("score_invalid_rows", _score_invalid_sql())
def score_invalid_rows(spark, sf_dir):
    """NULL and NaN features keep their rows in both scoring forms and orders:
    label 0 and its center; training leaves them out."""
    kind = F.when(F.col("event_id") % 11 == 0, "null").when(F.col("event_id") % 13 == 0, "nan").otherwise("ok")
    pts = event_points(spark, sf_dir).withColumn("kind", kind)
    features = F.when(F.col("kind") == "ok", F.col("features")).when(
        F.col("kind") == "nan", F.array(F.lit(float("nan")), F.col("y")))
    pts = stage_by_batch(pts.select("event_id", "day", "kind", features.alias("features")), "day")
    init = initial_state_from_first(pts.filter("kind = 'ok'"), K, "event_id", weight=W0)
    keys, hist = fit_fold(pts, "day", init, UpdateParams(decay=DECAY))
    out = None
    for which in ("after", "before"):
        for method in ("hof", "arrow"):
            one = score_with_history(pts, "day", keys, init, hist, which, method=method).select(
                "event_id", "kind", F.lit(which).alias("which"), F.lit(method).alias("method"),
                "prediction", r6(F.col("center")[0]).alias("cx"))
            out = one if out is None else out.unionByName(one)
    return out


@register("model_transform_invalid", f"""
SELECT id AS vec_id, CASE WHEN id % 7 = 0 OR id % 5 = 0 THEN 0 ELSE prediction END AS prediction FROM (
{_assign_sql(sql.EMB_POINTS, _first_centers_sql(sql.EMB_POINTS, K), 'id')})""")
def model_transform_invalid(spark, sf_dir):
    """``transform`` labels every row, also those with NULL or NaN features."""
    pts = embedding_points(spark, sf_dir)
    init = initial_state_from_first(pts, K, "vec_id", weight=W0)
    km = StreamingKMeans(k=K).setInitialCenters(init.centers, init.weights)
    bad = F.when(F.col("vec_id") % 7 == 0, F.lit(None)).when(
        F.col("vec_id") % 5 == 0, F.transform("features", lambda v: F.lit(float("nan")))).otherwise(F.col("features"))
    return km.getModel().transform(pts.select("vec_id", bad.alias("features"))).select("vec_id", "prediction")


# ---- bounded assignment, center tables, high dimension -----------------------------------------

LARGE_K = 300


@register("assign_large_k", f"""
SELECT vec_id, prediction, {sql.r6('distance')} AS distance FROM (
{_assign_sql(sql.EMB_POINTS, _first_centers_sql(sql.EMB_POINTS, LARGE_K), 'id AS vec_id')})""")
def assign_large_k(spark, sf_dir):
    """Hundreds of centers: running minimum with the norm bound."""
    pts = embedding_points(spark, sf_dir)
    init = initial_state_from_first(pts, LARGE_K, "vec_id")
    out = assign_nearest(pts, init, distance_col="distance")
    return out.select("vec_id", "prediction", r6("distance").alias("distance"))


INDEX_K = 500


@register("assign_index", f"""
SELECT vec_id, prediction, {sql.r6('distance')} AS distance FROM (
{_assign_sql(sql.EMB_POINTS, _first_centers_sql(sql.EMB_POINTS, INDEX_K), 'id AS vec_id')})""")
def assign_index(spark, sf_dir):
    """The exact index over 500 centers."""
    pts = embedding_points(spark, sf_dir)
    init = initial_state_from_first(pts, INDEX_K, "vec_id")
    out = assign_nearest(pts, init, distance_col="distance", method="arrow")
    return out.select("vec_id", "prediction", r6("distance").alias("distance"))


SPARSE_USERS = 200
_SPARSE_POINTS = f"""SELECT event_id AS id, list_concat(list_transform(range(0, {SPARSE_USERS}),
  lambda i: CASE WHEN user_id % {SPARSE_USERS} = i THEN 1.0 ELSE 0.0 END)::DOUBLE[], [value / 100.0]::DOUBLE[]) AS f FROM events"""


@register("assign_sparse", f"""
SELECT event_id, prediction, {sql.r6('distance')} AS distance FROM (
{_assign_sql(_SPARSE_POINTS, _first_centers_sql(_SPARSE_POINTS, 6), 'id AS event_id')})""")
def assign_sparse_q(spark, sf_dir):
    """V2 V8: events as sparse vectors (one place per user group, and the value),
    assigned without making them dense."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    ev = table(spark, sf_dir, "events").select(
        "event_id", (F.col("user_id") % SPARSE_USERS).cast("double").alias("user"), (F.col("value") / 100.0).alias("amount"))
    groups = spark.range(SPARSE_USERS).select(F.col("id").cast("double").alias("user"))
    hot = OneHotEncoder(inputCol="user", outputCol="hot", dropLast=False).fit(groups).transform(ev)
    pts = VectorAssembler(inputCols=["hot", "amount"], outputCol="features").transform(hot).select("event_id", "features")
    init = initial_state_from_first(pts.select("event_id", to_array("features").alias("features")), 6, "event_id")
    out = assign_sparse(pts, init, distance_col="distance")
    return out.select("event_id", "prediction", r6("distance").alias("distance"))


@register("attach_center_table", f"""
SELECT p.id AS vec_id, p.label, CAST(j - 1 AS INTEGER) AS dim, {sql.r6('v')} AS center FROM (
  SELECT p.id, p.label, unnest(m.center) AS v, generate_subscripts(m.center, 1) AS j
  FROM ({sql.EMB_POINTS}) p JOIN ({LABEL_MEANS_SQL}) m ON m.label = p.label) p""")
def attach_center_table(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    out = attach_center(pts.select("vec_id", "label"), _label_means(pts), "label", "center")
    return out.select("vec_id", "label", F.posexplode("center").alias("dim", "v")).select(
        "vec_id", "label", F.col("dim").cast("int").alias("dim"), r6("v").alias("center"))


@register("cluster_stats_high_dim", f"""
SELECT CAST(label AS INTEGER) AS label, CAST(j - 1 AS INTEGER) AS dim, {sql.r6('sum(v)')} AS s, count(*) AS n FROM (
  SELECT label, unnest(g) AS v, generate_subscripts(g, 1) AS j FROM (
    SELECT label, list_concat(f, list_concat(list_transform(f, lambda x: 2 * x), list_transform(f, lambda x: x * x))) AS g
    FROM ({sql.EMB_POINTS}))) GROUP BY label, j""")
def cluster_stats_high_dim(spark, sf_dir):
    """192 dimensions: Arrow partial sums."""
    pts = embedding_points(spark, sf_dir).select("label", F.concat(
        "features", F.transform("features", lambda x: 2 * x), F.transform("features", lambda x: x * x)).alias("features"))
    st = cluster_stats(pts, "label", "features", 192)
    return stats_long(st).select("label", "dim", r6("s").alias("s"), "n")


@register("vec_norm_bound", f"""
SELECT vec_id, {sql.r6('pow(sqrt(list_sum(list_transform(f, lambda x: x * x))) - sqrt(list_sum(list_transform(mean, lambda x: x * x))), 2)')} AS bound,
       pow(sqrt(list_sum(list_transform(f, lambda x: x * x))) - sqrt(list_sum(list_transform(mean, lambda x: x * x))), 2) <= {sql.sqdist('f', 'mean')} + 1e-9 AS holds
FROM ({EMB_WITH_MEAN})""")
def vec_norm_bound_q(spark, sf_dir):
    df = _with_label_mean(spark, sf_dir)
    bound = vec_sqdist_lower_bound(vec_norm("features"), vec_norm("mean"))
    return df.select("vec_id", r6(bound).alias("bound"), (bound <= vec_sqdist("features", "mean") + 1e-9).alias("holds"))


@register("sparse_vectors", f"""
SELECT id AS vec_id, CAST(j - 1 AS INTEGER) AS dim, v AS value FROM (
  SELECT id, unnest(g) AS v, generate_subscripts(g, 1) AS j FROM (
    SELECT id, list_transform(range(0, 8), lambda i: CASE WHEN label = i THEN 1.0 ELSE 0.0 END)::DOUBLE[] AS g
    FROM ({sql.EMB_POINTS})))""")
def sparse_vectors(spark, sf_dir):
    """Label indicators as sparse ML vectors and back to arrays."""
    from pyspark.ml.feature import VectorAssembler
    cols = [f"l{i}" for i in range(8)]
    wide = embedding_points(spark, sf_dir).select(
        "vec_id", *[(F.col("label") == i).cast("double").alias(c) for i, c in enumerate(cols)])
    vec = VectorAssembler(inputCols=cols, outputCol="v").transform(wide)
    return vec.select("vec_id", F.posexplode(to_array("v")).alias("dim", "value")).select(
        "vec_id", F.col("dim").cast("int").alias("dim"), "value")


# ---- line sources, row and console sinks, rejects --------------------------------------------


def _lines_folder(spark, sf_dir) -> str:
    """The event lines as a folder of text files."""
    path = fresh_dir(spark, "line-files")
    event_lines(spark, sf_dir).select("value").write.text(path)
    return path


ONE_BATCH_EVENTS = f"""WITH RECURSIVE pts AS (SELECT id, 0 AS b, f FROM ({sql.EVENT_POINTS})),
{sql.fold_ctes(K, W0, DECAY)}"""


@register("lines_stream", f"""{ONE_BATCH_EVENTS}
{sql.history_long_select()}""")
def lines_stream_q(spark, sf_dir):
    """A folder of lines read once with an availableNow trigger
    and awaited; the folder is one batch."""
    lines = read_lines_stream(spark, "text", path=_lines_folder(spark, sf_dir))
    q, trainer = train_stream(points_stream(lines), _initial_events(spark, sf_dir), UpdateParams(decay=DECAY),
                              trigger={"availableNow": True})
    _run_to_end(q)
    h = trainer.table.history().select(
        "batch_id", "label", F.posexplode("center").alias("dim", "center"), "weight")
    return _rounded_history(h.withColumn("dim", F.col("dim").cast("int")))


@register("lines_source", ORACLE["valid_points"])
def lines_source_q(spark, sf_dir):
    """The ``lines`` source, run, stopped and run again on the same
    checkpoint while its files grow in number; every valid line comes out once."""
    folder, out, checkpoint = fresh_dir(spark, "growing"), fresh_dir(spark, "points"), fresh_dir(spark, "checkpoint")
    lines = event_lines(spark, sf_dir).select("event_id", F.to_json(F.struct("event_id", "value")).alias("line"))
    for part in (0, 1):
        lines.where(F.col("event_id") % 2 == part).select("line").write.mode("append").text(folder)
        stream = read_lines_stream(spark, "lines", path=folder, rangeBytes=1 << 20)
        events = stream.select(F.from_json("value", "event_id BIGINT, value STRING").alias("e")).select("e.event_id", "e.value")
        _run_to_end(run_batches(_points_json(points_stream(events)), write_lines_batch(out), checkpoint, trigger=NOW))
    return _read_points_json(spark, out)


@register("interval_lines", f"""WITH RECURSIVE pts AS (SELECT id, 0 AS b, f FROM ({sql.EVENT_POINTS})),
{sql.fold_ctes(K, 0.0, DECAY, split=True)}
{sql.history_long_select()}""")
def interval_lines_q(spark, sf_dir):
    """The interval job's settings (1 s trigger, weight 0, split) on the
    ``lines`` source; what lies in the folder is one interval's batch."""
    lines = read_lines_stream(spark, "lines", path=_lines_folder(spark, sf_dir))
    q, trainer = train_stream(points_stream(lines), _initial_events(spark, sf_dir, w0=0.0), UpdateParams(decay=DECAY, split_dying=True),
                              trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return _stream_history(trainer)


@register("stream_rejects", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'no_point' WHEN 'signup' THEN 'bad_field' END AS reason FROM events""")
def stream_rejects(spark, sf_dir):
    """Every input line comes out once: labelled, or rejected with a reason."""
    source = fresh_dir(spark, "lines")
    lines = event_lines(spark, sf_dir).select("event_id", "value")
    lines.write.parquet(source)
    good, bad = fresh_dir(spark, "labelled"), fresh_dir(spark, "rejects")

    def save(path):
        return lambda d, i: d.select("event_id", *[c for c in (REASON_COL,) if c in d.columns]) \
            .write.mode("overwrite").parquet(f"{path}/batch_id={int(i)}")
    stream = spark.readStream.schema(lines.schema).parquet(source)
    q, _ = train_and_score_stream(checked_points(stream), _initial_events(spark, sf_dir), UpdateParams(decay=DECAY),
                                  [save(good)], rejects=save(bad), trigger={"availableNow": True})
    _run_to_end(q)
    labelled = spark.read.parquet(good).select("event_id", F.lit(None).cast("string").alias("reason"))
    return labelled.union(spark.read.parquet(bad).select("event_id", F.col(REASON_COL).alias("reason")))


@register("batch_functions", ORACLE["valid_points"])
def batch_functions(spark, sf_dir):
    """K1 K4 K8: a batch function that writes the points and shows a sample,
    beside an untruncated console query on the same lines."""
    path = _event_parquet(spark, sf_dir)
    out = fresh_dir(spark, "points")

    def points():
        return _points_json(points_stream(spark.readStream.schema(
            "event_id long, value string").parquet(path)))
    now = {"availableNow": True}
    _run_to_end(run_batches(points(), fan_out(write_lines_batch(out), print_sample(1)), fresh_dir(spark, "checkpoint"), trigger=now))
    _run_to_end(console(points(), trigger=now))
    return _read_points_json(spark, out)


def _event_parquet(spark, sf_dir) -> str:
    path = fresh_dir(spark, "event-files")
    event_lines(spark, sf_dir).select("event_id", "value").write.parquet(path)
    return path


# ---- estimator: setters, fit, training on a stream ---------------------------------------------


def _model_rows(spark, model) -> DataFrame:
    """The model's centers and, for each, the label that ``predict`` gives it."""
    own = spark.createDataFrame([(i, int(model.predict(c))) for i, c in enumerate(model.clusterCenters())], "label int, own int")
    h = model.centers_df(spark).join(own, "label").select(
        "label", "own", "weight", F.posexplode("center").alias("dim", "center"))
    return h.select("label", "own", F.col("dim").cast("int").alias("dim"), r6("center").alias("center"), r6("weight").alias("weight"))


_MODEL_ROWS_SQL = (f"SELECT label, label AS own, dim, center, weight FROM ({_one_batch_sql(DECAY)})")


def _estimator(spark, sf_dir) -> StreamingKMeans:
    init = initial_state_from_first(embedding_points(spark, sf_dir), K, "vec_id", weight=W0)
    return StreamingKMeans().setK(K).setDecayFactor(DECAY).setFeaturesCol("features").setInitialCenters(init.centers, init.weights)


@register("estimator_fit", _MODEL_ROWS_SQL)
def estimator_fit(spark, sf_dir):
    """Setters, one fit over the table, a copied model."""
    model = _estimator(spark, sf_dir).copy().fit(embedding_points(spark, sf_dir))
    return _model_rows(spark, model.copy())


@register("estimator_stream", _MODEL_ROWS_SQL)
def estimator_stream(spark, sf_dir):
    """Training on a stream of the table's rows, then the latest model."""
    path = fresh_dir(spark, "embedding-files")
    pts = embedding_points(spark, sf_dir).select("vec_id", "features")
    pts.write.parquet(path)
    km = _estimator(spark, sf_dir)
    if (km.getK(), km.getDecayFactor(), km.getHandleInvalid()) != (K, DECAY, "keep"):
        raise ValueError("the getters do not give what was set")
    _run_to_end(km.trainOn(spark.readStream.schema(pts.schema).parquet(path), trigger={"availableNow": True}))
    return _model_rows(spark, km.latestModel())

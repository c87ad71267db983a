"""Physical-plan properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fadeclust.functions import parse_valid_points
from fadeclust.operators import (UpdateParams, assign_nearest, attach_center,
                                 cluster_stats, initial_state_from_first)
from fadeclust.plans import fit_fold, score_with_history, stage_by_batch
from fadeclust.sources import embedding_points, event_lines, lineitem_points


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_codegen_assignment_has_no_python(spark):
    pts = lineitem_points(spark, SF_SMALL)
    init = initial_state_from_first(pts, 4, ["l_orderkey", "l_linenumber"])
    p = plan(assign_nearest(pts, init, method="auto").select("prediction"))
    assert "EvalPython" not in p
    assert re.search(r"ReadSchema: struct<l_quantity:double,l_extendedprice:double,"
                     r"l_discount:double,l_tax:double>", p)


def test_arrow_assignment_ships_only_features(spark):
    pts = embedding_points(spark, SF_SMALL)
    init = initial_state_from_first(pts, 3, "vec_id")
    p = plan(assign_nearest(pts, init).select("vec_id", "prediction"))
    assert "ArrowEvalPython" in p
    py_inputs = re.search(r"ArrowEvalPython \[(.*?)\]", p).group(1)
    assert "embedding" in py_inputs and "vec_id" not in py_inputs and "label" not in py_inputs


def test_stats_partial_aggregation_one_shuffle(spark):
    pts = lineitem_points(spark, SF_SMALL)
    init = initial_state_from_first(pts, 4, ["l_orderkey", "l_linenumber"])
    p = plan(cluster_stats(assign_nearest(pts, init), "prediction", "features", 4))
    assert "partial_sum" in p and "partial_count" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_history_scoring_and_center_table_are_broadcast(spark):
    pts = embedding_points(spark, SF_SMALL).withColumn("b", F.col("vec_id") % 3)
    init = initial_state_from_first(pts, 3, "vec_id", weight=0.01)
    keys, hist = fit_fold(pts, "b", init, UpdateParams(decay=0.3))
    p = plan(score_with_history(pts, "b", keys, init, hist).select("vec_id", "prediction"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    p2 = plan(attach_center(assign_nearest(pts, init), init.to_df(spark)))
    assert "BroadcastHashJoin" in p2


def test_fold_batch_reads_only_its_partition(spark):
    pts = embedding_points(spark, SF_SMALL).withColumn("b", F.col("vec_id") % 3)
    staged = stage_by_batch(pts.select("b", "features"), "b")
    from fadeclust.plans.fold import _batch_of
    p = plan(_batch_of(staged, "b", 1).select("features"))
    assert re.search(r"PartitionFilters: \[.*\(__batch#\d+ = k1\)", p)


def test_point_lines_parsed_once(spark):
    p = plan(parse_valid_points(event_lines(spark, SF_SMALL), "value").select("event_id", "x"))
    assert p.count("from_json(") == 1


def test_high_dim_stats_do_not_sort(spark):
    pts = embedding_points(spark, SF_SMALL)
    from fadeclust.operators import cluster_stats
    p = plan(cluster_stats(pts.select(F.col("label"), "features"), "label", "features", 192, "arrow"))
    assert "Sort" not in p and p.count("MapInArrow") == 3


def test_scores_and_centers_come_from_the_staged_points(spark, monkeypatch):
    """One scan of the raw events: what is scored afterwards is the staged table."""
    from fadeclust.plans import queries
    p = plan(queries.QUERIES["train_and_score_after"](spark, SF_SMALL))
    assert "from_json" not in p and "__batch#" in p and p.count("FileScan") == 1

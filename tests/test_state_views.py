"""W1 and W2 as state of a streaming query."""

import pytest
from pyspark.sql import functions as F

from fadeclust.session import fresh_dir
from fadeclust.streaming.views import (SALTS, _state, latest_centers_stream, latest_points_stream, read_latest_centers,
                                       read_latest_points)

NOW = {"availableNow": True}


def run(query):
    query[0].awaitTermination()
    query[0].stop()


def test_newest_rows_and_centers_over_restarts(spark):
    df = spark.range(900).select(
        F.col("id"), F.when(F.col("id") % 50 > 0, F.col("id") * 7 % 300).alias("seq"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("day"),
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).cast("int").alias("prediction"),       # label 0 holds most rows
        F.array(F.col("id") / 7, F.lit(1.0)).alias("center"))
    source, points, centers = (fresh_dir(spark, x) for x in ("source", "points", "centers"))
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for part in range(3):
        df.where(F.col("id") % 3 == part).repartition(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        run(latest_points_stream(stream, ["seq", "day", "id"], 25, points, NOW))
        run(latest_centers_stream(stream, ["seq", "day", "id"], "prediction", centers, NOW))
        sofar = df.where(F.col("id") % 3 <= part)
        got = [r.id for r in read_latest_points(spark, points, "id long", 25).collect()]
        want = [r.id for r in sofar.orderBy(F.desc_nulls_last("seq"), F.desc("day"), F.desc("id")).limit(25).collect()]
        assert sorted(got) == sorted(want)
        got = {r.prediction: list(r.center) for r in read_latest_centers(spark, centers, "center array<double>").collect()}
        want = sofar.groupBy("prediction").agg(F.max_by("center", F.struct(F.coalesce("seq", F.lit(-1)), "day", "id")).alias("c")).collect()
        assert got == {r.prediction: list(r.c) for r in want}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    per_key = [r["count"] for r in _state(spark, points).groupBy("salt").count().collect()]
    assert len(per_key) == SALTS and max(per_key) <= 25       # bounded, and no key holds more than its share
    assert _state(spark, centers).count() <= SALTS * 5


def test_negative_numbers_and_other_types(spark):
    rows = [(i, str(i % 4)) for i in (-(2**63), -5, -1, 0, 3, 2**63 - 1)] + [(None, "z")]
    df = spark.createDataFrame(rows, "n long, s string")
    source = fresh_dir(spark, "source")
    df.write.parquet(source)
    _, checkpoint = query = latest_points_stream(spark.readStream.schema(df.schema).parquet(source), "n", 3, trigger=NOW)
    run(query)
    assert sorted(r.n for r in read_latest_points(spark, checkpoint, df.schema, 3).collect()) == [0, 3, 2**63 - 1]
    _, checkpoint = query = latest_points_stream(spark.readStream.schema(df.schema).parquet(source), ["s", "n"], 1, trigger=NOW)
    run(query)
    assert [tuple(r) for r in read_latest_points(spark, checkpoint, df.schema, 1).collect()] == [(None, "z")]
    with pytest.raises(TypeError):
        latest_points_stream(spark.readStream.schema("x double").parquet(source), "x")

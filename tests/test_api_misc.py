
import numpy as np

from fadeclust.estimator import StreamingKMeans
from fadeclust.operators import ModelState, UpdateParams, train_step
from fadeclust.operators.views import center_display, latest_center, latest_n
from fadeclust.session import fresh_dir
from fadeclust.sources.streams import points_stream, read_lines_stream
from fadeclust.streaming import console


def _lines_dir(spark, lines):
    d = fresh_dir(spark, "lines-src")
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1) \
        .write.text(d)
    return d


LINES = ['{"x":1.0,"y":1.0}', '{"x":2.0,"y":0.0}', 'junk', '{"x":4.5,"y":4.0}',
         '{"x":"3","y":1}', '{"x":3.5,"y":4.5}']


def test_text_stream_train_on_available_now(spark):
    """A text line source, trained with an availableNow
    trigger; awaitTermination returns when the folder is consumed."""
    d = _lines_dir(spark, LINES)
    km = StreamingKMeans(k=2, decayFactor=0.5).setInitialCenters([[0, 0], [4, 4]], [1.0, 1.0])
    q = km.trainOn(points_stream(read_lines_stream(spark, "text", path=d)),
                   trigger={"availableNow": True})
    q.awaitTermination()
    model = km.latestModel()
    good = spark.createDataFrame([([1.0, 1.0],), ([2.0, 0.0],), ([4.5, 4.0],), ([3.5, 4.5],)],
                                 "features array<double>")
    exp = train_step(good, ModelState([[0, 0], [4, 4]], [1.0, 1.0]), UpdateParams(decay=0.5))
    assert np.allclose(np.array(model.clusterCenters()), exp.centers)
    assert np.allclose(model.clusterWeights(), exp.weights)


def test_console_sink_runs(spark):
    """K1: untruncated console output of a line stream."""
    d = _lines_dir(spark, LINES[:2])
    q = console(read_lines_stream(spark, "text", path=d), truncate=False,
                trigger={"availableNow": True})
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 2


def test_console_sends_the_driver_only_the_rows_shown(spark, tmp_path, capsys):
    """Every row is computed; what is printed, and no whole batch, comes back."""
    path = str(tmp_path / "rows")
    spark.range(0, 50_000, 1, 4).selectExpr("id", "repeat(cast(id as string), 20) AS value").write.parquet(path)
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            computed.add(b.num_rows)
            yield b

    rows = spark.readStream.schema("id long, value string").parquet(path).mapInArrow(count, "id long, value string")
    q = console(rows, trigger={"availableNow": True}, numRows=3)
    q.awaitTermination()
    printed = capsys.readouterr().out
    assert "Batch: 0" in printed and "only showing top 3 rows" in printed
    table = [line for line in printed.splitlines() if line.startswith("|")]
    assert len(table) == 4 and all(len(line) > 20 for line in table)      # the header and 3 rows, untruncated
    assert computed.value == 50_000
    assert "Console" not in q.lastProgress["sink"]["description"]


def test_center_display():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([([0.5, 1.0],), ([float(i) for i in range(150)],)],
                               "center array<double>")
    out = [r.t for r in df.select(center_display("center").alias("t")).collect()]
    assert out[0] == "[0.5,1.0]"
    assert out[1].startswith("[0.0,1.0,") and out[1].endswith("99.0...")
    assert out[1].count(",") == 99


def test_latest_views(spark):
    df = spark.createDataFrame(
        [(i, i % 3, [float(i), 0.0]) for i in range(200)], "seq int, label int, center array<double>")
    last = [r.seq for r in latest_n(df, "seq", 90).collect()]
    assert last == list(range(199, 109, -1))
    lc = {r.label: r.center for r in latest_center(df, "label", "seq", "center").collect()}
    assert lc == {0: [198.0, 0.0], 1: [199.0, 0.0], 2: [197.0, 0.0]}


def test_model_transform_on_stream(spark):
    """The model's transform is a plain projection, so it works on a
    streaming frame as well."""
    d = _lines_dir(spark, LINES)
    model = StreamingKMeans(k=2).setInitialCenters([[0, 0], [4, 4]], [1.0, 1.0]).getModel()
    scored = model.transform(points_stream(read_lines_stream(spark, "text", path=d)))
    q = (scored.select("x", "y", "prediction").writeStream.format("memory")
         .queryName("scored_points").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.x, r.y, r.prediction) for r in spark.table("scored_points").collect())
    assert got == [(1.0, 1.0, 0), (2.0, 0.0, 0), (3.5, 4.5, 1), (4.5, 4.0, 1)]


def test_jobs_run_end_to_end(spark):
    """Both jobs on a text folder: every line comes out, labelled or rejected
    with a reason, each update is logged, and the model reaches the state
    table; the row writer gives the same lines."""
    import json
    import logging

    seen = []
    handler = logging.Handler()
    handler.emit = lambda r: seen.append(r.getMessage())
    logging.getLogger("fadeclust.jobs").addHandler(handler)
    logging.getLogger("fadeclust.jobs").setLevel(logging.INFO)

    from fadeclust.jobs import interval_job, structured_job
    d = _lines_dir(spark, LINES)
    lines = LINES + ['{"x":"NaN","y":2}', '{"x":1}']
    d = _lines_dir(spark, lines)
    for job, writer, show in ((structured_job, "lines", "full"), (interval_job, "rows", True)):
        out = fresh_dir(spark, "job-out")
        seen.clear()
        q, trainer = job(spark, read_lines_stream(spark, "text", path=d), out, seed=3,
                         trigger={"availableNow": True}, writer=writer, console=show)
        q.awaitTermination()
        recs = [json.loads(r.value) for r in spark.read.text(out).collect()]
        bad = {r["value"]: r["reason"] for r in (json.loads(r.value) for r in spark.read.text(f"{out}-rejects").collect())}
        assert bad == {"junk": "no_point", '{"x":"3","y":1}': "bad_field", '{"x":"NaN","y":2}': "not_finite", '{"x":1}': "bad_field"}
        assert len(seen) == 1 and seen[0].startswith("batch 0: 0: w=")
        assert sorted((r["point"]["x"], r["point"]["y"]) for r in recs) == \
            [(1.0, 1.0), (2.0, 0.0), (3.5, 4.5), (4.5, 4.0)]
        assert all(r["label"] in (0, 1, 2) and set(r["center"]) == {"x", "y"} for r in recs)
        assert trainer.table.batch_ids() == [0]


def test_jobs_cli_once(spark):
    """The command line with --once: consume the folder, stop, and a second
    run on the same checkpoint and state resumes without reprocessing."""
    from fadeclust.jobs import main
    d = _lines_dir(spark, LINES)
    out, st, ck = (fresh_dir(spark, "cli-out"), fresh_dir(spark, "cli-state"),
                   fresh_dir(spark, "cli-ck"))
    args = ["--source", "text", "--path", d, "--out", out, "--state", st,
            "--checkpoint", ck, "--once", "--seed", "5"]
    trainer = main(args)
    assert trainer.table.batch_ids() == [0]
    assert spark.read.text(out).count() == 4
    trainer = main(args)                      # nothing new: no new batch
    assert trainer.table.batch_ids() == [0]

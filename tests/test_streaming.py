import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fadeclust.operators import UpdateParams, initial_state_from_first
from fadeclust.plans import fit_fold
from fadeclust.session import fresh_dir
from fadeclust.sources.streams import KeyedBatches, points_stream
from fadeclust.sources.tables import event_lines, event_points
from fadeclust.streaming import (FileLineTransport, LineWriter, StateTable,
                                 batch_distinct_count, fan_out, register,
                                 train_and_score_stream, train_stream,
                                 write_lines_batch)
from fadeclust.streaming.train import StreamTrainer

P = UpdateParams(decay=0.3)
NOW = {"availableNow": True}


def by_key(kb):
    return lambda func: kb.each(func, points_stream)


def finish(q):
    q.awaitTermination()
    q.stop()


@pytest.fixture(scope="module")
def lines(spark):
    # four days of events keep the streaming tests quick
    return event_lines(spark, SF_SMALL).filter(F.col("day") < "2024-01-05")


@pytest.fixture(scope="module")
def init(spark):
    return initial_state_from_first(event_points(spark, SF_SMALL), 3, "event_id", weight=0.01)


@pytest.fixture(scope="module")
def replayed(spark, lines):
    pts = points_stream(lines)
    keys, hist = fit_fold(pts, "day", initial_state_from_first(pts, 3, "event_id", weight=0.01), P)
    return keys, hist


@pytest.mark.parametrize("per_trigger", [1, 3])
def test_keyed_batches_come_in_order(spark, lines, per_trigger):
    kb = KeyedBatches(lines, "day")
    assert [str(k) for k in kb.keys] == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    seen, triggers = [], []

    def note(d, i):
        seen.append((i, sorted({str(r.day) for r in d.select("day").collect()})))

    def run(listed, batch_id):
        triggers.append(batch_id)
        kb.each(note)(listed, batch_id)
    finish(kb.stream(per_trigger).writeStream.foreachBatch(run).trigger(**NOW)
           .option("checkpointLocation", fresh_dir(spark, "ck")).start())
    assert seen == [(i, [str(k)]) for i, k in enumerate(kb.keys)]
    assert triggers == list(range(-(-4 // per_trigger)))
    assert kb.all_rows().count() == lines.count()


def test_published_files_have_rising_times(spark):
    from fadeclust.session import list_dir
    kb = KeyedBatches(spark.range(120).withColumn("k", (F.col("id") % 40).cast("int")), "k")
    times = [i.mtime_ns // 1_000_000 for i in sorted(list_dir(kb.listed), key=lambda i: i.base_name) if i.is_file]
    assert len(times) == 40 and all(a < b for a, b in zip(times, times[1:]))
    with pytest.raises(ValueError, match="must not be NULL"):
        KeyedBatches(spark.createDataFrame([(1, None)], "a int, k string"), "k")


def test_stream_equals_replay(spark, lines, replayed):
    _, hist = replayed
    kb = KeyedBatches(lines, "day")
    pts = points_stream(lines)
    init = initial_state_from_first(pts, 3, "event_id", weight=0.01)
    q, trainer = train_stream(kb.stream(3), init, P, batches=by_key(kb), trigger=NOW)
    finish(q)
    assert trainer.table.batch_ids() == list(range(len(hist)))
    for h in hist:
        s = trainer.table.read(h.batch_id)
        assert np.array_equal(s.centers, h.centers) and np.array_equal(s.weights, h.weights)


def test_restart_and_failure_replay(spark, lines, replayed):
    """Stop after 2 batches and restart on the same checkpoint; also fail
    once after the state write of a batch: the result equals the clean run."""
    _, hist = replayed
    pts = points_stream(lines)
    init = initial_state_from_first(pts, 3, "event_id", weight=0.01)
    kb = KeyedBatches(lines, "day", publish=2)
    ck, sp = fresh_dir(spark, "ck"), fresh_dir(spark, "state")
    finish(train_stream(kb.stream(2), init, P, state_path=sp, checkpoint=ck, batches=by_key(kb), trigger=NOW)[0])
    assert StateTable(spark, sp).batch_ids() == [0, 1]
    calls = []

    def boom(df, batch_id):
        calls.append(batch_id)
        if batch_id == 3 and calls.count(3) == 1:
            raise RuntimeError("injected failure after the state write")

    def start():
        tr = StreamTrainer(spark, init, P, sp, outputs=[boom])
        return (kb.stream(2).writeStream.foreachBatch(kb.each(tr, points_stream)).trigger(**NOW)
                .option("checkpointLocation", ck).start())

    kb.publish()
    q = start()                       # one micro-batch of keys 2 and 3 fails in 3
    with pytest.raises(Exception):
        q.awaitTermination()
    q.stop()
    finish(start())                   # the micro-batch again: key 2 is whole, key 3 runs again
    assert calls == [2, 3, 3]
    table = StateTable(spark, sp)
    for h in hist:
        s = table.read(h.batch_id)
        assert np.array_equal(s.centers, h.centers) and np.array_equal(s.weights, h.weights)


@pytest.mark.parametrize("order", ["after", "before"])
def test_train_and_score_outputs(spark, lines, replayed, order):
    keys, hist = replayed
    pts = points_stream(lines)
    init = initial_state_from_first(pts, 3, "event_id", weight=0.01)
    kb = KeyedBatches(lines, "day")
    out_dir, cnt_dir, files = (fresh_dir(spark, "out"), fresh_dir(spark, "cnt"),
                               fresh_dir(spark, "files"))
    sink = fan_out(lambda d, i: write_lines_batch(out_dir)(
        d.select(F.to_json(F.struct("event_id", "prediction")).alias("value")), i),
        batch_distinct_count(cnt_dir))
    finish(train_and_score_stream(kb.stream(3), init, P, [sink], score_with=order, batches=by_key(kb), trigger=NOW)[0])
    got = spark.read.text(out_dir).select(
        F.from_json("value", "event_id bigint, prediction int").alias("r")).select("r.*")
    from fadeclust.plans import score_with_history
    exp = score_with_history(pts, "day", keys, init, hist, order)
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, exp.select("event_id", "prediction").collect()))
    from fadeclust.streaming.sinks import read_distinct_counts
    counts = read_distinct_counts(spark, cnt_dir).orderBy("batch_id").collect()
    assert [r.batch_id for r in counts] == list(range(len(keys)))
    assert sum(r.distinct_count for r in counts) == pts.count()   # event ids are unique


def test_line_writer_and_datasource_sink(spark, lines):
    register(spark)
    pts = points_stream(lines)
    expected = sorted(r.event_id for r in pts.select("event_id").collect())
    for kind in ("foreach", "datasource"):
        kb = KeyedBatches(lines, "day")
        out = fresh_dir(spark, kind)
        js = points_stream(kb.row_stream(2)).select(F.to_json(F.struct("event_id")).alias("value"))
        w = js.writeStream.trigger(**NOW).option("checkpointLocation", fresh_dir(spark, "ck"))
        if kind == "foreach":
            q = w.foreach(LineWriter(FileLineTransport(out))).start()
        else:
            q = w.format("jsonl_points").option("path", out).start()
        finish(q)
        if kind == "foreach":
            back = spark.read.text(out).select("value").collect()
        else:
            from fadeclust.streaming.datasource import read_committed
            back = read_committed(spark, out).collect()
        assert sorted(json.loads(r.value)["event_id"] for r in back) == expected, kind


def test_row_writer_rerun_leaves_no_stale_rows(spark, monkeypatch):
    """An epoch that runs again with fewer partitions replaces what was there."""
    from fadeclust.streaming.sinks import write_rows
    out = fresh_dir(spark, "rows")
    df = spark.createDataFrame([(f"line {i}",) for i in range(4)], "value string")
    sc = spark.sparkContext
    for run, parts in (("run-1", 4), ("run-2", 1), ("run-2", 1)):
        sc.setJobGroup(run, run)
        write_rows(FileLineTransport(out))(df.repartition(parts), 7)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r.value for r in spark.read.text(out).select("value").collect()) == [f"line {i}" for i in range(4)]


def test_uncommitted_sink_files_are_not_read(spark):
    from fadeclust.session import arrow_fs, write_small_text
    from fadeclust.streaming.datasource import JsonLinesStreamWriter, _Written, read_committed
    out = fresh_dir(spark, "sink")
    fs, base = arrow_fs(out)
    fs.create_dir(f"{base}/data", recursive=True)
    for name in ("a", "b", "stray"):
        with fs.open_output_stream(f"{base}/data/{name}") as f:
            f.write(f"{name}\n".encode())
    writer = JsonLinesStreamWriter(out, None)
    writer.commit([_Written(["a", "stray"])], 0)
    writer.commit([_Written(["a"]), None, _Written(["b"])], 0)          # batch 0 again
    assert sorted(r.value for r in read_committed(spark, out).collect()) == ["a", "b"]
    assert read_committed(spark, fresh_dir(spark, "none")).count() == 0
    write_small_text(out, "x/y.json", "1")


def test_state_table_readers_see_whole_models(spark):
    """Listing and reading while models are written; what a crash leaves
    behind does not count."""
    import threading
    from fadeclust.operators import ModelState
    from fadeclust.session import arrow_fs
    path = fresh_dir(spark, "state")
    table = StateTable(spark, path)
    problems, seen = [], []
    stop = threading.Event()

    def poll():
        while not stop.is_set():
            try:
                ids = table.batch_ids()
                seen.append(len(ids))
                if ids:
                    assert table.read(ids[-1]).k == 2
            except Exception as e:  # noqa: BLE001 - reported below
                problems.append(e)
    reader = threading.Thread(target=poll)
    reader.start()
    for n in range(60):
        table.write(ModelState([[n, 0.0], [1.0, n]], [1.0, 2.0], n))
        table.write(ModelState([[n, 0.0], [1.0, n]], [1.0, 2.0], n))     # a re-run batch
    stop.set()
    reader.join()
    assert not problems and table.batch_ids() == list(range(60)) and len(seen) > 1
    fs, base = arrow_fs(path)
    for left in ("batch_id=60", "batch_id=7.tmp-abc", "_tmp", "batch_id=x"):
        fs.create_dir(f"{base}/{left}", recursive=True)
    with fs.open_output_stream(f"{base}/_tmp/half") as f:
        f.write(b"{")
    assert table.batch_ids()[-1] == 59 and table.history().select("batch_id").distinct().count() == 60
    kept = StateTable(spark, path, retain=3)
    kept.write(ModelState([[0.0, 0.0], [1.0, 1.0]], [1.0, 2.0], 60))
    assert kept.batch_ids() == [58, 59, 60]


def test_missing_model_of_the_batch_before_is_refused(spark, init):
    from fadeclust.session import remove_dir
    path = fresh_dir(spark, "state")
    table = StateTable(spark, path)
    for n in range(3):
        table.write(type(init)(init.centers, init.weights, n))
    remove_dir(f"{path}/batch_id=2")
    trainer = StreamTrainer(spark, init, P, path)
    with pytest.raises(ValueError, match="no model of batch 2"):
        trainer.state_before(3)
    assert trainer.state_before(2).batch_id == 1


def test_replay_integer_keys_in_numeric_order(spark):
    from fadeclust.sources.tables import embedding_points
    emb = embedding_points(spark, "/root/testdata/sf0.001").withColumn(
        "batch", (F.col("vec_id") / 40).cast("int"))
    kb = KeyedBatches(emb.select("vec_id", "batch"), "batch")
    assert kb.keys == list(range(len(kb.keys))) and len(kb.keys) > 10
    seen = []
    finish(kb.stream(4).writeStream.trigger(**NOW)
           .foreachBatch(kb.each(lambda d, i: seen.append(sorted({r.batch for r in d.select("batch").collect()}))))
           .option("checkpointLocation", fresh_dir(spark, "ck")).start())
    assert seen == [[k] for k in kb.keys]


def test_high_dim_stream_equals_fold(spark):
    """64-D embeddings (Arrow assignment inside foreachBatch): the streaming
    trainer and the batch fold give the same models."""
    from fadeclust.sources.tables import embedding_points
    emb = embedding_points(spark, "/root/testdata/sf0.001").withColumn(
        "batch", (F.col("vec_id") / 100).cast("int"))
    init = initial_state_from_first(emb, 4, "vec_id", weight=0.01)
    _, hist = fit_fold(emb, "batch", init, P)
    kb = KeyedBatches(emb, "batch")
    q, trainer = train_stream(kb.stream(), init, P, batches=kb.each, trigger=NOW)
    finish(q)
    assert trainer.table.batch_ids() == list(range(len(hist)))
    for h in hist:
        s = trainer.table.read(h.batch_id)
        assert np.array_equal(s.centers, h.centers) and np.array_equal(s.weights, h.weights)


def test_state_table_ahead_of_checkpoint_is_refused(spark, lines, init):
    kb = KeyedBatches(lines, "day", publish=2)
    sp = fresh_dir(spark, "state")
    finish(train_stream(kb.stream(), init, P, state_path=sp, batches=by_key(kb), trigger=NOW)[0])
    q, _ = train_stream(kb.stream(), init, P, state_path=sp, batches=by_key(kb), trigger=NOW)   # a new checkpoint
    with pytest.raises(Exception, match="state table"):
        q.awaitTermination()
    q.stop()


def test_display_window_matches_batch_views(spark, lines, replayed):
    """W1/W2 on the stream: the rolling window after the last batch equals the
    batch views over everything scored so far."""
    from fadeclust.operators.views import latest_center, latest_n
    from fadeclust.plans import score_with_history
    from fadeclust.streaming.sinks import display_window, read_display
    keys, hist = replayed
    pts = points_stream(lines)
    init = initial_state_from_first(pts, 3, "event_id", weight=0.01)
    kb = KeyedBatches(lines, "day")
    out = fresh_dir(spark, "display")
    sink = display_window(out, ["ts", "event_id"], n=20)
    finish(train_and_score_stream(kb.stream(3), init, P, [lambda d, i: sink(d.select("event_id", "ts", "prediction", "center"), i)],
                                  batches=by_key(kb), trigger=NOW)[0])
    got_p, got_c = read_display(spark, out)
    scored = score_with_history(pts, "day", keys, init, hist, "after")
    exp_p = latest_n(scored, ["ts", "event_id"], 20)
    exp_c = latest_center(scored, "prediction", ["ts", "event_id"], "center")
    assert sorted(r.event_id for r in got_p.collect()) == sorted(r.event_id for r in exp_p.collect())
    assert {r.prediction: r.center for r in got_c.collect()} == \
        {r.prediction: r.center for r in exp_c.collect()}


def test_a_large_key_is_read_by_several_tasks(spark):
    """Rows of one key lie in files of bounded length, small keys in one file."""
    df = spark.range(0, 130_000, 1, 2).selectExpr("id", "CAST(IF(id < 125000, 1, 0) AS INT) AS k")
    seen = {}

    def look(rows, n):
        seen[n] = (rows.rdd.getNumPartitions(), len(rows.inputFiles()), rows.agg(F.count("id"), F.sum("id")).first())

    kb = KeyedBatches(df, "k")
    finish(kb.stream(2).writeStream.foreachBatch(kb.each(look)).trigger(**NOW)
           .option("checkpointLocation", fresh_dir(spark, "ck")).start())
    assert seen[0] == (1, 1, (5_000, sum(range(125_000, 130_000))))
    assert seen[1][0] > 1 and seen[1][1] >= 3 and seen[1][2] == (125_000, sum(range(125_000)))
    whole = KeyedBatches(df, "k", file_rows=0)
    assert len(whole.all_rows().inputFiles()) == 2 and whole.all_rows().count() == 130_000
    from fadeclust.plans.fold import _batch_of, stage_by_batch
    staged = _batch_of(stage_by_batch(df, "k"), "k", 1)
    assert staged.count() == 125_000 and staged.rdd.getNumPartitions() > 1

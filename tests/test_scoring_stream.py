"""The scoring query beside a training query, and the restartable line source."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fadeclust.operators import ModelState
from fadeclust.operators.assign import predict_point
from fadeclust.session import arrow_fs, fresh_dir
from fadeclust.sources.lines import LineFilesReader, LineRange, complete_bytes, read_lines
from fadeclust.sources.streams import read_lines_stream
from fadeclust.streaming import StateTable, StreamScorer, run_batches, score_stream, write_lines_batch

NOW = {"availableNow": True}


def model(n):
    return ModelState([[0.0, float(n)], [10.0, -float(n)]], [1.0, 2.0], n)


def points(spark, lo, hi):
    return spark.range(lo, hi).select("id", F.array((F.col("id") % 11).cast("double"), (F.col("id") % 7).cast("double")).alias("features"))


def local(path):
    return arrow_fs(path)[1]


def test_batches_keep_the_version_they_were_pinned_to(spark):
    state, out, ck, pins, source = (fresh_dir(spark, x) for x in ("state", "scored", "ck", "pins", "source"))
    table = StateTable(spark, state, retain=1)
    schema = points(spark, 0, 1).schema
    failing = {1: True}

    def save(d, i):
        d.select("id", "version", "prediction").write.mode("overwrite").parquet(f"{out}/batch_id={i}")
        if failing.pop(i, False):
            raise RuntimeError("after the rows were written, before the commit")

    def run():
        q, scorer = score_stream(spark.readStream.schema(schema).parquet(source), state, [save], pins, ck,
                                 initial=model(-1), trigger=NOW, version_col="version")
        try:
            q.awaitTermination()
        finally:
            q.stop()
        return scorer

    points(spark, 0, 50).write.mode("append").parquet(source)
    run()                                       # before any model is committed: the initial one
    table.write(model(0))
    table.write(model(1))
    points(spark, 50, 90).write.mode("append").parquet(source)
    with pytest.raises(Exception):
        run()                                   # pinned to version 1, scored, not committed
    for n in (2, 3):
        table.write(model(n))                   # training goes on; retain=1 removes version 1
    run()                                       # batch 1 again
    points(spark, 90, 120).write.mode("append").parquet(source)
    scorer = run()
    got = {r.id: (r.version, r.prediction) for r in spark.read.parquet(out).collect()}
    want = {}
    for i in range(120):
        v = -1 if i < 50 else 1 if i < 90 else 3
        want[i] = (v, predict_point(model(v), [i % 11, i % 7]))
    assert got == want
    assert [tuple(r) for r in scorer.versions().orderBy("batch_id").collect()] == [(0, -1), (1, 1), (2, 3)]
    assert "model" not in json.load(open(f"{local(pins)}/batch_id=1.json"))     # committed: the log keeps versions alone


def test_scorer_without_models_or_with_a_foreign_pin(spark):
    scorer = StreamScorer(spark, fresh_dir(spark, "state"), fresh_dir(spark, "pins"), [])
    with pytest.raises(ValueError, match="no model yet"):
        scorer.pinned(0)
    scorer.table.write(model(0))
    assert scorer.pinned(0).batch_id == 0 and scorer.pinned(1).batch_id == 0
    with pytest.raises(ValueError, match="committed before"):
        scorer.pinned(0)


def run_lines(spark, folder, out, ck, **options):
    q = run_batches(read_lines_stream(spark, "lines", path=folder, **options), write_lines_batch(out), ck, trigger=NOW)
    q.awaitTermination()
    q.stop()
    return sorted(r.value for r in spark.read.text(out).collect())


def append(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab") as f:
        f.write(data)


def test_restart_neither_loses_nor_repeats_lines(spark):
    folder, out, ck = fresh_dir(spark, "lines"), fresh_dir(spark, "out"), fresh_dir(spark, "ck")
    base = local(folder)
    append(f"{base}/a.txt", b"a0\na1\r\nhalf")
    append(f"{base}/_hidden", b"no\n")
    append(f"{base}/sub/b.txt", b"no\n")
    assert run_lines(spark, folder, out, ck) == ["a0", "a1"]
    append(f"{base}/a.txt", b" line\n")                                 # the last line is finished now
    append(f"{base}/b.txt", "é\n\n".encode() + b"x" * 300_000 + b"\n" + b"y" * 10)
    assert run_lines(spark, folder, out, ck, rangeBytes=1000) == sorted(["a0", "a1", "half line", "é", "", "x" * 300_000])
    assert run_lines(spark, folder, out, ck) == sorted(["a0", "a1", "half line", "é", "", "x" * 300_000])   # nothing new
    append(f"{base}/b.txt", b"\n")
    assert len(run_lines(spark, folder, out, ck)) == 7


def test_a_failed_batch_reads_the_same_bytes_again(spark):
    folder, ck = fresh_dir(spark, "lines"), fresh_dir(spark, "ck")
    base, seen = local(folder), []
    append(f"{base}/a.txt", b"1\n2\n")

    def keep(d, i):
        seen.append((i, sorted(r.value for r in d.collect())))
        if len(seen) == 1:
            append(f"{base}/a.txt", b"3\n")                             # grows while the batch fails
            raise RuntimeError("boom")
    for fails in (True, False, False):      # an availableNow run of this source is one micro-batch
        q = run_batches(read_lines_stream(spark, "lines", path=folder), keep, ck, trigger=NOW)
        if fails:
            with pytest.raises(Exception):
                q.awaitTermination()
        else:
            q.awaitTermination()
        q.stop()
    assert seen[:2] == [(0, ["1", "2"]), (0, ["1", "2"])]
    assert [x for _, lines in seen[1:] for x in lines] == ["1", "2", "3"]


def test_ranges_cover_every_line_once(tmp_path):
    import random
    rnd = random.Random(3)
    for _ in range(200):
        lines = [bytes(rnd.choice(b"ab") for _ in range(rnd.choice([0, 1, 2, 5, 30]))) for _ in range(rnd.randint(0, 12))]
        data = b"".join(x + b"\n" for x in lines) + rnd.choice([b"", b"rest"])
        f = tmp_path / "f"
        f.write_bytes(data)
        with open(f, "rb") as stream:
            last = complete_bytes(stream, len(data), 0)
            assert last == data.rfind(b"\n") + 1
            step = rnd.randint(1, 9)
            got = [x for at in range(0, last, step) for block in read_lines(stream, LineRange("f", at, min(at + step, last), 0, last)) for x in block]
        assert got == lines


def test_files_that_shrink_are_refused(tmp_path):
    f = tmp_path / "a"
    f.write_bytes(b"one\ntwo\n")
    reader = LineFilesReader(str(tmp_path), 100)
    end = reader.latestOffset()
    assert end == {"files": {"a": 8}} and reader.latestOffset() == end
    f.write_bytes(b"one\n")
    with pytest.raises(ValueError, match="was read up to"):
        reader.latestOffset()
    with pytest.raises(ValueError, match="was read up to"):
        LineFilesReader(str(tmp_path), 100).partitions(end, LineFilesReader(str(tmp_path), 100).latestOffset())
    assert LineFilesReader(str(tmp_path / "none"), 100).latestOffset() == {"files": {}}


def test_history_listed_before_the_first_roll(spark, monkeypatch):
    """The first roll ends after the reader's listing and before Spark's."""
    path = fresh_dir(spark, "state")
    table, reader = StateTable(spark, path, roll=5), StateTable(spark, path)
    for n in range(10):
        table.write(model(n))
    before = reader._listed()
    table.write(model(10))
    assert not before[1] and reader._listed()[1]
    monkeypatch.setattr(reader, "_listed", lambda: before)
    rows = {(r.batch_id, r.label): (list(r.center), r.weight) for r in reader.history().collect()}
    assert rows == {(n, i): (c, w) for n in range(10) for i, c, w in model(n).to_rows()}


def test_rolled_history_under_a_reader(spark, monkeypatch):
    """Old models move into few Parquet files; a reader beside sees every batch."""
    import threading
    from fadeclust.session import list_dir
    from fadeclust.streaming import state as state_module
    path = fresh_dir(spark, "state")
    table, reader = StateTable(spark, path, roll=20), StateTable(spark, path)
    problems, seen, stop = [], [], threading.Event()

    def poll():
        while not stop.is_set():
            try:
                ids = reader.batch_ids()
                if ids:
                    assert ids == list(range(len(ids))) and reader.read(ids[-1]).batch_id == ids[-1]
                    got = [r.batch_id for r in reader.history().select("batch_id").distinct().collect()]
                    assert set(ids) <= set(got)
                    seen.append(len(got))
            except Exception as e:  # noqa: BLE001 - reported below
                problems.append(e)
    thread = threading.Thread(target=poll)
    thread.start()
    for n in range(205):
        table.write(model(n))
    stop.set()
    thread.join()
    assert not problems and seen
    assert reader.batch_ids() == list(range(205))
    rows = {(r.batch_id, r.label): (list(r.center), r.weight) for r in reader.history().collect()}
    assert rows == {(n, i): (c, w) for n in range(205) for i, c, w in model(n).to_rows()}
    assert reader.read(3).centers.tolist() == model(3).centers.tolist()         # rolled: read from Parquet
    monkeypatch.setattr(state_module, "ROLL_GRACE", 0)      # the reader is done: rolled files may go
    for n in range(205, 241):
        table.write(model(n))
    assert {r.batch_id for r in reader.history().collect()} == set(reader.batch_ids()) == set(range(241))
    files = [i.path for i in list_dir(path, recursive=True) if i.is_file]
    assert sum("batch_id=" in f for f in files) <= 65 and sum(f.endswith("_SUCCESS") for f in files) >= 7
    with pytest.raises(ValueError):
        StateTable(spark, path, retain=3, roll=20)


def test_history_bears_retired_models(spark):
    path = fresh_dir(spark, "state")
    table = StateTable(spark, path, retain=5)
    for n in range(8):
        table.write(model(n))
    history = StateTable(spark, path).history()
    for n in range(8, 12):
        table.write(model(n))                   # removes models that the frame above has listed
    assert {r.batch_id for r in history.collect()} <= {3, 4, 5, 6, 7}
    assert {r.batch_id for r in StateTable(spark, path).history().collect()} == {7, 8, 9, 10, 11}


def test_progress_rides_on_the_training_job(spark):
    import numpy as np
    from fadeclust.operators import UpdateParams
    from fadeclust.sources.streams import KeyedBatches
    from fadeclust.streaming import train_stream
    from fadeclust.streaming.train import read_progress
    df = points(spark, 0, 90).withColumn("k", (F.col("id") / 30).cast("int"))
    kb, path, sp = KeyedBatches(df, "k"), fresh_dir(spark, "progress"), fresh_dir(spark, "state")
    init = ModelState([[0.0, 0.0], [9.0, 5.0]], [1.0, 1.0], -1)
    q, trainer = train_stream(kb.stream(2), init, UpdateParams(decay=0.3), sp, batches=kb.each, trigger=NOW, progress_path=path)
    q.awaitTermination()
    got = {r.batch_id: (r.rows, r.cost, list(r.weights)) for r in read_progress(spark, path).collect()}
    before = init
    for n in range(3):
        x = np.array([[i % 11, i % 7] for i in range(30 * n, 30 * n + 30)], dtype=float)
        cost = ((x[:, None] - before.centers[None]) ** 2).sum(2).min(1).sum()
        before = trainer.table.read(n)
        assert got[n][0] == 30 and got[n][1] == pytest.approx(cost) and got[n][2] == before.weights.tolist()


def test_vector_sums_merge_in_two_levels(spark):
    import numpy as np
    from fadeclust.operators.stats import MERGE_FAN, cluster_stats
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 3)) if i % 3 else 0, [float(v) for v in rng.integers(-9, 9, 200)]) for i in range(600)]
    df = spark.createDataFrame(rows, "prediction int, features array<double>").repartition(150)
    stats = cluster_stats(df, form="arrow")
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 3 and "__salt" in plan
    got = {r.label: (r.n, list(r.s)) for r in stats.collect()}
    for lab in range(3):
        x = np.array([f for v, f in rows if v == lab])
        assert got[lab][0] == len(x) and got[lab][1] == x.sum(axis=0).tolist()
    # no merge task of the first level reads more than its share of the partial rows of a label
    partial = df.select(F.spark_partition_id().alias("p"), "prediction").distinct()
    share = partial.groupBy("prediction", F.col("p") % MERGE_FAN).count().agg(F.max("count")).first()[0]
    assert share <= -(-150 // MERGE_FAN)

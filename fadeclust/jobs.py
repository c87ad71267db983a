"""The two end-to-end jobs as one-call functions and a command line.

``structured_job``  JSON point lines from any line source -> parse and
                    validate -> train and label in one query (k=3, decay 0.3,
                    random centers with weight 0.01) -> labelled JSON lines
                    written per batch, optionally echoed to the console.
``interval_job``    the interval (DStream-style) variant: a fixed trigger
                    interval (1 s), initial weight 0 with the dying-cluster
                    split, labels from the model after each batch's update, and
                    a sample of each batch printed.

Both keep the model in a state table, so a restart resumes where the last
committed batch left off.  Lines that are no valid point go, with the reason, to
a reject output (``<out>-rejects`` unless ``rejects_dir`` says otherwise), and
each update is logged with its weights and centers.  ``writer="rows"`` sends the
labelled lines row by row through the line writer instead of Spark's text
writer.

    python -m fadeclust.jobs --source text --path /data/points --out /data/labelled
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.points import REASON_COL
from .operators.model import random_state
from .operators.update import UpdateParams
from .session import fresh_dir
from .sources.streams import checked_points, read_lines_stream
from .streaming.sinks import (FileLineTransport, fan_out, print_sample,
                              write_lines_batch, write_rows)
from .streaming.train import labelled_json, train_and_score_stream

# Fixed model settings of the two jobs: k = 3 clusters of 2-D points, decay
# 0.3; initial weight 0.01 (structured) or 0 (interval, with the split).
K, DIM, DECAY = 3, 2, 0.3
W0_STRUCTURED, W0_INTERVAL = 0.01, 0.0


log = logging.getLogger("fadeclust.jobs")


def _labelled_lines(out_dir: str, writer: str):
    if writer == "rows":
        return write_rows(FileLineTransport(out_dir), labelled_json)
    if writer != "lines":
        raise ValueError("writer must be 'lines' or 'rows'")
    write = write_lines_batch(out_dir)
    return lambda df, batch_id: write(labelled_json(df), batch_id)


def _rejects(path: str):
    write = write_lines_batch(path)
    return lambda df, batch_id: write(df.select(F.to_json(
        F.struct("value", F.col(REASON_COL).alias("reason"))).alias("value")), batch_id)


def _start(spark, lines, out_dir, init, params, trigger, console, writer, rejects_dir, state_path, checkpoint, name):
    outputs = [_labelled_lines(out_dir, writer)]
    if console == "full":
        outputs.append(lambda df, batch_id: df.show(df.count(), truncate=False))
    elif console:
        outputs.append(print_sample())
    return train_and_score_stream(
        checked_points(lines), init, params, [fan_out(*outputs, persist=len(outputs) > 1)], score_with="after",
        state_path=state_path, checkpoint=checkpoint, trigger=trigger,
        query_name=name, rejects=_rejects(rejects_dir or f"{out_dir.rstrip('/')}-rejects"), log=log.info)


def structured_job(spark: SparkSession, lines, out_dir: str, seed: int = 0,
                   state_path: str | None = None, checkpoint: str | None = None,
                   trigger: dict | None = None, console: bool | str = False,
                   writer: str = "lines", rejects_dir: str | None = None):
    """Start the structured job on a streaming frame of JSON lines; returns
    ``(query, trainer)``.  ``console``: True shows a sample of each batch,
    ``"full"`` every row untruncated."""
    init = random_state(spark, K, DIM, W0_STRUCTURED, seed)
    return _start(spark, lines, out_dir, init, UpdateParams(decay=DECAY), trigger, console, writer,
                  rejects_dir, state_path, checkpoint, "fadeclust-structured-job")


def interval_job(spark: SparkSession, lines, out_dir: str, seed: int = 0,
                 state_path: str | None = None, checkpoint: str | None = None,
                 trigger: dict | None = None, console: bool | str = True,
                 writer: str = "lines", rejects_dir: str | None = None):
    """Start the interval job (1 s batches unless ``trigger`` says otherwise)."""
    init = random_state(spark, K, DIM, W0_INTERVAL, seed)
    return _start(spark, lines, out_dir, init, UpdateParams(decay=DECAY, split_dying=True),
                  trigger or {"processingTime": "1 second"}, console, writer,
                  rejects_dir, state_path, checkpoint, "fadeclust-interval-job")


def main(argv=None):
    ap = argparse.ArgumentParser(description="streaming k-means on JSON point lines")
    ap.add_argument("--job", choices=["structured", "interval"], default="structured")
    ap.add_argument("--source", default="socket", help="socket, text, kafka, rate")
    ap.add_argument("--path", help="folder for file sources")
    ap.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                    help="source option, e.g. host=localhost or port=9999")
    ap.add_argument("--out", required=True, help="folder for labelled JSON lines")
    ap.add_argument("--rejects", help="folder for lines that are no valid point")
    ap.add_argument("--writer", choices=["lines", "rows"], default="lines")
    ap.add_argument("--console", choices=["sample", "full"], help="also show each batch")
    ap.add_argument("--seed", type=int, default=0)
    ap.add_argument("--state", help="state table folder (default: a new folder "
                    "under spark.checkpoint.dir)")
    ap.add_argument("--checkpoint", help="query checkpoint folder")
    ap.add_argument("--once", action="store_true",
                    help="process what the source holds now, then stop (backfill)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"fadeclust-{args.job}-job").getOrCreate()
    opts = dict(o.split("=", 1) for o in args.option)
    lines = read_lines_stream(spark, args.source, args.path, **opts)
    job = structured_job if args.job == "structured" else interval_job
    query, trainer = job(spark, lines, args.out, args.seed,
                         state_path=args.state or fresh_dir(spark, f"{args.job}-state"),
                         checkpoint=args.checkpoint, writer=args.writer, rejects_dir=args.rejects,
                         console={"sample": True, "full": "full", None: False}[args.console],
                         trigger={"availableNow": True} if args.once else None)
    query.awaitTermination()
    return trainer


if __name__ == "__main__":
    main()

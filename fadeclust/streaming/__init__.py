"""Structured Streaming: training/scoring queries, state table and sinks."""

from .datasource import JsonLinesSink, register
from .score import StreamScorer, score_stream
from .sinks import (FileLineTransport, LineWriter, SocketLineTransport,
                    batch_distinct_count, console, display_window, fan_out,
                    print_sample, read_display, run_batches, write_lines_batch)
from .state import StateTable
from .train import (StreamTrainer, labelled_json, train_and_score_stream,
                    train_stream)

__all__ = [
    "JsonLinesSink", "register", "FileLineTransport", "LineWriter",
    "SocketLineTransport", "batch_distinct_count", "console", "display_window",
    "fan_out", "read_display",
    "print_sample", "run_batches", "write_lines_batch", "StateTable", "StreamScorer", "score_stream",
    "StreamTrainer", "labelled_json", "train_and_score_stream", "train_stream",
]

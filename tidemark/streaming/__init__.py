"""Structured Streaming wiring over the batch operators."""

from tidemark.streaming.wiring import (
    LateRows,
    accounted_batch_writer,
    dropped_by_watermark,
    raw_rejects,
    run_until_stopped,
    start_accounted_sink,
    start_archive,
    start_reject_sink,
    start_table_sink,
    table_batch_writer,
    window_stream,
)

__all__ = [
    "LateRows", "accounted_batch_writer", "start_accounted_sink", "dropped_by_watermark", "raw_rejects", "start_reject_sink", "run_until_stopped", "start_archive", "start_table_sink",
    "table_batch_writer", "window_stream",
]

"""Streams run the batch operators on every micro-batch."""

from blockfee.streaming.run import preview_batches, preview_stream, run_stream
from blockfee.streaming.work import work_dir

__all__ = ["preview_batches", "preview_stream", "run_stream", "work_dir"]

"""Streams of messages into stored batches."""

from tarnlake.streaming.ingest import drain, finish, ingest, parse_messages
from tarnlake.streaming.progress import ProgressLog, progress_rows
from tarnlake.streaming.replay import cut_for_replay, replay
from tarnlake.streaming.state import NewestRows, YearlyMetrics
from tarnlake.streaming.store import BatchStore, publish_ledger, store_batch, store_batches

__all__ = [
    "BatchStore",
    "NewestRows",
    "ProgressLog",
    "YearlyMetrics",
    "cut_for_replay",
    "drain",
    "finish",
    "ingest",
    "parse_messages",
    "progress_rows",
    "publish_ledger",
    "replay",
    "store_batch",
    "store_batches",
]

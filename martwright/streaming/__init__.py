"""Structured Streaming jobs."""

from martwright.streaming.jobs import StreamCounts, dedupe_stream, enrich_stream, fan_out, first_in_batch, run_stream
from martwright.streaming.orders import load_counters, load_vault, vault_table
from martwright.streaming.promotions import promotion_outputs, promotion_triggers, send_triggers

__all__ = [
    "StreamCounts",
    "dedupe_stream",
    "enrich_stream",
    "fan_out",
    "first_in_batch",
    "load_counters",
    "load_vault",
    "promotion_outputs",
    "promotion_triggers",
    "run_stream",
    "send_triggers",
    "vault_table",
]

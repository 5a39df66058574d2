"""Structured Streaming: change-event sources, publishing, per-batch ledger writes."""

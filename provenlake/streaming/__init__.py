"""Incremental landing of receipts on Structured Streaming."""

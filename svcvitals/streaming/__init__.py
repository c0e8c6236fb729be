"""Structured Streaming ingestion (append-only, checkpointed)."""

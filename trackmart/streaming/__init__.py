"""Incremental, checkpointed lookup batches (batch and Structured Streaming drivers)."""

"""Incremental (Structured Streaming) form of the daily rollup."""

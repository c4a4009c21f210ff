"""Structured Streaming forms of aggregations; the batch engine doesn't need them."""

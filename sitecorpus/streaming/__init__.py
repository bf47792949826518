"""Structured Streaming twins: live crawl progress, per-URL outcomes, the corpus stream."""

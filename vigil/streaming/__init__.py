"""Structured Streaming: the scorer as keyed state, the enriched sink and
its reader, and batch-duration monitoring."""

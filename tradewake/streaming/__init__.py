"""Structured Streaming: keyed state, sinks and the jobs."""

"""Structured Streaming: sinks, jobs and progress."""

"""Structured Streaming: the job log as a stream of definitions."""

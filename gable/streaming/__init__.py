"""Incremental scoring and deduplication with Structured Streaming."""
from gable.streaming.jobs import append_new, deduplicate_stream, read_files, run_available, score_stream  # noqa: F401

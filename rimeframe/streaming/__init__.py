"""Incremental work: file-stream ingest and rebuilding a range of years."""

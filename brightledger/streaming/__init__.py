"""Structured Streaming jobs: change log, hourly rollup, incremental summaries."""

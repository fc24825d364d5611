"""The job as Structured Streaming queries, and its command line."""

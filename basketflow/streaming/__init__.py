"""The incremental operators as Structured Streaming jobs."""

"""The hourly loads as Structured Streaming jobs."""

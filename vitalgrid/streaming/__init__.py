"""Structured Streaming forms of the hourly aggregate, the environment join and the alerts."""

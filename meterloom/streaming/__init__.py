"""The daily recalculation as Structured Streaming."""

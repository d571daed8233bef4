"""Live ad-click queries on Structured Streaming."""

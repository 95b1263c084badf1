"""The incremental model driven by Structured Streaming."""

"""Publishing staged rows with Structured Streaming."""

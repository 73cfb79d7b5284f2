"""waymark.streaming."""

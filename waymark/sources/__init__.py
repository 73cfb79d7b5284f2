"""waymark.sources."""

"""waymark.functions."""

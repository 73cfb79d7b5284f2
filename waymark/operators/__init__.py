"""waymark.operators."""

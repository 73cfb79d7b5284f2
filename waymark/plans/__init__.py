"""waymark.plans."""

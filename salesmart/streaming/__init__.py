"""Long-running and bounded streams over the same plans."""

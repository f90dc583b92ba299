"""Long-running jobs over the same plans."""

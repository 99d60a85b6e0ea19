"""Reading, writing and keeping tables."""

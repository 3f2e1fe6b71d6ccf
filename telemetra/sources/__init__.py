"""Reading messages and tables."""

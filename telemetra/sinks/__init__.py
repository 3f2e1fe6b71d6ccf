"""Writing tables and messages."""

"""Streaming queries."""

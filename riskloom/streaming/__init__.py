"""Structured Streaming sources and queries."""

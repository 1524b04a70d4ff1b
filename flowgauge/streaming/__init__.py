"""Structured Streaming versions of status, statistics and scoring."""

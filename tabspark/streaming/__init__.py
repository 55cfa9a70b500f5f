"""Structured Streaming scoring of arriving feature rows and JSON requests."""

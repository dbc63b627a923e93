"""Structured Streaming versions of the live-feed operators."""

"""Fitted statistics applied to Structured Streaming frames."""

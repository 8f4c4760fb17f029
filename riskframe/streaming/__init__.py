"""Structured Streaming adapters for the monitoring operators."""

"""Structured Streaming sources, sinks, stateful operators and monitoring."""

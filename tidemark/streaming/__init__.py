"""Structured Streaming: sources, stateful operators, sinks."""

"""Structured Streaming versions of stateful operators."""

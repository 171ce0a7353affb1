"""Increments as a stream."""

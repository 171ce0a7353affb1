"""Whole runs: push a frame, run a table, report on results."""

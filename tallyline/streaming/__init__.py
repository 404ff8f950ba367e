"""Structured Streaming jobs on the operators the batch side uses."""

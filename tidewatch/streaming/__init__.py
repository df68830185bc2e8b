"""Structured Streaming forms of the batch operators, for feeds that are polled."""

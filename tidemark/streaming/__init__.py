"""Structured Streaming drivers of batch operators."""

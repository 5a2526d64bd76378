"""Readers and writers: landing payloads, typed tables, seeds, published relations."""

"""Composite relations: staging, dimensions, facts, marts and the refresh programs."""

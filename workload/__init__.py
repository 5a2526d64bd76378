"""Queries of the engine over the sample tables."""

from workload import deltas, measures, operators, payloads, quality, relations  # noqa: F401
from workload.registry import ORACLES, QUERIES  # noqa: F401

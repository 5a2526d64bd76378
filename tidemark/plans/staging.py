"""Staging: the latest ingested version of every source row."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.versions import latest_version, with_provenance
from tidemark.schemas import FACT_GRAIN, OBSERVATION_GRAIN, PRICE_GRAIN


def stg_market_prices(prices: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per symbol and trading date."""
    return latest_version(with_provenance(prices, runs), PRICE_GRAIN)


def stg_financial_facts(facts: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per filing context; context columns may be NULL and compare equal."""
    return latest_version(with_provenance(facts, runs), FACT_GRAIN)


def stg_macro_observations(observations: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per series, observation date and real-time window."""
    return latest_version(with_provenance(observations, runs), OBSERVATION_GRAIN)

"""Seed tables and configured entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.relational import literal_table
from tidemark.schemas import IDENTITY_MAPPING_SCHEMA, METRIC_MAPPING_SCHEMA

# Company key, ticker, registrant key, role, current registrant.
COMPANY_IDENTITIES = [
    ("AAPL", "AAPL", "0000320193", "primary", True),
    ("MSFT", "MSFT", "0000789019", "primary", True),
    ("NVDA", "NVDA", "0001045810", "primary", True),
    ("AMZN", "AMZN", "0001018724", "primary", True),
    ("XOM", "XOM", "0002115436", "successor", True),
    ("XOM", "XOM", "0000034088", "predecessor", False),
    ("WMT", "WMT", "0000104169", "primary", True),
]

# Taxonomy, concept, metric key, metric name, period type.
FINANCIAL_METRICS = [
    (
        "us-gaap",
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "contract_revenue_excluding_assessed_tax",
        "Revenue from Contracts with Customers, Excluding Assessed Tax",
        "duration",
    ),
    ("us-gaap", "NetIncomeLoss", "net_income_attributable_to_parent", "Net Income (Loss) Attributable to Parent", "duration"),
    ("us-gaap", "Assets", "total_assets", "Total Assets", "instant"),
    ("us-gaap", "Liabilities", "total_liabilities", "Total Liabilities", "instant"),
    ("us-gaap", "StockholdersEquity", "equity_attributable_to_parent", "Equity Attributable to Parent", "instant"),
    ("us-gaap", "NetCashProvidedByUsedInOperatingActivities", "operating_cash_flow", "Operating Cash Flow", "duration"),
]

# Configured macro series.
MACRO_SERIES = ["DFF", "CPIAUCSL", "UNRATE", "GDPC1", "DGS10"]


SERIES_LIST_SCHEMA = T.StructType([T.StructField("series_id", T.StringType(), False)])


def company_identities(spark: SparkSession) -> DataFrame:
    return literal_table(spark, COMPANY_IDENTITIES, IDENTITY_MAPPING_SCHEMA)


def financial_metrics(spark: SparkSession) -> DataFrame:
    return literal_table(spark, FINANCIAL_METRICS, METRIC_MAPPING_SCHEMA)


def macro_series(spark: SparkSession) -> DataFrame:
    return literal_table(spark, [(s,) for s in MACRO_SERIES], SERIES_LIST_SCHEMA)

"""Tidemark: financial time series and filings analytics as Spark DataFrame operators."""

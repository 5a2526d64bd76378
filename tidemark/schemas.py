"""Table contracts: column types, identities, grains and row rules.

Every stored table has a fixed, explicit schema.  Nothing is inferred and a table
whose schema differs from its contract is refused, not adapted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RUN_KEY = ["source", "dataset", "run_id"]
ROW_KEY = [*RUN_KEY, "source_row_number"]
#: Newest first.  Every column is NOT NULL in the contracts below.
RECENCY = ["ingested_at", "run_id", "loaded_at", "source_row_number"]

PRICE = T.DecimalType(38, 18)
#: Reported values are stored next to their literal (``value_text``); a value with more digits
#: than this type holds rejects its payload.
VALUE = T.DecimalType(38, 10)

# Provider and dataset identities.
PRICES = ("twelve_data", "daily_market_prices")
SUBMISSIONS = ("sec_edgar", "submissions")
COMPANY_FACTS = ("sec_edgar", "company_facts")
SERIES_METADATA = ("fred", "series_metadata")
SERIES_OBSERVATIONS = ("fred", "series_observations")
DATASETS = [PRICES, SUBMISSIONS, COMPANY_FACTS, SERIES_METADATA, SERIES_OBSERVATIONS]

RUN_ID_PATTERN = r"^[0-9]{8}T[0-9]{12}Z(--entity-[A-Za-z0-9_-]+)?$"


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_S, _L, _I, _D, _TS, _B = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DateType(),
    T.TimestampType(),
    T.BooleanType(),
)
_LINEAGE = (
    ("source", _S, False),
    ("dataset", _S, False),
    ("run_id", _S, False),
    ("source_row_number", _L, False),
)

INGESTION_RUNS_SCHEMA = _struct(
    ("source", _S, False),
    ("dataset", _S, False),
    ("run_id", _S, False),
    ("ingested_at", _TS, False),
    ("raw_json_path", _S, False),
    ("parquet_path", _S, False),
    ("record_count", _L, False),
    ("loaded_at", _TS, False),
)

PRICES_SCHEMA = _struct(
    *_LINEAGE,
    ("symbol", _S, False),
    ("trading_date", _D, False),
    ("open", PRICE, False),
    ("high", PRICE, False),
    ("low", PRICE, False),
    ("close", PRICE, False),
    ("volume", _L, True),
)

SUBMISSIONS_SCHEMA = _struct(
    *_LINEAGE,
    ("cik", _S, False),
    ("company_name", _S, False),
    ("accession_number", _S, False),
    ("filing_date", _D, False),
    ("report_date", _D, True),
    ("acceptance_datetime", _TS, True),
    ("form", _S, False),
    ("act", _S, True),
    ("file_number", _S, True),
    ("film_number", _S, True),
    ("items", _S, True),
    ("size", _L, False),
    ("is_xbrl", _B, False),
    ("is_inline_xbrl", _B, False),
    ("primary_document", _S, True),
    ("primary_doc_description", _S, True),
)

COMPANY_FACTS_SCHEMA = _struct(
    *_LINEAGE,
    ("cik", _S, False),
    ("entity_name", _S, False),
    ("taxonomy", _S, False),
    ("concept", _S, False),
    ("label", _S, True),
    ("description", _S, True),
    ("unit", _S, False),
    ("value", VALUE, True),
    ("value_text", _S, False),
    ("value_exact", _B, False),
    ("start_date", _D, True),
    ("end_date", _D, False),
    ("accession_number", _S, False),
    ("fiscal_year", _I, True),
    ("fiscal_period", _S, True),
    ("form", _S, False),
    ("filed_date", _D, False),
    ("frame", _S, True),
)

SERIES_METADATA_SCHEMA = _struct(
    *_LINEAGE,
    ("series_id", _S, False),
    ("realtime_start", _D, False),
    ("realtime_end", _D, False),
    ("title", _S, False),
    ("observation_start", _D, False),
    ("observation_end", _D, False),
    ("frequency", _S, False),
    ("frequency_short", _S, False),
    ("units", _S, False),
    ("units_short", _S, False),
    ("seasonal_adjustment", _S, False),
    ("seasonal_adjustment_short", _S, False),
    ("last_updated", _TS, False),
    ("popularity", _L, False),
    ("notes", _S, True),
)

SERIES_OBSERVATIONS_SCHEMA = _struct(
    *_LINEAGE,
    ("series_id", _S, False),
    ("realtime_start", _D, False),
    ("realtime_end", _D, False),
    ("observation_date", _D, False),
    ("value", VALUE, True),
    ("value_text", _S, True),
    ("value_exact", _B, False),
)

LANDING_SCHEMA = _struct(
    ("source", _S, False),
    ("dataset", _S, False),
    ("ingestion_date", _D, False),
    ("run_id", _S, False),
    ("entity", _S, True),
    ("ingested_at", _TS, False),
    ("payload", _S, False),
)

DATASET_SCHEMA = _struct(("source", _S, False), ("dataset", _S, False))

IDENTITY_MAPPING_SCHEMA = _struct(
    ("company_key", _S, False),
    ("current_ticker", _S, False),
    ("source_cik", _S, False),
    ("registrant_role", _S, False),
    ("is_current_registrant", _B, False),
)

METRIC_MAPPING_SCHEMA = _struct(
    ("taxonomy", _S, False),
    ("concept", _S, False),
    ("metric_key", _S, False),
    ("metric_name", _S, False),
    ("period_type", _S, False),
)


@dataclass(frozen=True)
class TableContract:
    """One stored source table."""

    name: str
    identity: tuple[str, str]
    schema: T.StructType
    #: Natural key inside one run; empty when occurrences may repeat.
    run_grain: tuple[str, ...]
    #: Column naming the entity a run belongs to.
    entity: str
    #: The date whose maximum is the entity's high-water mark.
    watermark: str | None


CONTRACTS: dict[str, TableContract] = {
    c.name: c
    for c in (
        TableContract(
            "market_daily_prices", PRICES, PRICES_SCHEMA,
            ("symbol", "trading_date"), "symbol", "trading_date",
        ),
        TableContract(
            "sec_submissions", SUBMISSIONS, SUBMISSIONS_SCHEMA,
            ("accession_number",), "cik", "filing_date",
        ),
        TableContract(
            "sec_company_facts", COMPANY_FACTS, COMPANY_FACTS_SCHEMA,
            (), "cik", "filed_date",
        ),
        TableContract(
            "fred_series_metadata", SERIES_METADATA, SERIES_METADATA_SCHEMA,
            ("series_id",), "series_id", None,
        ),
        TableContract(
            "fred_series_observations", SERIES_OBSERVATIONS, SERIES_OBSERVATIONS_SCHEMA,
            ("series_id", "observation_date", "realtime_start", "realtime_end"),
            "series_id", "observation_date",
        ),
    )
}

PRICE_GRAIN = ["symbol", "trading_date"]
FACT_GRAIN = [
    "cik",
    "taxonomy",
    "concept",
    "unit",
    "start_date",
    "end_date",
    "accession_number",
    "fiscal_year",
    "fiscal_period",
    "form",
    "filed_date",
    "frame",
]
OBSERVATION_GRAIN = ["series_id", "observation_date", "realtime_start", "realtime_end"]
GROWTH_GRAIN = ["company_key", "metric_key", "end_date", "unit"]


class SchemaMismatch(ValueError):
    """A table does not have exactly the columns and types of its contract."""


def require_schema(df: DataFrame, contract: T.StructType, *, what: str = "table") -> DataFrame:
    """Return ``df`` if names, order and types equal ``contract``; raise otherwise.

    Nullability is a data property (Parquet always reads back nullable) and is checked
    by the ``not_null`` quality rule instead.
    """
    have = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in contract.fields]
    if have != want:
        missing = [n for n, t in want if (n, t) not in have]
        extra = [n for n, t in have if (n, t) not in want]
        raise SchemaMismatch(
            f"{what}: schema differs from its contract "
            f"(missing or mistyped: {missing}; unexpected: {extra}; order matters)"
        )
    return df

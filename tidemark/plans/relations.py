"""All modelled relations wired together from the six source tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versions import with_provenance
from tidemark.plans import dimensions as D
from tidemark.plans import marts as M
from tidemark.plans import staging as S

MARTS = ("mart_company_daily_performance", "mart_company_financial_growth", "mart_market_macro")
#: The part of the performance mart that the market/macro mart takes; may be named in ``stored``.
MARKET = "market"
RELATIONS = (
    "stg_market_prices",
    "stg_financial_facts",
    "stg_macro_observations",
    "dim_company",
    "dim_date",
    "dim_financial_metric",
    "dim_macro_series",
    "fact_market_daily",
    "fact_financial_reported",
    "fact_macro_observation",
    *MARTS,
)


class Relations:
    """Lazily composed relations; nothing runs until one of them is consumed.

    By default the plan stays lazy, so the optimizer sees the whole chain from source to
    mart.  ``keep`` stores the relations named in ``stored`` when they are first used and
    returns a frame that reads the stored rows, for relations with several consumers.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        identities: DataFrame,
        metrics: DataFrame,
        keep: Callable[[str, DataFrame], DataFrame] | None = None,
        stored: Collection[str] = (),
    ) -> None:
        self.tables = tables
        self.identities = identities
        self.metrics = metrics
        self._stored = frozenset(stored) if keep else frozenset()
        self._store = keep

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        return self._store(name, df) if name in self._stored else df

    def _versions(self, staging: str, table: str) -> DataFrame:
        """All versions of a source table, or its staging relation when that is stored.

        Dimensions, the calendar and the current vintage only look at columns of the
        staging grain and pick rows by the same recency order, so they give the same
        result over all versions and over the latest ones.  Skipping the staging
        window saves its shuffle unless the result is stored anyway.
        """
        if staging in self._stored:
            return getattr(self, staging)
        return with_provenance(self.tables[table], self.tables["ingestion_runs"])

    @cached_property
    def _prices(self) -> DataFrame:
        return self._versions("stg_market_prices", "market_daily_prices")

    @cached_property
    def _facts(self) -> DataFrame:
        return self._versions("stg_financial_facts", "sec_company_facts")

    @cached_property
    def _observations(self) -> DataFrame:
        return self._versions("stg_macro_observations", "fred_series_observations")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RELATIONS:
            raise KeyError(name)
        return getattr(self, name)

    @cached_property
    def stg_market_prices(self) -> DataFrame:
        return self._keep(
            "stg_market_prices",
            S.stg_market_prices(self.tables["market_daily_prices"], self.tables["ingestion_runs"]),
        )

    @cached_property
    def stg_financial_facts(self) -> DataFrame:
        return self._keep(
            "stg_financial_facts",
            S.stg_financial_facts(self.tables["sec_company_facts"], self.tables["ingestion_runs"]),
        )

    @cached_property
    def stg_macro_observations(self) -> DataFrame:
        return self._keep(
            "stg_macro_observations",
            S.stg_macro_observations(self.tables["fred_series_observations"], self.tables["ingestion_runs"]),
        )

    @cached_property
    def dim_company(self) -> DataFrame:
        return self._keep("dim_company", D.dim_company(self._facts))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._keep(
            "dim_date",
            D.dim_date(self._prices, self._facts, self._observations),
        )

    @cached_property
    def dim_financial_metric(self) -> DataFrame:
        return self._keep("dim_financial_metric", D.dim_financial_metric(self.metrics))

    @cached_property
    def dim_macro_series(self) -> DataFrame:
        return self._keep("dim_macro_series", D.dim_macro_series(self._observations))

    @cached_property
    def fact_market_daily(self) -> DataFrame:
        return self._keep("fact_market_daily", D.fact_market_daily(self.stg_market_prices))

    @cached_property
    def fact_financial_reported(self) -> DataFrame:
        return self._keep(
            "fact_financial_reported", D.fact_financial_reported(self.stg_financial_facts, self.metrics)
        )

    @cached_property
    def fact_macro_observation(self) -> DataFrame:
        return self._keep("fact_macro_observation", D.fact_macro_observation(self._observations))

    @property
    def _company_prices(self) -> DataFrame:
        """Market facts of the symbols that companies trade under now.

        The symbol belongs to the staging grain, so leaving the others out before runs are
        met and versions are ranked gives the rows the mart would find in the whole fact.
        """
        if self._stored & {"stg_market_prices", "fact_market_daily"}:
            return self.fact_market_daily
        symbols = self._current.select(F.col("current_ticker").alias("symbol"))
        prices = self.tables["market_daily_prices"].join(symbols, "symbol", "left_semi")
        return D.fact_market_daily(S.stg_market_prices(prices, self.tables["ingestion_runs"]))

    @property
    def _company_names(self) -> DataFrame:
        """Names of the current registrants; every registrant's name rests on its own facts."""
        if self._stored & {"stg_financial_facts", "dim_company"}:
            return self.dim_company
        ciks = self._current.select(F.col("source_cik").alias("cik"))
        facts = self.tables["sec_company_facts"].join(ciks, "cik", "left_semi")
        return D.dim_company(with_provenance(facts, self.tables["ingestion_runs"]))

    @property
    def _current(self) -> DataFrame:
        return self.identities.where("is_current_registrant")

    @cached_property
    def mart_company_daily_performance(self) -> DataFrame:
        return self._keep(
            "mart_company_daily_performance",
            M.mart_company_daily_performance(self._company_prices, self.identities, self._company_names),
        )

    @cached_property
    def mart_company_financial_growth(self) -> DataFrame:
        return self._keep(
            "mart_company_financial_growth",
            M.mart_company_financial_growth(
                self.fact_financial_reported, self.identities, self.dim_financial_metric
            ),
        )

    @cached_property
    def mart_market_macro(self) -> DataFrame:
        return self._keep(
            "mart_market_macro",
            M.mart_market_macro(
                self.market,
                self.fact_macro_observation,
                self.trading_days,
            ),
        )

    @cached_property
    def market(self) -> DataFrame:
        """Every row of the performance mart with the columns the macro mart takes.

        Stored, it serves queries that read both marts: prices are met with their runs and
        ranked once, without the columns nobody reads.
        """
        return self._keep(MARKET, self.mart_company_daily_performance.select(*M.MARKET_COLUMNS))

    @property
    def trading_days(self) -> DataFrame:
        """Rows whose dates bound the trading days: the mart if it is stored, else the prices,
        which cost one narrow scan instead of a second computation of the mart."""
        for name in ("mart_company_daily_performance", MARKET):
            if name in self._stored:
                return getattr(self, name)
        return self.tables["market_daily_prices"]

    def register_views(self, spark: SparkSession, prefix: str = "") -> list[str]:
        """Publish every relation as a temporary view."""
        names = []
        for name in RELATIONS:
            self[name].createOrReplaceTempView(f"{prefix}{name}")
            names.append(f"{prefix}{name}")
        return names

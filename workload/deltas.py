"""Relations brought up to date by parts: the result is that of a full build."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import cache, cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.relational import measured
from tidemark.operators.timeseries import calendar
from tidemark.operators.versions import latest_version, with_provenance
from tidemark.plans import delta, standins
from tidemark.plans import dimensions as D
from tidemark.plans.reference_data import financial_metrics
from tidemark.plans.relations import Relations
from tidemark.sources.scratch import kept
from workload.registry import digits, query

#: Runs from these instants on arrive after the first build, by source.
LATE = {"twelve_data": "2001-05-01", "sec_edgar": "2001-05-01", "fred": "2024-01-20"}

#: Relations of the first build that come from rows met with their runs once.
BUILT = (
    "stg_market_prices", "fact_market_daily", "dim_company", "dim_date",
    "stg_macro_observations", "fact_macro_observation", "dim_macro_series",
)
#: Changed relations that several steps read.
CARRIED = ("dim_company", "fact_market_daily", delta.MONTH_CLOSES, "fact_macro_observation", "dim_macro_series")

#: Marks the rows of late runs; NULL where a run has no instant, which is in neither build.
LATE_ROW = "_late"


class _Arrived:
    """Source rows met with their runs once, for the first build and for the late runs on top.

    Rows are ranked on either side of the mark, so a stored frame holds the versions picked by the
    first build beside the newest late ones.  Each frame is stored when it is first used.
    """

    def __init__(self, tables: Mapping[str, DataFrame], runs: DataFrame, is_late: Column, identities: DataFrame) -> None:
        self._tables, self._runs, self._is_late = tables, runs, is_late
        self._identities = identities

    def _marked(self, rows: DataFrame) -> DataFrame:
        return with_provenance(rows, self._runs).withColumn(LATE_ROW, self._is_late)

    @cached_property
    def prices(self) -> DataFrame:
        """Prices of the symbols that companies trade under now; no mart takes another one.  They
        are ranked, grouped and ordered by symbol from here on, so they are shuffled by it."""
        symbols = self._identities.where("is_current_registrant").select(F.col("current_ticker").alias("symbol"))
        traded = self._tables["market_daily_prices"].join(symbols, "symbol", "left_semi")
        return kept("fact_market_daily", latest_version(measured(self._marked(traded), "symbol"), [LATE_ROW, *S.PRICE_GRAIN]))

    @cached_property
    def observations(self) -> DataFrame:
        rows = self._marked(self._tables["fred_series_observations"])
        return kept("stg_macro_observations", latest_version(rows, [LATE_ROW, *S.OBSERVATION_GRAIN]))

    @cached_property
    def names(self) -> DataFrame:
        """The newest name of every registrant, in the columns that names are picked by."""
        rows = self._tables["sec_company_facts"].select(*S.ROW_KEY, "cik", "entity_name", "filed_date")
        return kept("names", latest_version(self._marked(rows), [LATE_ROW, "cik"], ["filed_date", *S.RECENCY]))

    @cached_property
    def days(self) -> DataFrame:
        """First and last day of all rows, whatever symbol; each run is reduced to its own first."""
        bounds = [F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")]
        dated = []
        for name, columns in delta.DATES.items():
            pick = (F.least(*columns), F.greatest(*columns)) if len(columns) > 1 else (F.col(columns[0]),) * 2
            rows = self._tables[delta.STAGED[name][0]]
            dated.append(rows.select(*S.RUN_KEY, pick[0].alias("first_day"), pick[1].alias("last_day")))
        of_runs = reduce(DataFrame.unionByName, dated).groupBy(*S.RUN_KEY).agg(*bounds)
        return kept("days", self._marked(of_runs).groupBy(LATE_ROW).agg(*bounds))

    @cached_property
    def built(self) -> Mapping[str, DataFrame]:
        prices, observations = before_late(self.prices), before_late(self.observations)
        return {
            "stg_market_prices": prices,
            "fact_market_daily": D.fact_market_daily(prices),
            "stg_macro_observations": observations,
            "fact_macro_observation": kept("fact_macro_observation", D.fact_macro_observation(observations)),
            "dim_macro_series": kept("dim_macro_series", D.dim_macro_series(observations)),
            "dim_company": kept("dim_company", D.dim_company(before_late(self.names))),
            "dim_date": calendar(before_late(self.days)),
        }


def before_late(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col(LATE_ROW)).drop(LATE_ROW)


def only_late(rows: DataFrame) -> DataFrame:
    return rows.where(LATE_ROW).drop(LATE_ROW)


def _changed(spark, sf, sources: tuple[str, ...]) -> delta.Delta:
    """Late runs of some sources on top of relations built from all other runs."""
    given = standins.SourceTables(spark, sf)
    runs = given["ingestion_runs"]
    is_late = F.lit(False)
    for source in sources:
        is_late = is_late | ((F.col("source") == source) & (F.col("ingested_at") >= F.lit(LATE[source]).cast("timestamp")))
    tables = {table: given[table] for table, _ in delta.STAGED.values()}
    identities, metrics = standins.company_identities(spark, sf), financial_metrics(spark)
    early, late = {**tables, "ingestion_runs": runs.where(~is_late)}, runs.where(is_late)
    arrivals = {
        name: with_provenance(tables[table].where(F.lit(S.CONTRACTS[table].identity[0] in sources)), late)
        for name, (table, _) in delta.STAGED.items()
    }

    def keep(name: str, rows: DataFrame, parts) -> DataFrame:
        return kept(name, rows) if name in CARRIED else rows

    # A delta of facts alone ends in the growth mart, which reads no prices.
    if set(sources) == {"sec_edgar"}:
        relations = Relations(early, identities, metrics, kept, ("dim_company",))

        def known(name: str, parts) -> DataFrame:
            return _parts(with_provenance(early[delta.STAGED[name][0]], early["ingestion_runs"]), name, parts)

        def facts_before(name: str, parts, without) -> DataFrame:
            rows = delta.month_closes(relations.fact_market_daily) if name == delta.MONTH_CLOSES else relations[name]
            return _parts(rows, name, parts, without)

        return delta.Delta(facts_before, arrivals, identities, metrics, keep, known)

    arrived = _Arrived(tables, runs, is_late, identities)
    relations = Relations(early, identities, metrics, lambda name, _: arrived.built[name], BUILT)
    closes = kept(delta.MONTH_CLOSES, delta.month_closes(relations.fact_market_daily))

    @cache
    def months() -> set[str]:
        return {r[0] for r in closes.select(delta.part(delta.MONTH_CLOSES)).distinct().collect()}

    def before(name: str, parts, without) -> DataFrame:
        rows = closes if name == delta.MONTH_CLOSES else relations[name]
        if without and name in delta.BY_MONTH and months() <= {*without, None}:
            return rows.where(F.lit(False))
        return _parts(rows, name, parts, without)

    def versions(name: str, parts) -> DataFrame:
        known = {"stg_market_prices": arrived.prices, "stg_financial_facts": arrived.names}
        return _parts(before_late(known[name]), name, parts)

    arrivals |= {"stg_market_prices": only_late(arrived.prices), "stg_macro_observations": only_late(arrived.observations)}
    heads = {"stg_financial_facts": only_late(arrived.names)}
    return delta.Delta(before, arrivals, identities, metrics, keep, versions, heads, only_late(arrived.days))


def _parts(rows: DataFrame, name: str, parts: Collection[str] | None, without: Collection[str] = ()) -> DataFrame:
    if parts is not None:
        rows = rows.where(delta.part(name).isin(list(parts)))
    return rows.where(~delta.part(name).isin(list(without))) if without else rows


@query("delta_market_macro", """
SELECT company_key, current_ticker, current_cik, company_name, CAST(trading_date AS VARCHAR) AS trading_date, series_id,
  CAST(market_close AS DOUBLE) AS market_close, market_volume, CAST(macro_observation_date AS VARCHAR) AS macro_observation_date,
  CAST(macro_value AS DOUBLE) AS macro_value, macro_age_days
FROM x_aligned
""")
def delta_market_macro(spark, sf):
    """Late prices and observations carried into the market/macro mart."""
    return _changed(spark, sf, ("twelve_data", "fred")).now("mart_market_macro")


@query("delta_daily_performance", """
SELECT company_key, current_ticker, current_cik, company_name, CAST(trading_date AS VARCHAR) AS trading_date,
  CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
  volume, CAST(previous_close AS DOUBLE) AS previous_close, CAST(daily_change AS DOUBLE) AS daily_change, daily_return
FROM x_performance
""")
def delta_daily_performance(spark, sf):
    """Late prices, and late facts that may rename companies, carried into the performance mart."""
    return _changed(spark, sf, ("twelve_data", "sec_edgar")).now("mart_company_daily_performance")


@query("delta_financial_growth", """
SELECT company_key, current_ticker, source_cik, metric_key, metric_name, period_type, taxonomy, concept, unit,
  CAST(fiscal_year AS BIGINT) AS fiscal_year, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
  CAST(CAST(current_value AS DECIMAL(38,10)) AS VARCHAR) AS current_value, CAST(previous_end_date AS VARCHAR) AS previous_end_date,
  CAST(CAST(previous_value AS DECIMAL(38,10)) AS VARCHAR) AS previous_value,
  CAST(CAST(absolute_change AS DECIMAL(38,10)) AS VARCHAR) AS absolute_change, growth_rate,
  form, CAST(filed_date AS VARCHAR) AS filed_date, accession_number
FROM x_growth
""")
def delta_financial_growth(spark, sf):
    """Late facts carried into the growth mart."""
    mart = _changed(spark, sf, ("sec_edgar",)).now("mart_company_financial_growth")
    return mart.withColumns({c: digits(F.col(c)) for c in ("current_value", "previous_value", "absolute_change")})

"""Relations after new runs, worked out for the parts that can change and no others.

Every relation is cut into parts by a column expression (``PARTS``): months of the trading day, or
buckets of an entity.  Arriving rows name the parts they touch; touched keys are carried on:

* staging: the parts of the arriving grains are ranked again, with the arrivals;
* facts and dimensions: the same parts;
* daily performance: these months, and the next month of a company whose last price in one of
  them may be another one, because the lag reaches over the end of the month.  The last price
  before a month comes from ``month_closes``, one row for each symbol and month, not from prices;
* growth: the buckets of companies whose registrants have arriving facts;
* market and macro: the months of the performance and every month in which a changed observation
  is in force, from its own day to the day before the next one.

A company name that changes touches every month in which it stands, and a new series touches every
month, since the grid gets new rows there.  Seeds that change need a full refresh.

Only lists of parts pass the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.relational import differs
from tidemark.operators.timeseries import calendar, column_bounds, day_bounds, merged_bounds
from tidemark.operators.versions import latest_version
from tidemark.plans import dimensions as D
from tidemark.plans import marts as M
from tidemark.schemas import FACT_GRAIN, OBSERVATION_GRAIN, PRICE_GRAIN, RUN_KEY

BUCKETS = 64
WHOLE = "all"

#: Working relations that are stored beside the published ones.
MONTH_CLOSES, STAGED_RUNS = "month_closes", "staged_runs"


def month(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def bucket(key: str) -> Column:
    return F.lpad(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("string"), 2, "0")


def run_month(run_id: str = "run_id") -> Column:
    """Run ids begin with their instant."""
    return F.concat_ws("-", F.substring(run_id, 1, 4), F.substring(run_id, 5, 2))


PARTS: dict[str, Callable[[], Column]] = {
    "stg_market_prices": lambda: month("trading_date"),
    "stg_financial_facts": lambda: bucket("cik"),
    "stg_macro_observations": lambda: bucket("series_id"),
    "dim_company": lambda: bucket("cik"),
    "dim_date": lambda: F.lit(WHOLE),
    "dim_financial_metric": lambda: F.lit(WHOLE),
    "dim_macro_series": lambda: bucket("series_id"),
    "fact_market_daily": lambda: month("trading_date"),
    "fact_financial_reported": lambda: bucket("cik"),
    "fact_macro_observation": lambda: bucket("series_id"),
    "mart_company_daily_performance": lambda: month("trading_date"),
    "mart_company_financial_growth": lambda: bucket("company_key"),
    "mart_market_macro": lambda: month("trading_date"),
    MONTH_CLOSES: lambda: month("trading_date"),
    STAGED_RUNS: lambda: run_month(),
}

#: Relations cut into months of the trading day.
BY_MONTH = (
    "stg_market_prices", "fact_market_daily", "mart_company_daily_performance", "mart_market_macro", MONTH_CLOSES,
)

#: Staging relation: source table and grain.
STAGED = {
    "stg_market_prices": ("market_daily_prices", PRICE_GRAIN),
    "stg_financial_facts": ("sec_company_facts", FACT_GRAIN),
    "stg_macro_observations": ("fred_series_observations", OBSERVATION_GRAIN),
}

#: Staging relation: its dates in the calendar.
DATES = {
    "stg_market_prices": ("trading_date",),
    "stg_financial_facts": ("start_date", "end_date", "filed_date"),
    "stg_macro_observations": ("observation_date",),
}


def part(name: str) -> Column:
    return PARTS[name]()


def month_closes(prices: DataFrame) -> DataFrame:
    """The last price row of every symbol and month, in the columns of the market fact."""
    rows = F.struct(*prices.columns)
    return (
        prices.groupBy("symbol", month("trading_date").alias("_month"))
        .agg(F.max_by(rows, "trading_date").alias("_row"))
        .select("_row.*")
    )


def _values(df: DataFrame, column: Column) -> list[str]:
    """Distinct parts; as many as there are months or buckets at most."""
    return sorted(r[0] for r in df.select(column.alias("p")).where("p IS NOT NULL").distinct().collect())


def _ranges(months: Collection[str]) -> Iterable[tuple[date, date]]:
    """First and last days of the stretches of months that follow each other."""
    days = sorted(date(int(m[:4]), int(m[5:7]), 1) for m in months)
    spans: list[list[date]] = []
    for first in days:
        last = (first.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
        if spans and spans[-1][1] + timedelta(days=1) == first:
            spans[-1][1] = last
        else:
            spans.append([first, last])
    return [tuple(s) for s in spans]


def _arriving_days(arrivals: Mapping[str, DataFrame]) -> DataFrame:
    return merged_bounds(*[column_bounds(arrivals[name], *columns) for name, columns in DATES.items()])


class Delta:
    """New rows of touched parts, relation by relation, each one on top of the ones before.

    ``before(name, parts, without)`` reads the relation as it was, all of it or some parts.
    ``keep(name, rows, parts)`` may store the new rows of the given parts and returns a frame of
    them; by default nothing is stored.  ``changed`` has the parts and new rows of every relation
    that changes.  ``versions(name, parts)`` may give all versions of the rows a staging relation
    was picked from; names and keys found in them are those of the picked rows, which need not
    be ranked then.  ``heads`` may give arriving rows once more with fewer columns or versions, for
    the steps that look for touched parts, names and keys; ``days`` may give the first and last
    day of all arriving rows.
    """

    def __init__(
        self,
        before: Callable[[str, Collection[str] | None, Collection[str]], DataFrame],
        arrivals: Mapping[str, DataFrame],
        identities: DataFrame,
        metrics: DataFrame,
        keep: Callable[[str, DataFrame, Collection[str]], DataFrame] = lambda name, rows, parts: rows,
        versions: Callable[[str, Collection[str]], DataFrame] | None = None,
        heads: Mapping[str, DataFrame] | None = None,
        days: DataFrame | None = None,
    ) -> None:
        self._before = before
        self._keep = keep
        self._versions = versions or (lambda name, parts: before(name, parts, ()))
        self._days = (lambda: versions("stg_market_prices", None)) if versions else (lambda: before(MONTH_CLOSES, None, ()))
        self.changed: dict[str, tuple[list[str], DataFrame]] = {}
        self.identities = identities
        heads = {**arrivals, **(heads or {})}
        touched = {name: _values(rows, part(name)) for name, rows in heads.items()}
        for name, rows in arrivals.items():
            self._stage(name, rows, touched[name])
        self._calendar(_arriving_days(arrivals) if days is None else days)
        names = self._facts(touched["stg_financial_facts"], heads["stg_financial_facts"], metrics)
        spans, new_series = self._observations(touched["stg_macro_observations"], arrivals["stg_macro_observations"])
        months = self._prices(touched["stg_market_prices"], arrivals["stg_market_prices"].select("symbol").distinct(), names)
        self._market_macro(months, spans, new_series)

    def now(self, name: str, parts: Collection[str] | None = None) -> DataFrame:
        """A relation after the change: parts that did not change come from before."""
        if name not in self.changed:
            return self._before(name, parts, ())
        replaced, rows = self.changed[name]
        if parts is not None:
            rows = rows.where(part(name).isin(list(parts)))
            if set(parts) <= set(replaced):
                return rows
        return self._before(name, parts, replaced).unionByName(rows)

    def _put(self, name: str, parts: list[str], rows: DataFrame) -> None:
        if parts:
            self.changed[name] = (parts, self._keep(name, rows, parts))

    def _new(self, name: str, parts: list[str]) -> DataFrame:
        """Rows of changed parts only."""
        return self.now(name, parts)

    def _stage(self, name: str, rows: DataFrame, parts: list[str]) -> None:
        if parts:
            known = self._before(name, parts, ())
            self._put(name, parts, latest_version(known.unionByName(rows.select(*known.columns)), STAGED[name][1]))

    def _calendar(self, arriving: DataFrame) -> None:
        """Dates belong to the staging grains, so the calendar can only grow."""
        known = day_bounds(self._before("dim_date", None, ()), "date_day")
        bounds = merged_bounds(known, arriving)
        if known.head() != bounds.head():
            self._put("dim_date", [WHOLE], calendar(bounds))

    def _facts(self, buckets: list[str], rows: DataFrame, metrics: DataFrame) -> DataFrame | None:
        """Fact and growth parts; gives the current registrants whose company name changed."""
        if not buckets:
            return None
        staged = self._new("stg_financial_facts", buckets)
        old = self._before("dim_company", buckets, ()).select("cik", F.col("entity_name").alias("_name"))
        known = self._versions("stg_financial_facts", buckets)
        self._put("dim_company", buckets, D.dim_company(known.unionByName(rows.select(*known.columns))))
        self._put("fact_financial_reported", buckets, D.fact_financial_reported(staged, metrics))
        # One row for every registrant that has a staged fact.
        ciks = self._new("dim_company", buckets).select(F.col("cik").alias("source_cik"))
        companies = self.identities.join(ciks, "source_cik", "left_semi").select("company_key").distinct()
        growth = _values(companies, bucket("company_key"))
        if growth:
            of_parts = self.identities.where(bucket("company_key").isin(growth))
            sources = _values(of_parts, bucket("source_cik"))
            facts = self._new("fact_financial_reported", sources)
            rows = M.mart_company_financial_growth(facts, of_parts, self._before("dim_financial_metric", None, ()))
            self._put("mart_company_financial_growth", growth, rows)
        named = self._new("dim_company", buckets).join(old, "cik", "full_outer")
        renamed = named.where(differs(F.col("entity_name"), F.col("_name"))).select(F.col("cik").alias("source_cik"))
        return self.identities.where("is_current_registrant").join(renamed, "source_cik", "left_semi")

    def _observations(self, buckets: list[str], rows: DataFrame) -> tuple[list[str], bool]:
        """Macro parts; gives the months in which another observation is in force, and whether
        there is a new series."""
        if not buckets:
            return [], False
        staged = self._new("stg_macro_observations", buckets)
        old = self._before("fact_macro_observation", buckets, ())
        self._put("fact_macro_observation", buckets, D.fact_macro_observation(staged))
        self._put("dim_macro_series", buckets, D.dim_macro_series(staged))
        known = self._before("dim_macro_series", buckets, ())
        if not rows.select("series_id").distinct().join(known, "series_id", "left_anti").isEmpty():
            return [], True
        following = F.lead("observation_date").over(Window.partitionBy("series_id").orderBy("observation_date"))
        new = self._new("fact_macro_observation", buckets).withColumn("_next", following)
        same = old.select("series_id", "observation_date", F.struct("value").alias("_old"))
        # Only days that arrive can have another value, so only these are compared.
        arriving = rows.select("series_id", "observation_date").distinct()
        changed = (
            new.join(arriving, ["series_id", "observation_date"], "left_semi")
            .join(same, ["series_id", "observation_date"], "left")
            .where(differs(F.struct("value"), F.col("_old")))
        )
        last = self._last_price()
        until = F.coalesce(F.date_sub("_next", 1), F.lit(last), F.col("observation_date"))
        months = F.sequence(F.trunc("observation_date", "month"), F.greatest(until, "observation_date"), F.expr("INTERVAL 1 MONTH"))
        return _values(changed.select(F.explode(months).alias("_day")), month("_day")), False

    def _last_price(self) -> date | None:
        return self.now(MONTH_CLOSES).agg(F.max("trading_date")).first()[0]

    def _prices(self, months: list[str], symbols: DataFrame, renamed: DataFrame | None) -> list[str]:
        """Market facts of the touched months, and the performance of all months they reach."""
        name = "mart_company_daily_performance"
        if months:
            self._put("fact_market_daily", months, D.fact_market_daily(self._new("stg_market_prices", months)))
            self._put(MONTH_CLOSES, months, month_closes(self._new("fact_market_daily", months)))
        closes = self.now(MONTH_CLOSES)
        if renamed is not None and not renamed.isEmpty():
            every = _values(self._days(), month("trading_date"))
            return self._performance(name, sorted({*every, *months}))
        if not months:
            return []
        current = self.identities.where("is_current_registrant").select("company_key", F.col("current_ticker").alias("symbol"))
        companies = current.join(symbols, "symbol", "left_semi").select("company_key").distinct()
        held = closes.join(current.join(companies, "company_key", "left_semi"), "symbol").select("company_key", month("trading_date").alias("_month")).distinct()
        following = F.lead("_month").over(Window.partitionBy("company_key").orderBy("_month"))
        reached = held.withColumn("_next", following).where(F.col("_month").isin(months))
        return self._performance(name, sorted({*months, *_values(reached, F.col("_next"))}))

    def _performance(self, name: str, months: list[str]) -> list[str]:
        facts = self.now("fact_market_daily", months)
        # The last price before a month, of symbols with none in a month that is read anyway.
        listed = F.array(*[F.lit(m) for m in months])
        own = month("trading_date")
        following = F.lead(own).over(Window.partitionBy("symbol").orderBy(own))
        ahead = self.now(MONTH_CLOSES).withColumn("_own", own).withColumn("_next", following)
        reaches = F.exists(listed, lambda m: (F.col("_own") < m) & (F.col("_next").isNull() | (F.col("_next") >= m)))
        before = ahead.where(reaches & ~F.col("_own").isin(months)).select(*facts.columns)
        companies = self.now("dim_company")
        rows = M.mart_company_daily_performance(facts.unionByName(before), self.identities, companies)
        self._put(name, months, rows.where(own.isin(months)))
        return months

    def _market_macro(self, months: list[str], spans: list[str], new_series: bool) -> None:
        name = "mart_market_macro"
        every = _values(self.now(MONTH_CLOSES), month("trading_date")) if new_series or spans else []
        months = every if new_series else sorted({*months, *[m for m in every if m in set(spans)]})
        if not months:
            return
        observed = self.now("fact_macro_observation")
        performance = self.now("mart_company_daily_performance", months)
        rows = None
        for first, last in _ranges(months):
            days = observed.sparkSession.range(1).select(F.explode(F.array(F.lit(first), F.lit(last))).alias("trading_date"))
            here = performance.where(F.col("trading_date").between(F.lit(first), F.lit(last)))
            found = M.mart_market_macro(here, observed, days)
            rows = found if rows is None else rows.unionByName(found)
        self._put(name, months, rows)


def staged_runs(runs: DataFrame) -> DataFrame:
    return runs.select(*RUN_KEY)


__all__ = ["Delta", "MONTH_CLOSES", "PARTS", "STAGED", "STAGED_RUNS", "month_closes", "part", "staged_runs"]

"""The sample tables read as the engine's source tables.

The sample data holds no market or filings feed, so its tables play those parts:
line items are price quotes and reported facts of suppliers, orders are the ingestion
runs they arrived in, events are macro observations.  Every row of every table is used.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.relational import measured
from tidemark.plans.reference_data import financial_metrics
from tidemark.plans.relations import Relations
from tidemark.sources.scratch import kept

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table as it is stored."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> Column:
    """Two-digit amounts stored as doubles, as exact decimals."""
    return F.col(column).cast("decimal(18,2)")


def order_run(order: Column) -> Column:
    return F.concat(F.lit("19950101T"), F.lpad(order.cast("string"), 12, "0"), F.lit("Z"))


def event_run(day: Column) -> Column:
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lit("T000000000000Z"))


def symbol(supplier: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(supplier.cast("string"), 7, "0"))


def cik(supplier: Column) -> Column:
    return F.lpad((supplier + 1).cast("string"), 10, "0")


def row_number() -> Column:
    """A number that tells the line items of one order apart."""
    return (
        F.col("l_linenumber").cast("bigint") * 100_000_000_000_000_000
        + F.col("l_partkey") * 100_000_000
        + (money("l_extendedprice") * 100).cast("bigint")
    )


def _runs(df: DataFrame, identity: tuple[str, str], run: Column, at: Column, count: Column) -> DataFrame:
    source, dataset = identity
    path = F.concat(F.lit(f"{source}/{dataset}/run_id="), run)
    return df.select(
        F.lit(source).alias("source"),
        F.lit(dataset).alias("dataset"),
        run.alias("run_id"),
        at.cast("timestamp").alias("ingested_at"),
        F.concat(path, F.lit("/payload.json")).alias("raw_json_path"),
        F.concat(path, F.lit("/data.parquet")).alias("parquet_path"),
        count.cast("bigint").alias("record_count"),
        (at.cast("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("loaded_at"),
    )


def price_runs(spark: SparkSession, sf_dir: str, identity: tuple[str, str] = S.PRICES) -> DataFrame:
    """One run per order; it declares as many records as the order has line items."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return _runs(
        orders, identity, order_run(F.col("o_orderkey")), F.col("o_orderdate").cast("date"),
        F.coalesce("n", F.lit(0)),
    )


def run_stamps(spark: SparkSession, sf_dir: str, identity: tuple[str, str]) -> DataFrame:
    """The order runs without their record counts, for joins that only need the stamps."""
    orders = table(spark, sf_dir, "orders")
    return _runs(orders, identity, order_run(F.col("o_orderkey")), F.col("o_orderdate").cast("date"), F.lit(0))


def observation_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event day."""
    days = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count("*").alias("n")
    )
    return _runs(days, S.SERIES_OBSERVATIONS, event_run(F.col("day")), F.col("day"), F.col("n"))


def ingestion_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        run_stamps(spark, sf_dir, S.PRICES)
        .unionByName(run_stamps(spark, sf_dir, S.COMPANY_FACTS))
        .unionByName(observation_runs(spark, sf_dir))
    )


def market_daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    close = money("l_extendedprice")
    discount, tax = money("l_discount"), money("l_tax")
    return table(spark, sf_dir, "lineitem").select(
        F.lit(S.PRICES[0]).alias("source"),
        F.lit(S.PRICES[1]).alias("dataset"),
        order_run(F.col("l_orderkey")).alias("run_id"),
        row_number().alias("source_row_number"),
        symbol(F.col("l_suppkey")).alias("symbol"),
        F.col("l_shipdate").cast("date").alias("trading_date"),
        (close - discount).cast(S.PRICE).alias("open"),
        (close + tax).cast(S.PRICE).alias("high"),
        (close - discount * 2).cast(S.PRICE).alias("low"),
        close.cast(S.PRICE).alias("close"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("bigint")).alias("volume"),
    )


def _concept() -> Column:
    # Line numbers 1-6 report the mapped concepts, 7 one that is not mapped.
    names = [
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "NetIncomeLoss",
        "Assets",
        "Liabilities",
        "StockholdersEquity",
        "NetCashProvidedByUsedInOperatingActivities",
        "Unmapped",
    ]
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col("l_linenumber"))


def sec_company_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("l_shipdate")
    instant = F.col("l_linenumber").isin(3, 4, 5)
    # A tax of 8 % marks half-year periods; they are not annual.
    start = F.make_date(year, F.when(F.col("l_tax") >= 0.08, F.lit(7)).otherwise(F.lit(1)), F.lit(1))
    shipped = F.col("l_shipdate").cast("date")
    value = (money("l_extendedprice") - F.when(F.col("l_discount") >= 0.09, F.lit(90000)).otherwise(F.lit(0))).cast(S.VALUE)
    return table(spark, sf_dir, "lineitem").select(
        F.lit(S.COMPANY_FACTS[0]).alias("source"),
        F.lit(S.COMPANY_FACTS[1]).alias("dataset"),
        order_run(F.col("l_orderkey")).alias("run_id"),
        row_number().alias("source_row_number"),
        cik(F.col("l_suppkey")).alias("cik"),
        F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string"), F.lit(" as of "), year.cast("string")).alias("entity_name"),
        F.lit("us-gaap").alias("taxonomy"),
        _concept().alias("concept"),
        F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("string").alias("description"),
        F.when(F.col("l_quantity") > 45, F.lit("shares")).otherwise(F.lit("USD")).alias("unit"),
        value.alias("value"),
        value.cast("string").alias("value_text"),
        F.lit(True).alias("value_exact"),
        F.when(~instant, start).alias("start_date"),
        F.make_date(year, F.lit(12), F.lit(31)).alias("end_date"),
        F.concat(
            F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
            F.lit("-"),
            F.date_format(shipped, "yy"),
            F.lit("-"),
            F.lpad((F.col("l_partkey") % 1_000_000).cast("string"), 6, "0"),
        ).alias("accession_number"),
        year.alias("fiscal_year"),
        F.when(F.col("l_linestatus") == "O", F.lit("FY")).otherwise(F.lit("Q4")).alias("fiscal_period"),
        F.when(F.col("l_returnflag") == "A", F.lit("10-K"))
        .when(F.col("l_returnflag") == "N", F.lit("10-K/A"))
        .otherwise(F.lit("10-Q"))
        .alias("form"),
        F.date_add(shipped, 45).alias("filed_date"),
        F.when(F.col("l_quantity") > 25, F.concat(F.lit("CY"), year.cast("string"))).alias("frame"),
    )


def fred_series_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations between 1995 and 2001; one series starts two years late."""
    late = F.when(F.col("event_type") == "signup", F.lit(730)).otherwise(F.lit(0))
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("event_id") % 2400).cast("int") + late)
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.when(k % 17 != 0, money("value").cast(S.VALUE))
    return table(spark, sf_dir, "events").select(
        F.lit(S.SERIES_OBSERVATIONS[0]).alias("source"),
        F.lit(S.SERIES_OBSERVATIONS[1]).alias("dataset"),
        event_run(F.col("ts").cast("date")).alias("run_id"),
        F.col("event_id").alias("source_row_number"),
        F.upper("event_type").alias("series_id"),
        F.date_add(day, (F.col("user_id") % 3).cast("int")).alias("realtime_start"),
        F.lit("9999-12-31").cast("date").alias("realtime_end"),
        day.alias("observation_date"),
        value.alias("value"),
        value.cast("string").alias("value_text"),
        F.lit(True).alias("value_exact"),
    )


def company_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring suppliers form one company: even successors, odd predecessors."""
    key = F.col("s_suppkey")
    even = key - key % 2
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("C"), F.lpad((even / 2).cast("bigint").cast("string"), 7, "0")).alias("company_key"),
        symbol(even).alias("current_ticker"),
        cik(key).alias("source_cik"),
        F.when(key % 2 == 0, F.lit("successor")).otherwise(F.lit("predecessor")).alias("registrant_role"),
        (key % 2 == 0).alias("is_current_registrant"),
    )


class SourceTables(Mapping):
    """The source tables, each built when it is asked for."""

    BUILDERS = {
        "ingestion_runs": ingestion_runs,
        "market_daily_prices": market_daily_prices,
        "sec_company_facts": sec_company_facts,
        "fred_series_observations": fred_series_observations,
    }

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._place = (spark, sf_dir)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self.BUILDERS[name](*self._place)
        return self._built[name]

    def __iter__(self):
        return iter(self.BUILDERS)

    def __len__(self) -> int:
        return len(self.BUILDERS)


def relations(spark: SparkSession, sf_dir: str, stored: Collection[str] = ()) -> Relations:
    """The modelled relations over the sample tables; those in ``stored`` are computed once."""
    return Relations(
        SourceTables(spark, sf_dir), company_identities(spark, sf_dir), financial_metrics(spark), kept, stored
    )


# --- payloads built from the sample rows ----------------------------------------
#
# Each payload is made from one row, and some rows get a planted violation, so both
# the accepted rows and the quarantine grow with the tables.

def _landing(df: DataFrame, identity: tuple[str, str], run: Column, entity: Column, at: Column, payload: Column) -> DataFrame:
    return df.select(
        F.lit(identity[0]).alias("source"),
        F.lit(identity[1]).alias("dataset"),
        at.cast("date").alias("ingestion_date"),
        run.alias("run_id"),
        entity.alias("entity"),
        at.cast("timestamp").alias("ingested_at"),
        payload.alias("payload"),
    )


def _positions(count: Column) -> Column:
    """0 .. count-1; empty for 0."""
    return F.filter(F.sequence(F.lit(0), count), lambda i: i < count)


def _planted(column: str, modulus: int) -> Column:
    return F.col(column) % modulus == 0


def price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price payload per order with 0 to 3 days."""
    orders = table(spark, sf_dir, "orders")
    price = money("o_totalprice")
    day = F.col("o_orderdate").cast("date")
    step = F.when(_planted("o_custkey", 13), F.lit(0)).otherwise(F.lit(1))
    high = F.when(_planted("o_custkey", 17), price - 6).otherwise(price + 5)
    values = F.transform(
        _positions((F.col("o_orderkey") % 4).cast("int")),
        lambda i: F.struct(
            F.date_add(day, i * step).cast("string").alias("datetime"),
            price.cast("string").alias("open"),
            high.cast("string").alias("high"),
            (price - 5).cast("string").alias("low"),
            (price + i).cast("string").alias("close"),
            (F.col("o_custkey") + i).cast("string").alias("volume"),
        ),
    )
    entity = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    named = F.when(_planted("o_custkey", 19), F.lit("other")).otherwise(F.concat(F.lit(" "), F.lower(entity), F.lit(" ")))
    interval = F.when(_planted("o_custkey", 11), F.lit("1week")).otherwise(F.lit("1day"))
    body = F.to_json(
        F.struct(F.struct(named.alias("symbol"), interval.alias("interval")).alias("meta"), values.alias("values"))
    )
    payload = F.when(_planted("o_custkey", 23), F.concat(body, F.lit("}"))).otherwise(body)
    return _landing(orders, S.PRICES, order_run(F.col("o_orderkey")), entity, day, payload)


def filing_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filings payload per order with 0 to 2 filings."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    positions = _positions((F.col("o_orderkey") % 3).cast("int"))

    def column(value) -> Column:
        return F.transform(positions, value)

    accession = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.date_format(day, "-yy-"))
    items = F.when(_planted("o_custkey", 13), F.array(F.lit("9.01"), F.lit("9.02"), F.lit("9.03"))).otherwise(
        column(lambda i: F.lit(" 2.02 "))
    )
    size = F.when(_planted("o_custkey", 17), F.lit(-1)).otherwise(F.col("o_custkey"))
    arrays = {
        "accessionNumber": column(lambda i: F.concat(accession, F.lpad(i.cast("string"), 6, "0"))),
        "filingDate": column(lambda i: F.date_add(day, i).cast("string")),
        "reportDate": column(lambda i: F.when(i == 0, F.lit("")).otherwise(day.cast("string"))),
        "acceptanceDateTime": column(lambda i: F.concat(day.cast("string"), F.lit("T16:30:00+02:00"))),
        "act": column(lambda i: F.lit("34")),
        "form": column(lambda i: F.when(i == 0, F.lit("10-K")).otherwise(F.lit("8-K"))),
        "fileNumber": column(lambda i: F.lit("")),
        "filmNumber": column(lambda i: F.lit(" ")),
        "items": items,
        "size": column(lambda i: size + i),
        "isXBRL": column(lambda i: i),
        "isInlineXBRL": column(lambda i: F.lit(0)),
        "primaryDocument": column(lambda i: F.lit("a.htm")),
        "primaryDocDescription": column(lambda i: F.col("o_orderpriority")),
    }
    recent = F.struct(*[c.alias(n) for n, c in arrays.items()])
    body = F.to_json(
        F.struct(
            F.col("o_custkey").cast("string").alias("cik"),
            F.concat(F.lit(" Customer "), F.col("o_custkey").cast("string")).alias("name"),
            F.struct(recent.alias("recent")).alias("filings"),
        )
    )
    return _landing(orders, S.SUBMISSIONS, order_run(F.col("o_orderkey")), F.col("o_custkey").cast("string"), day, body)


def fact_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One facts payload per order: two taxonomies, three concepts, 0 to 2 occurrences each."""
    # A file is as many tasks as it has row groups, often one; a payload is dear to parse.
    orders = measured(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")
    day = F.col("o_orderdate").cast("date")
    accession = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.date_format(day, "-yy-"), F.lit("000001"))
    start = F.when(_planted("o_custkey", 13), F.date_add(day, 9)).otherwise(F.date_sub(day, 364))

    def occurrences(scale: int) -> Column:
        return F.transform(
            _positions((F.col("o_orderkey") % 3).cast("int")),
            lambda i: F.struct(
                F.when(i == 0, start.cast("string")).alias("start"),
                day.cast("string").alias("end"),
                (money("o_totalprice") * scale + i).alias("val"),
                F.when(_planted("o_custkey", 17), F.lit("bad")).otherwise(accession).alias("accn"),
                F.year(day).alias("fy"),
                F.lit(" FY ").alias("fp"),
                F.lit("10-K").alias("form"),
                F.date_add(day, 30).cast("string").alias("filed"),
            ),
        )

    def concept(label: str, units: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), F.lit(" about it ").alias("description"), units.alias("units"))

    facts = F.create_map(
        F.lit("us-gaap"),
        F.create_map(
            F.lit("NetIncomeLoss"),
            concept(" Net income ", F.create_map(F.lit("USD"), occurrences(1), F.lit("EUR"), occurrences(2))),
            F.lit("Assets"),
            concept("Assets", F.create_map(F.lit("USD"), occurrences(3))),
        ),
        F.lit("dei"),
        F.create_map(F.lit("SharesOutstanding"), concept("  ", F.create_map(F.lit("shares"), occurrences(4)))),
    )
    # JSON leaves out a NULL start, which is how an instant is written.
    body = F.to_json(
        F.struct(
            F.when(_planted("o_custkey", 19), F.lit(0)).otherwise(F.col("o_custkey")).alias("cik"),
            F.lit("Entity").alias("entityName"),
            facts.alias("facts"),
        )
    )
    return _landing(orders, S.COMPANY_FACTS, order_run(F.col("o_orderkey")), F.col("o_custkey").cast("string"), day, body)


def series_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series payload per customer."""
    customers = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    start = F.date_add(F.lit("2000-01-01").cast("date"), (key % 1000).cast("int"))
    end = F.when(_planted("c_custkey", 13), F.date_sub(start, 1)).otherwise(F.date_add(start, 10))
    series = F.struct(
        F.concat(F.lit(" "), F.col("c_name")).alias("id"),
        start.cast("string").alias("realtime_start"),
        end.cast("string").alias("realtime_end"),
        F.col("c_mktsegment").alias("title"),
        start.cast("string").alias("observation_start"),
        start.cast("string").alias("observation_end"),
        F.lit("Monthly").alias("frequency"),
        F.lit("M").alias("frequency_short"),
        F.lit("Percent").alias("units"),
        F.lit("%").alias("units_short"),
        F.lit("None").alias("seasonal_adjustment"),
        F.lit("NSA").alias("seasonal_adjustment_short"),
        F.when(_planted("c_custkey", 17), F.lit("2024-01-02 07:31:02")).otherwise(F.lit("2024-01-02 07:31:02-06")).alias("last_updated"),
        F.col("c_nationkey").alias("popularity"),
        F.when(key % 2 == 0, F.lit("  ")).otherwise(F.lit(" note ")).alias("notes"),
    )
    copies = F.when(_planted("c_custkey", 19), F.array(series, series)).otherwise(F.array(series))
    body = F.to_json(F.struct(copies.alias("seriess")))
    run = F.concat(F.lit("20240101T"), F.lpad(key.cast("string"), 12, "0"), F.lit("Z"))
    return _landing(customers, S.SERIES_METADATA, run, F.col("c_name"), start, body)


def observation_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observations payload per event with 0 to 3 observations."""
    events = table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    k = F.get_json_object("props", "$.k").cast("int")
    step = F.when(_planted("user_id", 19), F.lit(0)).otherwise(F.lit(1))
    text = F.when(_planted("user_id", 17), F.lit("n/a")).otherwise(money("value").cast("string"))
    values = F.transform(
        _positions(k % 4),
        lambda i: F.struct(
            day.cast("string").alias("realtime_start"),
            F.when(_planted("user_id", 13), F.date_sub(day, 1)).otherwise(F.date_add(day, 1)).cast("string").alias("realtime_end"),
            F.date_add(day, i * step).cast("string").alias("date"),
            F.when(i == 2, F.lit(".")).otherwise(text).alias("value"),
        ),
    )
    body = F.to_json(F.struct(values.alias("observations")))
    run = F.concat(F.lit("20240101T"), F.lpad(F.col("event_id").cast("string"), 12, "0"), F.lit("Z"))
    return _landing(events, S.SERIES_OBSERVATIONS, run, F.upper("event_type"), day, body)


PAYLOADS = {
    "market_daily_prices": price_payloads,
    "sec_submissions": filing_payloads,
    "sec_company_facts": fact_payloads,
    "fred_series_metadata": series_payloads,
    "fred_series_observations": observation_payloads,
}

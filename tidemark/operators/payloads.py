"""Provider payloads -> typed rows, with whole-payload quarantine.

A parser takes the landing frame (one row per payload) and returns *verdicts*: the run
columns, ``reason`` (NULL when the payload is valid) and ``records`` (typed rows in
provider order).  One violation anywhere rejects the whole payload.  All checks,
including duplicate detection, happen inside the row, so parsing needs no shuffle and
its cost does not depend on how payloads are spread over sources.

``accepted_rows`` and ``quarantined`` split the verdicts.  When both are wanted, write
or checkpoint the verdicts first so the JSON is read once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numeric, temporal, text
from tidemark.schemas import CONTRACTS, ROW_KEY, RUN_KEY, TableContract

_REASON = "struct<rank:int,reason:string>"


# --- variant access -------------------------------------------------------------

def _at(value: Column, field: str) -> Column:
    """Field of a variant object; SQL NULL when it is absent."""
    return F.try_variant_get(value, f"$.{field}", "variant")


def _kind(value: Column) -> Column:
    """STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID or NULL for absent.

    Only used on scalars: describing a large object would walk all of it.
    """
    return F.schema_of_variant(value)


def _text(value: Column) -> Column:
    """The text of a JSON string; NULL for every other kind."""
    return F.when(_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _whole(value: Column) -> Column:
    """A JSON integer; NULL for other kinds (booleans and fractions included)."""
    return F.when(_kind(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def _is_absent_or_null(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def _list(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def _is_object(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "map<string,variant>").isNotNull()


def _read(item: Column, names: Sequence[str]) -> Column:
    """An object's fields as text and the kinds of all its fields, each in one call."""
    wanted = ",".join(f"`{n}`:string" for n in names)
    return F.struct(
        item.alias("item"),
        F.schema_of_variant(item).alias("kinds"),
        F.try_variant_get(item, "$", f"struct<{wanted}>").alias("text"),
    )


def _is_record(read: Column) -> Column:
    return F.coalesce(read["kinds"].startswith("OBJECT<"), F.lit(False))


def _field_is(read: Column, name: str, kind: str) -> Column:
    """Whether a field exists with a kind that starts with ``kind``.

    ``kinds`` reads ``OBJECT<a: STRING, b: BIGINT>``.  With nested objects the text could
    name a field of an inner one, so those rare records ask for the field itself.
    """
    kinds = read["kinds"]
    listed = kinds.contains(f"<{name}: {kind}") | kinds.contains(f", {name}: {kind}")
    is_flat = F.locate("<", kinds, len("OBJECT<") + 1) == 0
    found = F.when(is_flat, listed).otherwise(_kind(_at(read["item"], name)).startswith(kind))
    return F.coalesce(found, F.lit(False))


def _string(read: Column, name: str) -> Column:
    """The text of a string field; NULL for every other kind."""
    return F.when(_field_is(read, name, "STRING"), read["text"][name])


# --- violations -----------------------------------------------------------------

def _first_violation(*checks: tuple[Column, str], rank: int = 2) -> Column:
    """The first failed check of one record, NULL when all pass.

    A check whose condition is NULL counts as failed only if written that way.
    """
    found = F.lit(None).cast(_REASON)
    for failed, reason in reversed(checks):
        found = F.when(failed, F.struct(F.lit(rank).alias("rank"), F.lit(reason).alias("reason"))).otherwise(found)
    return found


def _repeated(keys: Column, rank: int, reason: str) -> Column:
    """Position and reason of the first repeated key, NULL when keys are distinct.

    The positions are only worked out for payloads that do have a repeat.
    """
    ordered = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    neighbours = F.arrays_zip(
        F.slice(ordered, 1, F.size(keys) - 1).alias("a"), F.slice(ordered, 2, F.size(keys) - 1).alias("b")
    )
    positions = F.transform(
        F.filter(neighbours, lambda p: p["a"]["k"] == p["b"]["k"]), lambda p: p["b"]["i"]
    )
    return F.when(
        F.size(F.array_distinct(keys)) < F.size(keys),
        F.struct(
            F.array_min(positions).alias("position"), F.lit(rank).alias("rank"), F.lit(reason).alias("reason")
        ),
    )


def _first_in_order(violations: Column, repeated: Column | None = None) -> Column:
    """The violation met first when reading records in order."""
    placed = F.transform(
        violations,
        lambda v, i: F.when(
            v.isNotNull(),
            F.struct(i.alias("position"), v["rank"].alias("rank"), v["reason"].alias("reason")),
        ),
    )
    first = F.array_min(placed)
    if repeated is not None:
        first = F.array_min(F.array(first, repeated))
    return first["reason"]


def _reason(*checks: tuple[Column, str]) -> Column:
    """The first failed payload-level check as text."""
    return _first_violation(*checks)["reason"]


# --- verdict handling -----------------------------------------------------------

def typed_fields(contract: TableContract) -> list[Column]:
    """The columns of a contract behind the lineage, out of the struct ``record``."""
    fields = [f for f in contract.schema.fields if f.name not in ROW_KEY]
    return [F.col(f"record.{f.name}").cast(f.dataType).alias(f.name) for f in fields]


def accepted_rows(verdicts: DataFrame, contract: TableContract) -> DataFrame:
    """Typed rows of the valid payloads, numbered from 0 in provider order."""
    rows = verdicts.where(F.col("reason").isNull()).select(
        *RUN_KEY, F.posexplode("records").alias("source_row_number", "record")
    )
    return rows.select(*RUN_KEY, F.col("source_row_number").cast("bigint"), *typed_fields(contract))


def stored_form(verdicts: DataFrame, contract: TableContract) -> DataFrame:
    """Verdicts whose records hold the contract's columns only, for writing them out."""
    names = [n for n in contract.schema.names if n not in ROW_KEY]
    slim = F.transform("records", lambda r: F.struct(*[r[n].alias(n) for n in names]))
    # Records of rejected payloads are never used.
    return verdicts.withColumn("records", F.when(F.col("reason").isNull(), slim))


def quarantined(verdicts: DataFrame) -> DataFrame:
    """One row per rejected payload with its reason."""
    return verdicts.where(F.col("reason").isNotNull()).select(*RUN_KEY, "entity", "reason")


def accepted_counts(verdicts: DataFrame) -> DataFrame:
    """Declared row count of each valid payload; empty payloads count 0."""
    return verdicts.where(F.col("reason").isNull()).select(
        *RUN_KEY, "entity", "ingested_at", F.size("records").cast("bigint").alias("record_count")
    )


def strict_json(payload: Column) -> Column:
    """The payload as ``[payload, 0]``, NULL when it is not JSON.

    The parser stops after the first complete value, so text behind it would go
    unnoticed.  Behind the payload stands a sentinel here: the payload is exactly one
    JSON value if and only if the sentinel is found at position 1 and nothing at 2.
    """
    return F.try_parse_json(F.concat(F.lit("["), payload, F.lit(",0]")))


def is_single_value(strict: Column) -> Column:
    sentinel = F.try_variant_get(strict, "$[1]", "int").eqNullSafe(F.lit(0))
    return sentinel & F.try_variant_get(strict, "$[2]", "variant").isNull()


def _once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Project columns so that they are evaluated exactly once per row.

    The optimizer copies an expression into every filter above it, which would parse a
    payload again for each rule.  It does not look through a generator.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def _opened(landing: DataFrame) -> DataFrame:
    """Parse strictly (NaN and infinities are not JSON) and note whether it is an object."""
    payload = F.col("payload")
    parsed = _once(
        landing, *RUN_KEY, "entity", "ingested_at", payload.rlike(r"^\s*\{").alias("_braced"), strict_json(payload).alias("_strict")
    )
    single = F.col("_braced") & is_single_value(F.col("_strict"))
    return parsed.select(
        *RUN_KEY,
        "entity",
        "ingested_at",
        F.when(single, F.try_variant_get("_strict", "$[0]", "variant")).alias("_json"),
        (~single).alias("_not_object"),
    )


def _verdicts(df: DataFrame, reason: Column, records: Column) -> DataFrame:
    return _once(df, *RUN_KEY, "entity", "ingested_at", reason.alias("reason"), records.alias("records"))


def _with_records(df: DataFrame, records: Column) -> DataFrame:
    return _once(df, *df.columns, records.alias("records"))


# --- daily prices ---------------------------------------------------------------

_PRICE_FIELDS = ("open", "high", "low", "close")


def parse_prices(landing: DataFrame) -> DataFrame:
    """Daily OHLCV payloads: ``meta`` with symbol and interval, ``values`` list."""
    expected = text.normalised_symbol(F.col("entity"))
    symbol = text.normalised_symbol(_text(_at(F.col("_json"), "meta.symbol")))
    opened = _opened(landing).select(
        *RUN_KEY, "entity", "ingested_at",
        "_not_object",
        (~_is_object(F.col("_json"), "$.meta")).alias("_no_meta"),
        expected.alias("_expected"),
        symbol.alias("_symbol"),
        _text(_at(F.col("_json"), "meta.interval")).alias("_interval"),
        _list(F.col("_json"), "$.values").alias("_values"),
    )

    def read(item: Column) -> Column:
        return _read(item, ["datetime", *_PRICE_FIELDS, "volume"])

    def raw(r: Column) -> Column:
        is_number = _field_is(r, "volume", "BIGINT") | _field_is(r, "volume", "STRING")
        return F.struct(
            _is_record(r).alias("is_object"),
            _string(r, "datetime").alias("day"),
            *[_string(r, f).alias(f) for f in _PRICE_FIELDS],
            r["text"]["volume"].isNotNull().alias("has_volume"),
            F.when(is_number, text.strip(r["text"]["volume"])).alias("volume"),
        )

    def typed(r: Column) -> Column:
        return F.struct(
            F.col("_symbol").alias("symbol"),
            temporal.strict_date(r["day"]).alias("trading_date"),
            *[numeric.to_decimal(r[f], 38, 18).alias(f) for f in _PRICE_FIELDS],
            numeric.non_negative_count(r["volume"]).alias("volume"),
            r.alias("raw"),
            F.forall(
                F.array(*[r[f] for f in _PRICE_FIELDS]), lambda p: numeric.fits_exactly(p, 38, 18)
            ).alias("fits"),
        )

    # A rule only looks at the written form once the typed value is missing.
    def violation(t: Column) -> Column:
        r = t["raw"]
        written = F.coalesce(r["day"].rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.lit(False))
        no_day = t["trading_date"].isNull()
        early = _first_violation(
            (~r["is_object"], "entry of values has to be an object"),
            (no_day & ~written, "datetime is not written year-month-day"),
            (no_day, "datetime is no calendar date"),
            rank=0,
        )
        prices = [
            check
            for f in _PRICE_FIELDS
            for check in (
                (t[f].isNull() & ~text.is_not_blank(r[f]), f"{f} has to be text with a number"),
                (t[f].isNull() & ~numeric.is_decimal_literal(r[f]), f"{f} is no finite decimal"),
            )
        ]
        late = _first_violation(
            *prices,
            (t["high"] < t["low"], "high lies below low"),
            (t["high"] < t["open"], "high lies below open"),
            (t["high"] < t["close"], "high lies below close"),
            (t["low"] > t["open"], "low lies above open"),
            (t["low"] > t["close"], "low lies above close"),
            (t["volume"].isNull() & r["volume"].rlike(r"^-0*[1-9][0-9]*$"), "volume is negative"),
            (r["has_volume"] & t["volume"].isNull(), "volume is no whole number"),
        )
        return F.coalesce(early, late)

    records = _with_records(opened, F.transform(F.transform(F.transform("_values", read), raw), typed))
    days = F.transform("records", lambda t: t["trading_date"].cast("string"))
    in_records = _first_in_order(
        F.transform("records", violation), _repeated(days, 1, "trading date comes twice")
    )
    reason = F.coalesce(
        _reason(
            (~text.is_not_blank(F.col("_expected")), "symbol asked for is blank"),
            (F.col("_not_object"), "not exactly one strict JSON object"),
            (F.col("_no_meta"), "meta has to be an object"),
            (~text.is_not_blank(F.col("_symbol")), "meta.symbol is blank"),
            (F.col("_symbol") != F.col("_expected"), "symbol is not the one asked for"),
            (~F.col("_interval").eqNullSafe(F.lit("1day")), "meta.interval differs from 1day"),
            (F.col("_values").isNull(), "values has to be a list"),
        ),
        in_records,
        F.when(F.exists("records", lambda t: ~t["fits"]), F.lit("prices have more digits than are stored")),
    )
    return _verdicts(records, reason, F.col("records"))


# --- filings --------------------------------------------------------------------

# Provider array names of the filings payload.
FILING_FIELDS = (
    "accessionNumber",
    "filingDate",
    "reportDate",
    "acceptanceDateTime",
    "act",
    "form",
    "fileNumber",
    "filmNumber",
    "items",
    "size",
    "isXBRL",
    "isInlineXBRL",
    "primaryDocument",
    "primaryDocDescription",
)
_OPTIONAL_TEXT = {
    "act": "act",
    "fileNumber": "file_number",
    "filmNumber": "film_number",
    "items": "items",
    "primaryDocument": "primary_document",
    "primaryDocDescription": "primary_doc_description",
}


def _registrant(value: Column) -> Column:
    """Ten-digit key from a JSON string or positive integer."""
    return text.cik10(F.coalesce(_text(value), _whole(value).cast("string")))


def parse_submissions(landing: DataFrame) -> DataFrame:
    """Filings payloads: 14 parallel arrays of equal length under ``filings.recent``."""
    json = F.col("_json")
    opened = _opened(landing).select(
        *RUN_KEY, "entity", "ingested_at",
        "_not_object",
        text.cik10(F.col("entity")).alias("_expected"),
        _registrant(_at(json, "cik")).alias("_cik"),
        _text(_at(json, "name")).alias("_name"),
        (~_is_object(json, "$.filings")).alias("_no_filings"),
        (~_is_object(json, "$.filings.recent")).alias("_no_recent"),
        *[_list(json, f"$.filings.recent.{f}").alias(f"_{f}") for f in FILING_FIELDS],
    )
    sizes = F.array_distinct(F.array(*[F.size(f"_{f}") for f in FILING_FIELDS]))
    aligned = F.arrays_zip(*[F.col(f"_{f}").alias(f) for f in FILING_FIELDS])

    def raw(r: Column) -> Column:
        return F.struct(
            *[_text(r[f]).alias(f) for f in FILING_FIELDS if f not in ("size", "isXBRL", "isInlineXBRL")],
            *[_whole(r[f]).alias(f) for f in ("size", "isXBRL", "isInlineXBRL")],
        )

    def typed(r: Column) -> Column:
        return F.struct(
            F.col("_cik").alias("cik"),
            text.strip(F.col("_name")).alias("company_name"),
            r["accessionNumber"].alias("accession_number"),
            temporal.strict_date(r["filingDate"]).alias("filing_date"),
            temporal.strict_date(r["reportDate"]).alias("report_date"),
            temporal.strict_instant(r["acceptanceDateTime"]).alias("acceptance_datetime"),
            r["form"].alias("form"),
            *[text.blank_to_null(r[f]).alias(name) for f, name in _OPTIONAL_TEXT.items()],
            r["size"].alias("size"),
            (r["isXBRL"] == 1).alias("is_xbrl"),
            (r["isInlineXBRL"] == 1).alias("is_inline_xbrl"),
            r.alias("raw"),
        )

    def violation(t: Column) -> Column:
        r = t["raw"]
        early = _first_violation(
            (~text.is_accession(r["accessionNumber"]), "accessionNumber is no accession number"),
            rank=0,
        )
        late = _first_violation(
            (t["filing_date"].isNull(), "filingDate is no calendar date"),
            (
                t["report_date"].isNull() & ~r["reportDate"].eqNullSafe(F.lit("")),
                "reportDate is neither empty nor a calendar date",
            ),
            (r["acceptanceDateTime"].isNull(), "acceptanceDateTime has to be text"),
            (
                text.is_not_blank(r["acceptanceDateTime"]) & ~temporal.has_zone(r["acceptanceDateTime"]),
                "acceptanceDateTime lacks an offset",
            ),
            (
                text.is_not_blank(r["acceptanceDateTime"]) & t["acceptance_datetime"].isNull(),
                "acceptanceDateTime is no instant",
            ),
            (~text.is_not_blank(r["form"]), "form is blank"),
            *[(r[f].isNull(), f"{f} has to be text") for f in ("act", "fileNumber", "filmNumber", "items")],
            (~F.coalesce(r["size"] >= 0, F.lit(False)), "size has to be a whole number, zero or more"),
            *[
                (~F.coalesce(r[f].isin(0, 1), F.lit(False)), f"{f} is neither 0 nor 1")
                for f in ("isXBRL", "isInlineXBRL")
            ],
            *[(r[f].isNull(), f"{f} has to be text") for f in ("primaryDocument", "primaryDocDescription")],
        )
        return F.coalesce(early, late)

    checked = _with_records(opened, F.transform(F.transform(aligned, raw), typed))
    accessions = F.transform("records", lambda t: t["accession_number"])
    reason = F.coalesce(
        _reason(
            (F.col("_expected").isNull(), "expected cik is invalid"),
            (F.col("_not_object"), "not exactly one strict JSON object"),
            (F.col("_cik").isNull(), "payload.cik is invalid"),
            (F.col("_cik") != F.col("_expected"), "registrant is not the one asked for"),
            (~text.is_not_blank(F.col("_name")), "name is blank"),
            (F.col("_no_filings"), "filings has to be an object"),
            (F.col("_no_recent"), "filings.recent has to be an object"),
            *[(F.col(f"_{f}").isNull(), f"filings.recent.{f} has to be a list") for f in FILING_FIELDS],
            (F.size(sizes) != 1, "filings.recent has lists of different lengths"),
        ),
        _first_in_order(
            F.transform("records", violation),
            _repeated(accessions, 1, "accessionNumber comes twice"),
        ),
    )
    return _verdicts(checked, reason, F.col("records"))


# --- company facts --------------------------------------------------------------

# Maps keep the provider's key order; variant objects would sort their keys.
# The last array element is a sentinel: it shows that the payload is one JSON value.
_FACTS = (
    "array<struct<_sentinel:int, cik:variant, entityName:variant, "
    "facts:map<string,map<string,struct<label:variant,description:variant,"
    "units:map<string,array<variant>>>>>>>"
)
_OCCURRENCE_FIELDS = ("start", "end", "val", "accn", "fy", "fp", "form", "filed", "frame")


def parse_company_facts(landing: DataFrame) -> DataFrame:
    """Facts payloads: taxonomy -> concept -> unit -> occurrences, flattened in order."""
    wrapped = F.concat(F.lit("["), F.col("payload"), F.lit(',{"_sentinel":0}]'))
    parsed = _once(
        landing, *RUN_KEY, "entity", "ingested_at", F.col("payload").rlike(r"^\s*\{").alias("_braced"),
        F.from_json(wrapped, _FACTS, {"allowNonNumericNumbers": "false"}).alias("_json"),
    )
    single = F.col("_braced") & F.coalesce(
        (F.size("_json") == 2) & (F.try_element_at("_json", F.lit(2))["_sentinel"] == 0), F.lit(False)
    )
    body = F.try_element_at("_json", F.lit(1))
    opened = parsed.select(
        *RUN_KEY, "entity", "ingested_at",
        (~single).alias("_not_object"),
        text.cik10(F.col("entity")).alias("_expected"),
        _registrant(body["cik"]).alias("_cik"),
        text.strip(_text(body["entityName"])).alias("_entity_name"),
        F.when(single, body["facts"]).alias("_facts"),
    )

    def occurrence(
        taxonomy: Column, concept: Column, label: Column, description: Column, unit: Column, item: Column, broken: Column
    ) -> Column:
        return F.struct(
            taxonomy.alias("taxonomy"),
            concept.alias("concept"),
            label.alias("label"),
            description.alias("description"),
            unit.alias("unit"),
            item.alias("item"),
            broken.alias("broken"),
        )

    no_text = F.lit(None).cast("string")
    no_item = F.lit(None).cast("variant")

    def bad_kind(value: Column) -> Column:
        return value.isNull() | ~_kind(value).isin("STRING", "VOID")

    def of_unit(taxonomy: Column, concept: Column, label: Column, description: Column) -> Callable[[Column], Column]:
        def expand(entry: Column) -> Column:
            broken = (
                F.when(~text.is_not_blank(entry["key"]), "unit is blank")
                .when(entry["value"].isNull(), "unit has to be a list")
            )
            row = (taxonomy, concept, label, description, entry["key"])
            return F.when(broken.isNotNull(), F.array(occurrence(*row, no_item, broken))).otherwise(
                F.transform(entry["value"], lambda item: occurrence(*row, item, no_text))
            )

        return expand

    def described(entry: Column) -> Column:
        body = entry["value"]
        return F.struct(
            entry["key"].alias("concept"),
            text.blank_to_null(_text(body["label"])).alias("label"),
            text.keep_if_not_blank(_text(body["description"])).alias("description"),
            F.map_entries(body["units"]).alias("units"),
            F.when(~text.is_not_blank(entry["key"]), "concept is blank")
            .when(body.isNull(), "concept has to be an object")
            .when(bad_kind(body["label"]), "label has to be text or null")
            .when(bad_kind(body["description"]), "description has to be text or null")
            .when(body["units"].isNull(), "units has to be an object")
            .alias("broken"),
        )

    def of_concept(taxonomy: Column) -> Callable[[Column], Column]:
        def expand(c: Column) -> Column:
            row = (taxonomy, c["concept"], c["label"], c["description"])
            return F.when(
                c["broken"].isNotNull(), F.array(occurrence(*row, no_text, no_item, c["broken"]))
            ).otherwise(F.flatten(F.transform(c["units"], of_unit(*row))))

        return expand

    def of_taxonomy(entry: Column) -> Column:
        broken = (
            F.when(~text.is_not_blank(entry["key"]), "taxonomy is blank")
            .when(entry["value"].isNull(), "taxonomy has to be an object")
        )
        nothing = occurrence(entry["key"], no_text, no_text, no_text, no_text, no_item, broken)
        concepts = F.transform(F.map_entries(entry["value"]), described)
        return F.when(broken.isNotNull(), F.array(nothing)).otherwise(
            F.flatten(F.transform(concepts, of_concept(entry["key"])))
        )

    flat = opened.withColumn(
        "_flat", F.flatten(F.transform(F.map_entries("_facts"), of_taxonomy))
    )

    def read(o: Column) -> Column:
        return F.struct(
            *[o[f].alias(f) for f in ("taxonomy", "concept", "unit", "label", "description", "broken")],
            _read(o["item"], _OCCURRENCE_FIELDS).alias("read"),
        )

    def raw(o: Column) -> Column:
        r = o["read"]
        value = r["text"]["val"]
        is_decimal = _field_is(r, "val", "DECIMAL")
        # Whole numbers keep every digit; fractions take the shortest form of the double.
        literal = (
            F.when(_field_is(r, "val", "BIGINT") | (is_decimal & ~value.contains(".")), value)
            .when(is_decimal | _field_is(r, "val", "DOUBLE"), value.try_cast("double").cast("string"))
        )
        return F.struct(
            *[o[f].alias(f) for f in ("taxonomy", "concept", "unit", "broken", "label", "description")],
            _is_record(r).alias("is_object"),
            _field_is(r, "start", "").alias("has_start"),
            *[_string(r, f).alias(f) for f in ("start", "end", "accn", "fp", "form", "filed", "frame")],
            *[r["text"][f].isNull().alias(f"no_{f}") for f in ("fy", "fp", "frame")],
            F.when(_field_is(r, "fy", "BIGINT"), r["text"]["fy"].cast("bigint")).alias("fy"),
            literal.alias("val"),
        )

    def typed(r: Column) -> Column:
        return F.struct(
            F.col("_cik").alias("cik"),
            F.col("_entity_name").alias("entity_name"),
            *[r[f].alias(f) for f in ("taxonomy", "concept", "label", "description", "unit")],
            numeric.to_decimal(r["val"], 38, 10).alias("value"),
            r["val"].alias("value_text"),
            numeric.fits_exactly(r["val"], 38, 10).alias("value_exact"),
            temporal.strict_date(r["start"]).alias("start_date"),
            temporal.strict_date(r["end"]).alias("end_date"),
            r["accn"].alias("accession_number"),
            r["fy"].try_cast("int").alias("fiscal_year"),
            text.blank_to_null(r["fp"]).alias("fiscal_period"),
            text.strip(r["form"]).alias("form"),
            temporal.strict_date(r["filed"]).alias("filed_date"),
            text.blank_to_null(r["frame"]).alias("frame"),
            r.alias("raw"),
        )

    def violation(t: Column) -> Column:
        r = t["raw"]
        structural = F.when(
            r["broken"].isNotNull(), F.struct(F.lit(2).alias("rank"), r["broken"].alias("reason"))
        )
        return F.coalesce(
            structural,
            _first_violation(
                (~r["is_object"], "fact occurrence has to be an object"),
                (r["has_start"] & t["start_date"].isNull(), "start is no calendar date"),
                (t["end_date"].isNull(), "end is no calendar date"),
                (t["start_date"] > t["end_date"], "start lies after end"),
                (~text.is_not_blank(r["form"]), "form is blank"),
                (r["val"].isNull() | r["val"].isin("NaN", "Infinity", "-Infinity"), "val is no finite number"),
                (~text.is_accession(r["accn"]), "accn is no accession number"),
                (~r["no_fy"] & ~F.coalesce(r["fy"] > 0, F.lit(False)), "fy has to be a whole number above zero"),
                (~r["no_fp"] & r["fp"].isNull(), "fp has to be text"),
                (t["filed_date"].isNull(), "filed is no calendar date"),
                (~r["no_frame"] & r["frame"].isNull(), "frame has to be text"),
                (r["fy"].isNotNull() & t["fiscal_year"].isNull(), "fy is too large"),
                (~t["value_exact"], "val has more digits than are stored"),
            ),
        )

    checked = _with_records(flat.drop("_facts"), F.transform(F.transform(F.transform("_flat", read), raw), typed)).drop(
        "_flat"
    )
    reason = F.coalesce(
        _reason(
            (F.col("_expected").isNull(), "expected cik is invalid"),
            (F.col("_not_object"), "not exactly one strict JSON object"),
            (F.col("_cik").isNull(), "payload.cik is invalid"),
            (F.col("_cik") != F.col("_expected"), "registrant is not the one asked for"),
            (~text.is_not_blank(F.col("_entity_name")), "entityName is blank"),
            (F.col("records").isNull(), "facts is not nested by taxonomy, concept and unit"),
        ),
        _first_in_order(F.transform("records", violation)),
    )
    return _verdicts(checked, reason, F.col("records"))


# --- macro series ---------------------------------------------------------------

_SERIES_TEXT = (
    "title",
    "frequency",
    "frequency_short",
    "units",
    "units_short",
    "seasonal_adjustment",
    "seasonal_adjustment_short",
)
_SERIES_DAYS = ("realtime_start", "realtime_end", "observation_start", "observation_end")


def parse_series_metadata(landing: DataFrame) -> DataFrame:
    """Series payloads: ``seriess`` holds exactly one series."""
    opened = _opened(landing).withColumn("_seriess", _list(F.col("_json"), "$.seriess"))
    item = F.try_element_at("_seriess", F.lit(1))
    flat = opened.select(
        *RUN_KEY, "entity", "ingested_at",
        "_not_object",
        F.size("_seriess").alias("_count"),
        _is_object(item).alias("_is_object"),
        text.blank_to_null(F.col("entity")).alias("_expected"),
        text.blank_to_null(_text(_at(item, "id"))).alias("series_id"),
        *[temporal.strict_date(_text(_at(item, f))).alias(f) for f in _SERIES_DAYS],
        *[text.blank_to_null(_text(_at(item, f))).alias(f) for f in _SERIES_TEXT],
        text.strip(_text(_at(item, "last_updated"))).alias("_updated"),
        _whole(_at(item, "popularity")).alias("popularity"),
        (~_is_absent_or_null(_at(item, "notes")) & _text(_at(item, "notes")).isNull()).alias("_bad_notes"),
        text.blank_to_null(_text(_at(item, "notes"))).alias("notes"),
    ).withColumn("last_updated", temporal.strict_instant(F.col("_updated")))
    reason = _reason(
        (F.col("_expected").isNull(), "series asked for has to be text that is not blank"),
        (F.col("_not_object"), "not exactly one strict JSON object"),
        (F.col("_count").isNull() | (F.col("_count") < 0), "seriess has to be a list"),
        (F.col("_count") != 1, "seriess holds none or several series"),
        (~F.col("_is_object"), "series item has to be an object"),
        (F.col("series_id").isNull(), "id has to be text that is not blank"),
        (F.col("series_id") != F.col("_expected"), "series is not the one asked for"),
        (F.col("realtime_start").isNull(), "realtime_start is no calendar date"),
        (F.col("realtime_end").isNull(), "realtime_end is no calendar date"),
        (F.col("realtime_start") > F.col("realtime_end"), "realtime_start lies after realtime_end"),
        (F.col("observation_start").isNull(), "observation_start is no calendar date"),
        (F.col("observation_end").isNull(), "observation_end is no calendar date"),
        (F.col("observation_start") > F.col("observation_end"), "observation_start lies after observation_end"),
        *[(F.col(f).isNull(), f"{f} has to be text that is not blank") for f in _SERIES_TEXT],
        (~text.is_not_blank(F.col("_updated")), "last_updated has to be text that is not blank"),
        (~temporal.has_zone(F.col("_updated")), "last_updated lacks an offset"),
        (F.col("last_updated").isNull(), "last_updated is no instant"),
        (~F.coalesce(F.col("popularity") >= 0, F.lit(False)), "popularity has to be a whole number, zero or more"),
        (F.col("_bad_notes"), "notes has to be text or null"),
    )
    fields = [f.name for f in CONTRACTS["fred_series_metadata"].schema.fields][4:]
    return _verdicts(flat, reason, F.array(F.struct(*fields)))


def parse_observations(landing: DataFrame) -> DataFrame:
    """Observation payloads.  The missing marker becomes NULL; the row stays."""
    opened = _opened(landing).select(
        *RUN_KEY, "entity", "ingested_at",
        "_not_object",
        text.blank_to_null(F.col("entity")).alias("_expected"),
        _list(F.col("_json"), "$.observations").alias("_values"),
    )

    fields = ("realtime_start", "realtime_end", "date", "value")

    def read(item: Column) -> Column:
        return _read(item, fields)

    def raw(r: Column) -> Column:
        return F.struct(_is_record(r).alias("is_object"), *[_string(r, f).alias(f) for f in fields])

    def typed(r: Column) -> Column:
        missing = numeric.is_missing(r["value"])
        return F.struct(
            F.col("_expected").alias("series_id"),
            temporal.strict_date(r["realtime_start"]).alias("realtime_start"),
            temporal.strict_date(r["realtime_end"]).alias("realtime_end"),
            temporal.strict_date(r["date"]).alias("observation_date"),
            F.when(~missing, numeric.to_decimal(r["value"], 38, 10)).alias("value"),
            F.when(~missing, text.strip(r["value"])).alias("value_text"),
            (missing | numeric.fits_exactly(r["value"], 38, 10)).alias("value_exact"),
            r["is_object"].alias("is_object"),
            r["value"].alias("literal"),
        )

    def violation(t: Column) -> Column:
        return _first_violation(
            (~t["is_object"], "observation item has to be an object"),
            (t["realtime_start"].isNull(), "realtime_start is no calendar date"),
            (t["realtime_end"].isNull(), "realtime_end is no calendar date"),
            (t["realtime_start"] > t["realtime_end"], "realtime_start lies after realtime_end"),
            (t["observation_date"].isNull(), "date is no calendar date"),
            (t["literal"].isNull(), "value has to be text"),
            (~text.is_not_blank(t["literal"]), "value is blank"),
            (
                ~numeric.is_missing(t["literal"]) & ~numeric.is_decimal_literal(t["literal"]),
                "value is no finite decimal",
            ),
            (~t["value_exact"], "value has more digits than are stored"),
            rank=0,
        )

    checked = _with_records(opened, F.transform(F.transform(F.transform("_values", read), raw), typed))
    occurrences = F.transform(
        "records",
        lambda t: F.concat_ws("|", t["observation_date"], t["realtime_start"], t["realtime_end"]),
    )
    reason = F.coalesce(
        _reason(
            (F.col("_expected").isNull(), "series asked for has to be text that is not blank"),
            (F.col("_not_object"), "not exactly one strict JSON object"),
            (F.col("_values").isNull(), "observations has to be a list"),
        ),
        _first_in_order(
            F.transform("records", violation), _repeated(occurrences, 1, "observation comes twice")
        ),
    )
    return _verdicts(checked, reason, F.col("records"))


PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "market_daily_prices": parse_prices,
    "sec_submissions": parse_submissions,
    "sec_company_facts": parse_company_facts,
    "fred_series_metadata": parse_series_metadata,
    "fred_series_observations": parse_observations,
}


def parse(landing: DataFrame, table: str) -> DataFrame:
    """Verdicts for the payloads of one table's dataset; other payloads are ignored."""
    source, dataset = CONTRACTS[table].identity
    mine = landing.where((F.col("source") == source) & (F.col("dataset") == dataset))
    return PARSERS[table](mine)


def parse_all(landing: DataFrame, tables: Sequence[str] = tuple(PARSERS)) -> dict[str, DataFrame]:
    return {table: parse(landing, table) for table in tables}

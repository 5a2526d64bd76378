"""Key normalisation, identifier formats and the run-id codec."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def normalised_symbol(text: Column) -> Column:
    return F.upper(strip(text))


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or NULL when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def keep_if_not_blank(text: Column) -> Column:
    """The text as it came (untrimmed), or NULL when it is blank."""
    return F.when(is_not_blank(text), text)


def is_not_blank(text: Column) -> Column:
    """True for text with at least one visible character; False for NULL."""
    return F.coalesce(strip(text) != "", F.lit(False))


def cik10(text: Column) -> Column:
    """Ten-digit registrant key, or NULL when the input is not 1-10 digits above zero."""
    valid = text.rlike(r"^[0-9]{1,10}\z") & text.rlike("[1-9]")
    return F.when(valid, F.lpad(text, 10, "0"))


def is_accession(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[0-9]{10}-[0-9]{2}-[0-9]{6}\z"), F.lit(False))


def encoded_entity(entity: Column) -> Column:
    """URL-safe base64 of the UTF-8 text without padding."""
    packed = F.base64(F.encode(entity, "UTF-8"))
    # Long inputs are wrapped into lines by the encoder; the breaks go with the padding.
    return F.regexp_replace(F.translate(packed, "+/", "-_"), r"[=\r\n]", "")


def decoded_entity(token: Column) -> Column:
    packed = F.translate(token, "-_", "+/")
    padding = F.repeat(F.lit("="), F.pmod(-F.length(packed), F.lit(4)))
    return F.decode(F.unbase64(F.concat(packed, padding)), "UTF-8")


def run_id(ingested_at: Column, entity: Column | None = None) -> Column:
    """``yyyyMMddTHHmmssffffffZ`` in UTC, plus ``--entity-<token>`` when one is given.

    ``ingested_at`` is read in the session time zone, which the engine pins to UTC.
    """
    stamp = F.concat(
        F.date_format(ingested_at, "yyyyMMdd"),
        F.lit("T"),
        F.date_format(ingested_at, "HHmmssSSSSSS"),
        F.lit("Z"),
    )
    if entity is None:
        return stamp
    return F.concat(
        stamp, F.coalesce(F.concat(F.lit("--entity-"), encoded_entity(entity)), F.lit(""))
    )


def run_entity(run: Column) -> Column:
    """The entity encoded in a run id, NULL when it names none."""
    token = F.regexp_extract(run, r"--entity-([A-Za-z0-9_-]+)$", 1)
    return F.when(token != "", decoded_entity(token))


def run_instant(run: Column) -> Column:
    """The ingestion instant encoded in a run id."""
    return F.try_to_timestamp(
        F.regexp_extract(run, r"^([0-9]{8}T[0-9]{12})Z", 1), F.lit("yyyyMMdd'T'HHmmssSSSSSS")
    )


def metric_short_name(name: Column) -> Column:
    """Display label of a metric; unknown names pass through."""
    # Report labels.
    return (
        F.when(name == "Equity Attributable to Parent", "Equity")
        .when(name == "Net Income (Loss) Attributable to Parent", "Net Income")
        .when(name == "Operating Cash Flow", "Operating Cash Flow")
        # The label search ignores case, like the report's own substring test.
        .when(F.lower(name).contains("revenue from contracts with customers"), "Revenue")
        .when(name == "Total Assets", "Total Assets")
        .when(name == "Total Liabilities", "Total Liabilities")
        .otherwise(name)
    )

"""Registered queries: a Spark callable and, where SQL can express it, the same in SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import pin
from workload import sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: BIGINT, DOUBLE, BOOLEAN and text."""
    columns = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType | T.FloatType):
            value = value.cast("double")
        elif isinstance(f.dataType, T.IntegerType | T.ShortType | T.ByteType):
            value = value.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        columns.append(value.alias(f.name))
    return df.select(*columns)


def digits(column: Column, scale: int = 10) -> Column:
    """A decimal with all its digits as text, the way ``CAST(... AS VARCHAR)`` prints it."""
    exact = column.cast(f"decimal(38,{scale})")
    return F.when(exact == 0, "0." + "0" * scale).otherwise(exact.cast("string"))


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query.  ``oracle`` may use the shared relations of ``workload.sql``."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(pin(spark), sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_relations(oracle)
        return build

    return add


def with_relations(body: str) -> str:
    """Put the shared relations a statement uses in front of it, in dependency order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name, definition in sql.RELATIONS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(definition)
    parts = [f"{name} AS ({definition.strip()})" for name, definition in sql.RELATIONS.items() if name in needed]
    if not parts:
        return body.strip()
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body

"""Named queries and, where SQL can say the same, the SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.catalogue.tables import SQL_VIEWS, Tables
from tidewell.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, settings: dict[str, str] | None = None):
    """Register a function from tables to a result under `name`; `settings` are what its session has besides the usual ones."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return present(build(Tables(apply_settings(spark, settings), folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register


def present(df: DataFrame) -> DataFrame:
    """Result columns in types every engine reads the same way."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            column = F.unix_millis(column.cast("timestamp"))
        elif kind in ("tinyint", "smallint", "int"):
            column = column.cast("bigint")
        elif kind == "float" or kind.startswith("decimal"):
            column = column.cast("double")
        out.append(column.alias(name))
    return df.select(*out)


def with_views(sql: str) -> str:
    """Put the views `sql` uses, and those they use, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in SQL_VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    text = sql.strip()
    parts = [f"{name} AS ({SQL_VIEWS[name].strip()})" for name in needed]
    if text.upper().startswith("WITH "):
        parts.append(text[5:])
        return "WITH " + ",\n".join(parts)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + text


def rnd(expr: str, digits: int = 6) -> str:
    """SQL text of `round_to`."""
    return f"floor(CAST({expr} AS DOUBLE) * 1e{digits} + 0.5) / 1e{digits}"

"""Collecting queries, and the SQL pieces several of them share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def add(run: Run) -> Run:
        if run.__name__ in REGISTRY:
            raise ValueError(f"{run.__name__} is registered twice")
        REGISTRY[run.__name__] = Query(run, sql)
        return run

    return add


def sum2(x: str) -> str:
    return f"round(sum({x}), 2)"


def avg2(x: str) -> str:
    return f"round(avg({x}), 2)"


def money(x: str) -> str:
    return f"try_cast(regexp_replace({x}, '[^0-9.]', '', 'g') AS DOUBLE)"


def dollars(x: str) -> str:
    return f"try_cast(translate({x}, '$,', '') AS DOUBLE)"


def bucket(text: str) -> str:
    return f"CAST(concat('0x', substr(md5({text}), 1, 8)) AS BIGINT)"

"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

USAGE_CTE = f"usage_log AS ({fx.USAGE_LOG})"
REQUEST_CTE = f"request_log AS ({fx.REQUEST_LOG})"
SMSC_CTE = f"smsc AS ({fx.SMSC_FIELDS})"
DIMENSION_CTES = f"country_code_reference AS ({fx.COUNTRY_CODES}), roaming_destination AS ({fx.ROAMING_DESTINATIONS})"

#: Half-open windows as SQL conditions.
IN_USAGE = "usage_start_time >= TIMESTAMP '2024-01-05 00:00:00' AND usage_start_time < TIMESTAMP '2024-01-19 00:00:00'"
IN_REQUEST = "req_time >= TIMESTAMP '1998-01-01 00:00:00' AND req_time < TIMESTAMP '1999-01-01 00:00:00'"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``name`` with its SQL twin."""

    def put(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return put


def on_usage(name: str, sql: str) -> Callable:
    """Registers a function of the usage log; ``sql`` reads ``usage_log``."""

    def put(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        query(name, f"WITH {USAGE_CTE}, {DIMENSION_CTES} {sql}")(lambda spark, sf_dir: f(fx.usage_log(spark, sf_dir)))
        return f

    return put


def on_request(name: str, sql: str) -> Callable:
    def put(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        query(name, f"WITH {REQUEST_CTE} {sql}")(lambda spark, sf_dir: f(fx.request_log(spark, sf_dir)))
        return f

    return put


def on_smsc(name: str, sql: str) -> Callable:
    def put(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        query(name, f"WITH {SMSC_CTE} {sql}")(lambda spark, sf_dir: f(fx.smsc_fields(spark, sf_dir)))
        return f

    return put

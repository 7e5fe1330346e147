"""Grouped reports: one filter, named keys, named measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

Keys = dict[str, Column]


def money(total: Column) -> Column:
    """A rounded decimal as a double, which keeps its printed value."""
    return total.cast("double")


def count() -> Column:
    return F.count("*")


def sum_rounded(x: Column | str, digits: int = 2) -> Column:
    """Rounded once, after the sum."""
    return money(F.round(F.sum(x), digits))


def sum_of_rounded(x: Column, digits: int = 2) -> Column:
    """Every row is rounded first; the two differ, and both are used."""
    return money(F.sum(F.round(x, digits)))


def minutes_of_sum(x: Column | str) -> Column:
    return money(F.round(F.sum(x) / 60, 2))


def grouped(df: DataFrame, where: Column | None, keys: Keys, measures: Keys) -> DataFrame:
    """Filter, then one grouped aggregation.  Only the partial sums of each task are
    shuffled, so a key that holds most rows (home network, own number range) is
    no hot partition.  Without keys there is always one row."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(*[c.alias(n) for n, c in measures.items()])


def value_counts(df: DataFrame, *columns: str, where: Column | None = None, total: str | None = None) -> DataFrame:
    measures = {"n": count()} | ({"total": sum_rounded(total)} if total else {})
    return grouped(df, where, {c: F.col(c) for c in columns}, measures)

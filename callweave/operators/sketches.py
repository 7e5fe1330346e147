"""Distinct counts over any window from one mergeable sketch a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LG_K = 14  # 16,384 registers of at most 8 bits
ERROR = 0.02  # three standard errors of a sketch of that size


def daily_sketches(df: DataFrame, day: str, value: str) -> DataFrame:
    """(day, rows, sketch): a sketch of the values of each day.  Nulls count as rows only."""
    return df.groupBy(F.col(day).alias("day")).agg(F.count("*").alias("rows"), F.hll_sketch_agg(value, F.lit(LG_K)).alias("sketch"))


def distinct_in(sketches: DataFrame, start: str, end: str) -> DataFrame:
    """(rows, estimate) over the inclusive days: only their sketches are read and merged, so a
    value on several days counts once.  A window without days has no rows and an estimate of 0."""
    window = sketches.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    merged = window.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("rows", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("estimate"))

"""Dimension lookups: destination country by longest dialling prefix, roaming network."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

MOST_CODES = 20_000  # rows of a code table that is broadcast; there are some hundred codes in the world


def one_country_per_code(codes: DataFrame) -> DataFrame:
    """Codes that countries share go to the first country by name; rows without a code are left out."""
    return codes.where("country_code <> ''").groupBy("country_code").agg(F.min("country").alias("country"))


def by_length(codes: DataFrame) -> dict[int, DataFrame] | None:
    """(code, country) tables for each length of code, as local relations; None if
    there are more than MOST_CODES rows."""
    import pyarrow as pa

    rows = codes.select("country_code", "country").limit(MOST_CODES + 1).collect()
    if len(rows) > MOST_CODES:
        return None
    first: dict[str, str] = {}
    for code, country in rows:
        if code:
            first[code] = min(first.get(code, country), country)
    tables = {}
    for n in sorted({len(c) for c in first}, reverse=True):
        part = sorted((c, x) for c, x in first.items() if len(c) == n)
        tables[n] = codes.sparkSession.createDataFrame(pa.table({f"__code{n}": [c for c, _ in part], f"__country{n}": [x for _, x in part]}))
    return tables


def country_by_prefix(calls: DataFrame, codes: DataFrame, number: str = "opposite_number") -> DataFrame:
    """``calls`` with destination_country, matched_country_code (both UNMAPPED where
    no code fits) and unmatched_number_prefix.

    One broadcast equi-join for each length of code, longest first in the
    coalesce, instead of a LIKE join and a ROW_NUMBER: no shuffle and no sort of
    the calls.  A code table of more than MOST_CODES rows is joined without a
    broadcast hint.
    """
    tables = by_length(codes)
    if tables is None:
        large = one_country_per_code(codes)
        lengths = sorted((r[0] for r in large.select(F.length("country_code")).distinct().collect()), reverse=True)
        tables = {n: large.where(F.length("country_code") == n).select(F.col("country_code").alias(f"__code{n}"), F.col("country").alias(f"__country{n}")) for n in lengths}
    else:
        tables = {n: F.broadcast(part) for n, part in tables.items()}
    out = calls
    for n, part in tables.items():
        out = out.join(part, F.substring(number, 1, n) == F.col(f"__code{n}"), "left")
    none = F.lit(None).cast("string")
    country = F.coalesce(*[F.col(f"__country{n}") for n in tables], none)
    code = F.coalesce(*[F.col(f"__code{n}") for n in tables], none)
    return out.select(
        *calls.columns,
        F.coalesce(country, F.lit("UNMAPPED")).alias("destination_country"),
        F.coalesce(code, F.lit("UNMAPPED")).alias("matched_country_code"),
        F.when(country.isNull(), F.substring(number, 1, max(tables, default=0))).alias("unmatched_number_prefix"),
    )


def country_by_row_number(calls: DataFrame, codes: DataFrame, key: str, number: str = "opposite_number") -> DataFrame:
    """The same by prefix matches ranked within each call: for code tables whose
    lengths are unbounded.  Shuffles the calls by ``key``."""
    codes = one_country_per_code(codes)
    matches = [calls.select(key, F.substring(number, 1, n).alias("country_code")) for n in sorted(r[0] for r in codes.select(F.length("country_code")).distinct().collect())]
    found = reduce(DataFrame.unionByName, matches).join(codes, "country_code")
    best = Window.partitionBy(key).orderBy(F.desc(F.length("country_code")), F.desc("country_code"))
    top = found.withColumn("rn", F.row_number().over(best)).where("rn = 1").select(key, "country", "country_code")
    return calls.join(top, key, "left").select(
        *calls.columns,
        F.coalesce("country", F.lit("UNMAPPED")).alias("destination_country"),
        F.coalesce("country_code", F.lit("UNMAPPED")).alias("matched_country_code"),
    )


def roaming_network(calls: DataFrame, destinations: DataFrame) -> DataFrame:
    """``calls`` with country, mcc and network name of their roaming destination.

    The country of an unknown destination is UNMAPPED, its mcc the one of the
    visited network, and the visited network is kept for review.
    """
    dim = destinations.select(
        "roaming_destination_id", F.col("country").alias("__country"), F.col("mcc").alias("__mcc"), "roaming_destination_name"
    )
    visited = F.when(F.col("roaming_mccmnc").isNotNull(), F.substring("roaming_mccmnc", 1, 3))
    return calls.join(dim, "roaming_destination_id", "left").select(
        *calls.columns,
        F.coalesce("__country", F.lit("UNMAPPED")).alias("roaming_country"),
        F.coalesce("__mcc", visited, F.lit("UNMAPPED")).alias("mcc"),
        "roaming_destination_name",
        F.when(F.col("__country").isNull(), F.col("roaming_mccmnc")).alias("unmatched_mccmnc"),
    )

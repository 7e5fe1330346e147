"""CSV sources with fixed layouts: cells are cleaned and cast, bad rows set aside."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from .records import WHITE, numbered_cells
from .scratch import scratch

Layout = list[tuple[str, str]]
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm"]


def nullify(cell: Column, dates: bool = False) -> Column:
    """Trimmed cell; empty and NULL in any case become null, for dates N/A too."""
    text = F.btrim(cell, F.lit(WHITE))
    spelled = ["", "NULL", "N/A"] if dates else ["", "NULL"]
    return F.when(~F.upper(text).isin(spelled), text)


def header_of(spark: SparkSession, path: str) -> str:
    """First line of the first file, without a byte-order mark."""
    return (spark.read.text(path).first() or [""])[0].lstrip("﻿")


def read_cells(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> DataFrame:
    """All cells as strings, in the order of ``names``; quoted cells may hold
    separators and line ends, quotes are doubled, surplus cells make ``_corrupt``."""
    schema = ", ".join(f"`{n}` string" for n in [*names, "_corrupt"])
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": True, "enforceSchema": True, "columnNameOfCorruptRecord": "_corrupt", "ignoreLeadingWhiteSpace": False}
    return spark.read.schema(schema).options(**options).csv(path)


def cast_cells(cells: DataFrame, layout: Layout, key: str) -> DataFrame:
    """``cells``, as ``numbered_cells`` has them, cast to ``layout``, with ``bad``: the first cell in layout order that
    does not cast, or the key where it is missing; a row with a wrong number of
    cells is bad as a whole.  Three narrow steps keep the generated code small."""
    names = [n for n, _ in layout]
    extra = [c for c in cells.columns if c not in names and c != "_corrupt"]
    corrupt = F.col("_corrupt") if "_corrupt" in cells.columns else F.lit(None).cast("string")
    clean = cells.select(*[F.when(~F.col(n).isin("N/A", "N/a", "n/A", "n/a"), F.col(n)).alias(n) if kind == "timestamp_ntz" else n for n, kind in layout], *extra, corrupt.alias("__corrupt"))
    cast = clean.select("*", *[F.col(n).try_cast(kind).alias(f"__{n}") for n, kind in layout if kind != "string"])
    failed = [
        F.when((F.col(n).isNotNull() & F.col(f"__{n}").isNull()) if n != key else F.col(f"__{n}").isNull(), F.lit(i))
        for i, (n, kind) in enumerate(layout, 1)
        if kind != "string"
    ]
    marked = cast.withColumn("__at", F.coalesce(*failed))
    one_bad = F.struct(
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("__at")).alias("column_name"),
        F.element_at(F.array(*names), F.col("__at")).alias("bad_value"),
        F.concat(F.lit("not a "), F.element_at(F.array(*[F.lit(kind) for _, kind in layout]), F.col("__at"))).alias("error_message"),
    )
    whole_bad = F.struct(F.lit("(row)").alias("column_name"), F.col("__corrupt").alias("bad_value"), F.lit("wrong number of cells").alias("error_message"))
    return marked.select(
        *[F.col(n if kind == "string" else f"__{n}").alias(n) for n, kind in layout],
        *extra,
        F.col(key).alias("row_identifier"),
        F.when(F.col("__corrupt").isNotNull(), whole_bad).when(F.col("__at").isNotNull(), one_bad).alias("bad"),
    )


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside are not generated as methods that the JVM's compiler refuses for their
    length (8,000 bytes) and interprets; some sixty columns make such methods."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), 8000))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def good_and_bad(cells: DataFrame, layout: Layout, table: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that cast, and (table_name, source_path, row_number, row_identifier,
    column_name, bad_value, error_message) of those that do not.

    All rows are handed over as a table first: files are read and cells are cast once for
    both, and a filter on the good rows does not make Spark look for constraints
    in some hundred renamed and cast columns, which takes minutes.
    """
    rows = cast_cells(cells, layout, key)
    path = scratch(cells.sparkSession, "cast-cells")
    with small_methods(cells.sparkSession):
        rows.write.parquet(path)
    rows = cells.sparkSession.read.schema(rows.schema).parquet(path)
    bad = rows.where(F.col("bad").isNotNull()).select(F.lit(table).alias("table_name"), "source_path", "row_number", "row_identifier", "bad.*")
    return rows.where(F.col("bad").isNull()).select(*[n for n, _ in layout]), bad


def read_usage_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rejected rows are numbered from 1 in their file, without the header."""
    return good_and_bad(numbered_cells(spark, path, [n for n, _ in schemas.USAGE_LOG]), schemas.USAGE_LOG, "usage_log", "usage_log_id")


def read_request_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The header must name the 62 columns in order.  It is row 1, so rejected rows count from 2."""
    names = [n for n, _ in schemas.REQUEST_LOG]
    found = [h.strip().strip('"') for h in header_of(spark, path).split(",")]
    if found != names:
        raise ValueError(f"unexpected header: {found[:5]}... has {len(found)} columns")
    return good_and_bad(numbered_cells(spark, path, names, first=2), schemas.REQUEST_LOG, "request_log", "request_log_id")


def read_service_plan_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """As in request files, the header is row 1."""
    return good_and_bad(numbered_cells(spark, path, [n for n, _ in schemas.SERVICE_PLAN], first=2), schemas.SERVICE_PLAN, "sim_service_plan", "sim_service_plan_id")


def read_country_codes(spark: SparkSession, path: str) -> DataFrame:
    """(country, country_code); blank rows are skipped, half-empty ones are an error."""
    if header_of(spark, path).strip().lower() != "country,country code":
        raise ValueError("unexpected header of a country code file")
    rows = read_cells(spark, path, ["country", "country_code"]).select(*[F.coalesce(F.trim(F.col(c)), F.lit("")).alias(c) for c in ("country", "country_code")])
    rows = rows.where("country <> '' or country_code <> ''")
    if not rows.where("country = '' or country_code = ''").isEmpty():
        raise ValueError("a row lacks its country or its code")
    return rows


#: Fixed value: the header of roaming destination files.
ROAMING_HEADERS = {
    "roamingDestinationId": "roaming_destination_id",
    "serviceProvider": "service_provider",
    "country": "country",
    "roaming Destination Name": "roaming_destination_name",
    "mcc": "mcc",
    "remarks": "remarks",
    "Created at": "created_at",
    "Updated at": "updated_at",
}
DATED = ["Created at", "Updated at"]


def parse_date(cell: Column) -> Column:
    """A date in one of three formats; empty and N/A are null, and so is what fits none."""
    text = nullify(cell, dates=True)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]).cast("timestamp_ntz")


def read_roaming_destinations(spark: SparkSession, path: str) -> DataFrame:
    """The separator (comma, tab, semicolon or bar) is taken from the header, whose
    columns may be in any order.  An id or date that does not parse is an error."""
    header = header_of(spark, path)
    sep = max(",\t;|", key=header.count)
    names = [h.strip().strip('"') for h in header.split(sep)]
    missing = [h for h in ROAMING_HEADERS if h not in names]
    if missing:
        raise ValueError(f"missing headers: {', '.join(missing)}")
    cells = read_cells(spark, path, names, sep)
    rows = cells.where(F.concat_ws("", *[F.trim(F.col(f"`{n}`")) for n in names]) != "")
    out = rows.select(
        F.trim("roamingDestinationId").try_cast("bigint").alias("roaming_destination_id"),
        *[(parse_date(F.col(f"`{h}`")) if h in DATED else F.coalesce(F.trim(F.col(f"`{h}`")), F.lit(""))).alias(n) for h, n in list(ROAMING_HEADERS.items())[1:]],
        *[nullify(F.col(f"`{h}`"), dates=True).alias(f"__{i}") for i, h in enumerate(DATED)],
    )
    unread = F.col("roaming_destination_id").isNull()
    for i, h in enumerate(DATED):
        unread = unread | F.col(f"__{i}").isNotNull() & F.col(ROAMING_HEADERS[h]).isNull()
    if not out.where(unread).isEmpty():
        raise ValueError("a row has an id or a date that cannot be read")
    return out.drop(*[f"__{i}" for i in range(len(DATED))])

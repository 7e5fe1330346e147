"""SMS-centre log files: discovery, numbered lines, and a tolerant parser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..schemas import SMSC_FIELDS
from .delimited import nullify
from .scratch import scratch

#: Fixed value: the name of a day's log file.
FILE_NAME = r"^cdr\.log\.(\d{4}-\d{2}-\d{2})$"
MOST_SPLITS = 1_000_000  # rows about splits that are broadcast
#: A comma and the cell after it: quoted to the closing quote and on to the next comma,
#: quoted without a closing quote, plain, or empty.
CELL = r'\G,("[^"]*+(?:""[^"]*+)*+(?:"[^,]*+|$)|[^",][^,]*+|)'

#: Lines whose quotes open and close whole cells, without doubled ones.
REGULAR = r'\A(?:"[^"\x01]*+"|[^",\x01]*+)(?:,(?:"[^"\x01]*+"|[^",\x01]*+))*+\z'


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, modification_time) of all files below ``folder``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modification_time"))


def plain_path(path: Column) -> Column:
    """A path in one spelling: readers and listings write local ones with one or three slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def file_date(path: Column | str) -> Column:
    """The day in a log file's name; null for other names."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.try_to_date(F.nullif(F.regexp_extract(name, FILE_NAME, 1), F.lit("")))


def discover(listing: DataFrame, today: Column) -> DataFrame:
    """Log files of complete days, with file_date, in the order of date and path."""
    dated = listing.withColumn("file_date", file_date("path"))
    return dated.where(F.col("file_date") < today).orderBy("file_date", "path")


def skip_processed(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that the manifest lacks, or has with another size or time."""
    return files.join(manifest.select("path", "length", "modification_time"), ["path", "length", "modification_time"], "left_anti")


#: A line of text with its file and the start of its split in it.
PLACED_LINE = ("_metadata.file_path AS source_path", "_metadata.file_block_start AS start", "value AS raw_line")


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_path, line_number from 1, raw_line) of text files that Spark splits."""
    return numbered(spark.read.text(paths).selectExpr(*PLACED_LINE))


def numbered(lines: DataFrame) -> DataFrame:
    """Lines (PLACED_LINE, of a batch or a micro-batch) with their numbers in the file.

    Rows of a split are numbered by position; the first number and the count of
    each split, one row a split, are joined back.  Up to MOST_SPLITS of them are
    broadcast, so that lines are not shuffled; the text is read twice.
    """
    lines = lines.withColumn("at", F.monotonically_increasing_id())
    splits = lines.groupBy("source_path", "start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("source_path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("source_path", "start", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    path = scratch(lines.sparkSession, "splits")
    splits.write.parquet(path)
    before = lines.sparkSession.read.schema(splits.schema).parquet(path)
    if before.count() <= MOST_SPLITS:
        before = F.broadcast(before)
    return lines.join(before, ["source_path", "start"]).select("source_path", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_number"), "raw_line")


def cells_of(payload: Column) -> Column:
    """Cells of one line of CSV, in expressions alone.

    A cell that begins with a quote runs to the closing one, or to the end where
    there is none, and two quotes in it stand for one; elsewhere quotes are plain
    characters.  Lines without quotes are split at the commas, and so are regular ones
    after commas between quotes have been put aside; only others are matched cell by cell.
    """
    parts = F.transform(F.split(payload, '"', -1), lambda x, i: F.when(i % 2 == 1, F.translate(x, ",", "\1")).otherwise(x))
    regular = F.transform(F.split(F.array_join(parts, ""), ",", -1), lambda x: F.translate(x, "\1", ","))
    quoted = F.regexp_extract_all(F.concat(F.lit(","), payload), F.lit(CELL), F.lit(1))
    inside, rest = F.lit('^"([^"]*+(?:""[^"]*+)*+)'), F.lit('^"[^"]*+(?:""[^"]*+)*+"?')

    def plain(cell: Column) -> Column:
        text = F.concat(F.replace(F.regexp_substr(cell, inside), F.lit('""'), F.lit('"')), F.regexp_replace(cell, rest, F.lit("")))
        return F.when(cell.startswith('"'), F.substring(text, F.lit(2), F.length(text))).otherwise(cell)

    return F.when(~payload.contains('"'), F.split(payload, ",", -1)).when(payload.rlike(REGULAR), regular).otherwise(F.transform(quoted, plain))


def parse_lines(lines: DataFrame, layout: list[str] = SMSC_FIELDS, least_fields: int = 0, exact_null: bool = False) -> DataFrame:
    """``lines`` (source_path, line_number, raw_line) with the fields of ``layout``.

    error is INVALID_PREFIX where no ``] `` or nothing after it is found and
    CSV_ERROR where fewer than ``least_fields`` cells are; such rows have null
    fields.  Missing trailing fields are null, surplus ones go to extra_fields.
    ``exact_null`` is the older rule: only empty and ``null`` cells become null,
    and cells are not trimmed.
    """
    at = F.instr("raw_line", "] ")
    payload = F.when(at > 0, F.nullif(F.trim(F.expr("substring(raw_line, instr(raw_line, '] ') + 2)")), F.lit("")))
    rows = lines.withColumn("raw_cdr", payload).withColumn("cells", cells_of(F.col("raw_cdr")))
    size = F.coalesce(F.size("cells"), F.lit(0))
    error = F.when(F.col("raw_cdr").isNull(), "INVALID_PREFIX")
    if least_fields:  # otherwise a filter on the error needs no cells
        error = error.when(size < least_fields, "CSV_ERROR")
    rows = rows.select("*", error.alias("error"), size.alias("raw_fields_count"))

    def field(i: int) -> Column:
        cell = F.get("cells", F.lit(i))
        cell = F.when((cell != "") & (cell != "null"), cell) if exact_null else nullify(cell)
        return F.when(F.col("error").isNull(), cell)

    n = len(layout)
    extra = F.when(F.col("error").isNull() & (F.col("raw_fields_count") > n), F.slice("cells", F.lit(n + 1), F.col("raw_fields_count"))).otherwise(F.array().cast("array<string>"))
    return rows.select("source_path", "line_number", "raw_line", "raw_cdr", "raw_fields_count", "error", *[field(i).alias(f) for i, f in enumerate(layout)], extra.alias("extra_fields"))


def line_counts() -> list[Column]:
    """Counts of parsed lines: all, without error, and by error."""
    error = F.col("error")
    return [
        F.count("*").alias("lines"), F.count_if(error.isNull()).alias("rows"),
        F.count_if(error.eqNullSafe("INVALID_PREFIX")).alias("invalid_prefix"), F.count_if(error.eqNullSafe("CSV_ERROR")).alias("parse_errors"),
    ]


def file_stats(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("source_path").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("error").isNull()).alias("loaded"),
        F.count_if(F.col("error").eqNullSafe("INVALID_PREFIX")).alias("invalid_prefix"),
        F.count_if(F.col("error").eqNullSafe("CSV_ERROR")).alias("parse_errors"),
    )

"""Tables stored by day: reads prune days, loads rewrite only the days they touch.

A load keeps the stored rows that it does not replace, adds its own, and writes
the touched days beside the table first.  Only when that is complete does Spark's
dynamic partition overwrite put them in place, and a load that broke off between
the two is finished by the next one, so no day is ever lost or half new.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

DAY = "day"
PENDING = "_pending"  # readers skip names with an underscore
ROWS_A_FILE = 5_000_000
MOST_KEYS = 1_000_000  # keys of a load that are broadcast; more are joined by a shuffle


def _at(spark: SparkSession, path: str):  # type: ignore[no-untyped-def]
    """The store that Spark itself uses for a path, and the path in it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def _delete(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.delete(place, True)


def with_day(df: DataFrame, time_col: str | Column, unit: str = "day") -> DataFrame:
    """``df`` with its day, or the first day of its ``unit`` (week, month) where days are thin."""
    day = F.to_date(time_col)
    return df.withColumn(DAY, day if unit == "day" else F.trunc(day, unit))


def stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, of ``schema`` with its day; no rows where nothing was loaded yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.names)


def in_days(table: DataFrame, time_col: str, start: str, end: str, unit: str = "day") -> DataFrame:
    """Rows of the inclusive days ``start`` to ``end``: the range on the day prunes folders,
    and the half-open range on the time keeps the report's own condition."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    since = first if unit == "day" else F.trunc(first, unit)
    times = (F.col(time_col) >= first.cast("timestamp_ntz")) & (F.col(time_col) < F.date_add(last, 1).cast("timestamp_ntz"))
    return table.where((F.col(DAY) >= since) & (F.col(DAY) <= last) & times)


def _finish(spark: SparkSession, path: str, schema: StructType) -> None:
    """Puts the days of a complete pending load in place, and forgets an incomplete one."""
    pending = f"{path}/{PENDING}"
    if not _exists(spark, pending):
        return
    if _exists(spark, f"{pending}/rows/_SUCCESS"):
        days = spark.read.schema(schema).option("basePath", f"{pending}/rows").parquet(f"{pending}/rows")
        days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", ROWS_A_FILE).partitionBy(DAY).parquet(path)
        # A touched day of which nothing is left has no folder that could overwrite it.
        gone = spark.read.parquet(f"{pending}/days").join(days.select(DAY).distinct(), DAY, "left_anti").collect()
        for r in gone:
            _delete(spark, f"{path}/{DAY}={r[DAY]}")
    _delete(spark, pending)


def merged(table: DataFrame, rows: DataFrame, replaced: DataFrame) -> DataFrame:
    """``table`` without the rows whose columns match ``replaced``, and ``rows``.  Nothing is
    ranked: the table is only probed, and stays where it is if the keys are few."""
    keys = replaced.columns
    match = reduce(lambda a, b: a & b, [table[k].eqNullSafe(replaced[k]) for k in keys])
    few = F.broadcast(replaced) if replaced.count() <= MOST_KEYS else replaced
    return table.join(few, match, "left_anti").unionByName(rows)


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the largest ``order`` of each key; nulls come first, and null keys are values."""
    newest = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order))
    return rows.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__rank")


def load(spark: SparkSession, path: str, rows: DataFrame, replaced: DataFrame, days: DataFrame | None = None) -> None:
    """Puts ``rows`` (with their day) into the table at ``path``, in place of its rows whose
    columns match a row of ``replaced``.

    ``days`` (day) are the days that ``replaced`` can have rows in; without it these are the
    days of ``rows``, so a key must not move from one day to another.  A row without a day is an error.
    Loading the same rows again changes nothing.
    """
    schema = rows.schema
    _finish(spark, path, schema)
    dated = rows.withColumn(DAY, F.coalesce(DAY, F.raise_error(F.lit("a row has no day")).cast("date")))
    touched = dated.select(DAY).distinct() if days is None else dated.select(DAY).union(days.select(DAY)).distinct()
    touched = touched.where(F.col(DAY).isNotNull())
    names = [r[DAY] for r in touched.orderBy(DAY).collect()]  # one value a day
    table = stored(spark, path, schema).where(F.col(DAY).isin(names)) if names else stored(spark, path, schema).limit(0)
    spark.createDataFrame([(d,) for d in names], f"{DAY} date").write.mode("overwrite").parquet(f"{path}/{PENDING}/days")
    # Days are dealt out by Spark according to their size: large ones to several tasks, small ones together.
    out = merged(table, dated, replaced).hint("rebalance", DAY)
    out.write.mode("overwrite").option("maxRecordsPerFile", ROWS_A_FILE).partitionBy(DAY).parquet(f"{path}/{PENDING}/rows")
    _finish(spark, path, schema)


def upsert(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], order: str) -> None:
    """A load in which the last row of each key wins over earlier ones and over the table."""
    from .upsert import handed_over

    last = handed_over(latest(rows, keys, order), "load")
    load(spark, path, last, last.select(*keys).distinct())


def write_in_order(df: DataFrame, path: str, time_col: str, *then: str) -> None:
    """A listing by day and time: folders by day, files in the order of their names, rows in
    order inside.  The sort is split by ranges of time, so no task sorts it all."""
    dated = with_day(df, time_col)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = dated.repartitionByRange(parts, DAY, time_col, *then).sortWithinPartitions(DAY, time_col, *then)
    ranged.write.option("maxRecordsPerFile", ROWS_A_FILE).partitionBy(DAY).parquet(path)

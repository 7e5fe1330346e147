"""Increments of a growing table by its id, with a checkpoint that outlives the driver.

A load reads the ids after the checkpoint up to the largest one that it finds first,
writes them to a folder of its own number, and commits the checkpoint after that.
What was written without a checkpoint is no part of the copy, and the next load
writes the same folder again: a load that was killed in between neither loses rows
nor loads any twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

STATE = "upper_id long, rows long, load int"


class Source(NamedTuple):
    """``upper(after)``: the largest id over ``after``, or None; ``read(after, upto)``: the rows between."""

    upper: Callable[[int], int | None]
    read: Callable[[int, int], DataFrame]


class Increment(NamedTuple):
    load: int
    rows: int
    checkpoint: int


def frame_source(rows: DataFrame, key: str) -> Source:
    """A table that Spark reads; both bounds go down to its scan."""
    return Source(
        lambda after: rows.where(F.col(key) > after).agg(F.max(key)).first()[0],
        lambda after, upto: rows.where((F.col(key) > after) & (F.col(key) <= upto)),
    )


def jdbc_source(spark: SparkSession, url: str, table: str, key: str, partitions: int = 16, **options: str) -> Source:
    """A table of a database: the range of new ids is cut into as many queries as ``partitions``."""
    for name in (*table.split("."), key):
        if not re.fullmatch(r"\w+", name):
            raise ValueError(f"not a plain name: {name}")

    def query(sql: str, **more: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, dbtable=f"({sql}) q", **options, **more).load()

    def read(after: int, upto: int) -> DataFrame:
        parts = str(max(1, min(partitions, upto - after)))
        where = f"{key} > {after} AND {key} <= {upto}"
        column = query(f"SELECT * FROM {table} WHERE 1 = 0").select(key).columns[0]
        return query(f"SELECT * FROM {table} WHERE {where}", partitionColumn=column, lowerBound=str(after + 1), upperBound=str(upto + 1), numPartitions=parts)

    def upper(after: int) -> int | None:
        found = query(f"SELECT MAX({key}) AS upper_id FROM {table} WHERE {key} > {after}").first()[0]
        return None if found is None else int(found)

    return Source(upper, read)


def _stored(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The folders load=n of ``path``; none where it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def checkpoints(spark: SparkSession, state: str) -> DataFrame:
    """(upper_id, rows, load) of all loads that were committed."""
    return _stored(spark, state, STATE)


def load_increment(spark: SparkSession, source: Source, sink: str, state: str, first: int = -1, commit: bool = True) -> Increment:
    """Loads what came after the checkpoint, ``first`` at the beginning.  Rows that
    appear later under a smaller id are not seen, as in any sync by id."""
    last = checkpoints(spark, state).agg(F.max("load"), F.max_by("upper_id", "load")).first()
    number, after = (0, first) if last[0] is None else (last[0] + 1, last[1])
    upto = source.upper(after)
    if upto is None:
        return Increment(number, 0, after)
    seen = Observation(f"increment-{number}")
    rows = source.read(after, upto).observe(seen, F.count("*").alias("rows"))
    rows.write.mode("overwrite").parquet(f"{sink}/load={number}")
    n = seen.get["rows"]
    if commit:
        spark.createDataFrame([(upto, n)], "upper_id long, rows long").coalesce(1).write.mode("overwrite").parquet(f"{state}/load={number}")
    return Increment(number, n, upto)


def copied(spark: SparkSession, sink: str, state: str, schema: StructType) -> DataFrame:
    """The rows of all committed loads."""
    last = checkpoints(spark, state).agg(F.max("load")).first()[0]
    rows = _stored(spark, sink, StructType([*schema.fields, StructField("load", IntegerType())]))
    return rows.where(F.col("load") <= F.lit(-1 if last is None else last)).drop("load")

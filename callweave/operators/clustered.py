"""Tables clustered by a key, for reads of one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROW_GROUP = 8 << 20  # bytes: a read of one key takes a row group or two


def write_clustered(df: DataFrame, path: str, key: str, distinct: int, *then: str) -> None:
    """``df`` in ranges of ``key``, sorted inside, with a Bloom filter of the key in each row group.
    ``distinct`` is about how many keys a file holds.  A key of many rows goes on over
    several files, as ranges are cut by ``then`` too."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, key, *then).sortWithinPartitions(key, *then)
    options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(distinct), "parquet.block.size": str(ROW_GROUP)}
    ranged.write.options(**options).parquet(path)


def with_key(spark: SparkSession, path: str, key: str, value: object) -> DataFrame:
    """The rows of one key: ranges and Bloom filters of row groups rule out the others."""
    return spark.read.parquet(path).where(F.col(key) == F.lit(value))


def with_prefix(spark: SparkSession, path: str, key: str, prefix: str) -> DataFrame:
    """The rows whose key starts with ``prefix``, as a range that row groups can be held against."""
    following: Column | None = F.col(key) < F.lit(prefix[:-1] + chr(ord(prefix[-1]) + 1)) if prefix else None
    rows = spark.read.parquet(path).where(F.col(key) >= F.lit(prefix))
    return rows if following is None else rows.where(following)

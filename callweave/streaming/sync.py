"""Incremental copies: new files are enriched and loaded, restart-safe.

Spark's checkpoint remembers the files that are done.  A micro-batch that runs again
loads the same rows again, so ``load`` has to give the same table then, as the dated
tables of ``operators.dated`` do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


def sync(
    spark: SparkSession, folder: str, schema: StructType, checkpoint: str, load: Callable[[DataFrame, int], None],
    name_filter: str = "*.parquet", file_format: str = "parquet", columns: tuple[Column | str, ...] = ("*",),
) -> None:
    """Gives what is new in ``folder`` to ``load`` with the number of the micro-batch, and
    stops; schedule it.  ``columns`` are what is read of the files, and may name their
    hidden metadata.  A folder without files loads nothing."""
    reader = spark.readStream.schema(schema).format(file_format).option("pathGlobFilter", name_filter)
    query = reader.load(folder).select(*columns).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()

"""The folder that driver and executors share, and tables written there.

``spark.checkpoint.dir`` names the folder.  Where it is unset and the master is
local (tests, a laptop), a temporary one is made and set as Spark's checkpoint
folder; on a cluster that raises, as executors do not share such a folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

MOST_ROWS = 1_000_000  # of narrow rows that are broadcast; larger tables are joined by shuffles
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.split("[")[0] == "local":
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors of {master} share")
        base = "file://" + tempfile.mkdtemp(prefix="callweave-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage ends there,
    so a lost executor costs a re-read and not a recomputation."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(table: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, to be broadcast if it has at most MOST_ROWS rows."""
    return F.broadcast(table) if table.count() <= MOST_ROWS else table


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's bound on the bytes of an Arrow batch, unless it has one.  By default a
    batch of 10,000 texts takes tens of MB in the JVM and again in each Python worker."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)


def open_filesystem(uri: str):
    """(pyarrow filesystem, path in it) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)

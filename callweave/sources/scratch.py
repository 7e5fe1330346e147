"""Folders that driver and executors share, for files that jobs hand over."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` or the checkpoint folder that was set;
    below a temporary one where both are unset, which only a local master can share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.conf.get("spark.master", "")
        if master.split("[")[0] != "local":
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors of {master} share")
        base = "file://" + tempfile.mkdtemp(prefix="callweave-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

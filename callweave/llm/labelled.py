"""Labelled samples for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out.  A null id is in fold 0."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(key.cast("long").cast("string").cast("binary")), F.lit(5)), F.lit(0)).cast("int")


def bounded(rows: DataFrame, keys: list[str], most: int, count: int) -> DataFrame:
    """About ``most`` of ``count`` rows, picked by a hash of ``keys``, each set of keys
    once: the same rows every time, and all rows where there are no more than ``most``."""
    if count <= most:
        return rows
    picked = rows.where(F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(1 << 30)) < int((1 << 30) * most / count))
    return picked.dropDuplicates(keys)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text, y) of at most about ``most`` labelled rows of ``docs`` outside
    fold 0.  The label side, each id and label once, is bounded by ``most``, so it is
    broadcast.  Ids that repeat in ``docs`` may make more rows; these are bounded
    once more, by id, label and text, where rows that are equal count once.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where((fold("doc_id") != 0) & F.col("y").isNotNull()).distinct()
    known = bounded(known, ["doc_id", "y"], most, known.count())
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(known), "doc_id")
    return bounded(rows, ["doc_id", "y", "text"], most, rows.select("doc_id").count())

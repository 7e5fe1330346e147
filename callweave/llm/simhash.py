"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a common variant
within half the radius of both.  Fingerprints emit all variants of that ball and
variants meet in a shuffle.  All members of a variant are within ``radius`` of
each other, so each is linked to the smallest alone: rows grow with the members
of a group of near copies, and not with their pairs.

The ball for radius 4 has 2,081 variants, and most fingerprints have no
neighbour at all.  A lossless filter therefore comes first, the same method on
halves: of two fingerprints within 4 bits, one 32-bit half differs in at most 2
bits, so the balls of radius 1 around these halves (33 variants each) meet.
Collisions of keys that few fingerprints share are verified; fingerprints
without a verified one, or a crowded key, emit no full ball.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Window, functions as F

from .bpe import small_batches
from .components import connected_components
from .storage import written

if TYPE_CHECKING:
    import numpy as np

FEW = 16  # members of a key whose pairs are verified; the members of fuller keys all go on
BLOCK = 1 << 16  # shingles hashed at a time, so that one huge text needs no huge list


def fingerprint(text: str | None, words: int = 4) -> int:
    """64-bit SimHash of a text: XXH64 (seed 42) of each word shingle, bits set
    in more than half of them.  Null and blank texts have fingerprint 0; a text
    of fewer words is one shingle."""
    import numpy as np
    import xxhash

    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    count = max(1, len(parts) - words + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, BLOCK):
        block = parts[at : min(at + BLOCK, count) + words - 1]
        shifted = [block[i:] for i in range(words)] if len(parts) >= words else [[b" ".join(block)]]
        hashes = np.array([digest(b" ".join(s), 42) for s in zip(*shifted)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count, bitorder="little").tobytes(), "little")


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set in more than half of the 64-bit hashes; 0 of none."""
    import numpy as np

    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, fp) with one row per row of ``docs``; fp holds the 64 bits as a long."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for b in small_batches(whole):
                fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "id long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def ball_masks(radius: int, bits: int = 64) -> list[int]:
    """All masks of at most ``radius`` of ``bits`` bits, as signed longs."""
    return [_signed(sum(1 << i for i in c)) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _half_keys(fps: DataFrame) -> DataFrame:
    """(k, fp): each half of each fingerprint with at most one bit flipped."""
    i = F.col("i")
    half = F.when(i < 33, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    flip = F.expr("case when i % 33 = 0 then 0L else shiftleft(1L, cast(i % 33 as int) - 1) end")
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("i")).select(
        (half.bitwiseXOR(flip) + F.when(i < 33, F.lit(0)).otherwise(F.lit(1 << 32))).alias("k"), "fp"
    )


def ball_links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (a, b) by full balls: every fingerprint emits all its variants."""
    masks = ", ".join(f"{m}L" if m != -(1 << 63) else "shiftleft(1L, 63)" for m in ball_masks(radius // 2))
    balls = fps.select("fp", F.explode(F.expr(f"transform(array({masks}), m -> fp ^ m)")).alias("v"))
    least = F.first("fp").over(Window.partitionBy("v").orderBy("fp").rowsBetween(Window.unboundedPreceding, 0))
    met = balls.withColumn("least", least).where("least <> fp").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return met.distinct()


def with_neighbours(fps: DataFrame, radius: int = 4) -> DataFrame:
    """The fingerprints (fp) that can be within ``radius`` of another one: they share
    a half-ball key with one that is, or share a key with more than FEW."""
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    keys = _half_keys(fps.repartition(parts, F.hash("fp")))
    met = keys.groupBy("k").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    met = written(met.where((F.col("n") > 2) | near), "met-keys")
    members = written(keys.join(met.where("n > 2").select("k", "n"), "k"), "met-members")
    few = members.where(F.col("n") <= FEW)
    pairs = few.select("k", F.col("fp").alias("a")).join(few.select("k", F.col("fp").alias("b")), "k").where("a < b").where(near)
    ends = met.where("n = 2").select("a", "b").unionByName(pairs.select("a", "b")).select(F.explode(F.array("a", "b")).alias("fp"))
    return ends.unionByName(members.where(F.col("n") > FEW).select("fp")).distinct()


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within ``radius`` (0, 2 or 4) bits.

    ``fps`` has one distinct column fp.  The edges are a spanning set, not all
    pairs: each variant links its members to its smallest one.
    """
    if radius not in (0, 2, 4):
        raise ValueError("radius must be 0, 2 or 4")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = ball_links(written(with_neighbours(fps, radius), "neighbours").repartition(parts, F.hash("fp")), radius)
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the smallest id whose fingerprint can be reached over links
    of at most ``radius`` bits.  Null, empty and blank texts have fingerprint 0
    and link like any other; repeated rows and equal texts share a component; a
    component whose ids are all null has a null id; an empty table gives no
    rows.  Other columns of ``docs`` are ignored.
    """
    rows = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = written(connected_components(links(fps.select("fp"), radius)), "roots")
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = named.join(roots.select(F.col("node").alias("fp")), "fp", "left_semi").groupBy("root").agg(F.min("first_id").alias("least"))
    named = named.join(least, "root", "left").select("fp", F.coalesce("least", "first_id").alias("component_id"))
    return rows.join(named, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

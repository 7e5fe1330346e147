"""Connected components of an edge table by alternating star contraction.

Every round is two joins: a large star (each node hands its larger neighbours
to its smallest one) and a small star (each node hands its smaller neighbours
to the smallest).  The edge table never leaves the executors; the driver sees
one count and one checksum a round.  Every round is written to the shared
folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import written


def _star(edges: DataFrame) -> DataFrame:
    """Joins every edge (u, v) with m, the smallest node among u and its v's."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _star(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = _star(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    kept = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b), root being the
    smallest node that can be reached.

    Null ends and self loops are dropped; repeated edges count once; no edges
    give no rows.  Nodes without an edge to another node are not in the result.
    """
    now = written(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        now = written(_round(now), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)

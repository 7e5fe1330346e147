"""Shards of near equal bytes by minimax contiguous partition.

Rows of equal text form an atomic group.  Groups are ordered by a SHA-256 digest
of their text, which spreads sizes evenly over the order.  The smallest feasible
shard capacity is found by binary search; a capacity is checked greedily (fill a
shard until the next group does not fit).  Groups of an average shard or more
get a shard of their own first, as no cut can make them smaller.

The search needs prefix sums at the cuts only.  The driver reads the sums of
2**14 ranges of the order, brackets the capacity with them, and then reads the
inner sums of just the ranges in which a cut can fall, until these hold few
enough groups to be read one by one.  What the driver holds is bounded by
constants, whatever the number of rows.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import written

TOP_BITS, STEP_BITS, LEAF_GROUPS, SLOT_CHUNKS = 14, 8, 50_000, 4096


def _prefix(bits: int) -> Column:
    """The first ``bits`` (at most 62) of the digest as a long."""
    return F.shiftrightunsigned(F.conv(F.substring("digest", 1, 16), 16, -10).cast("long"), 64 - bits)


class _Steps:
    """Prefix sums at known places of the order: ``ends[i]`` is the sum up to and
    with item i, and items are ranges of the order or single groups."""

    def __init__(self, items: list[tuple[str, int, bool]]) -> None:
        self.items = items  # (upper digest bound, bytes, is it one group)
        self.ends, total = [], 0
        for _, size, _ in items:
            total += size
            self.ends.append(total)
        self.total = total

    def greedy(self, capacity: int, shards: int, hopeful: bool) -> list[int] | None:
        """Sums at the cuts; None if the shards don't suffice.  Where a cut falls
        into a range, it is put at the range's end (hopeful) or start."""
        cuts, at = [], 0
        for _ in range(shards):
            if at >= self.total:
                break
            i = bisect_right(self.ends, at + capacity)
            nxt = self.ends[i - 1] if i else 0
            if hopeful and i < len(self.ends) and not self.items[i][2]:
                nxt = min(self.ends[i], at + capacity)
            if nxt <= at:
                return None
            at = nxt
            cuts.append(at)
        return cuts if at >= self.total else None

    def smallest(self, shards: int, hopeful: bool, low: int, high: int) -> int:
        while low < high:
            mid = (low + high) // 2
            if self.greedy(mid, shards, hopeful) is None:
                low = mid + 1
            else:
                high = mid
        return low


def _read(groups: DataFrame, bits: int, among: list[int] | None, parent_bits: int) -> list[tuple[int, int, int]]:
    src = groups if among is None else groups.where(_prefix(parent_bits).isin(among))
    got = src.groupBy(_prefix(bits).alias("p")).agg(F.sum("bytes"), F.count("*")).orderBy("p").collect()
    return [(r[0], r[1], r[2]) for r in got]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[str], int]:
    """Last digest of each shard but the last, and the smallest capacity, for
    ``groups`` of (digest, bytes) in the order of digest."""
    bits = TOP_BITS
    tree = {p: [size, n, None] for p, size, n in _read(groups, bits, None, 0)}
    levels = [tree]

    def flat(nodes: dict, width: int) -> list[tuple]:
        out = []
        for p in sorted(nodes):
            size, n, inner = nodes[p]
            if inner is None:
                out.append(((width, p), size, False, n))
            elif isinstance(inner, list):
                out += [(d, s, True, 1) for d, s in inner]
            else:
                out += flat(inner, width + STEP_BITS)
        return out

    while True:
        items = flat(tree, TOP_BITS)
        steps = _Steps([(x[0], x[1], x[2]) for x in items])
        if not steps.total:
            return [], 0
        low = steps.smallest(shards, True, -(-steps.total // shards), steps.total)
        high = steps.smallest(shards, False, low, steps.total)
        early = steps.greedy(high, shards, False) if low == high else None
        if early is not None and low == high:
            at = [bisect_right(steps.ends, c) - 1 for c in early]
            nxt = [i + 1 for i in at if i + 1 < len(items)]
            unsure = {i for i in nxt if not items[i][2]}
            if not unsure:
                return _digests(groups, [items[i][0] for i in at[:-1]]), high
        else:
            unsure = set()
            worst, best = steps.greedy(low, shards, False), steps.greedy(high, shards, True)
            worst = worst if worst is not None else _forced(steps, low, shards)
            for a, b in zip(worst, best + [steps.total] * shards):
                lo, hi = bisect_right(steps.ends, a), bisect_right(steps.ends, b)
                unsure |= {i for i in range(max(0, lo - 1), min(hi + 1, len(items))) if not items[i][2]}
        if not unsure:  # only groups are left, so both searches agree
            at = [bisect_right(steps.ends, c) - 1 for c in steps.greedy(high, shards, False)]
            return _digests(groups, [items[i][0] for i in at[:-1]]), high
        by_width: dict[int, list[int]] = {}
        for i in unsure:
            (width, p) = items[i][0]
            by_width.setdefault(width, []).append(p)
        for width, ps in by_width.items():
            where = _prefix(width).isin(ps)
            count = sum(_node(tree, width, p)[1] for p in ps)
            if count <= LEAF_GROUPS or width + STEP_BITS > 62:
                for p in ps:
                    _node(tree, width, p)[2] = []
                for r in groups.where(where).select(_prefix(width).alias("p"), "digest", "bytes").orderBy("digest").collect():
                    _node(tree, width, r[0])[2].append((r[1], r[2]))
            else:
                for p in ps:
                    _node(tree, width, p)[2] = {}
                for q, size, n in _read(groups, width + STEP_BITS, ps, width):
                    _node(tree, width, q >> STEP_BITS)[2][q] = [size, n, None]


def _forced(steps: _Steps, capacity: int, shards: int) -> list[int]:
    """Greedy cuts at range starts for a capacity that may not suffice; a range
    larger than the capacity is stepped over."""
    cuts, at = [], 0
    for _ in range(shards):
        i = bisect_right(steps.ends, at + capacity)
        at = max(at, steps.ends[i - 1] if i else 0)
        cuts.append(at)
    return cuts


def _node(tree: dict, width: int, p: int) -> list:
    node, at = tree[p >> (width - TOP_BITS)], TOP_BITS
    while at < width:
        at += STEP_BITS
        node = node[2][p >> (width - at)]
    return node


def _digests(groups: DataFrame, marks: list) -> list[str]:
    """A cut after a whole range is the last digest that the range can hold."""
    out = []
    for m in marks:
        if isinstance(m, tuple):
            width, p = m
            out.append(f"{(((p + 1) << (64 - width)) - 1):016x}" + "f" * 48)
        else:
            out.append(m)
    return out


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row.

    size is the UTF-8 bytes of the text plus 1.  Null texts form one group of
    their own and have crc32 0; equal texts share a shard; slots of a shard
    count from 0 without gaps (the order within a shard is not meaningful; rows
    that are equal may swap slots).  An empty table gives no rows.  Other
    columns are ignored.  The law is ``bytes``.
    """
    text = F.col(text_col).cast("string")
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("0" * 64)).alias("digest"),
        ),
        "sizes",
    )
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    own: list[str] = []
    left = total
    for r in groups.where(F.col("bytes") >= -(-total // shards)).orderBy(F.desc("bytes"), "digest").collect():  # at most `shards` rows
        if len(own) < shards - 1 and r["bytes"] * (shards - len(own)) >= left:
            own.append(r["digest"])
            left -= r["bytes"]
    rest = groups.where(~F.col("digest").isin(own)) if own else groups
    cuts, _ = minimax_cuts(rest, shards - len(own))
    place = F.lit(len(own)) + sum((F.when(F.col("digest") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    for i, d in enumerate(own):
        place = F.when(F.col("digest") == d, F.lit(i)).otherwise(place)
    placed = rows.withColumn("shard", place.cast("int")).withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SLOT_CHUNKS)).cast("int")
    )
    # Slots: rows are numbered inside (shard, chunk), and the at most
    # shards * SLOT_CHUNKS chunk counts are summed up in order.
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n")).select(
        "shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "digest"))
    return placed.withColumn("inside", inside).join(F.broadcast(starts), ["shard", "chunk"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("inside") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

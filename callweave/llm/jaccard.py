"""Near copies by the Jaccard similarity of their word shingles, without loss.

SimHash comes first: fingerprints within 4 bits meet by ball hashing, and pairs
that are verified on the whole sets connect most copies.  A similarity of 0.8
leaves 9 or 10 of 64 bits different, which no ball can reach, so a second search
finds the rest.  It deals the shingles of a set out to P parts by their hash, and
a token is all of a part: its number and its shingles.  Sets of n and m shingles
with a similarity of 0.8 or more differ in d = (n + m) / 9 shingles at most, so
in d of the P tokens, and the first d + 1 tokens of both share one, in any order
that is the same for all documents.  P is the power of two up to the size of the
larger set; a set of which the larger one may have the next power has tokens for
that too.  The order puts tokens of many and of rare shingles first, so that a
first one holds two or more shingles mostly, and sets share it by chance almost
never, at any number of documents.  It decides the work and not the result.
Shingles are counted over all documents, in a table of SLOTS counts that shingles
share by their hash: what stands out of the mean of its slots is common.

Documents that share one, and are not connected yet, are candidates if their
sizes and the places of the token allow it.  Parities of hashed shingles rule out
most of them: each bit that differs is a shingle that one set lacks.  The others
are verified on the whole sets.

Where more than FEW documents share a token, each is first compared with a few
pivots, the members that have least before it.  Members that this leaves in
another component than most are then compared with members of other components
that share a second token with them among the first d + 2: sets of a similarity
of 0.8 do.  Crowds that overlap are a family, and its pairs are looked at once;
only where these would be more than WORK, members meet on pairs of tokens.  So no
pair over the bar that could join two components is left out, and documents that
have one token in common and no other are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window, functions as F

from .bpe import close_all, small_batches
from .components import connected_components
from .simhash import links, majority
from .storage import small, written

if TYPE_CHECKING:
    import numpy as np

WORDS = 5
FEW, PIVOTS = 4, 4
PARITIES = 2048
SLOTS, PART = 1 << 22, 1 << 16  # counts of shingles by their hash, and how many of them a row holds
WORK, SALTS = 1 << 22, 16  # pairs of a family that are looked at one by one, and the tasks that share in it
LOTS = 16  # tasks that add up a part first, so that the last sum of it has as few rows
MIXER = 0x9E3779B97F4A7C15  # an odd 64-bit mixing constant


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """XXH64 (seed 42) of a text's word shingles, as unsigned longs.  A text of fewer
    words is one shingle; null and blank texts have none."""
    import numpy as np
    import xxhash

    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    runs = zip(*[islice(parts, i, None) for i in range(min(words, len(parts)))])
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(r), 42) for r in runs), np.uint64)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The set of ``shingle_hashes``, sorted, as signed longs."""
    import numpy as np

    return np.unique(shingle_hashes(text, words).view(np.int64))


def weights(counts: np.ndarray) -> np.ndarray:
    """What a shingle of each slot adds to the rank of its token, from 1 to 255: the rarer, the more."""
    import numpy as np

    return np.clip(8 * np.log2((counts.max(initial=0) + 1.0) / (counts + 1.0)) + 1, 1, 255).astype(np.uint8)


def tokens(s: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first d + 2 tokens of a set, in 2^k parts with k from its own size, and in twice as many
    if larger sets of that class can be similar (else none).  d is the most that it may differ
    from a set of a similarity of 0.8 there.  Sets of 3 or less are only similar if equal."""
    import numpy as np

    n, none = len(s), np.empty(0, np.int64)
    if n < 4:
        return none, none
    mixed = s.view(np.uint64) * np.uint64(MIXER)
    order = np.argsort(mixed)
    mixed, w = mixed[order], weight[slots(s)][order].astype(np.int64)
    h = (mixed ^ mixed >> np.uint64(29)) * np.uint64(MIXER)

    def first(k: int, largest: int) -> np.ndarray:
        part = (mixed >> np.uint64(64 - k)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        wanted = (n + largest) // 9 + 2
        parts, sums, rank = part[starts], np.add.reduceat(h, starts), np.add.reduceat(w, starts)
        if len(parts) < wanted:  # empty parts are tokens too, the last ones
            empty = np.setdiff1d(np.arange(1 << k), parts)
            parts, blank = np.r_[parts, empty], np.zeros(len(empty), np.int64)
            sums, rank = np.r_[sums, blank.view(np.uint64)], np.r_[rank, blank]
        token = (sums ^ (parts << 6 | k).astype(np.uint64) * np.uint64(MIXER)) * np.uint64(MIXER)
        token ^= token >> np.uint64(31)
        return token[np.lexsort((token, -rank))[:wanted]].view(np.int64)

    k, most = n.bit_length() - 1, 5 * n // 4
    return first(k, min(most, (2 << k) - 1)), first(k + 1, most) if most >> k + 1 else none


def parities(s: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of PARITIES bits, as longs."""
    import numpy as np

    odd = np.bincount(s & (PARITIES - 1), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def similar(both: Column, n: Column, m: Column) -> Column:
    """Whether sets of n and m with ``both`` in common have a similarity of 0.8 or more."""
    return 9 * both >= 4 * (n + m)


def slots(s: np.ndarray) -> np.ndarray:
    """The slot of each shingle: other bits than those that ``parities`` takes."""
    return (s >> 20) & (SLOTS - 1)


def slot_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """SLOTS counts: in how many of all documents a shingle of the slot occurs (one
    document counts once a shingle).  The driver gets this table, whose size is fixed."""
    import numpy as np

    def parts_of(total: np.ndarray) -> Iterator:
        import pyarrow as pa

        for part in range(SLOTS // PART):
            of = total[part * PART : (part + 1) * PART]
            at = np.flatnonzero(of)
            if len(at):
                yield pa.RecordBatch.from_pydict({"part": [part], "at": [at.astype("<u2").tobytes()], "n": [of[at].astype("<i8").tobytes()]}, schema=pa.schema([("part", pa.int32()), ("at", pa.binary()), ("n", pa.binary())]))

    def count(batches: Iterator) -> Iterator:
        close_all()
        total = np.zeros(SLOTS, np.int64)
        for whole in batches:
            for b in small_batches(whole):
                sets = [slots(shingles(t)) for t in b.column(1).to_pylist()]
                at, n = np.unique(np.concatenate(sets), return_counts=True)
                total[at] += n
        yield from parts_of(total)

    def add(batches: Iterator) -> Iterator:
        total = np.zeros(SLOTS, np.int64)
        for b in batches:
            for part, at, n in zip(*(c.to_pylist() for c in b.columns)):
                total[part * PART + np.frombuffer(at, "<u2").astype(np.int64)] += np.frombuffer(n, "<i8")
        yield from parts_of(total)

    kinds = "part int, at binary, n binary"
    src = docs.select(F.lit(0).alias("id"), F.col(text_col).cast("string").alias("text"))
    lot = F.pmod(F.spark_partition_id(), F.lit(LOTS))
    first = src.mapInArrow(count, kinds).withColumn("lot", lot).repartition("part", "lot").drop("lot").mapInArrow(add, kinds)
    out = np.zeros(SLOTS, np.int64)
    for r in first.repartition("part").mapInArrow(add, kinds).toLocalIterator():
        out[r["part"] * PART + np.frombuffer(r["at"], "<u2").astype(np.int64)] += np.frombuffer(r["n"], "<i8")
    return out


def row_hashes(docs: DataFrame) -> DataFrame:
    """(row, row_a, row_b): each row of ``docs`` as a struct, and two hashes of the whole of it.
    Maps, which Spark does not hash, count by their text."""
    whole = [F.col(f"`{c}`") for c in docs.columns]
    nulls = F.concat_ws("", *[F.when(c.isNull(), "n").otherwise("v") for c in whole])
    parts = [F.to_json(F.struct(c)) if "map<" in kind else c for c, (_, kind) in zip(whole, docs.dtypes)]
    return docs.select(F.struct(*whole).alias("row"), F.xxhash64(nulls, *parts).alias("row_a"), F.xxhash64(*parts[::-1], nulls, F.lit(1)).alias("row_b"))


def _key(s: np.ndarray) -> int:
    import xxhash

    digest = xxhash.xxh64_intdigest(s.tobytes(), 42)
    return digest - (1 << 64) if digest >> 63 else digest


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return row_hashes(docs).select(F.col(f"row.`{id_col}`").cast("long").alias("id"), F.col(f"row.`{text_col}`").cast("string").alias("text"), "row_a", "row_b")


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_a, row_b, key, n, fp, own, above, odd) with one row per row of ``docs``: a hash
    of the set of shingles, its size, the SimHash fingerprint, its ``tokens`` and its parities."""
    weighed = docs.sparkSession.sparkContext.broadcast(weights(slot_counts(docs, text_col)))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        close_all()
        weight = weighed.value
        for whole in batches:
            for b in small_batches(whole):
                hashes = [shingle_hashes(t) for t in b.column(1).to_pylist()]
                fps = np.array([majority(h) for h in hashes], np.uint64).view(np.int64)
                sets = [np.unique(h.view(np.int64)) for h in hashes]
                numbers = [pa.array([_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(fps)]
                own, above = zip(*[tokens(s, weight) for s in sets])
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (own, above, [parities(s) for s in sets])]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), *numbers, *lists], ["doc_id", "row_a", "row_b", "key", "n", "fp", "own", "above", "odd"])

    kinds = "doc_id long, row_a long, row_b long, key long, n long, fp long, own array<long>, above array<long>, odd array<long>"
    return _source(docs, id_col, text_col).mapInArrow(run, kinds)


def _sets(docs: DataFrame, keys: DataFrame, text_col: str) -> DataFrame:
    """(key, shingles) of the rows of ``keys`` (key, row_a, row_b)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        close_all()
        for whole in batches:
            for b in small_batches(whole):
                sets = pa.array([shingles(t) for t in b.column(1).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0), sets], ["key", "shingles"])

    texts = row_hashes(docs).select("row_a", "row_b", F.col(f"row.`{text_col}`").cast("string").alias("text"))
    met = texts.join(small(keys), ["row_a", "row_b"]).select("key", "text").dropDuplicates(["key"])
    return met.mapInArrow(run, "key long, shingles array<long>")


def _apart() -> Column:
    """In how many bits the parities odd_a and odd_b differ."""
    return F.aggregate(F.zip_with("odd_a", "odd_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)


def _verified(docs: DataFrame, pairs: DataFrame, uniq: DataFrame, text_col: str) -> DataFrame:
    """Those of the pairs (a, b) of keys that have a similarity of 0.8 or more."""

    def joined(pairs: DataFrame, by: DataFrame, *columns: str) -> DataFrame:
        right = by.select(F.col("key").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
        left = by.select(F.col("key").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
        return pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")

    likely = joined(pairs, uniq, "n", "odd").where(9 * _apart() <= F.col("n_a") + F.col("n_b")).select("a", "b")
    likely = written(likely, "likely-pairs")
    ends = likely.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    sets = written(_sets(docs, written(uniq.select("key", "row_a", "row_b").join(ends, "key", "left_semi"), "ends"), text_col), "shingles")
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return joined(likely, sets, "shingles").where(similar(both, F.size("shingles_a"), F.size("shingles_b"))).select("a", "b")


def _close(uniq: DataFrame) -> DataFrame:
    """Pairs (a, b) of keys whose fingerprints are equal or linked within 4 bits: a
    spanning set of them, in which one key stands for each fingerprint."""
    first = written(uniq.groupBy("fp").agg(F.min("key").alias("a")), "fingerprints")
    equal = uniq.join(first, "fp").where("key <> a").select("a", F.col("key").alias("b"))
    linked = links(first.select("fp")).select(F.col("a").alias("fp"), F.col("b").alias("other"))
    other = first.select(F.col("fp").alias("other"), F.col("a").alias("b"))
    return equal.unionByName(linked.join(first, "fp").join(other, "other").select("a", "b"))


def _pairs(left: DataFrame, right: DataFrame, of: str = "x <> y") -> DataFrame:
    """Distinct pairs (a, b), a < b, of members of the same token that are not connected and may be
    similar: one of them is of the token's own class, the sizes are near enough, and no more
    tokens than may differ come before the common one."""
    right = right.select("k", F.col("key").alias("y"), F.col("n").alias("m"), F.col("i").alias("j"), F.col("own").alias("theirs"), F.col("root").alias("s"))
    met = left.select("k", F.col("key").alias("x"), "n", "i", "own", "root").join(right, "k").where(of).where("root <> s")
    met = met.where("(own or theirs) and 4 * n <= 5 * m and 4 * m <= 5 * n and 9 * greatest(i, j) <= n + m")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with the root of their component, which is their own key if they have no link."""
    return members.drop("root").join(small(roots).withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))


def components(docs: DataFrame, uniq: DataFrame, text_col: str = "text") -> DataFrame:
    """(node, root) of the keys of ``uniq`` that are linked to another one."""
    edges = written(_verified(docs, written(_close(uniq), "pairs"), uniq, text_col), "links")
    roots = written(connected_components(edges), "roots")

    # Tokens that members of two components have; i is the place among the tokens of its class.
    every = _rooted(uniq.select("key", "n", "own", "above"), roots)
    every = every.select("key", "n", "root", F.size("own").alias("owns"), F.size("above").alias("others"), F.posexplode(F.concat("own", "above")).alias("at", "k"))
    met = Window.partitionBy("k")  # one shuffle, whether few or many of them meet
    every = every.withColumns({"least": F.min("root").over(met), "most": F.max("root").over(met)}).where("least <> most")
    members = every.select("k", "key", "n", "root", F.expr("at < owns as own"), F.expr("if(at < owns, at, at - owns) as i"), F.expr("at + 1 in (owns, owns + others) as last"))
    members = written(members, "met-members")
    counted = members.where("not last").groupBy("k").agg(F.count("*").alias("members"))
    firsts = members.where("not last").join(counted, "k")
    few, crowd = firsts.where(F.col("members") <= FEW), firsts.where(F.col("members") > FEW)
    central = F.struct(-F.col("i") / F.col("n"), "key")
    salted = crowd.groupBy("k", F.pmod(F.xxhash64("key"), F.lit(PIVOTS)).alias("salt")).agg(F.max_by(F.struct("key", "n", "i", "own", "root"), central).alias("p"))
    pivots = salted.select("k", "p.*")
    first = written(_pairs(few, few, "x < y").unionByName(_pairs(crowd, pivots)).distinct(), "pairs")
    edges = edges.unionByName(written(_verified(docs, first, uniq, text_col), "links"))
    roots = written(connected_components(edges), "roots")
    if crowd.isEmpty():
        return roots

    again = written(_verified(docs, written(_crowd_pairs(members, crowd, roots, uniq), "pairs"), uniq, text_col), "links")
    return roots if again.isEmpty() else connected_components(edges.unionByName(again))


def _crowd_pairs(members: DataFrame, crowd: DataFrame, roots: DataFrame, uniq: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of a crowd that are not connected, may be similar and share two tokens."""
    named = written(_rooted(crowd, roots), "crowds")
    split = named.groupBy("k").agg(F.min("key").alias("least"), F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s")
    named = written(named.join(small(written(split.select("k", "least"), "split-crowds")), "k"), "split-members")
    # Crowds that overlap are one family, in which every pair meets once, on however many tokens.
    families = connected_components(named.select(F.col("least").alias("a"), F.col("key").alias("b"))).select(F.col("node").alias("key"), F.col("root").alias("family"))
    who = small(written(named.select("key").distinct(), "kin-keys"))
    held = members.join(who, "key", "left_semi").groupBy("key", "n").agg(F.collect_list("k").alias("held"))
    odd = uniq.select("key", "odd").join(who, "key", "left_semi")
    kin = written(_rooted(held.join(families, "key").join(odd, "key"), roots), "families")
    sizes = kin.groupBy("family", "root").agg(F.count("*").alias("size"))
    sizes = sizes.groupBy("family").agg(F.max_by("root", F.struct("size", "root")).alias("most"), (F.sum("size") * (F.sum("size") - F.max("size"))).alias("work"))
    kin = written(kin.join(sizes, "family"), "kin").withColumn("minor", F.col("root") != F.col("most"))

    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).alias("salt")
    right = kin.where(F.col("work") <= WORK).select("family", salt, F.col("key").alias("y"), F.col("n").alias("m"), F.col("root").alias("s"), F.col("held").alias("theirs"), F.col("odd").alias("odd_b"), F.col("minor").alias("other"))
    left = kin.where(F.col("minor") & (F.col("work") <= WORK)).select("family", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"), F.col("key").alias("x"), "n", "root", "held", F.col("odd").alias("odd_a"))
    # The first d + 2 tokens of both were kept for the largest d of each, and for a smaller d more than two are common.
    largest = "shiftleft(1L, length(bin(greatest(n, m)))) - 1"
    least = f"(least(n, m) + least(5 * least(n, m) div 4, {largest})) div 9 + 2 - (n + m) div 9"
    met = left.join(right, ["family", "salt"]).where("root <> s and 4 * n <= 5 * m and 4 * m <= 5 * n and (x < y or not other)")
    met = met.where(9 * _apart() <= F.col("n") + F.col("m")).where(f"size(array_intersect(held, theirs)) >= {least}")
    met = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    # In a family too large for that, members meet on a token and a second one behind it.
    # Tokens of one component alone are no seconds, and those that no minor member has make no pairs either.
    large = kin.where(F.col("work") > WORK).select("key", "minor")
    if large.isEmpty():
        return met
    behind = members.select("key", "own", F.col("k").alias("t"), F.col("i").alias("j"))
    twice = named.join(large, "key").join(behind, ["key", "own"]).where("j > i").withColumn("k", F.xxhash64("k", "t"))
    twice = twice.select("k", "key", "n", "i", "own", "root", "minor")
    minors = written(twice.where("minor"), "minor-members")
    twice = written(twice.join(small(written(minors.select("k").distinct(), "minor-keys")), "k", "left_semi"), "second-tokens")
    return met.unionByName(_pairs(minors, twice))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_a, row_b, component), one row per row of ``docs``: the hashes of row_hashes, and
    one number for all rows that links of a similarity of 0.8 or more connect.  Null
    and blank texts are one component; an empty table gives no rows."""
    every = written(described(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "sets")
    copies = every.groupBy("key").agg(F.min("row").alias("least"), F.count("*").alias("rows")).where("rows > 1")
    copies = small(written(copies.select("key", "least"), "copies"))
    uniq = every.drop("doc_id").join(copies, "key", "left").where("least is null or row = least").drop("row", "least")
    roots = written(components(docs, uniq, text_col), "roots")
    # Only sets with a link have a root; others are their own.
    roots = small(roots).withColumnRenamed("node", "key")
    named = every.select("doc_id", "row_a", "row_b", "key").join(roots, "key", "left")
    return named.select("doc_id", "row_a", "row_b", F.coalesce("root", "key").alias("component"))

"""Sharding and decontamination against brute force."""

import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from callweave.llm import sharding, winnow
from tests.llm.cases import TEXTS, documents, pairs


def smallest_capacity(sizes, shards):
    def fits(c):
        used, held = 1, 0
        for s in sizes:
            if s > c:
                return False
            if held + s > c:
                used, held = used + 1, 0
            held += s
        return used <= shards

    return next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=30), st.integers(1, 8))
def test_steps_find_the_smallest_capacity(sizes, shards):
    steps = sharding._Steps([(f"{i:02x}", s, True) for i, s in enumerate(sizes)])
    low = -(-sum(sizes) // shards)
    assert steps.smallest(shards, False, low, sum(sizes)) == smallest_capacity(sizes, shards)


@pytest.mark.parametrize("bits, leaf", [(14, 50_000), (2, 1), (2, 3)])
def test_cuts_by_levels(spark, monkeypatch, bits, leaf):
    """The bracketed search over ranges gives the capacity of the plain one."""
    monkeypatch.setattr(sharding, "TOP_BITS", bits)
    monkeypatch.setattr(sharding, "STEP_BITS", 2)
    monkeypatch.setattr(sharding, "LEAF_GROUPS", leaf)
    groups = sorted((hashlib.sha256(str(i).encode()).hexdigest(), 1 + i * i % 37) for i in range(60))
    cuts, capacity = sharding.minimax_cuts(spark.createDataFrame(groups, "digest string, bytes long"), 5)
    assert capacity == smallest_capacity([s for _, s in groups], 5)
    totals = {}
    for d, s in groups:
        k = sum(d > c for c in cuts)
        totals[k] = totals.get(k, 0) + s
    assert max(totals.values()) == capacity and len(totals) <= 5


def check_shards(rows, texts, ids):
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(8))
    want = sorted(((i if i is not None else -1), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in rows) == want


def test_shard_cases(spark):
    from tests.llm.cases import IDS

    rows = sharding.shard(documents(spark)).collect()
    check_shards(rows, TEXTS, IDS)
    same = {r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(b"same words here again and again")}
    assert len(same) == 1


def test_shard_sizes_are_near_equal_beside_a_hot_group(spark):
    texts = [f"text number {i} " + "x" * (i % 50) for i in range(3000)] + ["hot " * 20] * 1500
    ids = list(range(len(texts)))
    rows = sharding.shard(documents(spark, texts, ids)).collect()
    check_shards(rows, texts, ids)
    totals = {}
    for r in rows:
        totals[r["shard"]] = totals.get(r["shard"], 0) + r["size"]
    rest = sorted(totals.values())[:-1]
    assert len(totals) == 8 and max(rest) - min(rest) < 600 and max(totals.values()) == 1500 * 81


def test_shard_empty(spark):
    assert sharding.shard(documents(spark, [])).collect() == []


LOWER = str.maketrans(winnow.UPPER, winnow.LOWER)
WORD = re.compile(winnow.WORD)


def brute(texts, items):
    windows = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        n = min(10, len(w))
        for j in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[j : j + n]), set()).add(i)
    out = []
    for t in texts:
        w, hit, ids = WORD.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if found := windows.get(tuple(w[j : j + n])):
                    hit.update(range(j, j + n))
                    ids |= found
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


COLUMNS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [
    (1, PASSAGE), (2, PASSAGE.upper()), (10, "ONE two"), (3, None), (4, "..."), (5, "a a a a a a a a a a a a b"), (None, "seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"),
]
DOCS = [
    *TEXTS[:16], f"x {PASSAGE} y", f"{PASSAGE} {PASSAGE}", PASSAGE.replace("five", "5"), "two three four five six seven eight nine ten eleven",
    "a " * 40 + "b", "z " * 30 + "a a a a a a a a a b", f"É one two {PASSAGE}; fourteen fifteen sixteen",
]


def test_decontamination_equals_brute_force(spark):
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    ids = list(range(len(DOCS)))
    got = winnow.decontaminate(documents(spark, DOCS, ids), bench).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == brute(DOCS, ITEMS)


@pytest.mark.parametrize("seed", range(3))
def test_decontamination_of_small_alphabets(spark, seed):
    """Few distinct words make ties, repeats and overlapping alignments."""
    import random

    rnd = random.Random(seed)
    words = lambda n: " ".join(rnd.choice("abc") for _ in range(n))
    items = [(i, words(rnd.choice([3, 9, 10, 11, 14, 25]))) for i in range(12)]
    docs = [words(rnd.randint(0, 60)) for _ in range(40)] + [f"{words(9)} {t} {words(5)}" for _, t in items]
    got = winnow.decontaminate(documents(spark, docs), spark.createDataFrame(items, "item_id int, text string")).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == brute(docs, items)


def test_decontamination_empty_sides(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert winnow.decontaminate(documents(spark, []), none).collect() == []
    assert {r["n_hit"] for r in winnow.decontaminate(documents(spark), none).collect()} == {0}


def test_keep_uncontaminated_keeps_columns_and_repeats(spark):
    docs = documents(spark, [PASSAGE, "clean", "clean", None], [1, 2, 2, None])
    kept = winnow.keep_uncontaminated(docs, spark.createDataFrame(ITEMS, "item_id int, text string"))
    assert kept.columns == docs.columns and pairs(kept, "doc_id", "text") == [(None, None), (2, "clean"), (2, "clean")]


def test_decontamination_query_equals_its_sql(spark):
    import duckdb

    from callweave.llm import queries

    d, name = "/root/testdata/sf0.001", "op7_winnowing_decontamination"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).fetchall()
    got = [tuple(r) for r in queries.QUERIES[name](spark, d).select("doc_id", *COLUMNS).collect()]
    assert sorted(got) == sorted(want) and any(r[2] for r in got)


@pytest.mark.parametrize("most", [10**6, 0])
def test_decontamination_without_broadcasts(spark, monkeypatch, most):
    """Tables beyond the bound of a broadcast are joined by shuffles, with the same result."""
    from callweave.llm import storage

    monkeypatch.setattr(storage, "MOST_ROWS", most)
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    got = winnow.decontaminate(documents(spark, DOCS), bench).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == brute(DOCS, ITEMS)

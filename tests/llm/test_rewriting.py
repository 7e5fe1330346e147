"""Repeated strings, fill-in-middle and whitening against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from callweave.llm import infill, suffixes, whitening
from tests.llm.cases import TEXTS, documents, pairs


# Repeated strings
def removed(texts, length=suffixes.LENGTH):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text, string by string."""
    raw = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for run in bytes(gone).split(b"\0") if run)
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def passages(seed, count=60):
    """Texts of random words that share passages of about 200 bytes, some one byte short of it, and parts of each other."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(120)[:n] for n in (150, 195, 199, 200, 201, 203, 230, 260, 295, 310, 400, 600)]
    texts = []
    for _ in range(count):
        parts = [rnd.choice(shared) if rnd.random() < 0.5 else prose(rnd.randint(1, 60)) for _ in range(rnd.randint(1, 5))]
        whole = rnd.choice(["", " "]).join(parts)
        at = rnd.randint(0, 40)
        texts.append(whole[at:] if rnd.random() < 0.5 else whole)
    return texts + ["x" * 199, "x" * 200, "y" * 201, "ab" * 300, "", None, "z" * 1000 + "q" + "z" * 300]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_strings_equal_brute_force(spark, seed):
    texts = passages(seed)
    got = suffixes.remove_repeats(documents(spark, texts).repartition(3))
    want = removed(texts)
    assert sum(w[1] for w in want) > 1000
    assert pairs(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == [(i, *w) for i, w in enumerate(want)]


def test_repeated_strings_of_odd_rows_and_other_lengths(spark):
    texts = [t for t in TEXTS if not t or len(t) < 10_000] * 2
    got = suffixes.remove_repeats(documents(spark, texts), length=120)
    assert pairs(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == [(i, *w) for i, w in enumerate(removed(texts, 120))]
    with pytest.raises(ValueError):
        suffixes.remove_repeats(documents(spark, []), length=100)


def test_strings_over_several_chunks_and_blocks(spark):
    """Texts of over a mebibyte: one is a chunk of two blocks, and shares its end with a short one."""
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(suffixes.BLOCK + 60_000))
    tail, own = long[-5000:], "".join(rnd.choice("mnop") for _ in range(700))
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffixes.remove_repeats(documents(spark, [long, own + tail, own[:150], long[suffixes.BLOCK - 300 : suffixes.BLOCK + 300]])).collect()}
    assert got == {0: (5600, 2), 1: (5000, 1), 2: (0, 0), 3: (600, 1)}


def test_phrases_cover_each_place_once_with_one_trigger(monkeypatch):
    rnd = random.Random(3)
    text = bytes(rnd.choice(b"ab ") for _ in range(4000)) + b"\0" * 500
    ends = np.array([0, 1000, 1000, 1150, 4500])
    monkeypatch.setattr(suffixes, "BLOCK", 700)
    first, last, trigger = suffixes.phrases(text, ends, 200)
    places = [p for a, b in zip(first.tolist(), last.tolist()) for p in range(a, b + 1)]
    assert places == [p for p in range(4301) if p <= 800 or p >= 1150]
    assert (trigger >= last).all() and (trigger - first < suffixes.WINDOW).all()


def test_a_common_passage_is_asked_about_once_a_chunk(spark):
    rnd = random.Random(1)
    prose = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = prose(900)
    texts = [prose(100) + passage + prose(100) for _ in range(400)]
    held = suffixes.chunks(documents(spark, texts).coalesce(1))
    asked = suffixes._asked(held, 200, 1)
    assert held.count() == 1
    kinds = asked.select((F.length("core") / 8).cast("int").alias("n"), (F.length("twice")).alias("m")).first()
    assert kinds["n"] == kinds["m"] < 400 * 12  # of the 19 phrases or so of 900 places, those inside the passage once for all texts
    got = suffixes.remove_repeats(documents(spark, texts)).agg(F.min("n_removed"), F.max("n_spans")).first()
    assert got[0] >= 900


def test_orders_give_the_same_strings_as_sets():
    rnd = random.Random(8)
    texts, before, places = [], [], []
    middle = bytes(rnd.choice(b"ab") for _ in range(105))
    for _ in range(80):
        left, right = bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 6))), bytes(rnd.choice(b"ab") for _ in range(3)) + b"c" * 92
        texts.append(left + middle + right)
        before.append(len(left))
        places.append(len(left) + 1)
    texts = [t[: n + 199] if len(t) >= n + 199 else t + b"c" * (n + 199 - len(t)) for t, n in zip(texts, places)]
    kinds = list(dict.fromkeys(zip(texts, before, places)))
    texts, before, places = (list(x) for x in zip(*kinds))
    got = suffixes.repeats(texts, np.array(before), np.array(places), 200)
    times = Counter(t[i : i + 200] for t, n in zip(texts, places) for i in range(n))
    for t, n, bits in zip(texts, places, got):
        assert np.unpackbits(np.frombuffer(bits, np.uint8), count=n).tolist() == [int(times[t[i : i + 200]] > 1) for i in range(n)]


# Fill-in-middle
def filled(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest, n = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest(), len(units)
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "plain" if not text or any(m in text for m in infill.MARKERS) or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm"
    output = {"plain": text, "psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[form]
    sizes = (None, None) if form == "plain" else (len(prefix), len(middle))
    return (n, form, *sizes, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


FILLED = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def test_fill_in_middle_equals_brute_force(spark):
    rnd = random.Random(4)
    odd = ["a <", "<<P", "P> <S", "$1 \\E {3} $", "\x1c\x1d \x85\xa0 x", "a\x0bb\x0cc\rd\n", "🙂 é\t\t", " ", "x<P>y", "<S>", "a<M>"]
    texts = TEXTS + [rnd.choice(odd) + rnd.choice(odd) + " ".join(rnd.choice(odd + ["w"]) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    got = pairs(infill.digests(documents(spark, texts)), *FILLED)
    assert got == sorted((i, *filled(i, t)) for i, t in enumerate(texts))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_long_texts_and_null_ids(spark):
    long = ["w " * 1_500_000, " " * 2_000_000 + "x", "y" * 2_000_000]
    texts = [t for t in long for _ in range(4)] + ["a b c", "a b c"]
    ids = [*range(12), None, None]
    got = pairs(infill.digests(documents(spark, texts, ids)), *FILLED)
    assert len(got) == 14 and got[0] == got[1] == (None, *filled(None, "a b c"))
    assert got[2:] == [(i, *filled(i, t)) for i, t in zip(ids[:12], texts)]
    assert any(r[2] != "plain" for r in got[2:])


# Whitening
def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, label int, n double")


def check(got, rows, most=16):
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    v = (fit - total / n).T @ (fit - total / n) / n
    values, parts = np.linalg.eigh(v)
    values, parts = values[::-1][:most], parts[:, ::-1][:, :most]
    k = int((values > 1e-9 * values[0]).sum())
    want = (x - total / n) @ parts[:, :k] / np.sqrt(values[:k])
    table = {(r["vec_id"], r["component"]): r for r in got}
    assert len(got) == len(rows) * k
    have = np.array([[table[i, c + 1]["whitened"] for c in range(k)] for i, _ in rows])
    assert np.abs(have - want * np.sign((have * want).sum(axis=0))).max() < 1e-8
    for j, (i, _) in enumerate(rows):
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[j], total))
        assert (table[i, 1]["n"], table[i, 1]["deviation"], table[i, 1]["deviation_exact"]) == (n, exact if exact < 1 << 63 else None, str(exact))
    explained = [table[rows[0][0], c + 1]["explained"] for c in range(k)]
    assert np.allclose(explained, values[:k] / np.trace(v), rtol=1e-10) and all(r["identity_error"] < 1e-9 for r in got)


def test_whitening_equals_a_dense_solution(spark):
    rnd = np.random.default_rng(2)
    base = rnd.standard_normal((150, 20)) * np.linspace(1, 30, 20)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, base[:30]]))]  # repeated vectors count once
    odd = [(900, None), (901, [None] * 20), (902, [float("nan")] * 20), (903, [1.0] * 19 + [float("inf")]), (904, [1.0] * 19 + [None]), (905, [])]
    check(whitening.whiten(vectors(spark, rows + odd)).collect(), rows)
    few = [(i, v[:3]) for i, v in rows]
    check(whitening.whiten(vectors(spark, few)).collect(), few)
    mixed = whitening.whiten(vectors(spark, rows + [(i + 1000, v) for i, v in few])).collect()
    check([r for r in mixed if r["vec_id"] < 1000], rows)
    assert len([r for r in mixed if r["vec_id"] >= 1000]) == 3 * len(few)
    flat = [(i, [*v, v[0], 5.0]) for i, v in few]  # rank 3 of 5
    check(whitening.whiten(vectors(spark, flat)).collect(), flat)


def test_whitening_of_wide_numbers_and_of_nothing(spark):
    rows = [(i, [float((-1) ** i * 1e9 * (i + 1)), float(i % 7) * 1e8]) for i in range(40)]
    check(whitening.whiten(vectors(spark, rows)).collect(), rows)
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect() == []
    huge = whitening.whiten(vectors(spark, [(1, [1e300, 1.0]), (None, [-1e300, 2.0]), (None, [0.0, 9.0])])).collect()
    assert None in {r["deviation"] for r in huge} and all(r["deviation_exact"].isdigit() for r in huge)


@pytest.mark.parametrize("case", ["random", "equal", "pairs", "diagonal", "graded", "one"])
def test_leading_pairs(case):
    rnd = np.random.default_rng(7)
    q, _ = np.linalg.qr(rnd.standard_normal((40, 40)))
    values = {"random": rnd.random(40), "equal": np.ones(40), "pairs": np.repeat(np.arange(20.0), 2), "diagonal": np.arange(40.0), "graded": 10.0 ** -np.arange(40), "one": np.ones(1)}[case]
    a = np.diag(values) if case in ("diagonal", "one") else q @ np.diag(values) @ q.T
    got, parts = whitening.leading_pairs((a + a.T) / 2)
    want = np.sort(values)[::-1][: len(got)]
    assert len(got) == min(16, len(values)) and np.abs(got - want).max() < 1e-13 * max(1, values.max()) * 40
    assert np.abs(parts.T @ parts - np.eye(len(got))).max() < 1e-12
    assert np.abs(a @ parts - parts * got).max() < 1e-13 * max(1, values.max()) * 40

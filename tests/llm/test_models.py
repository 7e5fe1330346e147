"""Near duplicates against brute force; trained operators by held-out accuracy."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from callweave.llm import components, jaccard, language, quality, simhash, toxicity
from callweave.llm.labelled import fold
from tests.llm.cases import IDS, TEXTS, documents


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert [simhash.fingerprint(t) for t in TEXTS] == [plain_fingerprint(t) for t in TEXTS]
    got = spark.createDataFrame([("The One",)], "t string").select(F.xxhash64(F.lit("the one"))).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"the one", 42)  # the same hash as Spark's


def component_ids(fps, ids):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    return [min((ids[j] for j in range(len(fps)) if find(j) == find(i) and ids[j] is not None), default=None) for i in range(len(fps))]


def test_near_duplicates_equal_brute_force(spark):
    rows = simhash.near_duplicates(documents(spark)).collect()
    want = sorted(zip(IDS, (f"{plain_fingerprint(t):016x}" for t in TEXTS), component_ids([plain_fingerprint(t) for t in TEXTS], IDS)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows), key=str) == want
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def near_fingerprints(rnd, groups):
    """Chains and balls of fingerprints around random centres, and lone ones."""
    out = {rnd.getrandbits(64) for _ in range(100)}
    for size, flips in groups:
        at = rnd.getrandbits(64)
        for _ in range(size):
            x = at
            for b in rnd.sample(range(64), rnd.randint(0, flips)):
                x ^= 1 << b
            out.add(x)
            if rnd.random() < 0.2:
                at = x
    return sorted(out)


@pytest.mark.parametrize("few", [16, 2])
def test_links_connect_the_same_components(spark, monkeypatch, few):
    monkeypatch.setattr(simhash, "FEW", few)
    fps = near_fingerprints(random.Random(few), [(60, 4), (40, 2), (10, 6), (30, 5), (2, 4)])
    signed = [simhash._signed(x) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = component_ids(fps, list(range(len(fps))))
    for edges in (simhash.links(df), simhash.ball_links(df)):
        roots = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
        groups = {}
        for i, x in enumerate(signed):
            groups.setdefault(roots.get(x, x), set()).add(i)
        brute = {}
        for i, c in enumerate(want):
            brute.setdefault(c, set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_components_of_a_long_chain_and_odd_edges(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (None, 3), (700, 701), (701, 700), (700, 701)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {700: 700, 701: 700}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_fold(spark):
    import zlib

    got = spark.range(50).select("id", fold("id").alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_quality_on_held_out_rows(spark, tables):
    docs, labels = tables
    scored = quality.score(docs, quality.learn(docs, labels))
    held = scored.where("held_out").join(labels, "doc_id").select("quality", "predicted", "score").collect()
    assert np.mean([r["quality"] == r["predicted"] for r in held]) > 0.93
    assert all(0 <= r["score"] <= 1 for r in held)
    assert scored.count() == docs.count()


def plain_features(text):
    """The features of quality.features in one pass over all words, without sections."""
    raw = (text or "").encode()
    ws, n_bytes = raw.split(), max(1, len(raw))
    n = max(1, len(ws))
    marks = [sum(raw.count(bytes([c])) for c in [k]) for k in [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]]
    repeats, shouts = sum(a == b for a, b in zip(ws, ws[1:])), sum(w.isupper() for w in ws)
    upper, digits, wide = (sum(raw.count(bytes([c])) for c in k) for k in (range(65, 91), range(48, 58), range(128, 256)))
    return [
        *np.log1p(marks), *(np.array(marks) / n_bytes * 20), upper / n_bytes * 5, digits / n_bytes * 5, wide / n_bytes, raw.count(b"\n") / n_bytes * 50, np.log1p(n_bytes) / 5,
        np.log1p(repeats), repeats / n * 5, np.log1p(shouts), shouts / n * 5, sum(not w.isalpha() for w in ws) / n * 5, len(set(ws)) / n, n_bytes / n / 10,
    ]


@pytest.mark.parametrize("section", [1, 7, 1000, 1 << 20])
def test_quality_features_do_not_depend_on_sections(monkeypatch, section):
    monkeypatch.setattr(quality, "SECTION", section)
    for t in TEXTS if section > 100 else TEXTS[:16]:
        assert np.allclose(quality.features(t), plain_features(t)), t


def test_quality_features_of_a_text_above_one_section():
    text = " ".join(f"word{i % 5000}" for i in range(150_000)) * 2
    assert len(text) > 2 * quality.SECTION and np.allclose(quality.features(text), plain_features(text))
    assert np.allclose(quality.features("x" * (3 << 20)), plain_features("x" * (3 << 20)))


def by_differences(loss, p, step=1e-5):
    """Gradient of ``loss`` by central differences."""
    return np.array([(loss(p + step * e) - loss(p - step * e)) / (2 * step) for e in np.eye(len(p))])


def test_pairwise_gradient():
    rng = np.random.default_rng(1)
    d, w = rng.normal(size=(40, 6)), rng.normal(size=6)
    loss = lambda v: sum(np.log(1 + np.exp(-sum(x * y for x, y in zip(row, v)))) for row in d) / len(d) + 0.05 * (v @ v) / 2
    assert np.allclose(quality.gradient(w, d, 0.05), by_differences(loss, w), atol=1e-6)


def test_quality_bar_is_the_quantile_of_the_bad_share():
    rng = np.random.default_rng(2)
    y = (rng.random(400) < 0.7).astype(int)
    x = np.c_[y + rng.normal(0, 0.7, 400), rng.normal(size=400)]
    ranking = quality.fit(x, y, steps=100)
    scores = ranking.score(x)
    assert abs(np.mean(scores < quality.THRESHOLD) - np.mean(y == 0)) < 0.01
    order = np.argsort(ranking.raw(x))
    assert (np.diff(scores[order]) >= 0).all() and np.mean(scores[y == 1]) > np.mean(scores[y == 0])


def test_labelled_rows_are_bounded(spark):
    """Also where one id has very many rows, in the labels or in the documents."""
    from callweave.llm.labelled import labelled_texts

    docs = spark.range(3000).selectExpr("id doc_id", "concat('text ', id) text")
    labels = spark.range(3000).selectExpr("id doc_id", "int(id % 2) quality")
    hot = next(i for i in range(100) if i and spark.range(1).select(fold(F.lit(i)).alias("f")).first()[0])
    many = spark.range(100_000).selectExpr(f"{hot}L doc_id", "1 quality")
    assert labelled_texts(docs, labels.unionByName(many), "quality", 1000).count() < 1200
    texts = spark.range(50_000).selectExpr(f"{hot}L doc_id", "'the same text' text")
    other = spark.range(50_000).selectExpr(f"{hot}L doc_id", "concat('text ', id) text")
    assert labelled_texts(docs.unionByName(texts), labels, "quality", 3000).count() <= 3000
    assert labelled_texts(docs.unionByName(other), labels, "quality", 3000).count() < 3300
    assert labelled_texts(docs, labels, "quality", 5000).count() == labels.where(fold("doc_id") != 0).count()


def test_toxicity_on_held_out_rows(spark, tables):
    """Learned outside fold 0, judged on fold 0 alone, in all documents of the larger table."""
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    held = docs.join(labels.where(fold("doc_id") == 0).select("doc_id", F.col("toxic").alias("y")), "doc_id")
    rows = toxicity.score(held.drop("y"), model).join(held.select("doc_id", "y"), "doc_id").select("y", "toxic", "severity").collect()
    bad, good = [r for r in rows if r["y"]], [r for r in rows if not r["y"]]
    assert len(bad) > 40 and np.mean([r["toxic"] for r in bad]) > 0.85
    assert np.mean([r["toxic"] for r in good]) < 0.05
    assert np.mean([r["severity"] for r in bad]) > 5 * np.mean([r["severity"] for r in good])


def test_ordinal_gradient_equals_differences():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(30, 4)), rng.integers(0, toxicity.GRADES + 1, 30)
    p = np.r_[rng.normal(size=4), 0.3, -0.2, 0.4]

    def loss(q):
        cuts = [q[4], q[4] + np.exp(q[5]), q[4] + np.exp(q[5]) + np.exp(q[6])]
        total = 0.0
        for row, grade in zip(x, y):
            above = [1.0] + [1 / (1 + np.exp(c - row @ q[:4])) for c in cuts] + [0.0]
            total -= np.log(above[grade] - above[grade + 1])
        return total / len(x) + toxicity.PENALTY * (q[:4] @ q[:4]) / 2

    assert np.allclose(toxicity.gradient(p, x, y), by_differences(loss, p), atol=1e-6)


def test_ordinal_fit():
    """The fit separates ordered grades that a count decides."""
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 12, 600)
    vectors = [{0: float(np.log1p(n)), 1: float(rng.random())} for n in counts]
    grades = np.searchsorted([2, 5, 8], counts, "right")
    w, cuts = toxicity.fit(vectors, grades, 2, steps=600)
    z = np.array([w[0] * v[0] + w[1] * v[1] for v in vectors])
    assert np.mean((z[:, None] > cuts).sum(1) == grades) > 0.9


def plain_grams(text):
    raw = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in f" {text.lower()} ".encode())
    return [raw[i : i + n] for n in (3, 4) for i in range(len(raw) - n + 1) if 32 not in raw[i + 1 : i + n - 1]]


def test_language_equals_sets_of_ngrams(spark, tables):
    """Dictionaries and sets instead of Bloom filters: the same sums but for rare false positives."""
    docs, _ = tables
    filters = language.learn(docs)
    sets = {}
    for r in docs.where((fold("doc_id") != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).collect():
        sets.setdefault(r["lang"], set()).update(plain_grams(r["text"]))
    assert set(filters.languages) == set(sets)
    for l, grams in sets.items():  # every n-gram is in its language's filter
        i = filters.languages.index(l)
        keys = np.unique(np.concatenate([language.ngrams(r["text"]) for r in docs.where((fold("doc_id") != 0) & (F.col("lang") == l) & F.col("text").isNotNull()).collect()]))
        assert len(keys) == len(grams)
        hit = np.bitwise_and.reduce([filters.masks[0][s] for s in filters.slots(keys)]) >> np.uint64(i) & np.uint64(1)
        assert hit.all() and 0 < filters.false_rate[i] < 0.3
    for r in docs.where("text is not null").limit(150).collect():
        grams = plain_grams(r["text"])
        want = {l: sum(g in s for g in grams) for l, s in sets.items()}
        got, n = filters.counts(r["text"])
        assert n == len(grams)
        for l, x in zip(filters.languages, got):
            assert abs(x - want[l]) <= 2 + 0.01 * n, (r["text"][:60], l)
        if n:
            best = max(want, key=want.get)
            assert want[filters.predict(r["text"])[0]] >= want[best] - 2 - 0.01 * n


def test_language_letters_and_many_languages(spark):
    filters = language.build(["en"])
    assert [filters.predict(t)[0] for t in ("²½①Ⅷ", "12_34", "", None, "a", "日", "ª")] == ["und"] * 4 + ["en"] * 3
    docs = spark.range(3000).selectExpr("id doc_id", "concat('l', id) lang", "'some text' text")
    with pytest.raises(ValueError, match="more than"):
        language.learn(docs)


def test_language_on_held_out_rows(spark, tables):
    docs, _ = tables
    said = language.identify(docs, language.learn(docs)).where("held_out").join(docs, "doc_id")
    assert said.where("lang = lang_pred").count() > 0.97 * said.count()


def test_bloom_false_positives_are_corrected():
    rng = np.random.default_rng(0)
    made = language.build(["a", "b"])
    keys = rng.integers(0, 2**40, 151_000).astype(np.uint64)
    made.mark(0, keys[:150_000])
    made.mark(1, keys[150_000:])
    slot = np.flatnonzero(made.masks[0])
    filters = language.build(["a", "b"], np.zeros_like(slot), slot, made.masks[0][slot].view(np.int64))
    assert (filters.masks == made.masks).all()
    assert 1e-3 < filters.false_rate[0] < 0.1 and filters.false_rate[1] < 1e-6
    keys = rng.integers(0, 2**40, 20_000).astype(np.uint64)
    places = filters.slots(keys)
    hit = filters.masks[0][places[0]] & filters.masks[0][places[1]] & filters.masks[0][places[2]]
    assert abs(np.count_nonzero(hit & np.uint64(1)) / len(keys) - filters.false_rate[0]) < 0.01


def test_models_take_odd_rows(spark, tables):
    docs, labels = tables
    odd, none = documents(spark), labels.limit(0)
    q, t, l = quality.learn(docs, labels), toxicity.learn(docs, labels), language.learn(docs)
    assert quality.score(odd, q).count() == toxicity.score(odd, t).count() == language.identify(odd, l).count() == len(TEXTS)
    said = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(odd, l).collect()}
    assert said[0] == said[1] == said[4] == ("und", 0.0)
    empty = documents(spark, [])
    assert quality.score(empty, q).collect() == toxicity.score(empty, t).collect() == language.identify(empty, l).collect() == []
    assert {r["predicted"] for r in quality.score(odd, quality.learn(docs, none)).collect()} == {1}
    assert {r["toxic"] for r in toxicity.score(odd, toxicity.learn(docs, none)).collect()} == {False}
    assert {r["lang_pred"] for r in language.identify(odd, language.learn(empty)).collect()} == {"und"}


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in cp.STAGES[:-1]:
        after = cp.written(stage(spark, before, sf), "test")
        assert after.columns == docs.columns and 0 < after.count() <= before.count(), name
        assert after.join(before, "doc_id", "left_anti").isEmpty(), name
        before = after
    final = cp.STAGES[-1][1](spark, before, sf)
    assert final.count() == before.count()
    assert cp.run(spark, sf).count() == final.count()


def test_pipeline_near_duplicate_stage_keeps_one(spark):
    import corpus_pipeline as cp

    docs = documents(spark).select("doc_id", "text", "lang", "source")
    kept = cp.near_duplicate_stage(spark, docs, "")
    ids = component_ids([plain_fingerprint(t) for t in TEXTS], IDS)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({i for i in ids if i is not None})


def near_texts(rnd, groups):
    """Chains and stars of texts around random ones, with a common line, and lone ones."""
    words = [f"w{i}" for i in range(400)]
    line = " the same line in very many of these texts"
    out = [" ".join(rnd.choices(words, k=rnd.randint(1, 60))) + line * (i % 2) for i in range(60)]
    for size, swaps in groups:
        at = rnd.choices(words, k=rnd.randint(40, 90))
        for _ in range(size):
            now = list(at)
            for _ in range(rnd.randint(0, swaps)):
                now[rnd.randrange(len(now))] = rnd.choice(words)
            out.append(" ".join(now) + line * rnd.randint(0, 1))
            if rnd.random() < 0.3:
                at = now
    return out


def jaccard_components(texts):
    """For each text the smallest index of its component, by comparing all pairs."""

    def grams(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, root = [grams(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a == sets[j] or 5 * both >= 4 * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("few", [16, 2])
def test_pipeline_near_duplicates_equal_jaccard_brute_force(spark, monkeypatch, few):
    import corpus_pipeline as cp

    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    texts = near_texts(random.Random(few), [(60, 3), (40, 2), (20, 1), (25, 4), (2, 1), (2, 2)]) + [None, "", " \n"]
    want = jaccard_components(texts)
    fps = [plain_fingerprint(t) for t in texts]
    assert len(set(want)) < len(set(component_ids(fps, list(range(len(fps)))))) - 20  # 4 bits of 64 find far fewer
    docs = documents(spark, texts).select("doc_id", "text")
    groups = {}
    for r in jaccard.near_duplicates(docs).collect():
        groups.setdefault(r["component"], []).append(r["doc_id"])
    assert sorted(map(sorted, groups.values())) == sorted([i for i, w in enumerate(want) if w == x] for x in set(want))
    assert sorted(r["doc_id"] for r in cp.near_duplicate_stage(spark, docs, "").collect()) == sorted(set(want))
    assert jaccard.near_duplicates(documents(spark, []).select("doc_id", "text")).collect() == []


def test_documents_with_one_common_shingle_make_no_pairs(spark, monkeypatch):
    """Even where the order puts it first: pairs don't grow with the square of a crowd."""
    import numpy as np

    compared = []
    verified = jaccard._verified

    def counted(docs, pairs, uniq, text_col):
        compared.append(pairs.count())
        return verified(docs, pairs, uniq, text_col)

    monkeypatch.setattr(jaccard, "_verified", counted)
    line = "one line that they share"
    texts = [f"{line} " + " ".join(f"w{i}x{j}" for j in range(60)) for i in range(300)]
    docs = documents(spark, texts).select("doc_id", "text")
    shared = jaccard.slots(jaccard.shingles(line))
    counts = jaccard.slot_counts(docs)
    assert counts.sum() == sum(len(jaccard.shingles(t)) for t in texts) and counts[shared] >= 300
    for order in (counts, np.where(np.arange(jaccard.SLOTS) == shared[0], 0, counts + 1)):
        monkeypatch.setattr(jaccard, "slot_counts", lambda *_, order=order: order)
        compared.clear()
        assert len({r["component"] for r in jaccard.near_duplicates(docs).collect()}) == 300
        assert sum(compared) <= jaccard.PIVOTS * 300


def test_similar_sets_share_two_of_their_first_tokens():
    rng = np.random.default_rng(4)
    weight = jaccard.weights(rng.integers(0, 50, jaccard.SLOTS))
    draw = lambda n: rng.integers(-(1 << 63), (1 << 63) - 1, n)
    for _ in range(2000):
        x = np.unique(draw(int(rng.integers(4, 300))))
        lost, new = int(rng.integers(0, len(x) // 5 + 1)), int(rng.integers(0, len(x) // 4 + 1))
        y = np.unique(np.r_[x[rng.permutation(len(x))[lost:]], draw(new)])
        if len(y) < 4 or 9 * (len(x) - lost) < 4 * (len(x) + len(y)):
            continue
        largest, d = max(len(x), len(y)).bit_length(), (len(x) + len(y)) // 9
        a, b = (jaccard.tokens(s, weight)[len(s).bit_length() < largest].tolist() for s in (x, y))
        both = [t for t in a if t in b]
        assert len(both) > 1 and max(a.index(both[0]), b.index(both[0])) <= d


def test_crowds_of_long_documents_make_no_squares(spark, monkeypatch):
    """Documents with half of their text in common, and an order that does not tell it from the rest."""
    rows = {}
    put = jaccard.written

    def counted(table, label):
        out = put(table, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    monkeypatch.setattr(jaccard, "slot_counts", lambda *_: np.ones(jaccard.SLOTS, np.int64))
    half = " ".join(f"c{j}" for j in range(300))
    texts = [f"{half} " + " ".join(f"w{i}x{j}" for j in range(200)) for i in range(12)]
    docs = documents(spark, texts).select("doc_id", "text")
    assert len({r["component"] for r in jaccard.near_duplicates(docs).collect()}) == 12
    assert "families" in rows and max(rows.values()) <= 250 * len(texts), rows
    monkeypatch.setattr(jaccard, "WORK", 0)  # the way for large families gives the same
    assert len({r["component"] for r in jaccard.near_duplicates(docs).collect()}) == 12
    assert "second-tokens" in rows


@pytest.mark.parametrize("work", [0, 1 << 22])
def test_families_equal_jaccard_brute_force(spark, monkeypatch, work):
    monkeypatch.setattr(jaccard, "FEW", 2)
    monkeypatch.setattr(jaccard, "PIVOTS", 1)
    monkeypatch.setattr(jaccard, "WORK", work)
    texts = near_texts(random.Random(7), [(60, 4), (40, 6), (25, 8)])
    groups = {}
    for r in jaccard.near_duplicates(documents(spark, texts).select("doc_id", "text")).collect():
        groups.setdefault(r["component"], []).append(r["doc_id"])
    want = jaccard_components(texts)
    assert sorted(map(sorted, groups.values())) == sorted([i for i, w in enumerate(want) if w == x] for x in set(want))


def test_pipeline_near_duplicate_stage_judges_rows(spark):
    """Different texts with equal or no ids stay; of copies, one does, the same on every run."""
    import corpus_pipeline as cp

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b), (None, c), (5, d), (5, c), (7, d), (7, "e"), (7, "f"), (9, "f"), (9, a), (9, "g"), (9, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(5, c), (5, d), (7, "e"), (7, "f"), (9, a), (9, "g"), (None, b)]
    for frame in (docs, docs.orderBy(F.desc("text")).repartition(3)):
        kept = [tuple(r) for r in cp.near_duplicate_stage(spark, frame, "").collect()]
        assert sorted(kept, key=str) == sorted(want, key=str)
    kept = cp.near_duplicate_stage(spark, documents(spark).select("doc_id", "text"), "").collect()
    assert sorted(r["text"] for r in kept if r["doc_id"] is None) == sorted(t for i, t in zip(IDS, TEXTS) if i is None)


def test_pipeline_bounds_arrow_batches(spark, sf_dir):
    """Workers get long texts some at a time; a bound that the session has set stays."""
    import corpus_pipeline as cp
    from callweave.llm.storage import BATCH_CONF

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [b.nbytes]})

    docs = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"))
    spark.conf.unset(BATCH_CONF)
    try:
        out = cp.encoding_stage(spark, docs, sf_dir)
        assert max(r[0] for r in docs.mapInArrow(sizes, "bytes long").collect()) < 6_000_000  # of 30 MB
        assert out.count() == 3000
        spark.conf.set(BATCH_CONF, "1m")
        cp.encoding_stage(spark, docs, sf_dir)
        assert max(r[0] for r in docs.mapInArrow(sizes, "bytes long").collect()) < 2_000_000
    finally:
        spark.conf.unset(BATCH_CONF)

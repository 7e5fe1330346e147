"""Encoding, decoding, shards, edits and media against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from callweave.llm import bpe, edits, media, pieces, repair
from tests.llm.cases import IDS, TEXTS, documents, pairs

PATH = pieces.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def packed(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("make", [bpe.speculative_coder, pieces.library_coder])
def test_coders_equal_the_library(library, make):
    rnd = random.Random(3)
    alphabet = [" ", "  ", "a", "the", "The", "'s", "\n", "é", "日", "1", "12", ".", "!!", "<|endoftext|>", "　", "\x85", "x" * 60, " "]
    mixed = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    texts = [*TEXTS, *mixed]
    coder = make(PATH)
    want = [packed(library, t) for t in texts]
    assert coder.pack(texts) == want
    assert coder.pack(texts) == want  # from the memory
    assert [make(PATH).pack([t])[0] for t in texts[:30]] == want[:30]
    coder = make(PATH)
    assert [coder.pack([t])[0] for t in texts] == want  # one by one, without arrays


def test_small_memories_and_sections(library, monkeypatch):
    monkeypatch.setattr(pieces, "SECTION", 1000)
    monkeypatch.setattr(pieces, "BLOCK", 2000)
    text = TEXTS[18] + "  \n x"
    assert bpe.speculative_coder(PATH, 50).pack([text])[0] == packed(library, text)


def test_greedy_proposals_are_corrected():
    v = bpe.Vocabulary(PATH)
    s = bpe.Speculator(v)
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeinorst") for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    wrong = sum(s.propose(w.encode()) != s.merge(w.encode()) for w in words)
    assert wrong > 100  # else the check is not needed
    assert s.encode(words) == [np.array(s.merge(w.encode()), "<u4").tobytes() for w in words]
    long = "ab" * 3000
    assert s._merge_long([s.single[b] for b in long.encode()]) == np.frombuffer(bpe.speculative_coder(PATH).pack([long])[0], "<u4").tolist()


def test_merging_looks_up_each_new_pair_once():
    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

    v = bpe.Vocabulary(PATH)
    s, rnd = bpe.Speculator(v), random.Random(8)
    v.merges = Counted(v.merges)
    words = ["".join(rnd.choice("abcdeinorst") for _ in range(40)).encode() for _ in range(200)]
    merged = [s.merge(w) for w in words]
    assert Counted.asked <= sum(3 * len(w) for w in words)
    assert merged == [s._merge_long([s.single[b] for b in w]) for w in words]


def test_roomy_coder_equals_the_library(library):
    coder = bpe.roomy_coder(PATH)
    assert coder.after_blank.limit == 200_000
    assert coder.pack(TEXTS) == [packed(library, t) for t in TEXTS]


def test_decoder_equals_the_library(library):
    rng = np.random.default_rng(1)
    decoder = bpe.Decoder(PATH)
    for n in (0, 1, 3, 50):
        for _ in range(50):
            ids = rng.integers(0, 50257, n)
            assert decoder.text(ids.astype("<u4").tobytes()) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_digests(spark, library):
    got = pairs(bpe.digests(documents(spark)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = [(i, len(p) // 4, hashlib.sha256(p).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in zip(IDS, TEXTS) for p in [packed(library, t)]]
    assert got == sorted(want, key=lambda t: [(x is not None, x) for x in t])
    assert bpe.digests(documents(spark, [])).collect() == []
    apart = bpe.decode(bpe.encode(documents(spark)))
    assert pairs(apart, "doc_id", "text") == sorted([(i, t or "") for i, t in zip(IDS, TEXTS)], key=lambda t: [(x is not None, x) for x in t])


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(2)
    docs = [np.r_[rng.integers(0, 6, n), 0].astype("<u4") for n in (0, 1, 5, 400, 4000)] + [np.array([7, 7, 7, 7, 0], "<u4")] * 40
    data, tokens = repair.to_bytes([d.tobytes() for d in docs], list(range(len(docs))), 50257)
    file = repair.ShardFile(data)
    assert tokens == sum(map(len, docs)) and len(file.grammar.rules) > 0
    assert len(file.symbols) < 0.7 * tokens
    for i, d in enumerate(docs):
        assert file.document(i).tolist() == d.tolist()
        for a in range(0, len(d), 97):
            assert file.span(i, a, a + 5).tolist() == d[a : a + 5].tolist()
    for k, (rule, n) in enumerate(zip(file.grammar.rules, file.grammar.lengths)):
        assert len(file.grammar.expand(np.array([file.grammar.first + k]))) == n


def test_grammar_leaves_no_frequent_pair():
    """Also of symbols that are not among the commonest, and of runs of one symbol."""
    rng = np.random.default_rng(4)
    pairs = [np.array([2 * p, 2 * p + 1, 9000 + p]) for p in rng.integers(0, 1500, 60_000)]
    ids = np.concatenate([*pairs, np.full(501, 8000), np.array([8001])])
    last = np.zeros(len(ids), bool)
    last[999::1000] = last[-1] = True
    grammar, symbols, ends = repair.compress(ids, last, 50257)
    assert grammar.expand(symbols).tolist() == ids.tolist()
    symbols = symbols.astype(np.int64)
    left, right = symbols[:-1][~ends[:-1]], symbols[1:][~ends[:-1]]
    other = left != right
    assert np.unique(left[other] << 32 | right[other], return_counts=True)[1].max() < repair.LEAST_COUNT
    assert len(grammar.rules) > 1500 and np.count_nonzero(symbols == 8000) < 2 * repair.LEAST_COUNT


def test_grammar_equals_plain_pairing_on_runs_and_phrases(monkeypatch):
    """Down to pairs that occur twice, a run of one id and a repeated phrase shrink as
    when the most frequent pair is replaced again and again."""
    monkeypatch.setattr(repair, "LEAST_COUNT", 2)

    def plain(ids):
        seq, new = list(ids), 60_000
        while True:
            counts, skip = {}, -1
            for i, pair in enumerate(zip(seq, seq[1:])):
                if pair[0] == pair[1] and skip == i:
                    continue
                skip = i + 1 if pair[0] == pair[1] else -1
                counts[pair] = counts.get(pair, 0) + 1
            if not counts or max(counts.values()) < 2:
                return len(seq)
            best, out, i = max(counts, key=counts.get), [], 0
            while i < len(seq):
                hit = tuple(seq[i : i + 2]) == best
                out.append(new if hit else seq[i])
                i += 2 if hit else 1
            seq, new = out, new + 1

    for ids in ([7] * 4000 + [0], list(range(1, 41)) * 25 + [0], [5, 5, 6] * 300 + [0]):
        last = np.zeros(len(ids), bool)
        last[-1] = True
        grammar, symbols, _ = repair.compress(np.array(ids), last, 50257)
        assert grammar.expand(symbols).tolist() == ids
        assert len(symbols) <= plain(ids) + 3


def test_late_rounds_do_not_look_through_the_shard(monkeypatch):
    """Long repeated phrases take many rounds, of which only the first ones touch most ids."""
    rng = np.random.default_rng(6)
    phrases = [rng.integers(0, 3000, n) for n in rng.integers(50, 400, 30)]
    ids = np.concatenate([x for k in rng.integers(0, 30, 400) for x in (phrases[k], rng.integers(0, 40_000, 300))])
    last = np.zeros(len(ids), bool)
    last[-1] = True
    real, asked = np.flatnonzero, []
    monkeypatch.setattr(np, "flatnonzero", lambda a: asked.append(len(a)) or real(a))
    grammar, symbols, _ = repair.compress(ids, last, 50257)
    assert grammar.expand(symbols).tolist() == ids.tolist() and len(symbols) < 0.8 * len(ids)
    assert asked.count(len(ids)) <= 10


def test_pairs_of_wide_symbols_sort_alike():
    rng = np.random.default_rng(7)
    left, right = rng.integers(0, 9, (2, 500)).astype(np.int32)
    pairs, order, w = repair._sorted_pairs(left, right, 9)
    wide, places, more = repair._sorted_pairs(left, right, 1 << 28)
    assert order.tolist() == places.tolist() == np.lexsort((right, left)).tolist()
    assert (pairs >> w).tolist() == (wide >> more).tolist() == left[order].tolist()
    assert (pairs & (1 << w) - 1).tolist() == (wide & (1 << more) - 1).tolist() == right[order].tolist()


def test_shards_on_spark(spark, library):
    manifest = repair.write_shards(documents(spark), shard_ids=20_000, file_bytes=100_000)
    got = repair.token_index(manifest).collect()
    order = sorted(range(len(TEXTS)), key=lambda k: (IDS[k] is not None, IDS[k] or 0, TEXTS[k] is not None, TEXTS[k] or ""))
    want, start = [], 0
    for k in order:
        p = packed(library, TEXTS[k]) + b"\0\0\0\0"
        want.append((IDS[k], start, len(p) // 4, zlib.crc32(p)))
        start += len(p) // 4
    assert sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == [(s, i, n, c) for i, s, n, c in want]
    assert repair.token_index(repair.write_shards(documents(spark, []))).collect() == []


def test_edits_equal_full_encoding():
    coder, rnd = pieces.library_coder(PATH), random.Random(7)
    inserts = ["", " ", "  ", "\n", "x", " foo", "foo ", " .", "é", "a b c d " * 20]
    for text in [t for t in TEXTS if t is not None and len(t) < 10_000] + ["word " * 500 + "end", " ".join(f"w{i}" for i in range(900))]:
        for _ in range(15):
            tree = edits.build_tree(text, coder)
            assert tree.tokens[1] * 4 == len(coder.pack([text])[0])
            cuts = sorted(rnd.sample(range(len(text) + 1), min(len(text) + 1, 2 * rnd.randint(1, 4))))
            changes = [(a, min(b - a, rnd.choice([0, 1, 2, 9, 400])), rnd.choice(inserts)) for a, b in zip(cuts[::2], cuts[1::2])]
            want = text
            for a, n, s in sorted(changes, reverse=True):
                want = want[:a] + s + want[a + n :]
            new, _ = edits.apply_edits(text, tree, changes, coder)
            assert new == want and tree.chars[1] == len(want) and tree.tokens[1] * 4 == len(coder.pack([want])[0])


def test_only_touched_regions_are_encoded(spark, library):
    text = " ".join(f"word{i}" for i in range(5000)) + " a@b.example " + " ".join(f"word{i}" for i in range(5000))
    (row,) = edits.redacted_counts(documents(spark, [text])).collect()
    assert row["n_edits"] == 1 and row["chars_encoded"] < len(text) / 50
    assert row["n_tokens_after"] == len(packed(library, text.replace("a@b.example", "0"))) // 4


def test_regions_of_many_texts_are_encoded_at_once(library):
    calls, coder = [], pieces.library_coder(PATH)
    pack = coder.pack
    coder.pack = lambda texts: calls.append(len(texts)) or pack(texts)
    placed, want = [], []
    for t in TEXTS:
        tree, made = edits.build_tree(t or "", coder), edits.mixed_edits(t or "")
        after, _, regions = edits.place_edits(t or "", tree, made)
        placed.append((tree, regions))
        want.append(len(packed(library, after)) // 4)
    calls.clear()
    edits.put_tokens(placed, coder)
    assert [tree.tokens[1] for tree, _ in placed] == want and len(calls) == 1


def test_recounts(spark, library):
    import re

    got = pairs(edits.redacted_counts(documents(spark)), "doc_id", "n_tokens", "n_tokens_after")
    want = [(i, len(packed(library, t)) // 4, len(packed(library, re.sub(edits.REDACTED, "0", t or ""))) // 4) for i, t in zip(IDS, TEXTS)]
    assert got == sorted(want, key=lambda t: [(x is not None, x) for x in t])
    assert edits.redacted_counts(documents(spark, [])).collect() == []
    states = edits.token_states(documents(spark))
    apart = edits.recount(states.withColumn("edits", edits.redactions(states["text"])))
    assert pairs(apart, "doc_id", "n_tokens", "n_tokens_after") == got


def test_recounts_of_mixed_edits(spark, library):
    """Insertions, deletions and replacements in every document, through the kept trees."""

    def edited(text):
        for at, n, s in sorted(edits.mixed_edits(text), reverse=True):
            text = text[:at] + s + text[at + n :]
        return text

    got = pairs(edits.edited_counts(documents(spark)), "doc_id", "n_tokens", "n_edits", "n_tokens_after")
    want = [(i, len(packed(library, t)) // 4, len(edits.mixed_edits(t or "")), len(packed(library, edited(t or ""))) // 4) for i, t in zip(IDS, TEXTS)]
    assert got == sorted(want, key=lambda t: [(x is not None, x) for x in t])
    kinds = [e for t in TEXTS for e in edits.mixed_edits(t or "")]
    assert any(n == 0 for _, n, s in kinds) and any(s == "" and n for _, n, s in kinds) and any(s and n for _, n, s in kinds)
    (row,) = edits.edited_counts(documents(spark, [TEXTS[18]])).collect()
    assert 0 < row["chars_encoded"] < len(TEXTS[18]) / 50


def test_media_column(spark):
    rows = media.media_column(documents(spark)).collect()
    want = []
    for i, t in zip(IDS, TEXTS):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        image = media.encode_png(payload)
        want.append((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(image), hashlib.sha256(image).hexdigest()))
    columns = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"]
    got = sorted((tuple(r[c] for c in columns) for r in rows), key=lambda t: [(x is not None, x) for x in t])
    assert got == sorted(want, key=lambda t: [(x is not None, x) for x in t])
    assert media.media_column(documents(spark, [])).collect() == []


def test_archives_are_read_by_ranges_and_members_retried(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(media.time, "sleep", lambda _: None)
    manifest = media.write_archives(documents(spark, [f"text {i} " * 50 for i in range(200)]), f"file://{tmp_path}/m")
    reader = media.MediaReader({"manifest": manifest, "rangeBytes": "5000"})
    parts = reader.partitions()
    assert len(parts) > 4
    members = [m for p in parts for b in reader.read(p) for m in b.column(1).to_pylist()]
    assert len(members) == 200
    real, failures = media.decode_png, {"left": 2}

    def flaky(data):
        if failures["left"]:
            failures["left"] -= 1
            raise ValueError("lost")
        return real(data)

    monkeypatch.setattr(media, "decode_png", flaky)
    rows = [r for p in parts for b in reader.read(p) for r in zip(b.column(1).to_pylist(), b.column(5).to_pylist())]
    assert sorted(n for _, n in rows)[-1] == 3 and len(rows) == 200
    failures["left"] = 3
    with pytest.raises(ValueError):
        list(reader.read(parts[0]))


def test_damaged_images_are_refused():
    image = bytearray(media.encode_png(media.to_payload("some text")))
    image[60] ^= 1
    with pytest.raises((ValueError, zlib.error)):
        media.decode_png(bytes(image))

"""Byte-pair encoding by speculation, and decoding.

Greedy longest match proposes the tokens of each new word.  A token sequence is
what byte-pair merging yields exactly when every two neighbours, merged alone,
stay as they are.  So the neighbours of all proposals are checked at once as an
array of pair numbers, against a memory of pairs met before; only words with a
failing pair are merged step by step.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F

from .pieces import BLOCK, WORDS, PieceCoder, Recent, vocabulary_path

SCAN_LIMIT = 48  # longer words are merged with a heap
PAIR_MEMORY = 120_000
RANK_BITS = 32
NO_MERGE = 1 << 62  # above every rank


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable bytes stand for themselves, the others for 256, 257 and so on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


class Vocabulary:
    """Tokens as bytes, merges as pairs of ids, and the added tokens of a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in byte_symbols().items()}
        names = spec["model"]["vocab"]
        self.ids = {bytes(to_byte[c] for c in name): i for name, i in names.items() if all(c in to_byte for c in name)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content in self.added:
            self.ids.pop(content.encode(), None)
        self.size = 1 + max([*names.values(), *self.added.values()])
        self.bytes = {i: b for b, i in self.ids.items()} | {i: c.encode() for c, i in self.added.items()}
        self.merges: dict[int, int] = {}  # the rank of a pair above what it becomes, in one number
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[names[left] * self.size + names[right]] = rank << RANK_BITS | names[left + right]
        self.longest: dict[bytes, int] = {}
        for token in self.ids:
            self.longest[token[:3]] = max(self.longest.get(token[:3], 1), len(token))


class Speculator:
    """Exact byte-pair encoding of words: propose, check, and merge what fails."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.single = [vocabulary.ids[bytes([b])] for b in range(256)]
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}

    def merge(self, word: bytes) -> list[int]:
        """Plain merging, lowest rank first and leftmost among equals."""
        ids = [self.single[b] for b in word]
        if len(ids) > SCAN_LIMIT:
            return self._merge_long(ids)
        find, size = self.v.merges.get, self.v.size
        # What each pair of neighbours would become; a merge changes the pairs on both sides of it alone.
        hits = [find(a * size + b, NO_MERGE) for a, b in zip(ids, ids[1:])]
        while hits and (best := min(hits)) != NO_MERGE:
            at, new = hits.index(best), best & (1 << RANK_BITS) - 1
            ids[at : at + 2] = [new]
            del hits[at]
            if at:
                hits[at - 1] = find(ids[at - 1] * size + new, NO_MERGE)
            if at < len(hits):
                hits[at] = find(new * size + ids[at + 1], NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        merges, size, n = self.v.merges, self.v.size, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(hit, i, ids[i], ids[i + 1]) for i in range(n - 1) if (hit := merges.get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            hit, i, left, right = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or ids[i] != left or ids[j] != right:
                continue
            ids[i], gone[j] = hit & (1 << RANK_BITS) - 1, True
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (hit := merges.get(ids[a] * size + ids[b])) is not None:
                    heapq.heappush(heap, (hit, a, ids[a], ids[b]))
        return [x for i, x in enumerate(ids) if not gone[i]]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        ids, longest = self.v.ids, self.v.longest
        if (whole := ids.get(word)) is not None:
            return [whole]
        out, at, end = [], 0, len(word)
        while at < end:
            for n in range(min(longest.get(word[at : at + 3], 2), end - at), 0, -1):
                if (token := ids.get(word[at : at + n])) is not None:
                    out.append(token)
                    at += n
                    break
        return out

    def _pair_fits(self, key: int) -> bool:
        left, right = divmod(key, self.v.size)
        return self.merge(self.v.bytes[left] + self.v.bytes[right]) == [left, right]

    def _alone_fits(self, token: int) -> bool:
        if token not in self.whole:
            self.whole[token] = self.merge(self.v.bytes[token]) == [token]
        return self.whole[token]

    def encode(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word."""
        import numpy as np

        if not words:
            return []
        raw = [w.encode("utf-8") for w in words]
        said = [self.propose(w) for w in raw]
        lengths = np.fromiter(map(len, said), np.int64, len(said))
        ends = np.cumsum(lengths)
        flat = np.fromiter((t for s in said for t in s), np.int64, int(ends[-1]))
        pairs = flat[:-1] * self.v.size + flat[1:]
        inner = np.ones(len(pairs), bool)
        inner[ends[:-1] - 1] = False  # from one word to the next
        keys, where = np.unique(pairs[inner], return_inverse=True)
        if len(self.fits) > PAIR_MEMORY:
            self.fits.clear()
        known = self.fits
        listed = keys.tolist()
        for k in listed:
            if k not in known:
                known[k] = self._pair_fits(k)
        good = np.fromiter(map(known.__getitem__, listed), bool, len(listed))
        bad_pair = np.zeros(len(pairs) + 1, np.int64)
        bad_pair[:-1][inner] = ~good[where]
        failing = np.add.reduceat(bad_pair, ends - lengths) > 0
        packed = flat.astype("<u4").tobytes()
        out = []
        for i, (end, n, bad) in enumerate(zip(ends.tolist(), lengths.tolist(), failing.tolist())):
            if bad or n == 1 and not self._alone_fits(said[i][0]):
                out.append(np.array(self.merge(raw[i]), dtype="<u4").tobytes())
            else:
                out.append(packed[4 * (end - n) : 4 * end])
        return out


def speculative_coder(path: str, word_limit: int = 50_000, **memory: int) -> PieceCoder:
    """A coder that cuts pieces into pre-tokens and speculates on the words it has not met;
    ``memory`` holds the limit and the block of its PieceCoder."""
    import numpy as np
    import regex

    v = opened(Vocabulary, path)
    speculator, words, find = Speculator(v), Recent(word_limit), regex.compile(WORDS).findall
    cut = regex.compile("|".join(regex.escape(s) for s in sorted(v.added, key=len, reverse=True)) or r"(?!)")

    def encode_pieces(pieces: list[str]) -> list[bytes]:
        words.turn()
        split = [find(p) for p in pieces]
        fresh = words.fresh({w for ws in split for w in ws})
        known = words.now
        known.update(zip(fresh, speculator.encode(fresh)))
        return [b"".join(map(known.__getitem__, ws)) for ws in split]

    def encode_whole(text: str) -> bytes:
        out, at = [], 0
        for m in cut.finditer(text):
            out += [coder.pack([text[at : m.start()]])[0], np.array([v.added[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, coder.pack([text[at:]])[0]])

    coder = PieceCoder(encode_pieces, encode_whole, list(v.added), **memory)
    return coder


def roomy_coder(path: str) -> PieceCoder:
    """A speculative coder with memories four times as large, for jobs whose workers do nothing else."""
    return speculative_coder(path, 200_000, limit=200_000, block=4 * BLOCK)


class Decoder:
    """Texts from packed ids, by gathering token bytes as arrays.  Ids that the
    vocabulary lacks give nothing; bytes that are no UTF-8 give U+FFFD."""

    def __init__(self, path: str) -> None:
        import numpy as np

        v = opened(Vocabulary, path)
        parts = [v.bytes.get(i, b"") for i in range(v.size)] + [b""]
        self.lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(parts), np.uint8)

    def text(self, packed: bytes) -> str:
        import numpy as np

        ids = np.minimum(np.frombuffer(packed, "<u4"), len(self.lengths) - 1)
        out = []
        for at in range(0, len(ids), 1 << 20):
            part = ids[at : at + (1 << 20)]
            n = self.lengths[part]
            ends = np.cumsum(n)
            if len(part):
                out.append(self.blob[np.repeat(self.starts[part] - (ends - n), n) + np.arange(ends[-1])].tobytes())
        return b"".join(out).decode("utf-8", "replace")


_OPEN: dict[tuple, object] = {}


def opened(kind, path: str):
    """One coder or decoder for each worker process."""
    if (kind, path) not in _OPEN:
        _OPEN[kind, path] = kind(path)
    return _OPEN[kind, path]


def close_all() -> None:
    """Gives back what coders and decoders hold.  Spark keeps worker processes from one
    job to the next; operators that need memory themselves call this first."""
    import gc

    import pyarrow as pa

    if _OPEN:
        _OPEN.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def small_batches(batch, size: int = 1 << 22) -> Iterator:
    """Slices of a record batch whose second column holds about ``size`` bytes each.
    After each whole batch, memory that Arrow keeps for later is given back."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    at = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > size:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield batch.slice(at)
    pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids), one row per row of ``docs``; ids are packed as little-endian
    unsigned 32-bit integers.

    Null texts count as empty, which has no ids.  Rows may repeat, ids may be
    null, other columns are ignored, an empty table gives no rows.  Texts of any
    length are encoded whole, in sections.  ``vocabulary`` is the path of a
    byte-level BPE file, which every executor must have.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder = opened(speculative_coder, path)
        for whole in batches:
            for b in small_batches(whole):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(coder.pack(b.column(1).to_pylist()), pa.binary())], ["doc_id", "ids"]
                )

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text; null ids decode to an empty text."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        decoder = opened(Decoder, path)
        for whole in batches:
            for b in small_batches(whole):
                texts = pa.array([decoder.text(x or b"") for x in b.column(1).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), texts], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, coder_of: Callable[[str], PieceCoder] = speculative_coder) -> DataFrame:
    """(doc_id, ids, text): ``encode`` and ``decode`` of its ids in one pass, so that a
    task needs one Python worker and not two."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder, decoder = opened(coder_of, path), opened(Decoder, path)
        for whole in batches:
            for b in small_batches(whole):
                ids = coder.pack(b.column(1).to_pylist())
                texts = pa.array([decoder.text(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), texts], ["doc_id", "ids", "text"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, ids binary, text string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, coder_of: Callable[[str], PieceCoder] = speculative_coder) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of texts encoded and decoded again."""
    return round_trip(docs, id_col, text_col, vocabulary, coder_of).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )

"""Token-id shards compressed by a Re-Pair grammar, with random access.

Texts are ranged over shards by ascending document id, encoded with the
tokenizers library, and each document closes with an end id.  Within a shard,
frequent pairs of neighbouring symbols are repeatedly replaced by nonterminals.
A round picks many pairs at once, such that no symbol is a left part of one and
a right part of another; then occurrences never overlap and one array pass
replaces them all.  Pairs never reach over the end of a document.

A task writes one file with shard after shard, and the manifest has the place of each.
A shard holds, after the magic and six counts: rules (left, right) and
expansion lengths per nonterminal; per document its id, whether it has one, its
first symbol and its first token; then the symbols, in 2 to 4 bytes.
A document is decoded from its own symbols and the rules alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Window, functions as F

from .bpe import opened, small_batches
from .pieces import library_coder, vocabulary_path
from .storage import open_filesystem, shared_folder

if TYPE_CHECKING:
    import numpy as np

MAGIC = b"CWPAIR01"
SHARD_IDS = 1 << 21
FILE_BYTES, LEAST_FILES = 256 << 20, 24  # text in a file of a large corpus, and the files of a small one
SHARDS_A_TASK = 32  # that one task reads back
LEAST_COUNT = 4  # a rule takes 12 bytes of a file and each use of it saves a symbol of 3: a rarer pair does not pay
SCAN_SHARE = 16  # a round that asks about less than this part of the symbols does not look through all of them


@dataclass
class Grammar:
    """``rules[i]`` is what symbol ``first + i`` stands for."""

    first: int
    rules: np.ndarray  # n x 2
    lengths: np.ndarray
    _flat: tuple | None = None

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Token ids of a run of symbols."""
        import numpy as np

        return self._put_together(symbols.astype(np.int64), *self._expansions())

    def _put_together(self, part: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> np.ndarray:
        import numpy as np

        big = part >= self.first
        rule = part[big] - self.first
        wide = np.ones(len(part), np.int64)
        wide[big] = self.lengths[rule]
        ends = np.cumsum(wide)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        out[(ends - wide)[~big]] = part[~big]
        n = wide[big]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat((ends - wide)[big], n) + inner] = flat[np.repeat(starts[rule], n) + inner]
        return out

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each nonterminal start, and all these ids.  Rules refer
        to earlier ones, and all up to the first that refers to one of them are expanded at once."""
        import numpy as np

        if self._flat is None:
            lengths = self.lengths.astype(np.int64)
            starts = np.cumsum(lengths) - lengths
            flat = np.empty(int(lengths.sum()), np.int64)
            needs, at = self.rules.max(1, initial=0) - self.first, 0
            while at < len(lengths):
                late = np.flatnonzero(needs[at:] >= at)
                end = at + int(late[0]) if len(late) else len(lengths)
                flat[starts[at] : starts[end - 1] + lengths[end - 1]] = self._put_together(self.rules[at:end].ravel(), starts, flat)
                at = end
            self._flat = starts, flat
        return self._flat


def compress(ids: np.ndarray, last: np.ndarray, first: int) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """Grammar, symbols and their end-of-document marks for token ids below ``first``.

    ``last`` marks the ids that close a document.  Rounds end when no pair
    is left that occurs LEAST_COUNT times.  A round sorts the pairs, which counts all of them.
    Each symbol takes the part (left, right or both) of its most frequent pair, and
    pairs of fitting parts are replaced: the most frequent pair of all always is.
    """
    import numpy as np

    seq, last, rules, size = ids.astype(np.int32), last.copy(), [np.empty((0, 2), np.int64)], first
    lengths = np.ones(first, np.int64)
    alive = ~last  # whether the pair that starts here may still become frequent
    after, before = np.arange(1, len(seq) + 2, dtype=np.int32), np.arange(-1, len(seq), dtype=np.int32)  # neighbours
    gone = np.zeros(len(seq), bool)
    at = np.flatnonzero(alive)
    while len(at):
        asked = at
        left, right = seq.take(at), seq.take(after.take(at))
        same = np.flatnonzero(left == right)
        if len(same):  # in a run of one symbol every other pair counts, from its start
            place, number = at[same], np.arange(len(same))
            fresh = np.r_[True, after[place[:-1]] != place[1:]]
            start = np.maximum.accumulate(np.where(fresh, number, 0))
            counted = np.ones(len(at), bool)
            counted[same[(number - start) % 2 == 1]] = False
            at, left, right = at[counted], left[counted], right[counted]
        pairs, order, w = _sorted_pairs(left, right, size)
        starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        counts = np.diff(np.r_[starts, len(pairs)])
        often = np.flatnonzero(counts >= LEAST_COUNT)
        new = np.where(counts < LEAST_COUNT, np.int32(-1), np.int32(0))
        earlier = at[:0]
        if len(often):
            ranked = often[np.argsort(-counts[often], kind="stable")]
            both = pairs[starts[ranked]]
            a, b = (both >> w).astype(np.int32), (both & (1 << w) - 1).astype(np.int32)
            picked = _fitting(a, b, size)
            new[ranked[picked]] = size + np.arange(np.count_nonzero(picked))
            rules.append(np.c_[a[picked], b[picked]])
            size += len(rules[-1])
            lengths = np.concatenate([lengths, lengths[a[picked]] + lengths[b[picked]]])

        into = np.empty(len(at), np.int32)
        into[order] = np.repeat(new, counts)
        alive[at.take(np.flatnonzero(into < 0))] = False
        if len(often):
            hit = np.flatnonzero(into > 0)
            at = at.take(hit)
            lost = after.take(at)
            seq[at], last[at], after[at] = into.take(hit), last.take(lost), after.take(lost)
            gone[lost], alive[lost] = True, False
            before[after.take(at)] = at
            earlier = before.take(at)
            earlier = earlier[earlier >= 0]
            alive[at], alive[earlier] = ~last.take(at), ~last.take(earlier)
        if len(asked) > len(seq) // SCAN_SHARE:
            at = np.flatnonzero(alive)
        else:  # only pairs that were asked about, and those before a new symbol, can be alive
            at = np.concatenate([asked, earlier])
            at = at[alive.take(at)]
            at.sort()
            at = at[np.r_[True, at[1:] != at[:-1]][: len(at)]]
    return Grammar(first, np.concatenate(rules).astype(np.int64), lengths[first:]), seq[~gone], last[~gone]


def _sorted_pairs(left: np.ndarray, right: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The pairs of symbols below ``size`` as sorted numbers (left above the bits of right), the place of
    each, and those bits.  Numbers with the place in their low bits sort faster than a list of places."""
    import numpy as np

    w, bits = size.bit_length(), len(left).bit_length()
    keys = left.astype(np.int64)
    keys <<= w
    keys |= right
    if 2 * w + bits > 63:
        order = np.argsort(keys, kind="stable")
        return keys[order], order, w
    keys <<= bits
    keys |= np.arange(len(keys))
    keys.sort()
    order = keys & (1 << bits) - 1
    keys >>= bits
    return keys, order, w


def _fitting(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Which of the pairs (a, b), most frequent first, fit together: no symbol is
    a left part of one and a right part of another."""
    import numpy as np

    rank = np.arange(len(a), dtype=np.int32)
    best = np.full((3, size), len(a), np.int32)  # first pair that has the symbol as left, right, or both parts
    for part, symbols, which in ((0, a, a != b), (1, b, a != b), (2, a, a == b)):
        best[part, symbols[which][::-1]] = rank[which][::-1]
    lefts, rights, both = best
    is_left, is_right = (lefts <= rights) & (lefts <= both), (rights < lefts) & (rights <= both)
    is_both = ~is_left & ~is_right
    return np.where(a == b, is_both[a], is_left[a] & is_right[b])


def to_bytes(packed: list[bytes], doc_ids: list[int | None], first: int) -> tuple[bytes, int]:
    """The bytes of a shard, and its number of token ids; ``packed`` holds each document's
    ids, the end id included."""
    import numpy as np

    sizes = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
    ids = np.frombuffer(b"".join(packed), "<u4")
    last = np.zeros(len(ids), bool)
    last[np.cumsum(sizes) - 1] = True
    grammar, symbols, last = compress(ids, last, first)
    ends = np.flatnonzero(last) + 1
    width = next(w for w in (2, 3, 4) if first + len(grammar.rules) <= 1 << 8 * w)
    parts = [
        np.array([len(packed), len(ids), len(symbols), len(grammar.rules), first, width], "<u8"),
        grammar.rules.astype("<u4"),
        grammar.lengths.astype("<u4"),
        np.array([x or 0 for x in doc_ids], "<i8"),
        np.array([x is not None for x in doc_ids], "<u1"),
        np.concatenate([[0], ends]).astype("<u8"),
        np.concatenate([[0], np.cumsum(sizes)]).astype("<u8"),
        symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width],
    ]
    return MAGIC + b"".join(p.tobytes() for p in parts), len(ids)


class ShardFile:
    """Random access to the documents of a shard, given its bytes."""

    def __init__(self, data: bytes) -> None:
        import numpy as np

        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        at = len(MAGIC)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        docs, self.tokens, symbols, rules, first, width = (int(x) for x in take("<u8", 6))
        pairs = take("<u4", 2 * rules).reshape(-1, 2).astype(np.int64)
        self.grammar = Grammar(first, pairs, take("<u4", rules))
        ids, known = take("<i8", docs), take("<u1", docs)
        self.doc_ids = [int(x) if k else None for x, k in zip(ids, known)]
        self.first_symbol, self.first_token = take("<u8", docs + 1), take("<u8", docs + 1)
        wide = np.zeros((symbols, 4), np.uint8)
        wide[:, :width] = take("<u1", symbols * width).reshape(-1, width)
        self.symbols = wide.view("<u4").ravel()

    def document(self, i: int) -> np.ndarray:
        """Token ids of the i-th document."""
        return self.grammar.expand(self.symbols[int(self.first_symbol[i]) : int(self.first_symbol[i + 1])])

    def documents(self, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """(i, token ids) of all documents, expanded some at a time: about ``most`` ids, or one document."""
        import numpy as np

        i, n = 0, len(self.doc_ids)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.first_token, int(self.first_token[i]) + most, "right")) - 1)
            ids = self.grammar.expand(self.symbols[int(self.first_symbol[i]) : int(self.first_symbol[j])])
            base = int(self.first_token[i])
            for k in range(i, j):
                yield k, ids[int(self.first_token[k]) - base : int(self.first_token[k + 1]) - base]
            i = j

    def span(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the i-th document, expanding only the symbols that hold them."""
        import numpy as np

        part = self.symbols[int(self.first_symbol[i]) : int(self.first_symbol[i + 1])].astype(np.int64)
        wide = np.ones(len(part), np.int64)
        big = part >= self.grammar.first
        wide[big] = self.grammar.lengths[part[big] - self.grammar.first]
        ends = np.cumsum(wide)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skip = int(ends[a - 1]) if a else 0
        return self.grammar.expand(part[a:b])[start - skip : stop - skip]


MANIFEST = "file int, path string, offset long, bytes long, docs long, start long, tokens long"


def write_shards(
    docs: DataFrame,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = 0,
    shard_ids: int = SHARD_IDS,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes files of token shards and returns their manifest, one row a shard (file,
    path, offset, bytes, docs, start, tokens); start counts the ids before it in its file.

    Documents are in ascending id order within and over files, null ids first.
    Null texts count as empty and hold the end id alone.  A task that runs twice
    writes two files, of which the manifest names the one whose task counted.
    A task writes one file and holds one shard of it: about ``shard_ids`` ids, or
    the longest text; many rows of one id make a long file, and no large memory.
    """
    import numpy as np

    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-shards")
    path = vocabulary or vocabulary_path()
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    end = np.array([end_id], "<u4").tobytes()

    def shards(batches: Iterator) -> Iterator[tuple[list, list]]:
        coder = opened(library_coder, path)
        packed: list[bytes] = []
        ids: list[int | None] = []
        size = 0
        for whole in batches:
            for b in small_batches(whole):
                for doc, p in zip(b.column(0).to_pylist(), coder.pack(b.column(1).to_pylist())):
                    packed.append(p + end)
                    ids.append(doc)
                    size += len(p) + 4
                    if size >= 4 * shard_ids:
                        yield packed, ids
                        packed, ids, size = [], [], 0
        if ids:
            yield packed, ids

    def run(batches: Iterator) -> Iterator:
        import uuid
        from itertools import chain

        import pyarrow as pa
        from pyspark import TaskContext

        found = shards(batches)
        one = next(found, None)
        if one is None:
            return
        fs, root = open_filesystem(folder)
        fs.create_dir(root, recursive=True)
        number = TaskContext.get().partitionId()
        name = f"tokens-{number:06d}-{uuid.uuid4().hex[:8]}.pair"
        rows, offset, start = [], 0, 0
        with fs.open_output_stream(f"{root}/{name}.part") as out:
            for packed, ids in chain([one], found):
                data, tokens = to_bytes(packed, ids, first_nonterminal(path))
                out.write(data)
                rows.append((number, f"{folder}/{name}", offset, len(data), len(ids), start, tokens))
                offset, start = offset + len(data), start + tokens
        fs.move(f"{root}/{name}.part", f"{root}/{name}")
        kinds = [pa.int32(), pa.string(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in MANIFEST.split(", ")])

    parts = max(LEAST_FILES, -(-total // file_bytes))
    manifest = (
        src.repartitionByRange(parts, F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
        .mapInArrow(run, MANIFEST)
    )
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def first_nonterminal(path: str) -> int:
    from .bpe import Vocabulary

    return opened(Vocabulary, path).size


def token_index(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents of all shards, read back
    from the files and decoded; start counts the ids of all documents before.

    Only one row a file is summed in order, and the shards carry their starts
    into the read, so the documents themselves are not joined or moved.
    """
    files = manifest.groupBy("file").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    shards = manifest.join(bases, "file").select("path", "offset", "bytes", (F.col("base") + F.col("start")).alias("start"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for b in batches:
            for path, offset, size, start in zip(*(c.to_pylist() for c in b.columns)):
                fs, at = open_filesystem(path)
                with fs.open_input_file(at) as f:
                    f.seek(offset)
                    shard = ShardFile(f.read(size))
                rows = []
                for i, ids in shard.documents():
                    rows.append((shard.doc_ids[i], start + int(shard.first_token[i]), len(ids), zlib.crc32(ids.astype("<u4"))))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    count = manifest.count()
    spread = shards.repartition(max(1, min(count, LEAST_FILES), count // SHARDS_A_TASK))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")

"""Edit-aware token counts.

Each document keeps a segment tree over its pre-token segments: characters and
tokens of each leaf, and sums above.  An edit finds its leaves by descending
over character sums, and only their text, with the boundary context that can
change the cut into pre-tokens, is encoded again; sums are then renewed on the
way to the root, which holds the document's count.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from .bpe import opened, small_batches
from .pieces import PieceCoder, library_coder, sections, split_pieces, vocabulary_path
from .storage import written

LEAF_PIECES = 24
#: Personal data and secrets that a redaction replaces: e-mail addresses, IPv4
#: addresses, card-like digit runs, long hexadecimal keys.
REDACTED = r"[\w.+-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63}){1,4}|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{12,19}\b|\b[0-9a-f]{32,64}\b"


class SegmentTree:
    """Sums of characters and tokens over leaves, in two flat arrays."""

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.leaves = max(1, len(chars))
        self.base = 1 << (self.leaves - 1).bit_length()
        blank = [0] * (2 * self.base)
        self.chars, self.tokens = blank[:], blank[:]
        self.chars[self.base : self.base + len(chars)] = chars
        self.tokens[self.base : self.base + len(tokens)] = tokens
        for i in range(self.base - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, offset: int) -> tuple[int, int]:
        """(leaf, start of the leaf) that holds a character offset; the last leaf for the end."""
        offset, start, i = min(offset, max(0, self.chars[1] - 1)), 0, 1
        while i < self.base:
            left = self.chars[2 * i]
            if offset < start + left:
                i = 2 * i
            else:
                start += left
                i = 2 * i + 1
        return i - self.base, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.base
        self.chars[i], self.tokens[i] = chars, tokens
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def leaf(self, i: int) -> tuple[int, int]:
        return self.chars[self.base + i], self.tokens[self.base + i]


def leaf_texts(text: str) -> list[str]:
    """The text cut at piece borders into leaves of LEAF_PIECES pieces."""
    out: list[str] = []
    for part in sections(text):
        pieces = split_pieces(part)
        for at in range(0, len(pieces), LEAF_PIECES):
            joined = " ".join(pieces[at : at + LEAF_PIECES])
            out.append(f" {joined}" if at else joined)
    return out


def starts_piece(text: str) -> bool:
    """Whether a new pre-token starts before ``text``, whatever stands there."""
    return len(text) > 1 and text[0] == " " and not text[1].isspace()


def apply_edits(text: str, tree: SegmentTree, edits: list[tuple[int, int, str]], coder: PieceCoder) -> tuple[str, int]:
    """Applies (position, deleted, inserted) edits to ``tree`` and returns the new
    text and the number of characters that were encoded again."""
    after, again, regions = place_edits(text, tree, edits)
    put_tokens([(tree, regions)], coder)
    return after, again


def put_tokens(placed: list[tuple[SegmentTree, dict[int, str]]], coder: PieceCoder) -> None:
    """Encodes the regions of all trees at once and gives their leaves the counts."""
    packed = iter(coder.pack([r for _, regions in placed for r in regions.values()]))
    for tree, regions in placed:
        for leaf, region in regions.items():
            tree.put(leaf, len(region), len(next(packed)) // 4)


def place_edits(text: str, tree: SegmentTree, edits: list[tuple[int, int, str]]) -> tuple[str, int, dict[int, str]]:
    """Applies edits to the characters of ``tree``: the new text, the number of characters to
    be encoded again, and the leaves whose tokens are to be counted, with their texts.

    Positions refer to the text before any edit; edits must not overlap and are
    clipped to the text.  Work is from the end to the start, so positions stay valid.
    """
    regions: dict[int, str] = {}
    again, done = 0, []  # done: what follows ``end_of_done`` in the new text, last part first
    end_of_done = len(text)
    for position, deleted, inserted in sorted(edits, reverse=True):
        position = max(0, min(position, end_of_done))
        stop = min(end_of_done, position + max(0, deleted))
        first, at = tree.find(position)
        last, last_at = (first, at) if stop <= at + tree.leaf(first)[0] else tree.find(stop - 1)
        end = last_at + tree.leaf(last)[0]
        region = text[at:position] + inserted + _from(text[stop : min(end, end_of_done)], done, end - stop)
        while first > 0 and not starts_piece(region):  # boundary context to the left
            first -= 1
            width = tree.leaf(first)[0]
            at -= width
            region = text[at : at + width] + region
        # To the right no context is needed: the next leaf starts a pre-token by itself.
        tree.put(first, len(region), 0)
        regions[first] = region
        for i in range(first + 1, last + 1):
            tree.put(i, 0, 0)
            regions.pop(i, None)
        again += len(region)
        done += [text[stop:end_of_done], inserted]
        end_of_done = position
    return text[:end_of_done] + "".join(reversed(done)), again, regions


def _from(start: str, done: list[str], length: int) -> str:
    """The first ``length`` characters of ``start`` and the parts of ``done`` after it."""
    out, missing = [start], length - len(start)
    for part in reversed(done):
        if missing <= 0:
            break
        out.append(part[:missing])
        missing -= len(part)
    return "".join(out)


def build_tree(text: str, coder: PieceCoder) -> SegmentTree:
    leaves = leaf_texts(text)
    return SegmentTree([len(x) for x in leaves], [len(p) // 4 for p in coder.pack(leaves)])


def token_states(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text, n_tokens, leaf_chars, leaf_tokens): the leaves of each
    document's tree, from which sums are rebuilt without encoding.  Null counts
    as empty."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder = opened(library_coder, path)
        for whole in batches:
            for b in small_batches(whole):
                leaves = [leaf_texts(t or "") for t in b.column(1).to_pylist()]
                packed = iter(coder.pack([x for ls in leaves for x in ls]))
                tokens = [[len(next(packed)) // 4 for _ in ls] for ls in leaves]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([sum(t) for t in tokens], pa.int64()), pa.array([[len(x) for x in ls] for ls in leaves], pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))],
                    ["doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens"],
                )

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, text string, n_tokens long, leaf_chars array<int>, leaf_tokens array<int>")


def redactions(text: Column, pattern: str = REDACTED, replacement: str = "0") -> Column:
    """Edits (pos, deleted, inserted) that replace every match of ``pattern``."""

    @F.pandas_udf("array<struct<pos:int,deleted:int,inserted:string>>")
    def found(texts):  # type: ignore[no-untyped-def]
        import pandas as pd

        rule = re.compile(pattern)
        return pd.Series([[{"pos": m.start(), "deleted": m.end() - m.start(), "inserted": replacement} for m in rule.finditer(t or "")] for t in texts], dtype=object)

    return found(text)


def mixed_edits(text: str, pattern: re.Pattern = re.compile(REDACTED)) -> list[tuple[int, int, str]]:
    """(position, deleted, inserted): every redaction, and one insertion, deletion and
    replacement, in the first, second and last third of the text.

    Places and inserted characters come from the text itself and a hash of it, so
    equal texts get equal edits.  Of these three, one that would touch a redaction
    is left out.  An empty text has no edits.
    """
    import xxhash

    out = [(m.start(), m.end() - m.start(), "0") for m in pattern.finditer(text)]
    if not text:
        return out
    digest, n, taken = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), 42), len(text), list(out)
    for third, longest in enumerate((0, 24, 7)):
        start, stop = n * third // 3, n * (third + 1) // 3
        if stop <= start:
            continue
        at = start + (digest >> 20 * third) % (stop - start)
        deleted = min(longest, stop - 1 - at)
        source = (digest >> 7 * third) % n
        inserted = "" if third == 1 else text[source : source + 12]
        if (deleted or inserted) and all(at + deleted < a or at > a + size for a, size, _ in taken):
            out.append((at, deleted, inserted))
    return out


def recount(states: DataFrame, vocabulary: str | None = None, edits_of: Callable[[str], list[tuple[int, int, str]]] | None = None) -> DataFrame:
    """Applies the edits in column ``edits`` of ``token_states`` rows, or those that
    ``edits_of`` makes of a text.

    (doc_id, n_tokens, n_edits, n_tokens_after, chars_encoded): the count before,
    the edits, the count after them, and the characters that were encoded again.
    Null or no edits leave the count; ids may be null; rows may repeat; an empty
    table gives no rows.  Edits of a row must not overlap.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder = opened(library_coder, path)
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_edits", pa.int64()), ("n_tokens_after", pa.int64()), ("chars_encoded", pa.int64())])
        for whole in batches:
            for b in small_batches(whole):
                rows, placed = [], []
                for doc, text, n, chars, tokens, *given in zip(*(c.to_pylist() for c in b.columns)):
                    edits = edits_of(text or "") if edits_of else [(e["pos"], e["deleted"], e["inserted"]) for e in given[0] or []]
                    tree, again = None, 0
                    if edits:
                        tree = SegmentTree(chars, tokens)
                        _, again, regions = place_edits(text or "", tree, edits)
                        placed.append((tree, regions))
                    rows.append([doc, n, len(edits), tree, again])
                put_tokens(placed, coder)
                for row in rows:
                    row[3] = row[3].tokens[1] if row[3] else row[1]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    src = states.select("doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens", *([] if edits_of else ["edits"]))
    return src.mapInArrow(run, "doc_id long, n_tokens long, n_edits long, n_tokens_after long, chars_encoded long")


def edited_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Counts before and after ``mixed_edits``, columns and cases as in ``recount``: the
    trees are kept as a table, and a second job reads them and encodes only what edits touch."""
    states = written(token_states(docs, id_col, text_col, vocabulary), "token-states")
    return recount(states, vocabulary, mixed_edits)


def redacted_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = REDACTED, replacement: str = "0", vocabulary: str | None = None) -> DataFrame:
    """Token counts of each whole text before and after redaction, with only the
    touched regions encoded again; columns and cases as in ``recount``.  States,
    edits and counts are made in one pass, so a task needs one Python worker."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder, rule = opened(library_coder, path), re.compile(pattern)
        schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_tokens", "n_edits", "n_tokens_after", "chars_encoded")])
        for whole in batches:
            for b in small_batches(whole):
                texts = [t or "" for t in b.column(1).to_pylist()]
                leaves = [leaf_texts(t) for t in texts]
                packed = iter(coder.pack([x for ls in leaves for x in ls]))
                rows = []
                for doc, text, ls in zip(b.column(0).to_pylist(), texts, leaves):
                    tokens = [len(next(packed)) // 4 for _ in ls]
                    found = [(m.start(), m.end() - m.start(), replacement) for m in rule.finditer(text)]
                    before = after = sum(tokens)
                    again = 0
                    if found:
                        tree = SegmentTree([len(x) for x in ls], tokens)
                        _, again = apply_edits(text, tree, found, coder)
                        after = tree.tokens[1]
                    rows.append((doc, before, len(found), after, again))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_tokens long, n_edits long, n_tokens_after long, chars_encoded long")

"""Token ids of whole texts, put together from cached pieces.

A text may be cut before every blank that a non-space character follows: the
byte-level pre-tokenizer always starts a new word there, whatever stands before.
So ids of the pieces, one after the other, are the ids of the text, and a piece
seen before costs one dictionary lookup.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    import numpy as np
    import pyarrow as pa

#: Fixed value: the pre-tokenizer's pattern of the public byte-level vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = re.compile(r" (?=\S)")
SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]
WIDE_GAPS = tuple(f" {c}" for c in SPACES)
NARROW_GAPS = tuple(f" {c}" for c in SPACES if c < "\x80")
MARKS = ".,;:!?|*#$%&"  # ASCII marks that never share a pre-token with letters before them
SECTION, BLOCK, SHORT = 1 << 20, 1 << 20, 1 << 14


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pieces(text: str) -> list[str]:
    """Pieces of a text; all but the first stand for a blank and the piece."""
    return CUT.split(text) if has_gaps(text) else text.split(" ")


def cut_texts(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, one after the other, and how many each text has."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    bounds, flat = lists.offsets.to_numpy(), lists.flatten()
    counts = np.diff(bounds)
    parts, at = [], 0
    for i, text in enumerate(texts):
        if has_gaps(text):
            pieces = CUT.split(text)
            parts += [flat.slice(bounds[at], bounds[i] - bounds[at]), pa.array(pieces, pa.large_string())]
            counts[i], at = len(pieces), i + 1
    return (pa.concat_arrays([*parts, flat.slice(bounds[at])]) if parts else flat), counts


def has_gaps(text: str) -> bool:
    """Whether a blank of the text is not followed by a non-space character."""
    return text.endswith(" ") or any(g in text for g in (NARROW_GAPS if text.isascii() else WIDE_GAPS))


def sections(text: str, size: int = SECTION) -> Iterator[str]:
    """The text cut at piece borders into parts of about ``size`` characters."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while cut >= 0 and (cut + 1 == len(text) or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


class Recent:
    """A dictionary that keeps about the last ``limit`` to twice as many entries."""

    def __init__(self, limit: int) -> None:
        self.limit, self.now, self.old = limit, {}, {}

    def turn(self) -> None:
        """Ages the entries; between two turns nothing that ``fresh`` has seen is lost."""
        if len(self.now) > self.limit:
            self.now, self.old = {}, self.now

    def fresh(self, keys: set) -> list:
        """Those of ``keys`` that have no value yet; the others are in ``now`` after this."""
        absent = keys.difference(self.now)
        if self.old:
            for k in list(absent):
                if (v := self.old.get(k)) is not None:
                    self.now[k] = v
                    absent.discard(k)
        return list(absent)


class PieceCoder:
    """Packs texts into ids (little-endian unsigned 32-bit).

    ``encode_pieces`` gives the packed ids of each piece; ``encode_whole`` those of
    a text that holds one of ``specials``, the added tokens, which cut texts
    before pieces do.
    """

    def __init__(
        self,
        encode_pieces: Callable[[list[str]], list[bytes]],
        encode_whole: Callable[[str], bytes],
        specials: list[str],
        limit: int = 50_000,
        block: int = BLOCK,
    ) -> None:
        self.encode_pieces, self.encode_whole, self.specials, self.block = encode_pieces, encode_whole, specials, block
        self.after_blank, self.heads = Recent(limit), Recent(limit // 8)

    def _encode_new(self, seen: set[str], firsts: set[str]) -> None:
        """Ids of the pieces after a blank, and of the first pieces of texts, that have none yet."""
        self.after_blank.turn()
        self.heads.turn()
        fresh = self.after_blank.fresh(seen)
        # A word with marks after it is the word's ids and the marks' ids.
        stems = {p: q for p in fresh if (q := p.rstrip(MARKS)) and q is not p and q[-1].isalpha()}
        fresh = [p for p in fresh if p not in stems]
        fresh += self.after_blank.fresh(set(stems.values()).difference(fresh))
        known, heads = self.after_blank.now, self.heads.now
        known.update(zip(fresh, self.encode_pieces([f" {p}" for p in fresh])))
        fresh = self.heads.fresh(firsts | {p[len(q) :] for p, q in stems.items()})
        heads.update(zip(fresh, self.encode_pieces(fresh)))
        known.update([(p, known[q] + heads[p[len(q) :]]) for p, q in stems.items()])

    def _short(self, text: str) -> bytes:
        first, *rest = split_pieces(text)
        self._encode_new(set(rest), {first})
        return self.heads.now[first] + b"".join(map(self.after_blank.now.__getitem__, rest))

    def _block(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        if len(texts) == 1 and len(texts[0]) < SHORT:  # arrays would not pay
            return [self._short(texts[0])]
        flat, counts = cut_texts(texts)
        coded = flat.dictionary_encode()
        where = coded.indices.to_numpy().astype(np.int32)
        seen = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        firsts = np.cumsum(counts) - counts
        first_seen, first_where = np.unique(where[firsts], return_inverse=True)
        first_pieces = [seen[i] for i in first_seen.tolist()]
        self._encode_new(set(seen), set(first_pieces))

        # Ids of the distinct pieces one after the other, gathered in the order of the texts.
        packed = [*map(self.after_blank.now.__getitem__, seen), *map(self.heads.now.__getitem__, first_pieces)]
        where[firsts] = len(seen) + first_where
        widths = np.fromiter(map(len, packed), np.int32, len(packed)) // 4
        starts = np.cumsum(widths, dtype=np.int32) - widths
        n = widths[where]
        ends = np.cumsum(n, dtype=np.int32)
        places = np.repeat(starts[where] - (ends - n), n)
        places += np.arange(len(places), dtype=np.int32)
        ids = np.frombuffer(b"".join(packed), "<u4")[places].tobytes()
        stops = (4 * ends[np.cumsum(counts) - 1]).tolist()
        return [ids[a:b] for a, b in zip([0, *stops], stops)]

    def pack(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text; null is taken as empty."""
        out: list[bytes] = []
        held: list[str] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                out.extend(self._block(held))
                held.clear()
                size = 0

        for t in texts:
            t = t or ""
            special = any(s in t for s in self.specials)
            if special or len(t) > SECTION:
                flush()
                out.append(self.encode_whole(t) if special else b"".join(self._block([s])[0] for s in sections(t)))
                continue
            held.append(t)
            size += len(t)
            if size > self.block:
                flush()
        flush()
        return out


def library_coder(path: str, limit: int = 600_000, block: int = 4 * BLOCK) -> PieceCoder:
    """A coder whose pieces are encoded by the tokenizers library."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import numpy as np
    from tokenizers import Tokenizer

    from .bpe import Vocabulary, opened

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()

    v = opened(Vocabulary, path)
    widths = np.array([len(v.bytes.get(i, b"")) for i in range(v.size)])

    def encode_pieces(pieces: list[str]) -> list[bytes]:
        # Pieces that start with a blank and a non-space may be joined to one text, as new
        # pre-tokens start there; the bytes that tokens cover tell where each piece ends.
        out: dict[int, bytes] = {}
        joined = [i for i, p in enumerate(pieces) if len(p) > 1 and p[0] == " " and not p[1].isspace()]
        if joined:
            (said,) = tok.encode_batch_fast(["".join([pieces[i] for i in joined])], add_special_tokens=False)
            ids = np.array(said.ids, dtype="<u4")
            ends = np.cumsum([len(pieces[i].encode()) for i in joined])
            cuts = (np.searchsorted(np.cumsum(widths[ids]), ends, "left") + 1).tolist()
            packed = ids.tobytes()
            out.update((i, packed[4 * a : 4 * b]) for i, a, b in zip(joined, [0, *cuts], cuts))
        if len(joined) < len(pieces):
            alone = [i for i in range(len(pieces)) if i not in out]
            said = tok.encode_batch_fast([pieces[i] for i in alone], add_special_tokens=False)
            out.update((i, np.array(e.ids, dtype="<u4").tobytes()) for i, e in zip(alone, said))
        return [out[i] for i in range(len(pieces))]

    def encode_whole(text: str) -> bytes:
        return np.array(tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    with open(path, encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f)["added_tokens"]]
    return PieceCoder(encode_pieces, encode_whole, added, limit, block)

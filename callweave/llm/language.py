"""Language identification with bit-sliced Bloom filters of n-grams.

One filter array serves all languages: each slot is a bit mask with one bit a
language.  The masks in an n-gram's slots, combined by AND, name every language
that holds the n-gram at once.  Bits are summed over the n-grams of a text, each
language's sum is corrected for its share of false positives, and the largest
sum decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from .bpe import small_batches
from .labelled import fold
from .pieces import sections

if TYPE_CHECKING:
    import numpy as np

DOCS_A_LANGUAGE = 4_000  # documents a language that are learned from, picked by a hash of the id
SLOTS, HASHES = 1 << 20, 3
MOST_LANGUAGES = 256  # filters of that many take 32 MB; more values of ``lang`` are refused
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)  # odd 64-bit mixing constants


def ngrams(text: str) -> np.ndarray:
    """Keys of the 3- and 4-byte grams of a lower-cased text; all but letters
    count as a blank, and a gram may have a blank at its ends only."""
    import numpy as np

    out = []
    for part in sections(text):
        raw = np.frombuffer(f" {part.lower()} ".encode("utf-8", "replace"), np.uint8)
        raw = np.where((raw >= 128) | (raw >= 97) & (raw <= 122), raw, np.uint8(32)).astype(np.uint64)
        if len(raw) < 4:
            raw = np.r_[raw, [np.uint64(32)]]
        inner = raw != 32
        three = raw[:-2] | raw[1:-1] << np.uint64(8) | raw[2:] << np.uint64(16)
        out.append(three[inner[1:-1]] | np.uint64(3 << 40))
        four = three[:-1] | raw[3:] << np.uint64(24)
        out.append(four[inner[1:-2] & inner[2:-1]] | np.uint64(4 << 40))
    return np.concatenate(out)


@dataclass
class Filters:
    """masks[word, slot] holds bit l % 64 for language l = 64 * word + l % 64."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray

    def slots(self, keys: np.ndarray) -> list[np.ndarray]:
        import numpy as np

        shift = np.uint64(64 - SLOTS.bit_length() + 1)
        return [((keys ^ (keys >> np.uint64(17))) * np.uint64(m) >> shift).astype(np.int64) for m in MULTIPLIERS[:HASHES]]

    def mark(self, language: int, keys: np.ndarray) -> None:
        """Enters n-grams into a language's filter."""
        import numpy as np

        for s in self.slots(keys):
            self.masks[language // 64][s] |= np.uint64(1 << language % 64)

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """For each language, the n-grams that its filter claims, corrected; and all n-grams."""
        import numpy as np

        keys = ngrams(text)
        places = self.slots(keys)
        sums = np.zeros(len(self.languages))
        for word in range(len(self.masks)):
            hit = self.masks[word][places[0]]
            for s in places[1:]:
                hit = hit & self.masks[word][s]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                sums[64 * word + bit] = np.count_nonzero(hit & np.uint64(1 << bit))
        return np.maximum(0, sums - len(keys) * self.false_rate) / (1 - self.false_rate), len(keys)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of the corrected sums; ``und`` and 0 where the text
        is null or has no letter.  Ties go to the language with more training rows."""
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0
        sums, _ = self.counts(text)
        best = int(sums.argmax())
        return self.languages[best], float(sums[best] / sums.sum()) if sums.sum() > 0 else 0.0


def build(languages: list[str], word: np.ndarray | None = None, slot: np.ndarray | None = None, mask: np.ndarray | None = None) -> Filters:
    """Filters of the masks of slots (none: empty ones); the share of slots that a language fills tells its false positives."""
    import numpy as np

    masks = np.zeros(((len(languages) + 63) // 64 or 1, SLOTS), np.uint64)
    if word is not None and slot is not None and mask is not None:
        masks[word, slot] = mask.view(np.uint64)
    fill = [np.count_nonzero(masks[i // 64] & np.uint64(1 << i % 64)) / SLOTS for i in range(len(languages))]
    return Filters(languages, masks, np.array(fill) ** HASHES)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = DOCS_A_LANGUAGE) -> Filters:
    """Filters from documents outside fold 0 with a language and a text.

    Every n-gram of about ``most`` documents a language enters its filter.  Tasks mark the
    slots of theirs, Spark joins the masks of a slot by OR, and the driver gets a table of
    at most SLOTS masks for each 64 of at most MOST_LANGUAGES languages.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where((fold("doc_id") != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"column {lang_col} has more than {MOST_LANGUAGES} values; filters for so many would not fit")
    found = sorted(((r[1], r[0]) for r in counted), key=lambda x: (-x[0], x[1]))
    languages = [l for _, l in found]
    if not languages:
        return build([])
    part = F.create_map(*[F.lit(x) for n, l in found for x in (l, min(1 << 30, int((1 << 30) * most / n)))])
    sample = rows.where(F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) < part[F.col("lang")])

    number = {l: i for i, l in enumerate(languages)}

    def mark(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        filters = build(languages)
        for whole in batches:
            for b in small_batches(whole.select(["lang", "text"])):
                for l, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    filters.mark(number[l], ngrams(t))
        word, slot = np.nonzero(filters.masks)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(slot), pa.array(filters.masks[word, slot].view(np.int64))], ["word", "slot", "mask"])

    marked = sample.mapInArrow(mark, "word long, slot long, mask long").groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    return build(languages, *(marked.column(c).to_numpy() for c in ("word", "slot", "mask")))


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``.

    A null text, one without letters, or an empty model gives ``und`` and score
    0.  Equal texts get equal values; rows may repeat; a null id counts as held
    out; other columns are ignored; an empty table gives no rows.  The filters
    (8 MB for up to 64 languages, 32 MB at most) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = shared.value
        for whole in batches:
            for b in small_batches(whole):
                said = [model.predict(t) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double").select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "lang_pred", "score"
    )

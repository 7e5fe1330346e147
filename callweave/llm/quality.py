"""Document quality by Bradley-Terry pairwise ranking.

Preference pairs (a document labelled good before one labelled bad) teach linear
scores: the logistic loss of the difference of their features.  The decision
threshold is a quantile of the scores: the share of bad documents among the
labelled ones.  The score that is returned is a logistic curve through 0.3 at
that threshold.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from .bpe import close_all, small_batches
from .labelled import fold, labelled_texts

if TYPE_CHECKING:
    import numpy as np

MOST_LABELLED = 20_000  # labelled rows that are learned from, picked by a hash of the id
PAIRS_EACH = 8  # preference pairs for each labelled document
THRESHOLD = 0.3
SECTION = 1 << 20  # bytes; longer texts are read part by part, which changes no feature
SPACE = re.compile(rb"\s")


def _sections(raw: bytes) -> Iterator[bytes]:
    """The bytes cut between words into parts of about SECTION bytes, so that no list of all words is held."""
    at = 0
    while at < len(raw):
        cut = SPACE.search(raw, at + SECTION)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def features(text: str | None) -> np.ndarray:
    """Shares and counts of ASCII classes, of word repeats and word shapes."""
    import numpy as np

    raw = (text or "").encode("utf-8", "replace")
    bytes_seen = np.zeros(256, np.int64)
    words = repeats = shouts = letters = 0
    distinct: set[bytes] = set()
    before = None
    for part in _sections(raw):
        bytes_seen += np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        ws = part.split()
        words += len(ws)
        distinct.update(ws)
        repeats += sum(map(operator.eq, ws, ws[1:])) + (ws[:1] == [before])
        before = ws[-1] if ws else before
        shouts += sum(map(bytes.isupper, ws))
        letters += sum(map(bytes.isalpha, ws))
    marked = words - letters
    size, n = max(1, len(raw)), max(1, words)
    ascii_marks = np.r_[bytes_seen[33:48], bytes_seen[58:65], bytes_seen[91:97], bytes_seen[123:127]]
    upper, digits = bytes_seen[65:91].sum(), bytes_seen[48:58].sum()
    return np.r_[
        np.log1p(ascii_marks),
        ascii_marks / size * 20,
        [
            upper / size * 5,
            digits / size * 5,
            bytes_seen[128:].sum() / size,
            bytes_seen[10] / size * 50,
            math.log1p(size) / 5,
            math.log1p(repeats),
            repeats / n * 5,
            math.log1p(shouts),
            shouts / n * 5,
            marked / n * 5,
            len(distinct) / n,
            size / n / 10,
        ],
    ].astype(np.float64)


@dataclass
class Ranking:
    """Linear scores; ``bar`` is the score at the quantile, ``slope`` scales the curve."""

    centre: np.ndarray
    weights: np.ndarray
    bar: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        import numpy as np

        z = np.clip(self.slope * (self.raw(x) - self.bar), -30, 30) + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-z))


def gradient(w: np.ndarray, differences: np.ndarray, penalty: float) -> np.ndarray:
    """Of the mean of log(1 + exp(-d.w)) over the feature differences d, and penalty / 2 of |w|^2."""
    import numpy as np

    loss = 1 / (1 + np.exp(np.clip(differences @ w, -30, 30)))
    return penalty * w - (loss[:, None] * differences).mean(0)


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7, steps: int = 400, penalty: float = 1e-4) -> Ranking:
    """Learns from features and 0/1 labels.  With one class only there is no pair:
    all scores are then one value, above the threshold unless every label is 0."""
    import numpy as np

    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        width = x.shape[1] if x.ndim == 2 and x.shape[1] else len(features(""))
        return Ranking(np.zeros(width), np.zeros(width), 1.0 if len(bad) else -1.0, 1.0)
    rng = np.random.default_rng(seed)
    centre, spread = x.mean(0), x.std(0) + 1e-3
    z = np.clip((x - centre) / spread, -20, 20)
    n = PAIRS_EACH * len(y)
    diff_of = rng.choice(good, n), rng.choice(bad, n)
    w, mean, square = np.zeros(z.shape[1]), np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for step in range(1, steps + 1):
        pick = rng.integers(0, n, 4096)
        d = z[diff_of[0][pick]] - z[diff_of[1][pick]]
        grad = gradient(w, d, penalty)
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        w -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = w / spread
    scores = (x - centre) @ weights
    share = len(bad) / len(y)
    bar = float(np.quantile(scores, share))
    above = scores[scores > bar]
    slope = 3.0 / max(1e-6, float(np.median(above) - bar)) if len(above) else 1.0
    return Ranking(centre, weights, bar, slope)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> Ranking:
    """Ranking from the labelled documents outside fold 0.  Features are computed
    on the executors; the driver gets those of about ``most`` rows at most."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for b in small_batches(whole):
                xs = [features(t).astype("<f4").tobytes() for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), b.column(2)], ["x", "y"])

    import numpy as np

    rows = labelled_texts(docs, labels, "quality", most, id_col, text_col).mapInArrow(run, "x binary, y int").collect()
    x = np.array([np.frombuffer(r[0], "<f4") for r in rows], np.float64).reshape(len(rows), len(features("")))
    y = np.array([r[1] for r in rows])
    order = np.lexsort((y, *x.T[:3])) if len(rows) else []  # the same order whatever task ended first
    return fit(x[order], y[order])


def score(docs: DataFrame, ranking: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Null, empty and blank texts get the score of a text without words.  Rows may
    repeat; equal texts score alike; a null id counts as held out; other columns
    are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for b in small_batches(whole):
                x = np.array([features(t) for t in b.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ranking.score(x))], ["doc_id", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns.

    Each row is judged by its text alone: null and empty texts as texts without
    words, equal texts alike, whatever their ids; other columns, of any name,
    play no part; an empty table stays empty.
    """
    ranking = learn(docs, labels)

    @F.arrow_udf("double")
    def quality(texts):  # type: ignore[no-untyped-def]
        import numpy as np
        import pyarrow as pa

        close_all()
        x = np.array([features(t.as_py()) for t in texts]).reshape(len(texts), len(ranking.centre))
        return pa.array(ranking.score(x), pa.float64())

    return docs.where(quality(F.col("text").cast("string")) >= THRESHOLD)

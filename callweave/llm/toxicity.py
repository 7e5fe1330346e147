"""Toxicity severity by cumulative-link ordinal regression.

P(grade > k) = logistic(w.x - t_k) with one weight vector for all of the ordered
thresholds t_1 < t_2 < t_3.  x holds log counts of words and word starts of a
text.  Labels say toxic or not; the grades to learn are 0 for a clean document
and 1, 2, 3 for a toxic one, by the tertile of its number of words that lean to
toxic documents.  The result is the expected grade and the chance of any.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from .bpe import close_all, small_batches
from .labelled import labelled_texts
from .pieces import sections

if TYPE_CHECKING:
    import numpy as np

MOST_LABELLED = 20_000  # labelled rows that are learned from, picked by a hash of the id
FEATURES, LEAST_DOCS, STARTS, GRADES = 1024, 5, (4, 5), 3
WORD = re.compile(r"[^\W\d_]+")
WORD_MEMORY = 200_000


def word_counts(text: str | None) -> Counter:
    out: Counter = Counter()
    for part in sections((text or "").lower()):
        out.update(WORD.findall(part))
    return out


def word_features(word: str) -> tuple[str, ...]:
    """The word, and its starts where it is longer."""
    return (word, *[f"{word[:n]}*" for n in STARTS if len(word) > n])


@dataclass
class Severity:
    vocabulary: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    bar: float = 0.5  # chance of grade 1 or more from which a text counts as toxic

    def __post_init__(self) -> None:
        self._seen: dict[str, tuple[int, ...]] = {}

    def __getstate__(self) -> tuple:
        return self.vocabulary, self.weights, self.thresholds, self.bar

    def __setstate__(self, state: tuple) -> None:
        self.vocabulary, self.weights, self.thresholds, self.bar = state
        self._seen = {}

    def vector(self, text: str | None) -> dict[int, float]:
        """Feature number to log(1 + count)."""
        import math

        seen, found = self._seen, Counter()
        if len(seen) > WORD_MEMORY:
            seen.clear()
        for word, n in word_counts(text).items():
            ids = seen.get(word)
            if ids is None:
                ids = seen[word] = tuple(self.vocabulary[f] for f in word_features(word) if f in self.vocabulary)
            for i in ids:
                found[i] += n
        return {i: math.log1p(n) for i, n in found.items()}

    def chances(self, text: str | None) -> np.ndarray:
        """P(grade > 0), P(grade > 1), P(grade > 2)."""
        return self.chance_of(self.vector(text))

    def chance_of(self, vector: dict[int, float]) -> np.ndarray:
        import numpy as np

        z = sum(self.weights[i] * v for i, v in vector.items())
        return 1 / (1 + np.exp(-np.clip(z - self.thresholds, -30, 30)))


PENALTY = 1e-4  # on squared weights


def cuts_of(p: np.ndarray, width: int) -> np.ndarray:
    """Thresholds in ascending order, from the first one and the logs of the gaps after it."""
    import numpy as np

    return p[width] + np.r_[0, np.cumsum(np.exp(p[width + 1 :]))]


def gradient(p: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Gradient of the mean negative log-likelihood of the grades ``y`` and the penalty.

    ``p`` holds the weights, the first threshold and the logs of the gaps.
    """
    import numpy as np

    width = x.shape[1]
    gaps, cuts = np.exp(p[width + 1 :]), cuts_of(p, width)
    z = x @ p[:width]
    upper = np.c_[np.ones(len(y)), _logistic(z[:, None] - cuts), np.zeros(len(y))]  # P(grade >= k)
    rows = np.arange(len(y))
    here = np.maximum(upper[rows, y] - upper[rows, y + 1], 1e-9)
    slope = upper * (1 - upper)
    # d log P / dz, and d log P / d cut_k
    dz = (slope[rows, y] - slope[rows, y + 1]) / here
    dcut = np.zeros((len(y), GRADES + 2))
    np.add.at(dcut, (rows, y), -slope[rows, y] / here)
    np.add.at(dcut, (rows, y + 1), slope[rows, y + 1] / here)
    each = dcut[:, 1:-1].mean(0)
    later = np.cumsum(each[::-1])[::-1]  # a gap moves its own cut and all after it
    return np.r_[PENALTY * p[:width] - (x * dz[:, None]).mean(0), -later[0], -later[1:] * gaps]


def _logistic(z: np.ndarray) -> np.ndarray:
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(vectors: list[dict[int, float]], grades: np.ndarray, width: int, seed: int = 7, steps: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps on the cumulative-link likelihood."""
    import numpy as np

    thresholds = np.array([4.0, 5.0, 6.0])
    if not len(vectors) or not width:
        return np.zeros(width), thresholds
    x = np.zeros((len(vectors), width), np.float32)
    for row, v in enumerate(vectors):
        x[row, list(v)] = list(v.values())
    rng = np.random.default_rng(seed)
    p = np.r_[np.zeros(width), 1.0, 0.0, 0.0]
    mean, square = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), min(2048, 4 * len(x)))
        grad = gradient(p, x[pick], grades[pick])
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        p -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return p[:width], cuts_of(p, width)


def best_bar(chances: np.ndarray, toxic: np.ndarray) -> float:
    """The chance that tells the labelled classes apart best: the most of the share
    of toxic documents at or above it less that of clean ones.  Of a range of
    equally good ones it is the middle on the logit scale."""
    import numpy as np

    z = np.log(chances) - np.log1p(-chances)
    order = np.argsort(-z, kind="stable")
    z, y = z[order], toxic[order]
    gain = np.cumsum(np.where(y, 1 / max(1, y.sum()), -1 / max(1, (~y).sum())))
    last = np.r_[z[:-1] > z[1:], True]  # a bar falls between different chances only
    i = int(np.flatnonzero(last)[np.argmax(gain[last])])
    below = z[i + 1] if i + 1 < len(z) else z[i] - 1
    return float(1 / (1 + np.exp(-(z[i] + below) / 2)))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> Severity:
    """Severity model from the labelled documents outside fold 0.

    Words are counted over the sample in Spark; the driver gets the FEATURES that
    tell the classes apart best, and the sample's counts of these.  Without toxic
    or without clean labels every text has grade 0.
    """
    import numpy as np

    sample = labelled_texts(docs, labels, "toxic", most, id_col, text_col)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for b in small_batches(whole):
                n, toxic = Counter(), Counter()
                for text, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    fs = {f for w in word_counts(text) for f in word_features(w)}
                    n.update(fs)
                    if y:
                        toxic.update(fs)
                yield pa.RecordBatch.from_pydict({"f": list(n), "n": list(n.values()), "toxic": [toxic[f] for f in n]}, schema=pa.schema([("f", pa.string()), ("n", pa.int64()), ("toxic", pa.int64())]))

    of = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    bad, good = of.get(1, 0), of.get(0, 0)
    if not bad or not good:
        return Severity({}, np.zeros(0), np.array([4.0, 5.0, 6.0]))
    # Dunning's log-likelihood ratio of the feature and the class, signed by the class it leans to
    share = F.lit(bad / (bad + good))
    clean = F.col("n") - F.col("toxic")
    gain = F.when(F.col("toxic") > 0, F.col("toxic") * F.log(F.col("toxic") / F.col("n") / share)).otherwise(0.0) + F.when(
        clean > 0, clean * F.log(clean / F.col("n") / (1 - share))
    ).otherwise(0.0)
    weight = gain * F.when(F.col("toxic") / F.col("n") > share, 1).otherwise(-1)
    ranked = (
        sample.mapInArrow(count, "f string, n long, toxic long")
        .groupBy("f")
        .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
        .where(F.col("n") >= min(LEAST_DOCS, bad))
        .select("f", weight.alias("w"))
        .orderBy(F.desc(F.abs("w")), "f")
        .limit(FEATURES)
        .collect()
    )
    model = Severity({r[0]: i for i, r in enumerate(ranked)}, np.zeros(len(ranked)), np.zeros(GRADES))
    leaning = np.array([r[1] > 0 for r in ranked], bool)

    def describe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for b in small_batches(whole):
                vs = [model.vector(t) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([list(v) for v in vs], pa.list_(pa.int32())), pa.array([list(v.values()) for v in vs], pa.list_(pa.float64())), b.column(2)],
                    ["doc_id", "i", "v", "y"],
                )

    rows = sorted(sample.mapInArrow(describe, "doc_id long, i array<int>, v array<double>, y int").collect(), key=lambda r: (r[0], r[3], r[1]))
    vectors = [dict(zip(r[1], r[2])) for r in rows]
    toxic = np.array([r[3] for r in rows]) == 1
    hits = np.array([sum(np.expm1(v) for i, v in x.items() if leaning[i]) for x in vectors])
    cuts = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + np.searchsorted(cuts, hits), 0)
    model.weights, model.thresholds = fit(vectors, grades, len(ranked))
    model.bar = best_bar(np.array([model.chance_of(v)[0] for v in vectors]), toxic)
    return model


def score(docs: DataFrame, model: Severity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic), one row per row of ``docs``.

    severity is the expected grade (0 to 3), p_toxic the chance of grade 1 or
    more, grade the most likely one, toxic whether p_toxic reaches the learned bar.
    Null, empty and blank texts are scored as texts without words.  Rows may
    repeat, ids may be null, other columns are ignored, an empty table gives no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for b in small_batches(whole):
                p = np.array([model.chances(t) for t in b.column(1).to_pylist()])
                each = -np.diff(np.c_[np.ones(len(p)), p, np.zeros(len(p))], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(each.argmax(1).astype(np.int32)), pa.array(p[:, 0] >= model.bar)],
                    ["doc_id", "severity", "p_toxic", "grade", "toxic"],
                )

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, severity double, p_toxic double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.

    Each row is judged by its text alone: null and empty texts as texts without
    words, equal texts alike, whatever their ids; other columns, of any name,
    play no part; an empty table stays empty.
    """
    model = learn(docs, labels)

    @F.arrow_udf("double")
    def chance(texts):  # type: ignore[no-untyped-def]
        import pyarrow as pa

        close_all()
        return pa.array([float(model.chances(t.as_py())[0]) for t in texts], pa.float64())

    return docs.where(chance(F.col("text").cast("string")) < model.bar)

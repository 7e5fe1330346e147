"""Repeated byte strings by prefix-free parsing.

A rolling hash decides where texts are cut: of the hashes of WINDOW consecutive
places, the least is a trigger, so there is one in every WINDOW places and equal
strings have equal triggers.  The places that take the same trigger are a phrase:
it reaches from its first place over the trigger to ``length`` bytes after its last
one, which is all that the parse says about strings that begin in it.

Strings that are equal have the same trigger at the same distance.  So phrases meet
at the bytes from the trigger on that every string of the phrase holds (its core):

* cores that occur once: no string that begins in the phrase is repeated;
* phrases that occur again as a whole: all of them are;
* the others go by their bytes, and with them one of each phrase that occurs again and
  shares their core.  Where they meet, the parts before the trigger are
  sorted backwards (the suffix array of the dictionary) and those from the trigger on
  forwards (that of the parse), each with the common lengths of neighbours.  Strings
  with d bytes before the trigger are equal if they are in one run of the first array
  with common lengths of d or more and in one of the second with length - d or more:
  both runs together are their place in the order of the corpus.

Texts travel as compressed chunks of some megabytes.  A chunk asks each bucket of
cores about its phrases, each kind once, and gets one byte an answer: a phrase that
a third of all documents hold is asked about once a chunk and not once a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from .storage import written

if TYPE_CHECKING:
    import numpy as np

LENGTH = 200
WINDOW = 96  # places that have at least one trigger
GRAM = 8  # bytes that the rolling hash covers
CHUNK = 1 << 22  # bytes of text in a chunk; a longer text is a chunk of its own
BLOCK = 1 << 20  # places looked at in one step
BUCKET = 1 << 25  # bytes of text for each bucket of cores
LEAST_BUCKETS = 256
UNIQUE, OPEN, SETTLED, WITNESS = 0, 1, 2, 3


# One chunk of texts
def anchors(text: np.ndarray, count: int) -> np.ndarray:
    """The trigger of each of the first ``count`` (at most BLOCK) places: among the places p to
    p + WINDOW - 1 the last one with the least hash of the GRAM bytes from there on."""
    import numpy as np

    n = count + WINDOW - 1
    part = text[: n + GRAM - 1].astype(np.uint64)
    grams = np.zeros(n, np.uint64)
    for i in range(GRAM):
        grams = grams << np.uint64(8) | part[i : i + n]
    grams *= np.uint64(0x9E3779B97F4A7C15)
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    # The hash above, and below it the place counted backwards, so that the last of equal ones is the least.
    low = np.uint64((1 << 21) - 1)
    best = grams & ~low | low - np.arange(n, dtype=np.uint64)
    width = 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        best = np.minimum(best[:-step], best[step:])
        width += step
    return (low - (best & low)).astype(np.int64)


def phrases(text: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, trigger) of the phrases of texts that end at ``ends`` of ``text``: the
    runs of places with one trigger.  The last ``length`` - 1 places of a text begin no string.
    Blocks cut runs, which costs a comparison by bytes and changes no result."""
    import numpy as np

    raw, count = np.frombuffer(text, np.uint8), len(text) - length + 1
    out = [(np.empty(0, np.int64),) * 3]
    for at in range(0, count, BLOCK):
        n = min(BLOCK, count - at)
        trigger = anchors(raw[at:], n)
        near = ends[np.searchsorted(ends, at) : np.searchsorted(ends, at + n + length) + 1]
        for end in near.tolist():
            trigger[max(0, end - length + 1 - at) : max(0, end - at)] = -1
        edge = np.flatnonzero(np.diff(trigger)) + 1
        first, last = np.concatenate([[0], edge]), np.concatenate([edge, [n]]) - 1
        sound = trigger[first] >= 0
        out.append((at + first[sound], at + last[sound], at + trigger[first[sound]]))
    first, last, trigger = (np.concatenate(x) for x in zip(*out))
    return first, last, trigger


def digests_of(text: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    import numpy as np
    import xxhash

    digest, view = xxhash.xxh3_64_intdigest, memoryview(text)
    return np.fromiter((digest(view[a:b]) for a, b in zip(starts.tolist(), stops.tolist())), np.uint64, len(starts))


class Parse:
    """The phrases of a chunk, and its questions: each distinct (core, phrase) once, by bucket."""

    def __init__(self, blob: bytes, sizes: list[int], length: int, buckets: int) -> None:
        import numpy as np
        import zstandard

        self.text = zstandard.ZstdDecompressor().decompress(blob) if blob else b""
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.length = length
        self.first, self.last, self.trigger = phrases(self.text, self.ends, length)
        core = digests_of(self.text, self.trigger, self.trigger + (length - WINDOW + 1))
        whole = digests_of(self.text, self.first, self.last + length)
        order = np.lexsort((whole, core, core % np.uint64(buckets)))
        core, whole = core[order], whole[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (core[1:] != core[:-1]) | (whole[1:] != whole[:-1])
        at = np.flatnonzero(fresh)
        self.core, self.whole = core[at], whole[at]
        self.twice = np.diff(np.concatenate([at, [len(order)]])) > 1
        self.example = order[at]  # a phrase of each kind
        self.kind = np.empty(len(order), np.int64)
        self.kind[order] = np.cumsum(fresh) - 1
        bucket = (self.core % np.uint64(buckets)).astype(np.int64)
        self.buckets, self.starts = np.unique(bucket, return_index=True)
        self.stops = np.concatenate([self.starts[1:], [len(bucket)]]).astype(np.int64)

    def states(self, answers: list | None) -> np.ndarray:
        """What the buckets said of each kind."""
        import numpy as np

        out = np.zeros(len(self.core), np.uint8)
        said = {a["bucket"]: a["states"] for a in answers or []}
        for b, start, stop in zip(self.buckets.tolist(), self.starts.tolist(), self.stops.tolist()):
            if b in said:
                out[start:stop] = np.frombuffer(said[b], np.uint8)
        return out

    def open_kinds(self, states: np.ndarray, start: int, stop: int) -> np.ndarray:
        """The kinds that are compared by their bytes."""
        import numpy as np

        return start + np.flatnonzero((states[start:stop] == OPEN) | (states[start:stop] == WITNESS))


def states_of(core: np.ndarray, whole: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """UNIQUE, OPEN or SETTLED for each question that reached a bucket.  Of a settled phrase
    that open ones have to be compared with, one is the WITNESS."""
    import numpy as np

    order = np.lexsort((whole, core))
    core, whole, times = core[order], whole[order], 1 + twice[order].astype(np.int64)

    def again(fresh: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(fresh)
        return (np.add.reduceat(times, at) > 1)[np.cumsum(fresh) - 1]

    new_core = np.concatenate([[True], core[1:] != core[:-1]])
    new_whole = new_core | np.concatenate([[True], whole[1:] != whole[:-1]])
    settled = again(new_whole)
    state = np.where(settled, SETTLED, np.where(again(new_core), OPEN, UNIQUE)).astype(np.uint8)
    some_open = np.add.reduceat((state == OPEN).astype(np.int64), np.flatnonzero(new_core)) > 0
    state[new_whole & settled & some_open[np.cumsum(new_core) - 1]] = WITNESS
    out = np.empty(len(order), np.uint8)
    out[order] = state
    return out


# The dictionary's and the parse's order
def _ranked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the order of equally long byte rows, and the common length of each with the one before."""
    import numpy as np

    wide = -rows.shape[1] % 8
    padded = np.pad(rows, ((0, 0), (0, wide))) if wide else np.ascontiguousarray(rows)
    words = padded.view(">u8")
    order = np.lexsort(tuple(words[:, i] for i in range(words.shape[1] - 1, -1, -1)))
    common = np.zeros(len(rows), np.int64)
    for at in range(1, len(rows), 1 << 14):
        here, before = rows[order[at : at + (1 << 14)]], rows[order[at - 1 : at - 1 + (1 << 14)]][: len(order[at : at + (1 << 14)])]
        differs = here != before
        common[at : at + len(here)] = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return order, common


def repeats(texts: list[bytes], before: np.ndarray, places: np.ndarray, length: int) -> list[bytes]:
    """For phrases (bytes, bytes before the trigger, places), which of their places begin a
    string that begins in another one too, as packed bits.

    ``before`` is at most WINDOW - 1.  The parts before the trigger, read backwards, and
    the parts from it on are sorted once each; every distance to the trigger then takes
    runs of both orders, and strings that share both are equal.
    """
    import numpy as np

    m = len(texts)
    left, right = np.zeros((m, WINDOW), np.uint8), np.zeros((m, length), np.uint8)
    for i, (t, b) in enumerate(zip(texts, before.tolist())):
        whole = np.frombuffer(t, np.uint8)
        left[i, :b] = whole[:b][::-1]
        right[i, : len(t) - b] = whole[b:]
    found = np.zeros((m, WINDOW), bool)  # by distance to the trigger
    by_left, common_left = _ranked(left)
    by_right, common_right = _ranked(right)
    run_left, run_right = np.empty(m, np.int64), np.empty(m, np.int64)
    nearest = before - places + 1
    for d in range(int(nearest.min()), int(before.max()) + 1):
        run_left[by_left] = np.cumsum(common_left < d)
        run_right[by_right] = np.cumsum(common_right < length - d)
        inside = np.flatnonzero((nearest <= d) & (d <= before))
        if len(inside) < 2:
            continue
        place = run_left[inside] * (m + 1) + run_right[inside]
        order = np.argsort(place, kind="stable")
        same = place[order[1:]] == place[order[:-1]]
        hit = np.zeros(len(inside), bool)
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
        found[inside[hit], d] = True
    return [np.packbits(found[i, b - np.arange(n)]).tobytes() for i, (b, n) in enumerate(zip(before.tolist(), places.tolist()))]


# Spark's part
def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(chunk, ids, sizes, blob), a written table: texts in chunks of about CHUNK bytes."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        number = (TaskContext.get().partitionId() << 32) - 1
        packer = zstandard.ZstdCompressor(level=1)
        ids: list = []
        texts: list[bytes] = []

        def chunk() -> pa.RecordBatch:
            nonlocal number, ids, texts
            number += 1
            columns = [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([packer.compress(b"".join(texts))], pa.binary())]
            ids, texts = [], []
            return pa.RecordBatch.from_arrays(columns, ["chunk", "ids", "sizes", "blob"])

        held = 0
        for b in batches:
            for i in range(b.num_rows):
                text = b.column(1)[i].as_py() or b""
                if held and held + len(text) > CHUNK:
                    yield chunk()
                    held = 0
                ids.append(b.column(0)[i].as_py())
                texts.append(text)
                held += len(text)
        if ids:
            yield chunk()

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return written(src.mapInArrow(run, "chunk long, ids array<long>, sizes array<long>, blob binary"), "chunks")


def _asked(chunk_rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, chunk, core, whole, twice): the questions of each chunk, packed."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                p = Parse(r["blob"], r["sizes"], length, buckets)
                spans = list(zip(p.starts.tolist(), p.stops.tolist()))
                columns = [pa.array(p.buckets), pa.array([r["chunk"]] * len(spans), pa.int64())]
                columns += [pa.array([x[s:t].tobytes() for s, t in spans], pa.binary()) for x in (p.core, p.whole, p.twice)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "core", "whole", "twice"])

    return chunk_rows.select("chunk", "sizes", "blob").mapInArrow(run, "bucket long, chunk long, core binary, whole binary, twice binary")


def _by_bucket(rows: Iterator) -> Iterator[list[dict]]:
    """The rows of each bucket, where batches come sorted by it."""
    held: list[dict] = []
    for b in rows:
        for r in b.to_pylist():
            if held and held[0]["bucket"] != r["bucket"]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _states(asked: DataFrame, parts: int) -> DataFrame:
    """(chunk, bucket, states): a byte for each question, where any is not UNIQUE."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for rows in _by_bucket(batches):
            core, whole = (np.concatenate([np.frombuffer(r[c], np.uint64) for r in rows]) for c in ("core", "whole"))
            out = states_of(core, whole, np.concatenate([np.frombuffer(r["twice"], bool) for r in rows]))
            cuts = np.cumsum([len(r["twice"]) for r in rows])[:-1]
            said = [(r["chunk"], s.tobytes()) for r, s in zip(rows, np.split(out, cuts)) if s.any()]
            columns = [pa.array([c for c, _ in said], pa.int64()), pa.array([rows[0]["bucket"]] * len(said), pa.int64()), pa.array([s for _, s in said], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "bucket", "states"])

    return asked.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "chunk long, bucket long, states binary")


def _told(chunk_rows: DataFrame, states: DataFrame) -> DataFrame:
    """Chunks with the answers they got: at most one for each bucket."""
    answers = states.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "states")).alias("answers"))
    return chunk_rows.join(answers.hint("merge"), "chunk", "left")


def _open_phrases(told: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, chunk, texts, before, places): the open phrases of each chunk by their bytes."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                p = Parse(r["blob"], r["sizes"], length, buckets)
                states = p.states(r["answers"])
                out: list[list] = [[], [], [], []]
                for bucket, start, stop in zip(p.buckets.tolist(), p.starts.tolist(), p.stops.tolist()):
                    e = p.example[p.open_kinds(states, start, stop)]
                    if len(e):
                        out[0].append(bucket)
                        out[1].append([p.text[a:z] for a, z in zip(p.first[e].tolist(), (p.last[e] + length).tolist())])
                        out[2].append((p.trigger[e] - p.first[e]).astype(np.uint8).tobytes())
                        out[3].append((p.last[e] - p.first[e] + 1).astype(np.uint8).tobytes())
                columns = [pa.array(out[0], pa.int64()), pa.array([r["chunk"]] * len(out[0]), pa.int64()), pa.array(out[1], pa.list_(pa.binary())), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "texts", "before", "places"])

    asked = told.where("answers is not null").select("chunk", "sizes", "blob", "answers")
    return asked.mapInArrow(run, "bucket long, chunk long, texts array<binary>, before binary, places binary")


def _repeats(open_rows: DataFrame, length: int, parts: int) -> DataFrame:
    """(chunk, bucket, bits): for each open phrase, the places that begin a repeated string."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for rows in _by_bucket(batches):
            texts = [t for r in rows for t in r["texts"]]
            before, places = (np.frombuffer(b"".join(r[c] for r in rows), np.uint8).astype(np.int64) for c in ("before", "places"))
            bits = repeats(texts, before, places, length)
            at, out = 0, []
            for r in rows:
                out.append(bits[at : at + len(r["texts"])])
                at += len(r["texts"])
            columns = [pa.array([r["chunk"] for r in rows], pa.int64()), pa.array([r["bucket"] for r in rows], pa.int64()), pa.array(out, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "bucket", "bits"])

    return open_rows.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "chunk long, bucket long, bits array<binary>")


def _covered(p: Parse, states: np.ndarray, answers: list | None) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the runs of bytes that repeated strings cover, in order."""
    import numpy as np

    state = states[p.kind]
    said = {a["bucket"]: a["bits"] for a in answers or []}
    bits_of: dict[int, bytes] = {}
    for bucket, start, stop in zip(p.buckets.tolist(), p.starts.tolist(), p.stops.tolist()):
        if bucket in said:
            bits_of.update((k, bits) for k, bits in zip(p.open_kinds(states, start, stop).tolist(), said[bucket]) if any(bits))
    settled = state >= SETTLED
    begins, lasts = [p.first[settled]], [p.last[settled]]
    for i in np.flatnonzero(state == OPEN).tolist():
        if (bits := bits_of.get(int(p.kind[i]))) is not None:
            at = p.first[i] + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8)))
            begins.append(at)
            lasts.append(at)
    begin, end = np.concatenate(begins), np.concatenate(lasts) + p.length
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    fresh = np.ones(len(begin), bool)
    of = np.searchsorted(p.ends, begin, "right")
    fresh[1:] = (begin[1:] > end[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(fresh)
    return begin[at], end[np.concatenate([at[1:], [len(begin)]]) - 1] if len(at) else end


def _removed(told: DataFrame, bits: DataFrame, length: int, buckets: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                p = Parse(r["blob"], r["sizes"], length, buckets)
                begin, end = _covered(p, p.states(r["answers"]), r["found"])
                text, sizes = memoryview(p.text), r["sizes"]
                removed, spans, digests = [], [], []
                for stop, size in zip(p.ends.tolist(), sizes):
                    at, i, j = stop - size, *np.searchsorted(begin, [stop - size, stop]).tolist()
                    kept = hashlib.sha256()
                    for gone, back in zip(begin[i:j].tolist(), end[i:j].tolist()):
                        kept.update(text[at:gone])
                        at = back
                    kept.update(text[at:stop])
                    digests.append(kept.hexdigest())
                    removed.append(int((end[i:j] - begin[i:j]).sum()))
                    spans.append(j - i)
                columns = [pa.array(r["ids"], pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = bits.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("found"))
    rows = told.join(found.hint("merge"), "chunk", "left").select("chunk", "ids", "sizes", "blob", "answers", "found")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``:
    what is left when each byte goes that is covered by a string of ``length`` bytes
    which also begins anywhere else, in the same text or another.

    Null counts as empty; texts shorter than ``length`` stay whole; a text that
    occurs twice goes whole, in all its rows; ids may be null or repeat; other
    columns are ignored; an empty table gives no rows.  A text of any length is one
    chunk at most, looked at in blocks.
    """
    if length <= WINDOW + GRAM:
        raise ValueError(f"length must be over {WINDOW + GRAM}")
    spark = docs.sparkSession
    held = chunks(docs, id_col, text_col)
    total = held.agg(F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, total // BUCKET)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    states = written(_states(_asked(held, length, buckets), parts), "states")
    told = _told(held, states)
    bits = written(_repeats(_open_phrases(told, length, buckets), length, parts), "repeats")
    return _removed(told, bits, length, buckets)

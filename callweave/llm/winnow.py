"""Benchmark decontamination by winnowing, in DataFrame operations only.

Of every WINDOW - GRAM + 1 consecutive word 5-grams the one with the smallest
hash is a fingerprint.  A span of WINDOW words that a document and an item share
holds the same run of 5-grams in both, hence a common fingerprint.

The first pass over the documents only finds which texts share a fingerprint
with an item; its rows carry hashes and counts, never texts.  The second pass
reads those texts alone.  There each place of a fingerprint is extended: the
words around it are compared with those around the fingerprint in an item, so
every result is exact.  Items that agree around a fingerprint share one context,
so a phrase that many items hold is compared once.

An item of fewer than WINDOW words is one window: all spans of its length are
fingerprints then, for the lengths that occur among the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import small, written

WINDOW, GRAM = 10, 5
AROUND = WINDOW - GRAM  # words on each side of a 5-gram that windows around it reach
SPREAD = AROUND + 1  # 5-grams in a window
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what is between words


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null has none."""
    only_ascii = F.length(text) == F.octet_length(text)
    ascii_lower = F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(ascii_lower, GAP), ""), F.array().cast("array<string>"))


def _ahead(values: str, by: int) -> Column:
    """The array from its element ``by`` on."""
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values), F.lit(1)))


def _first(values: Column, n: Column) -> Column:
    return F.slice(values, F.lit(1), F.greatest(n, F.lit(0)))


def _with_grams(df: DataFrame) -> DataFrame:
    """``df`` with the hash of each 5-gram of the column ``words``: pairs, then fours, then
    fives.  Hashes of words are shifted by different widths and added bit by bit: in a
    lambda, which is not compiled, that takes a fifth of the time of hashing them again."""
    df = df.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("twos", F.zip_with("h", _ahead("h", 1), lambda x, y: x.bitwiseXOR(F.shiftleft(y, 7))))
    df = df.withColumn("fours", F.zip_with("twos", _ahead("twos", 2), lambda x, y: x.bitwiseXOR(F.shiftleft(y, 17))))
    fives = F.zip_with("fours", _ahead("h", 4), lambda x, y: x.bitwiseXOR(F.shiftleft(y, 29)))
    return df.withColumn("grams", _first(fives, F.size("h") - (GRAM - 1))).drop("twos", "fours")


def _with_minima(df: DataFrame) -> DataFrame:
    """``df`` with the smallest of each SPREAD consecutive ``grams``: of twos, then fours, then sixes."""
    least = lambda x, y: F.least(x, y)
    df = df.withColumn("twos", F.zip_with("grams", _ahead("grams", 1), least))
    df = df.withColumn("fours", F.zip_with("twos", _ahead("twos", 2), least))
    sixes = F.zip_with("fours", _ahead("twos", 4), least)
    return df.withColumn("minima", _first(sixes, F.size("grams") - (SPREAD - 1))).drop("twos", "fours")


def _starts(n: Column, length: int) -> Column:
    """0 to n - length, or an empty array."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def _span(i: Column | int, length: int) -> Column:
    """Hash of ``length`` words from word i on."""
    return F.xxhash64(F.lit(length), *[F.get("h", i + F.lit(j)) for j in range(length)])


def _spans(length: int) -> Column:
    """(at, hash) of every run of ``length`` words."""
    return F.transform(_starts(F.size("h"), length), lambda i: F.struct(i.alias("at"), _span(i, length).alias("hash")))


def _text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")]


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, ids, words): one row per distinct word sequence, with the sorted ids
    of the benchmark rows that have it.  Rows without words are left out."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), words(F.col(text_col).cast("string")).alias("words"))
    rows = rows.where(F.size("words") > 0).groupBy("words").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return written(rows.select(F.monotonically_increasing_id().alias("item"), "ids", "words"), "items")


def item_contexts(items: DataFrame, short: list[int]) -> tuple[DataFrame, DataFrame]:
    """(c, hash, lead, around, need) and (c, item).

    A context is a fingerprint with the words that windows around it reach,
    ``lead`` of them before it, and the length of a window.  Every place whose
    hash is the least of a window counts, also where several are equal.
    """
    long_items = _with_minima(_with_grams(items.where(F.size("words") >= WINDOW)))
    lead = F.least("at", F.lit(AROUND))
    least = long_items.select("item", F.explode_outer("minima").alias("hash")).distinct()
    places = long_items.select("item", "words", F.posexplode_outer("grams").alias("at", "hash")).join(least, ["item", "hash"], "left_semi").select(
        "item", "hash", lead.alias("lead"), F.slice("words", F.col("at") - lead + 1, lead + (GRAM + AROUND)).alias("around"), F.lit(WINDOW).alias("need")
    )
    hashed = items.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    for m in short:
        whole = hashed.where(F.size("words") == m).select("item", _span(0, m).alias("hash"), F.lit(0).alias("lead"), F.col("words").alias("around"), F.lit(m).alias("need"))
        places = places.unionByName(whole)
    places = written(places, "item-places")
    context = ["hash", "lead", "around", "need"]
    contexts = written(places.select(*context).distinct().withColumn("c", F.monotonically_increasing_id()), "contexts")
    return contexts, written(places.join(contexts, context).select("c", "item").distinct(), "context-items")


def _met(docs: DataFrame, contexts: DataFrame, short: list[int]) -> DataFrame:
    """(doc_id, a, b, n_words, met) of documents (doc_id, text): one row per row of
    ``docs`` with met false, and rows with met true for texts that share a fingerprint.

    All expressions but the hashes of grams and the minima are compiled code, and
    so are the lookup and the filter after it: a print that no item has costs no row.
    (The outer form of explode keeps Spark from pushing a test of the array's size,
    and with it all that the array is made of, down to the scan.)
    """
    rows = docs.select("doc_id", *_text_key(F.col("text")), words(F.col("text")).alias("words"))
    rows = _with_minima(_with_grams(rows))
    spans = [_spans(m).getField("hash") for m in short]
    prints = rows.select("doc_id", "a", "b", F.size("words").alias("n_words"), F.array_distinct(F.concat("minima", *spans)).alias("prints"))
    # One more element, null, stands for the row itself.
    each = prints.select("doc_id", "a", "b", "n_words", F.explode_outer(F.concat("prints", F.array(F.lit(None).cast("long")))).alias("hash"))
    known = small(written(contexts.select("hash").distinct(), "hashes")).select(F.col("hash").alias("key"), F.lit(True).alias("found"))
    # Where this is a shuffle, the rows without a hash are spread by their text.
    looked = each.join(known, F.coalesce("hash", F.xxhash64("doc_id", "a")) == F.col("key"), "left")
    looked = looked.where(F.col("hash").isNull() | F.col("found"))
    return written(looked.select("doc_id", "a", "b", "n_words", F.col("hash").isNotNull().alias("met")), "met-texts")


def _windows(docs: DataFrame, met: DataFrame, contexts: DataFrame, short: list[int]) -> DataFrame:
    """(a, b, c, start, end): the windows of contexts in the texts that ``met`` names,
    as numbers of their first and last word."""
    keys = small(written(met.where("met").select("a", "b").distinct(), "met-keys"))
    texts = docs.select(*_text_key(F.col("text")), "text").join(keys, ["a", "b"], "left_semi")
    rows = _with_grams(texts.select("a", "b", words(F.col("text")).alias("words")))
    numbered = F.transform("grams", lambda x, i: F.struct(i.alias("at"), x.alias("hash")))
    places = rows.select("a", "b", "words", F.concat(numbered, *map(_spans, short)).alias("places")).select("a", "b", "words", F.explode_outer("places").alias("p")).where("p is not null")
    before = F.least("p.at", F.lit(AROUND))
    places = places.select("a", "b", F.col("p.at").alias("at"), F.col("p.hash").alias("hash"), before.alias("before"), F.slice("words", F.col("p.at") - before + 1, before + (GRAM + AROUND)).alias("near"))
    both = places.join(small(contexts), "hash")
    # The j-th word around the fingerprint in the item is the (j + before - lead)-th near it in the text.
    shift = F.col("before") - F.col("lead")
    first, last = F.greatest(F.lit(0), -shift), F.size("around") - F.col("need")
    tried = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    same = F.filter(tried, lambda j: F.slice("near", j + shift + 1, F.col("need")) == F.slice("around", j + 1, F.col("need")))
    found = both.select("a", "b", "c", "at", "lead", "need", F.explode_outer(same).alias("j")).where("j is not null")
    start = F.col("at") - F.col("lead") + F.col("j")
    return written(found.select("a", "b", "c", start.alias("start"), (start + F.col("need") - 1).alias("end")).distinct(), "windows")


def _benchmark(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    items = benchmark_items(benchmark)
    sizes = items.select(F.size("words").alias("m")).where(F.col("m") < WINDOW).distinct()
    short = sorted(r[0] for r in sizes.collect())  # at most WINDOW - 1 lengths
    return items, *item_contexts(items, short), short


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per
    row of ``docs``.

    n_hit counts words inside any span of 10 consecutive words (or a whole
    shorter item) that an item has; n_items and items_sha256 (of the sorted,
    comma-joined ids) tell which items.  Null, empty and wordless texts have no
    words and no hits; equal texts get equal values; benchmark rows with a null
    id count as hits but not as items; without benchmark rows nothing hits; an
    empty table gives no rows.  Columns other than id and text are ignored.
    """
    items, contexts, owners, short = _benchmark(benchmark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    met = _met(src, contexts, short)
    found = _windows(src, met, contexts, short)

    # Words in the union of the windows: each adds those after the furthest end so far.
    earlier = Window.partitionBy("a", "b").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest(F.col("start") - 1, F.coalesce(F.max("end").over(earlier), F.lit(-1)))
    spans = found.select("a", "b", "start", "end").distinct().select("a", "b", F.greatest(fresh, F.lit(0)).alias("fresh"))
    hit = spans.groupBy("a", "b").agg(F.sum("fresh").alias("n_hit"))

    # Items are looked up once for each set of contexts, and not for each text that has it.
    sets = written(found.groupBy("a", "b").agg(F.array_sort(F.collect_set("c")).alias("cs")).join(hit, ["a", "b"]), "hits")
    item = sets.select("cs").distinct().select("cs", F.explode("cs").alias("c")).join(owners, "c").select("cs", "item").distinct()
    named = item.join(items.select("item", "ids"), "item").groupBy("cs").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))
    digest = F.sha2(F.array_join("ids", ",").cast("binary"), 256)
    named = named.select("cs", F.size("ids").cast("long").alias("n_items"), digest.alias("items_sha256"))
    hits = written(sets.join(named, "cs").select("a", "b", "n_hit", "n_items", "items_sha256"), "hit-texts")

    rows = met.where(~F.col("met")).join(small(hits), ["a", "b"], "left")
    return rows.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which nothing hits, with all their columns.

    Null, empty and wordless texts stay; repeated rows stay as often as they are;
    no other column plays a part, whatever its name; an empty table stays empty.
    """
    _, contexts, _, short = _benchmark(benchmark)
    src = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = _windows(src, _met(src, contexts, short), contexts, short)
    bad = small(written(found.select("a", "b").distinct(), "hit-keys"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_text_key(F.col(f"`{text_col}`").cast("string")))
    return row.join(bad, ["a", "b"], "left_anti").select("row.*")

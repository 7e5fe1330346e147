"""Small tables with the awkward cases that every operator must take."""

LONG = " ".join(f"wort{i % 977} text{i % 31}." for i in range(30_000))
TEXTS = [
    None, "", " ", "\n\t ", "!!! ###", "one", "One two", "ONE two three", "one two three four", "The one two three four five.",
    "same words here again and again", "same words here again and again", "Same words HERE again and again", "a" * 5000, "  two  blanks \n ends  ",
    "it's 12 o'clock, isn't it? \r\n\r\n Ünïcödé 日本語 🙂 x y", "<|endoftext|>", "a <|endoftext|> b", LONG, LONG + " more", "\x00 nul \x1f", "1234567890123 a@b.example 10.0.0.1",
]
IDS = [*range(10), 10, 10, 12, None, None, *range(15, len(TEXTS))]


def documents(spark, texts=None, ids=None):
    """Documents with extra columns whose names clash with results."""
    texts = TEXTS if texts is None else texts
    ids = (IDS if texts is TEXTS else list(range(len(texts)))) if ids is None else ids
    rows = [(i, t, "en", "s", 0.5, 1, "f", 3) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, shard int, fingerprint string, n_tokens int")


def pairs(df, *columns):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda t: [(x is not None, x) for x in t])

"""Fill-in-middle transformation by counted quantifiers.

A text is cut into units, each a word with the white space before it, or the
white space at the end.  ``regexp_count`` gives their number n, hashes of the id
give the two cuts a <= b, and a pattern made for the row, with possessive groups
unit{a} and unit{b-a}, captures prefix, middle and suffix in one match: the
replacement writes them in the order of the form, each after its marker.  A
possessive count is a loop in Java's engine, so long texts need no deep stack.
Everything is an expression; no row moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"
MARKERS = ("<P>", "<S>", "<M>")
FORM_RATE, SPM_RATE = 50, 80  # texts of 100 that change, and of 100 of these that put the suffix first


def draws(id_col: Column, seed: int = 42) -> list[Column]:
    """Four unsigned 32-bit numbers: the first 8-digit groups of the hex SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, form_rate: int = FORM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, text, n, form, output), one row per row of ``docs``.

    Null counts as empty.  Empty texts, texts with a marker in them and the rest
    of ``form_rate`` in a hundred stay as they are (form plain).  A null id draws
    from the empty string; equal ids draw alike, so repeated rows give repeated
    rows.  A cut may leave any part empty.  Texts are matched whole at any
    length; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    marked = F.col("text").contains(MARKERS[0]) | F.col("text").contains(MARKERS[1]) | F.col("text").contains(MARKERS[2])
    plain = (F.col("text") == "") | marked | (h3 % 100 >= form_rate)
    form = F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    counted = rows.select("*", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    cut = [F.col(h) % (F.col("n") + 1) for h in ("h1", "h2")]
    cuts = counted.select("doc_id", "text", "n", "form", F.least(*cut).alias("a"), (F.greatest(*cut) - F.least(*cut)).alias("middle"))
    pattern = F.concat(F.lit(rf"(?s)\A({UNIT}{{"), F.col("a"), F.lit(rf"}}+)({UNIT}{{"), F.col("middle"), F.lit(r"}+)(.*+)\z"))
    order = F.when(F.col("form") == "spm", "<S>$3<P>$1<M>$2").otherwise("<P>$1<S>$3<M>$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return cuts.select("doc_id", "text", "n", "form", output.alias("output"))


def places(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Where the first, second and third marker of an output begin, from 1.  Parts hold
    no marker, and none can begin in one part and end in the next, as markers begin
    with the only < in them."""
    second = F.when(form == "spm", MARKERS[0]).otherwise(MARKERS[1])
    return F.lit(1), F.position(second, output), F.position(F.lit(MARKERS[2]), output)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    _, second, third = places(output, form)
    first = F.substring(output, F.lit(4), second - 4)
    other = F.substring(output, second + 3, third - second - 3)
    middle = F.substring(output, third + 3, F.length(output))
    return F.when(form == "plain", output).when(form == "spm", F.concat(other, middle, first)).otherwise(F.concat(first, middle, other))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256),
    one row per row of ``docs``; cases as in ``fill_in_middle``."""
    made = fill_in_middle(docs, id_col, text_col)
    form, output = F.col("form"), F.col("output")
    _, second, third = places(output, form)
    prefix = F.when(form == "psm", second - 4).when(form == "spm", third - second - 3)
    middle = F.when(form != "plain", F.length(output) - third - 2)
    return made.select(
        "doc_id", "n", "form", prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"),
        F.sha2(output, 256).alias("output_sha256"), F.sha2(restored(output, form), 256).alias("restored_sha256"),
    )

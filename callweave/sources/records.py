"""Numbered records of CSV files whose quoted cells may hold line breaks, read in splits.

A split starts anywhere, also inside a quoted cell, so whether its first line
begins a record is not known where it is read.  Each line is therefore a small
function: whether a quoted cell is open after it, if none was before it and if one
was.  A task runs through its splits for both cases at once; one row a split then
tells, over all splits of a file in order, which case holds and how many records
began before it.  Lines are not shuffled, but for those of records that take several.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from .scratch import scratch

MOST_SPLITS = 1_000_000  # rows about splits that are broadcast
NAMES = ("source_path", "start", "at", "line", "open_if_closed", "open_if_open", "count_if_closed", "count_if_open", "cells")
NULLS = ["".join(x) for x in product(*zip("NULL", "null"))]  # all spellings
WHITE = " \t\n\r\x0b\x0c"


def _open_after(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a quoted cell is open after a line, if none is before it, and if one is.
    Quotes count where a cell begins; two of them in a quoted cell stand for one."""
    s = "\\" + sep
    cells = rf'(?:(?:"[^"]*+(?:""[^"]*+)*+"(?!")[^{s}]*+|[^"{s}][^{s}]*+|){s})*+'
    unclosed = rf'{cells}"[^"]*+(?:""[^"]*+)*+\z'
    rest = rf'"(?!")(?:[^{s}]*+{s}{unclosed})'
    quoted = line.contains('"')
    from_closed = quoted & line.rlike(rf"(?s)\A{unclosed}")
    from_open = ~quoted | line.rlike(r'(?s)\A[^"]*+(?:""[^"]*+)*+\z') | line.rlike(rf'(?s)\A[^"]*+(?:""[^"]*+)*+{rest}')
    return from_closed, from_open


def _walked(batches: Iterator) -> Iterator:
    """For each run of lines of one split in a batch of (source_path, start, closed, open, blank, ...): the batch, whether the run begins
    a split, its bounds, and for both cases of the split's start: whether a cell is open before each line and after it, and how many
    records began up to it."""
    place, state, began = None, [False, True], [0, 0]
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        paths, starts = b.column(0), b.column(1).to_numpy()
        f, g, blank = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        new = (starts[1:] != starts[:-1]) | pc.not_equal(paths.slice(1), paths.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), n]
        for s, t in zip(cuts, cuts[1:]):
            begins = place != (here := (paths[s].as_py(), int(starts[s])))
            if begins:
                place, state, began = here, [False, True], [0, 0]
            fixed, swaps = f[s:t] == g[s:t], np.cumsum(f[s:t] & ~g[s:t])
            last = np.maximum.accumulate(np.where(fixed, np.arange(t - s), -1))
            since = (swaps - np.where(last >= 0, swaps[last], 0)) % 2 == 1
            before, after, counts = np.empty((2, t - s), bool), np.empty((2, t - s), bool), np.empty((2, t - s), np.int64)
            for case in (0, 1):
                after[case] = np.where(last >= 0, f[s:t][last], state[case]) ^ since
                before[case, 0], before[case, 1:] = state[case], after[case, :-1]
                counts[case] = began[case] + np.cumsum(~before[case] & ~blank[s:t])
                state[case], began[case] = bool(after[case, -1]), int(counts[case, -1])
            yield b, begins, s, t, before, after, counts


def _cut(lines: pa.Array, n: int, sep: str) -> tuple[pa.Array, pa.Array]:
    """Lists of the ``n`` trimmed cells, null if empty or NULL in any case, of lines that are such records and have no quotes; and the other lines."""
    try:
        lines.validate(full=True)
        pieces = pc.split_pattern(lines, sep)
        plain = pc.and_(pc.invert(pc.match_substring_regex(lines, r'(?s)["\x00]|\r.')), pc.equal(pc.list_value_length(pieces), n))
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        return pa.nulls(len(lines), pa.list_(pa.string())), lines
    if not pc.all(plain).as_py():
        pieces = pieces.filter(plain)
    cells = pc.ascii_trim(pieces.flatten(), WHITE)
    cells = pc.if_else(pc.is_in(cells, pa.array(["", *NULLS])), pa.scalar(None, pa.string()), cells)
    sizes = np.where(plain.to_numpy(zero_copy_only=False), n, 0)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    # By take, as if_else gives wrong offsets for a slice of strings.
    others = lines.take(pa.array(np.arange(len(lines)), mask=plain.to_numpy(zero_copy_only=False)))
    return pa.ListArray.from_arrays(offsets, cells, mask=pc.invert(plain)), others


def _scanned(lines: DataFrame, cells: int, sep: str) -> DataFrame:
    """Lines (source_path, start, closed, open, blank, at, line) with NAMES: whether a cell is open before
    each, and how many records began in the split up to it, for both cases of the split's start.
    If ``cells`` are given, lines that ``_cut`` can cut have these and no ``line``."""

    def run(batches: Iterator) -> Iterator:
        for b, _, s, t, before, _, counts in _walked(batches):
            line = b.column(6).slice(s, t - s)
            cut, line = _cut(line, cells, sep) if cells else (pa.nulls(t - s, pa.list_(pa.string())), line)
            columns = [*(b.column(i).slice(s, t - s) for i in (0, 1, 5)), line, *(pa.array(x) for x in (*before, *counts)), cut]
            yield pa.RecordBatch.from_arrays(columns, list(NAMES))

    return lines.mapInArrow(run, "source_path string, start long, at long, line string, open_if_closed boolean, open_if_open boolean, count_if_closed long, count_if_open long, cells array<string>")


def _split_ends(lines: DataFrame) -> DataFrame:
    """A row for each split of lines (source_path, start, closed, open, blank): for both cases of its start whether a
    cell is open at its end, how many records begin in it, and how many of its lines belong to records of several."""
    names = ("source_path", "start", "to_closed", "to_open", "n_closed", "n_open", "parts_closed", "parts_open")

    def run(batches: Iterator) -> Iterator:
        row = None
        for b, begins, s, t, before, after, counts in _walked(batches):
            if begins:
                if row:
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], list(names))
                row = [b.column(0)[s].as_py(), b.column(1)[s].as_py(), 0, 0, 0, 0, 0, 0]
            parts = (before | after).sum(axis=1)
            for case in (0, 1):
                row[2 + case], row[4 + case] = int(after[case, -1]), int(counts[case, -1])
                row[6 + case] += int(parts[case])
        if row:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], list(names))

    return lines.mapInArrow(run, ", ".join(f"{n} {'string' if n == 'source_path' else 'long'}" for n in names))


def numbered_records(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """(source_path, record, text): the records of CSV files, numbered from 1 in each file
    (the header is 1); blank lines between records do not count.

    Files are read twice, in splits.  Line breaks inside a quoted cell stay as they
    are.  A cell that is never closed runs to the end of its file.
    """
    return _records(spark, path, sep).drop("cells")


def _records(spark: SparkSession, path: str | list[str], sep: str, cells: int = 0) -> DataFrame:
    """``numbered_records`` with the ``cells`` of those that ``_cut`` can cut, which have no text."""
    lines = spark.read.option("lineSep", "\n").text(path).selectExpr("_metadata.file_path AS source_path", "_metadata.file_block_start AS start", "value AS line")
    closed, opened = _open_after(F.col("line"), sep)
    states = ["source_path", "start", closed.alias("closed"), opened.alias("open"), F.col("line").isin("", "\r").alias("blank")]

    # One row a split, without its lines.
    splits = _split_ends(lines.select(*states))
    in_order = Window.partitionBy("source_path").orderBy("start")
    fixed = F.col("to_closed") == F.col("to_open")
    splits = splits.withColumn("since", F.count_if(fixed).over(in_order))  # splits since the last one whose end does not depend on its start
    run = Window.partitionBy("source_path", "since").orderBy("start")
    swaps = F.sum(F.when(~fixed, F.col("to_closed")).otherwise(0)).over(run)
    start_of_run = F.when(F.col("since") > 0, F.first("to_closed").over(run)).otherwise(0)
    splits = splits.withColumn("after", (start_of_run + swaps) % 2).withColumn("is_open", F.coalesce(F.lag("after").over(in_order), F.lit(0)) == 1)
    records = F.sum(F.when(F.col("is_open"), F.col("n_open")).otherwise(F.col("n_closed"))).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    parts = F.when(F.col("is_open"), F.col("parts_open")).otherwise(F.col("parts_closed"))
    splits = splits.select("source_path", "start", "is_open", F.coalesce(records, F.lit(0)).alias("records"), parts.alias("parts"))
    folder = scratch(spark, "csv-splits")
    splits.write.parquet(folder)
    known = spark.read.schema(splits.schema).parquet(folder)
    n, several_lines = known.agg(F.count("*"), F.count_if(F.col("parts") > 0)).first()
    lines = lines.select(*states, F.monotonically_increasing_id().alias("at"), "line")

    def placed(known: DataFrame, cells: int = 0) -> DataFrame:
        case, blank = F.col("is_open"), F.coalesce(F.col("line").isin("", "\r"), F.lit(False))
        placed = _scanned(lines, cells, sep).join(F.broadcast(known) if n <= MOST_SPLITS else known, ["source_path", "start"]).select(
            "source_path", "start", "at", "line", "cells", (F.col("records") + F.when(case, F.col("count_if_open")).otherwise(F.col("count_if_closed"))).alias("record"),
            F.when(case, F.col("open_if_open")).otherwise(F.col("open_if_closed")).alias("inside"),
        )
        return placed.where(F.col("inside") | ~blank)

    goes_on = F.col("inside") | F.col("line").isNotNull() & _open_after(F.col("line"), sep)[0]
    ended = F.when(F.col("line").endswith("\r"), F.substring("line", F.lit(1), F.length("line") - 1)).otherwise(F.col("line"))
    single = placed(known, cells).where(~goes_on).select("source_path", "record", ended.alias("text"), "cells")
    if not several_lines:  # else files are read once more for these
        return single
    parts = placed(known.where("parts > 0")).where(goes_on).groupBy("source_path", "record").agg(F.array_sort(F.collect_list(F.struct("start", "at", "line"))).alias("lines"))
    several = parts.select("source_path", "record", F.regexp_replace(F.array_join("lines.line", "\n"), r"\r\z", "").alias("text"), F.lit(None).cast("array<string>").alias("cells"))
    return single.unionByName(several)


def numbered_cells(spark: SparkSession, path: str | list[str], names: list[str], sep: str = ",", first: int = 1, seen: Observation | str = "csv") -> DataFrame:
    """All cells as trimmed strings in the order of ``names``, null if empty or NULL in any case, with source_path and row_number,
    which is ``first`` for the record after the header; a record with another number of cells is in ``_corrupt``.
    Records with quotes are parsed, others were cut at their separators.
    ``seen`` observes how many records there are, and how many of these are malformed."""
    schema = ", ".join(f"`{n}` string" for n in [*names, "_corrupt"])
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    edges = rf"^[{WHITE}]++|(?<![{WHITE}])[{WHITE}]++\z"
    trimmed = lambda cell: F.regexp_replace(cell, edges, "")
    # A function of an array of one, as each cell would parse its record again.
    parsed = F.transform(F.array(F.from_csv("text", schema, options)), lambda r: F.array(*[trimmed(r[n]) for n in names], r["_corrupt"]))[0]
    nulls = F.transform(parsed, lambda cell, i: F.when((i == len(names)) | ~cell.isin("", *NULLS), cell))
    records = _records(spark, path, sep, len(names)).where("record > 1")
    rows = records.select((F.col("record") - 2 + first).alias("row_number"), "source_path", F.coalesce("cells", nulls).alias("cells"))
    rows = rows.select("row_number", "source_path", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate([*names, "_corrupt"])])
    return rows.observe(seen, F.count("*").alias("records"), F.count_if(F.col("_corrupt").isNotNull()).alias("malformed"))

"""Cells, layouts and log lines written by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from callweave import schemas
from callweave.sources import delimited, smsc

USAGE = [n for n, _ in schemas.USAGE_LOG]


def usage_file(path, rows):
    lines = [",".join(USAGE)]
    for row in rows:
        lines.append(",".join(row.get(n, "") for n in USAGE))
    path.write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_usage_cells(spark, tmp_path):
    rows = [
        {"usage_log_id": "1", "msisdn": " null ", "last_grant_shared_bucket_type_ids": '"1,2"', "usage_unit": "0.125", "cr_time": "N/A"},
        {"usage_log_id": "2", "usage_unit": "12x"},
        {"usage_log_id": "three"},
        {"usage_log_id": "4", "sim_id": "x", "usage_unit": "y"},
        {"usage_log_id": ""},
    ]
    good, bad = delimited.read_usage_csv(spark, usage_file(tmp_path / "u.csv", rows))
    (row,) = good.collect()
    assert row["msisdn"] is None and row["last_grant_shared_bucket_type_ids"] == "1,2" and str(row["usage_unit"]) == "0.1250000000000000"
    got = {(r["row_identifier"], r["column_name"]) for r in bad.collect()}
    assert got == {("2", "usage_unit"), ("three", "usage_log_id"), ("4", "sim_id"), (None, "usage_log_id")}


def test_rejected_rows_have_their_number_in_splits_and_multi_line_cells(spark, tmp_path):
    """Line breaks, quotes and separators inside cells, blank lines, and splits that begin anywhere."""
    n = len(USAGE) - 1
    for name in ("a", "b"):
        rows = []
        for i in range(1, 301):
            cells = [str(i)] + [""] * n
            cells[USAGE.index("notes")] = '"one\n""two"", three\r\n' + "x" * (i % 7) + '\n"' if i % 3 == 0 else "plain"
            cells[USAGE.index("usage_unit")] = "bad" if i % 50 == 0 else "1.5"
            rows.append(",".join(cells) + ("\n\n" if i % 11 == 0 else "\r\n" if name == "b" else "\n"))
        (tmp_path / f"{name}.csv").write_text("\ufeff" + ",".join(USAGE) + "\n" + "".join(rows), encoding="utf-8", newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        good, bad = delimited.read_usage_csv(spark, str(tmp_path))
        assert good.rdd.getNumPartitions() > 6
        assert good.count() == 588 and {r["notes"] for r in good.where("usage_log_id = 7 or usage_log_id = 9").collect()} == {"plain", 'one\n"two", three\r\nxx'}
        got = sorted((r["source_path"].rsplit("/", 1)[-1], r["row_number"], r["row_identifier"]) for r in bad.collect())
        assert got == [(f"{f}.csv", i, str(i)) for f in "ab" for i in range(50, 301, 50)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_equal_the_csv_module(spark, tmp_path):
    import csv
    import io
    import random

    from callweave.sources.records import numbered_records

    rnd, want = random.Random(1), {}
    pieces = ["a", "b", "é", '"', '""', '"x"', "\n", "\r\n", ",", ",", '","', '"\n', '\n"', " "]
    for k in range(12):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 200)))
        (tmp_path / f"f{k}.csv").write_text(text, encoding="utf-8", newline="")
        want[f"f{k}.csv"] = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        got: dict = {}
        for r in numbered_records(spark, str(tmp_path)).collect():
            got.setdefault(r["source_path"].rsplit("/", 1)[-1], {})[r["record"]] = next(csv.reader(io.StringIO(r["text"], newline="")))
        ends = lambda rows: [[c.strip("\r\n") for c in row] for row in rows]
        for name, rows in want.items():
            numbered = got.get(name, {})
            assert sorted(numbered) == list(range(1, len(rows) + 1)) and ends(numbered[i] for i in sorted(numbered)) == ends(rows), name
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_cut_cells_equal_parsed_ones(spark, tmp_path):
    """Records without quotes are cut at their separators; cells are as if each record were parsed and each cell cleaned."""
    import random

    from callweave.sources.records import numbered_cells, numbered_records

    rnd, names = random.Random(2), ["a", "b", "c"]
    pieces = ["x", "é", " ", "\t", "\x0b", "\r", "null", "NULL", "nUlL", " Null ", "N/A", "NULLx", "\0", ",", ",", ",", ",", '"', '""', '" y,"']
    lines = ["x" + "".join(rnd.choice(pieces[:k]) for _ in range(rnd.randint(1, 9))) for k in [17] * 1500 + [20] * 500]
    data = "\n".join(["a,b,c", *lines[:1500]]).encode() + b"\n7,\xff8,9\n,,\r\n" + "\n".join(lines[1500:]).encode()
    (tmp_path / "plain.csv").write_bytes(data)
    schema = "a string, b string, c string, _corrupt string"
    options = {"sep": ",", "quote": '"', "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    parsed = numbered_records(spark, str(tmp_path)).where("record > 1").select((F.col("record") - 1).alias("row_number"), F.inline(F.array(F.from_csv("text", schema, options))))
    want = parsed.select("row_number", *[delimited.nullify(F.col(n)).alias(n) for n in names], "_corrupt")
    got = numbered_cells(spark, str(tmp_path), names).select("row_number", *names, "_corrupt")
    rows = lambda df: sorted(map(tuple, df.collect()), key=lambda r: r[0])
    assert rows(got) == rows(want) and len(rows(got)) > 1502 and got.where("_corrupt is null").count() > 200


def test_cells_of_several_files_in_one_batch(spark, tmp_path):
    from callweave.sources.records import numbered_cells

    for k in range(40):
        (tmp_path / f"f{k}.csv").write_text("a,b\n" + "".join(f'{k}, {i}\n' if i % 3 else f'"{k}","{i} "\n' for i in range(k % 5)))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = numbered_cells(spark, str(tmp_path), ["a", "b"])
        assert got.rdd.getNumPartitions() < 40
        assert sorted((r["a"], r["b"], r["row_number"]) for r in got.collect()) == sorted((str(k), str(i), i + 1) for k in range(40) for i in range(k % 5))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_files_without_multi_line_records_are_scanned_once(spark, tmp_path):
    """After the pass over the splits, one more scan is enough, and no record is parsed that can be cut."""
    from callweave.sources.records import numbered_cells

    (tmp_path / "p.csv").write_text("a,b\n1,2\n3,4\n")
    scans = lambda: numbered_cells(spark, str(tmp_path), ["a", "b"])._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    assert scans() == 1
    (tmp_path / "q.csv").write_text('a,b\n1,"2\n3"\n')
    assert scans() == 2
    assert numbered_cells(spark, str(tmp_path), ["a", "b"]).where("b is not null").count() == 3


def test_wide_lines_are_the_same_file(spark):
    """Request files are written as lines of joined cells, byte for byte what the writer of cells writes."""
    from callweave.plans.ingest import csv_file

    df = spark.range(40).repartition(2, "id").selectExpr("id AS a", "'NULL' AS b", "concat('s', id) AS c", "CAST(id AS STRING) AS d").sortWithinPartitions("a")
    files = [sorted(r["value"] for r in spark.read.text(csv_file(df.selectExpr("CAST(a AS STRING) a", "b", "c", "d"), "wide", plain=p), wholetext=True).collect()) for p in (True, False)]
    assert files[0] == files[1] and files[0][0].startswith("a,b,c,d\n")


def test_request_header_must_match(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("request_log_id,other\n1,2\n")
    with pytest.raises(ValueError):
        delimited.read_request_csv(spark, str(path))


def test_roaming_separators_and_dates(spark, tmp_path):
    for sep in ",\t;|":
        path = tmp_path / f"r{ord(sep)}.csv"
        head = sep.join(delimited.ROAMING_HEADERS)
        path.write_text(f"{head}\n" + sep.join(["7", "p", "c", "n", "502", "", "03/02/2024 04:05", "n/a"]) + "\n" + sep.join([""] * 8) + "\n")
        (row,) = delimited.read_roaming_destinations(spark, str(path)).collect()
        assert row["roaming_destination_id"] == 7 and row["created_at"] == dt.datetime(2024, 2, 3, 4, 5) and row["updated_at"] is None


def parsed(spark, lines, **options):
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "source_path string, line_number int, raw_line string")
    return smsc.parse_lines(df, **options).orderBy("line_number").collect()


def test_smsc_lines(spark):
    fields = ["v%d" % i for i in range(31)]
    got = parsed(spark, ["no prefix", "x] ", "a] b] c,d", "p] " + ",".join(fields), "p] " + ",".join([*fields, "e1", "e2"]), 'p] NULL, null ,"a, b",""'])
    assert [r["error"] for r in got] == ["INVALID_PREFIX", "INVALID_PREFIX", None, None, None, None]
    assert got[2]["delivery_date"] == "b] c" and got[2]["submit_date"] == "d" and got[2]["reason_for_failure"] is None
    assert got[3]["reason_for_failure"] == "v30" and got[3]["extra_fields"] == []
    assert got[4]["extra_fields"] == ["e1", "e2"] and got[4]["raw_fields_count"] == 33
    assert (got[5]["delivery_date"], got[5]["submit_date"], got[5]["addr_src_digits"], got[5]["addr_src_ton"]) == (None, None, "a, b", None)


def test_smsc_older_rules(spark):
    nine, thirty = ",".join("a" * 9), ",".join("a" * 30)
    got = parsed(spark, [f"p] {nine}", f"p] {thirty}"], layout=schemas.SMSC_FIELDS_30, least_fields=10, exact_null=True)
    assert [r["error"] for r in got] == ["CSV_ERROR", None] and got[1]["extra_fields"] == []


def test_line_numbers_over_splits(spark, tmp_path):
    for day in ("01", "02"):
        (tmp_path / f"cdr.log.2024-01-{day}").write_text("".join(f"line {i}\n" for i in range(1, 501)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = smsc.numbered_lines(spark, [str(tmp_path)])
        assert lines.where(F.concat(F.lit("line "), "line_number") != F.col("raw_line")).count() == 0 and lines.count() == 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_discovery(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("cdr.log.2024-01-02", "sub/cdr.log.2024-01-01", "cdr.log.2024-01-03", "cdr.log.2024-13-01", "cdr.log.2024-01-01.gz"):
        (tmp_path / name).write_text("x")
    found = smsc.discover(smsc.list_files(spark, str(tmp_path)), F.lit("2024-01-03").cast("date"))
    assert [r["path"].rsplit("/", 1)[-1] for r in found.collect()] == ["cdr.log.2024-01-01", "cdr.log.2024-01-02"]
    assert smsc.skip_processed(found, found.limit(1)).count() == 1
    assert smsc.skip_processed(found, found.withColumn("length", F.col("length") + 1)).count() == 2


def test_cells_equal_the_csv_module(spark):
    import csv
    import random

    rnd = random.Random(3)
    lines = ["".join(rnd.choice(['a', 'b', ',', ',', '"', '""', ' ', 'é', ',"', '",']) for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    lines += ['a,,b', ',', ',,', '"a,b",c', '"a""b",c', '"open,c', 'x"y,z"', '"q"tail,1', '""', '"",""', '"' + "x" * 20_000 + '",1', '"' + '""' * 5000 + '"']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string").select("i", smsc.cells_of(F.col("x")).alias("cells"))
    for row in df.collect():
        assert row["cells"] == next(csv.reader([lines[row["i"]]])), lines[row["i"]]


def test_logs_from_files_to_table(spark, tmp_path):
    """Discovery, numbering, parsing, upsert and manifest; a file that grew is loaded again, a processed one is not."""
    from callweave.plans.ingest import ingest_logs

    logs, sink, manifest = tmp_path / "logs", str(tmp_path / "sink"), str(tmp_path / "manifest")
    logs.mkdir()
    line = "INFO] 2024-01-01,2024-01-01,{},1,1,6012"
    (logs / "cdr.log.2024-01-01").write_text("\n".join([line.format("a"), "broken", line.format("b")]) + "\n")
    (logs / "cdr.log.2024-01-02").write_text(line.format("c") + "\n")
    (logs / "cdr.log.2024-01-05").write_text(line.format("today") + "\n")
    first, did = ingest_logs(spark, str(logs), sink, manifest, "2024-01-05")
    assert tuple(did) == (2, 2, 0, 4, 3, 1, 0)
    assert sorted((r["line_number"], r["addr_src_digits"]) for r in first.collect()) == [(1, "a"), (1, "c"), (3, "b")]
    with open(logs / "cdr.log.2024-01-01", "a") as f:
        f.write(line.format("d") + "\n")
    second, did = ingest_logs(spark, str(logs), sink, manifest, "2024-01-05")
    assert tuple(did) == (2, 1, 1, 4, 3, 1, 0)
    assert sorted((r["line_number"], r["addr_src_digits"]) for r in second.collect()) == [(1, "a"), (1, "c"), (3, "b"), (4, "d")]
    third, did = ingest_logs(spark, str(logs), sink, manifest, "2024-01-05")
    assert did.loaded == 0 and third.count() == 4
    (logs / "cdr.log.2024-01-01").write_text(line.format("shorter") + "\n")
    fourth, did = ingest_logs(spark, str(logs), sink, manifest, "2024-01-05")
    assert sorted((r["line_number"], r["addr_src_digits"]) for r in fourth.collect()) == [(1, "c"), (1, "shorter")]
    (logs / "cdr.log.2024-01-02").write_text("nothing valid\n")
    fifth, did = ingest_logs(spark, str(logs), sink, manifest, "2024-01-05")
    assert [r["addr_src_digits"] for r in fifth.collect()] == ["shorter"]


def test_no_logs_are_an_empty_table(spark, tmp_path):
    from callweave.plans.ingest import ingest_logs

    (tmp_path / "logs").mkdir()
    table, did = ingest_logs(spark, str(tmp_path / "logs"), str(tmp_path / "sink"), str(tmp_path / "manifest"), "2024-01-05")
    assert table.collect() == [] and did.files == 0 and "addr_src_digits" in table.columns

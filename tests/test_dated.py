"""Tables by day: pruning, loads that touch few days, and loads that break off."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from callweave.operators import dated
from callweave.streaming.sync import sync

COLUMNS = "id long, v string, t timestamp_ntz"


def rows(spark, *values):
    df = spark.createDataFrame([(i, v, dt.datetime(2024, 1, d, 5)) for i, v, d in values], COLUMNS)
    return dated.with_day(df, "t")


def table(spark, path):
    return dated.stored(spark, path, rows(spark).schema)


def content(spark, path):
    return sorted((r["id"], r["v"], r["day"].day) for r in table(spark, path).collect())


def files(path):
    import pathlib

    return {p: p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


def test_upserts_touch_only_their_days_and_loading_twice_is_loading_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert content(spark, path) == []
    dated.upsert(spark, path, rows(spark, (1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)), ["id"], "v")
    before = files(path)
    update = rows(spark, (3, "x", 2), (3, "y", 2), (5, "new", 4))
    for _ in range(2):
        dated.upsert(spark, path, update, ["id"], "v")
        assert content(spark, path) == [(1, "a", 1), (2, "b", 1), (3, "y", 2), (4, "d", 3), (5, "new", 4)]
    after = files(path)
    kept = {p for p in before if "day=2024-01-02" not in str(p)}
    assert kept and all(after[p] == before[p] for p in kept)
    dated.load(spark, path, rows(spark), rows(spark, (3, "", 2)).select("id"), rows(spark, (3, "", 2)).select("day"))
    assert content(spark, path) == [(1, "a", 1), (2, "b", 1), (4, "d", 3), (5, "new", 4)]  # a day of which nothing is left
    with pytest.raises(Exception, match="no day"):
        dated.load(spark, path, rows(spark, (9, "z", 1)).withColumn("day", F.lit(None).cast("date")), rows(spark).select("id"))


def test_a_load_that_broke_off_is_finished_or_forgotten(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    dated.upsert(spark, path, rows(spark, (1, "a", 1), (2, "b", 2)), ["id"], "v")
    finish = dated._finish
    calls = []

    def broken(*args):
        calls.append(1)
        if len(calls) == 2:  # after the rows were written beside the table, before they are put in place
            raise RuntimeError("killed")
        finish(*args)

    monkeypatch.setattr(dated, "_finish", broken)
    with pytest.raises(RuntimeError, match="killed"):
        dated.upsert(spark, path, rows(spark, (1, "z", 1)), ["id"], "v")
    monkeypatch.undo()
    assert content(spark, path) == [(1, "a", 1), (2, "b", 2)]
    dated.upsert(spark, path, rows(spark, (3, "c", 3)), ["id"], "v")
    assert content(spark, path) == [(1, "z", 1), (2, "b", 2), (3, "c", 3)]
    rows(spark, (1, "lost", 1)).write.partitionBy("day").parquet(f"{path}/{dated.PENDING}/rows")
    (tmp_path / "t" / dated.PENDING / "rows" / "_SUCCESS").unlink()
    dated.upsert(spark, path, rows(spark, (4, "d", 3)), ["id"], "v")
    assert content(spark, path) == [(1, "z", 1), (2, "b", 2), (3, "c", 3), (4, "d", 3)]


def test_windows_prune_days(spark, tmp_path):
    path = str(tmp_path / "t")
    dated.upsert(spark, path, rows(spark, *[(i, "v" * 50, 1 + i % 28) for i in range(2800)]), ["id"], "v")
    window = dated.in_days(table(spark, path), "t", "2024-01-05", "2024-01-06")
    assert window.count() == 200
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and ">= 2024-01-05" in plan
    read = {r["f"] for r in window.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    size = {str(p): p.stat().st_size for p in files(path)}
    part = sum(n for p, n in size.items() if any(f.endswith(p) for f in read))
    assert 0 < part < sum(size.values()) / 10  # two days of 28


def test_a_merge_does_not_move_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    dated.upsert(spark, path, rows(spark, *[(i, "v", 1) for i in range(100)]), ["id"], "v")
    few = rows(spark, (3, "x", 1))
    plan = dated.merged(table(spark, path), few, few.select("id"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "hashpartitioning" not in plan


def test_listings_are_in_order_over_their_files(spark, tmp_path):
    path = str(tmp_path / "listing")
    df = spark.range(3000).select(F.col("id"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=((F.col("id") * 7919) % 7200).cast("int"))).alias("t"))
    dated.write_in_order(df.repartition(7), path, "t", "id")
    got = [(str(r["day"]), r["f"], r["i"], r["t"], r["id"]) for r in spark.read.parquet(path).selectExpr("day", "_metadata.file_name f", "_metadata.row_index i", "t", "id").collect()]
    assert [x[3:] for x in sorted(got)] == sorted(x[3:] for x in got) and len({x[1] for x in got}) > 1


def test_a_stream_over_an_empty_folder_loads_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = str(tmp_path / "t")
    sync(spark, str(tmp_path / "in"), rows(spark).schema, str(tmp_path / "state"), lambda batch, _: dated.upsert(batch.sparkSession, path, batch, ["id"], "v"))
    assert content(spark, path) == []

"""Sketches a day, and tables for reads of one key."""

import datetime as dt

from pyspark.sql import functions as F

from callweave.operators import clustered, sketches, upsert


def test_sketches_of_days_count_as_the_whole_does(spark):
    rows = spark.range(60_000).select((F.col("id") * 7919 % 17_000).cast("string").alias("v"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("d"))
    rows = rows.unionByName(spark.createDataFrame([(None, dt.date(2024, 1, 3))], "v string, d date"))
    days = sketches.daily_sketches(rows, "d", "v")
    for start, end in (("2024-01-01", "2024-01-10"), ("2024-01-03", "2024-01-03"), ("2024-01-02", "2024-01-07")):
        inside = rows.where(F.col("d").between(start, end))
        exact = inside.agg(F.count("*"), F.count_distinct("v"), F.hll_sketch_estimate(F.hll_sketch_agg("v", F.lit(sketches.LG_K)))).first()
        got = sketches.distinct_in(days, start, end).first()
        assert got["rows"] == exact[0] and abs(got["estimate"] - exact[1]) <= sketches.ERROR * exact[1]
        assert abs(got["estimate"] - exact[2]) <= sketches.ERROR * exact[1]
    assert tuple(sketches.distinct_in(days, "2023-01-01", "2023-01-02").first()) == (0, 0)


def scanned(df):
    """Rows that the scan gives on, after row groups were ruled out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_reads_of_one_key_take_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200_000).select(F.concat(F.lit("s"), F.col("id") * 7919 % 50_000).alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    before = clustered.ROW_GROUP
    clustered.ROW_GROUP = 1 << 19
    try:
        clustered.write_clustered(rows, path, "k", 20_000, "id")
    finally:
        clustered.ROW_GROUP = before
    conf = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one, none = clustered.with_key(spark, path, "k", "s123"), clustered.with_key(spark, path, "k", "s123x")
        assert scanned(one) < 200_000 / 8 and one.count() == 4
        assert scanned(none) < 200_000 / 8 and none.count() == 0
        some = clustered.with_prefix(spark, path, "k", "s4999")
        assert some.count() == rows.where("k like 's4999%'").count() > 0 and scanned(some) < 200_000 / 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", conf)
    assert clustered.with_prefix(spark, path, "k", "").count() == 200_000


def test_audit_counts_what_the_load_writes(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 2), (4, None, 5), (5, None, 5)], "i long, a string, b long")
    target = spark.createDataFrame([(9, "z", 5)], "i long, a string, b long")
    counts = {}
    got = upsert.first_wins(target, rows, [["a"], ["b"]], "i", audit=counts)
    assert sorted(r["i"] for r in got.collect()) == [1, 3] and counts == {"valid": 5, "inserted": 2, "skipped": 3}

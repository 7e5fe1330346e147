"""Streams and increments that stop and start again."""

import datetime as dt

from callweave.streaming import increments
from callweave.streaming.consumption import consumed, run_consumption

USAGE = "usage_start_time timestamp_ntz, rat_type string, service_type_sub_cd string, rating_group string, act_usage_unit decimal(32,16)"


def usage(spark, *minutes):
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(start + dt.timedelta(minutes=m), "VO", "MO", "ONNET", 1) for m in minutes], "usage_start_time timestamp_ntz, rat_type string, service_type_sub_cd string, rating_group string, n int").selectExpr(*USAGE.replace(" timestamp_ntz", "").replace(" string", "").split(", ")[:4], "cast(n as decimal(32,16)) as act_usage_unit")


def test_consumption_goes_on_after_a_stop(spark, tmp_path):
    folder, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = usage(spark).schema
    (tmp_path / "in").mkdir()
    run_consumption(spark, folder, schema, table, state)
    assert consumed(spark, table).collect() == []

    def after(*minutes):
        usage(spark, *minutes).coalesce(1).write.mode("append").parquet(folder)
        run_consumption(spark, folder, schema, table, state)
        return {(r["window_start"].hour * 60 + r["window_start"].minute): r["n"] for r in consumed(spark, table).collect()}

    assert after(1, 2, 58, 59) == {0: 2, 55: 2}
    assert after(57, 50, 3, 61) == {0: 2, 50: 1, 55: 3, 60: 1}  # 57 and 50 are late but not too late, 3 is
    assert after(4, 180) == {0: 2, 50: 1, 55: 3, 60: 1, 180: 1}
    assert after(59) == {0: 2, 50: 1, 55: 3, 60: 1, 180: 1}


def copy(spark, sink, state, schema):
    return sorted(r[0] for r in increments.copied(spark, sink, state, schema).collect())


def test_a_load_killed_before_its_commit_is_done_again(spark, tmp_path):
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")
    rows = spark.range(100).selectExpr("id", "id * 2 as v")
    source = lambda n: increments.frame_source(rows.where(f"id < {n}"), "id")
    assert copy(spark, sink, state, rows.schema) == []
    assert increments.load_increment(spark, source(0), sink, state) == (0, 0, -1)
    assert increments.load_increment(spark, source(10), sink, state) == (0, 10, 9)
    assert increments.load_increment(spark, source(30), sink, state, commit=False) == (1, 20, 29)
    assert copy(spark, sink, state, rows.schema) == list(range(10))
    assert increments.load_increment(spark, source(50), sink, state) == (1, 40, 49)
    assert increments.load_increment(spark, source(50), sink, state) == (2, 0, 49)
    assert copy(spark, sink, state, rows.schema) == list(range(50))
    plan = source(50).read(9, 29)._jdf.queryExecution().optimizedPlan().toString()
    assert "> 9" in plan and "<= 29" in plan


def test_increments_of_a_database_are_read_in_ranges(spark, tmp_path):
    url, options = "jdbc:derby:memory:increments;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(1, 1001).selectExpr("id as ID", "cast(id % 7 as string) as V")
    rows.where("id <= 600").write.format("jdbc").options(url=url, dbtable="USAGE_ROWS", **options).save()
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")
    source = increments.jdbc_source(spark, url, "usage_rows", "ID", 8, **options)
    assert source.read(-1, 600).rdd.getNumPartitions() == 8
    assert increments.load_increment(spark, source, sink, state) == (0, 600, 600)
    rows.where("id > 600").write.format("jdbc").options(url=url, dbtable="USAGE_ROWS", **options).mode("append").save()
    assert increments.load_increment(spark, source, sink, state) == (1, 400, 1000)
    assert copy(spark, sink, state, source.read(0, 1).schema) == list(range(1, 1001))

"""Reports over SMS-centre records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify as c
from ..operators import sketches
from ..operators.report import count, grouped, value_counts
from ..operators.upsert import handed_over
from ..sources import fixtures as fx
from .catalogue import on_smsc

A2P = "message_type = 'message' AND addr_src_digits IN ('22200','22200Brand','60119990001') AND message_delivery_status IN ('success','success_esme') AND day >= '1996-01-01' AND day < '1997-01-01'"


def in_year() -> Column:
    return (F.col("day") >= "1996-01-01") & (F.col("day") < "1997-01-01")


@on_smsc("a2p_by_sender_status", f"SELECT addr_src_digits AS sender, message_delivery_status AS status, COUNT(*) AS total FROM smsc WHERE {A2P} GROUP BY 1, 2")
def a2p_by_sender_status(s: DataFrame) -> DataFrame:
    return grouped(s, c.a2p_message(fx.A2P_SENDERS) & in_year(), {"sender": F.col("addr_src_digits"), "status": F.col("message_delivery_status")}, {"total": count()})


@on_smsc("a2p_by_status", f"SELECT message_delivery_status AS status, COUNT(*) AS total FROM smsc WHERE {A2P} GROUP BY 1")
def a2p_by_status(s: DataFrame) -> DataFrame:
    return grouped(s, c.a2p_message(fx.A2P_SENDERS) & in_year(), {"status": F.col("message_delivery_status")}, {"total": count()})


@on_smsc("smsc_sender_groups", "SELECT CASE WHEN addr_src_digits LIKE '60%' THEN '60xxxx' ELSE addr_src_digits END AS sender, COUNT(*) AS total FROM smsc GROUP BY 1")
def smsc_sender_groups(s: DataFrame) -> DataFrame:
    return grouped(s, None, {"sender": c.sender_group()}, {"total": count()}).orderBy(F.desc("total"))


@on_smsc("smsc_distinct_senders", "SELECT COUNT(DISTINCT addr_src_digits) AS senders FROM smsc")
def smsc_distinct_senders(s: DataFrame) -> DataFrame:
    return s.agg(F.count_distinct("addr_src_digits").alias("senders"))


@on_smsc("smsc_row_count", "SELECT COUNT(*) AS n FROM smsc")
def smsc_row_count(s: DataFrame) -> DataFrame:
    return s.agg(F.count("*").alias("n"))


@on_smsc("value_counts_delivery_status", "SELECT message_delivery_status, COUNT(*) AS n FROM smsc GROUP BY 1")
def delivery_states(s: DataFrame) -> DataFrame:
    return value_counts(s, "message_delivery_status")


@on_smsc("distinct_values_delivery_status", "SELECT DISTINCT message_delivery_status FROM smsc")
def distinct_states(s: DataFrame) -> DataFrame:
    return s.select("message_delivery_status").distinct()


@on_smsc("smsc_distinct_senders_by_day", "SELECT COUNT(*) AS total, COUNT(DISTINCT addr_src_digits) AS senders, TRUE AS within_bound FROM smsc WHERE day >= '1996-01-01' AND day < '1997-01-01'")
def smsc_distinct_senders_by_day(s: DataFrame) -> DataFrame:
    """Senders of a year from the sketches of its days, held against the exact count."""
    days = handed_over(sketches.daily_sketches(s.withColumn("day", F.to_date("day")), "day", "addr_src_digits"), "sender-sketches")
    found = sketches.distinct_in(days, *fx.SMSC_WINDOW)
    exact = s.where(in_year()).agg(F.count_distinct("addr_src_digits").alias("senders"))
    both = found.crossJoin(exact)  # one row each
    return both.select(F.col("rows").alias("total"), "senders", (F.abs(F.col("estimate") - F.col("senders")) <= sketches.ERROR * F.col("senders")).alias("within_bound"))

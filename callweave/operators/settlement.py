"""Settlement lines over the request log, all in one scan.

A request may belong to several lines, so each row is given the list of its
lines, which is exploded before one grouped aggregation.  Fourteen queries over
the same window become one pass; what is shuffled is at most one row for each
line and key in each task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify as c

KEYS = ("rat_type", "roaming_destination_id", "rating_group")
MEASURES = ("total_transaction", "mou", "mou_minutes", "mou_mbs")


@dataclass(frozen=True)
class Rules:
    """How lines are counted.

    ``documents`` follows the document store: unknown numbers and destinations
    count as foreign, rounding is half to even and done again after sums, and no
    line tests the number's length.  ``volume`` overrides each line's own column.
    """

    documents: bool = False
    volume: str | None = None
    least_length: int | None = 10


@dataclass(frozen=True)
class Line:
    number: int
    title: str
    where: Column
    keys: tuple[str, ...] = ("rat_type", "roaming_destination_id")
    volume: str = "act_update_used_volume"
    measures: tuple[str, ...] = field(default=("total_transaction", "mou"))
    sum_first: bool = False  # round once after the sum instead of every row


def lines(rules: Rules = Rules()) -> list[Line]:
    rat, group, direction = F.col("rat_type"), F.col("rating_group"), F.col("service_type_sub_cd")
    voice, sms = rat == "VO", rat == "SM"
    home = F.col("roaming_destination_id") == c.HOME_DESTINATION
    abroad = c.not_home(keep_unknown=rules.documents)
    foreign = c.number_not_local(keep_unknown=rules.documents)
    long_number = F.length("opposite_number") > rules.least_length if rules.least_length is not None and not rules.documents else F.lit(True)
    minutes, mbs = ("total_transaction", "mou", "mou_minutes"), ("total_transaction", "mou", "mou_mbs")
    used = "update_used_volume"
    return [
        Line(1, "Voice MO on net", voice & (group == "ONNET") & home & long_number, measures=minutes),
        Line(2, "Voice MO off net", voice & (group == "OFFNET") & home & long_number, measures=minutes),
        Line(3, "SMS MO on net", sms & home),
        Line(4, "SMS MO off net", sms & home),
        Line(5, "4G data", (rat == "4G") & home, measures=mbs),
        Line(6, "5G data", (rat == "5G") & home, measures=mbs),
        Line(7, "International voice", voice & home & foreign, ("rating_group",), measures=minutes, sum_first=True),
        Line(8, "International SMS", sms & home & foreign, ("rating_group",), measures=("mou",), sum_first=True),
        Line(9, "Roaming data 4G", (rat == "4G") & abroad, ("rat_type",), measures=mbs),
        Line(10, "Roaming data 5G", (rat == "5G") & abroad, ("rat_type",), measures=mbs),
        Line(11, "Roaming voice MO", voice & (direction == "MO") & abroad & foreign, ("rat_type",), measures=minutes),
        Line(12, "Roaming voice MT", voice & (direction == "MT") & abroad & foreign, ("rat_type",), measures=minutes),
        Line(13, "Roaming SMS MO", sms & (direction == "MO") & abroad, ("rat_type",), used),
        Line(14, "Premium numbers", voice & c.premium_number(), (), used, minutes),
    ]


def settle(requests: DataFrame, start: str, end: str, only: set[int] | None = None, rules: Rules = Rules()) -> DataFrame:
    """(query_id, keys, measures) of each line; keys and measures that a line does
    not have are null.  Lines without rows have no row."""
    wanted = [x for x in lines(rules) if only is None or x.number in only]
    hit = F.array_compact(F.array(*[F.when(x.where, F.lit(x.number)) for x in wanted]))
    rows = requests.where(c.report_window("req_time", start, end)).select(
        *KEYS, "act_update_used_volume", "update_used_volume", F.explode(hit).alias("query_id")
    )

    def among(numbers: list[int]) -> Column:
        return F.col("query_id").isin(numbers)

    x = (
        F.col(rules.volume)
        if rules.volume
        else F.when(among([l.number for l in wanted if l.volume == "update_used_volume"]), F.col("update_used_volume")).otherwise(F.col("act_update_used_volume"))
    )
    keyed = rows.select(
        "query_id", x.alias("x"), *[F.when(among([l.number for l in wanted if k in l.keys]), F.col(k)).alias(k) for k in KEYS]
    )
    near = F.bround if rules.documents else F.round
    again = (lambda v: F.bround(v, 2)) if rules.documents else (lambda v: v)
    v = F.col("x")
    sums = keyed.groupBy("query_id", *KEYS).agg(
        F.count("*").alias("n"),
        near(F.sum(v), 2).alias("once"),
        near(F.sum(v / 60) if rules.documents else F.sum(v) / 60, 2).alias("once_minutes"),
        again(F.sum(near(v, 2))).alias("each"),
        again(F.sum(near(v / 60, 2))).alias("each_minutes"),
        again(F.sum(near(v / 1048576, 2))).alias("each_mbs"),
    )
    first = among([l.number for l in wanted if l.sum_first])

    def measure(name: str, value: Column) -> Column:
        return F.when(among([l.number for l in wanted if name in l.measures]), value).alias(name)

    return sums.select(
        "query_id",
        *KEYS,
        measure("total_transaction", F.col("n")),
        measure("mou", F.when(first, F.col("once")).otherwise(F.col("each"))),
        measure("mou_minutes", F.when(first, F.col("once_minutes")).otherwise(F.col("each_minutes"))),
        measure("mou_mbs", F.col("each_mbs")),
    )


def summary(requests: DataFrame, start: str, end: str, rules: Rules = Rules()) -> DataFrame:
    """One row for each of the lines.  Several groups of a line are summed; a line
    without rows has nulls, but the premium line, which has no groups, a count of 0."""
    spark = requests.sparkSession
    found = settle(requests, start, end, rules=rules).groupBy("query_id").agg(*[F.sum(m).alias(m) for m in MEASURES])
    every = spark.createDataFrame([(x.number, x.title, not x.keys) for x in lines(rules)], "query_id int, title string, ungrouped boolean")
    out = every.join(found, "query_id", "left")
    n = F.when(F.col("ungrouped"), F.coalesce("total_transaction", F.lit(0))).otherwise(F.col("total_transaction"))
    return out.select("query_id", "title", n.alias("total_transaction"), *MEASURES[1:])

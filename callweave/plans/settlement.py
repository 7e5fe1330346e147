"""Settlement lines, their summary and the filled report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import settlement as st, template as tp
from ..sources import fixtures as fx
from .catalogue import IN_REQUEST, REQUEST_CTE, on_request, query

START, END = fx.REQUEST_WINDOW
ACT, UPD = "CAST(act_update_used_volume AS BIGINT)", "CAST(update_used_volume AS BIGINT)"
HOME, AWAY, FOREIGN = "roaming_destination_id = 87", "roaming_destination_id <> 87", "opposite_number NOT LIKE '60%'"
PREMIUM = "(opposite_number IN ('600380008000','60103','60100','6015454','6015300','6015353','6015404','6015444','6015777') OR ((opposite_number LIKE '601300%' OR opposite_number LIKE '601700%' OR opposite_number LIKE '601800%') AND LENGTH(opposite_number) < 12))"
N, NONE = "COUNT(*)", "CAST(NULL AS DOUBLE)"


def _each(x: str, by: int) -> str:
    return f"SUM(({x} * 100 + {by // 2}) // {by}) / 100.0"


def _once(x: str, by: int) -> str:
    return f"((SUM({x}) * 100 + {by // 2}) // {by}) / 100.0"


def _line(where: str, keys: tuple[str, ...], x: str = ACT, minutes: bool = False, mbs: bool = False, n: str = N, once: bool = False) -> tuple:
    rounded = _once if once else _each
    return where, keys, n, f"CAST(SUM({x}) AS DOUBLE)", rounded(x, 60) if minutes else NONE, rounded(x, 1048576) if mbs else NONE


RAT_ID, GROUP, RAT = ("rat_type", "roaming_destination_id"), ("rating_group",), ("rat_type",)
SQL_LINES = {
    1: _line(f"rat_type = 'VO' AND rating_group = 'ONNET' AND {HOME} AND LENGTH(opposite_number) > 10", RAT_ID, minutes=True),
    2: _line(f"rat_type = 'VO' AND rating_group = 'OFFNET' AND {HOME} AND LENGTH(opposite_number) > 10", RAT_ID, minutes=True),
    3: _line(f"rat_type = 'SM' AND {HOME}", RAT_ID),
    4: _line(f"rat_type = 'SM' AND {HOME}", RAT_ID),
    5: _line(f"rat_type = '4G' AND {HOME}", RAT_ID, mbs=True),
    6: _line(f"rat_type = '5G' AND {HOME}", RAT_ID, mbs=True),
    7: _line(f"rat_type = 'VO' AND {HOME} AND {FOREIGN}", GROUP, minutes=True, once=True),
    8: _line(f"rat_type = 'SM' AND {HOME} AND {FOREIGN}", GROUP, n="CAST(NULL AS BIGINT)", once=True),
    9: _line(f"rat_type = '4G' AND {AWAY}", RAT, mbs=True),
    10: _line(f"rat_type = '5G' AND {AWAY}", RAT, mbs=True),
    11: _line(f"rat_type = 'VO' AND service_type_sub_cd = 'MO' AND {AWAY} AND {FOREIGN}", RAT, minutes=True),
    12: _line(f"rat_type = 'VO' AND service_type_sub_cd = 'MT' AND {AWAY} AND {FOREIGN}", RAT, minutes=True),
    13: _line(f"rat_type = 'SM' AND service_type_sub_cd = 'MO' AND {AWAY}", RAT, UPD),
    14: _line(f"rat_type = 'VO' AND {PREMIUM}", (), UPD, minutes=True),
}
NAMES = ("voice_onnet", "voice_offnet", "sms_on", "sms_off", "4g", "5g", "intl_voice", "intl_sms", "roam_4g", "roam_5g", "roam_voice_mo", "roam_voice_mt", "roam_sms_mo", "premium")


def line_sql(number: int) -> str:
    where, keys, n, mou, minutes, mbs = SQL_LINES[number]
    columns = [k if k in keys else f"CAST(NULL AS {'BIGINT' if k.endswith('id') else 'VARCHAR'})" for k in st.KEYS]
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    return (
        f"SELECT {number} AS query_id, {', '.join(f'{e} AS {k}' for e, k in zip(columns, st.KEYS))}, {n} AS total_transaction, {mou} AS mou, {minutes} AS mou_minutes, {mbs} AS mou_mbs"
        f" FROM request_log WHERE {where} AND {IN_REQUEST}{group}"
    )


def as_doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({m: F.col(m).cast("double") for m in st.MEASURES[1:]})


for _number, _name in enumerate(NAMES, 1):

    def _query(number: int, name: str) -> None:
        @on_request(f"line_{number:02d}_{name}", line_sql(number))
        def run(q: DataFrame) -> DataFrame:
            return as_doubles(st.settle(q, START, END, {number}))

    _query(_number, _name)

ALL_LINES = " UNION ALL ".join(f"({line_sql(i)})" for i in SQL_LINES)
SUMMARY_SQL = f"SELECT query_id, SUM(total_transaction)::BIGINT AS total_transaction, SUM(mou) AS mou, SUM(mou_minutes) AS mou_minutes, SUM(mou_mbs) AS mou_mbs FROM ({ALL_LINES}) GROUP BY query_id"


@on_request("settlement_summary", SUMMARY_SQL)
def settlement_summary(q: DataFrame) -> DataFrame:
    return as_doubles(st.summary(q, START, END).drop("title"))


@on_request("settlement_by_group", ALL_LINES)
def settlement_by_group(q: DataFrame) -> DataFrame:
    return as_doubles(st.settle(q, START, END))


def _even(x: str, by: int) -> str:
    """Half to even in whole hundredths."""
    return f"CASE WHEN ({x} * 100) % {by} * 2 = {by} THEN ({x} * 100) // {by} + (({x} * 100) // {by}) % 2 ELSE ({x} * 100 + {by // 2}) // {by} END"


@on_request(
    "settlement_documents",
    "SELECT 5 AS query_id, COUNT(*) AS total_transaction, SUM(" + _even(UPD, 1048576) + f") / 100.0 AS measure FROM request_log WHERE rat_type = '4G' AND {HOME} AND {IN_REQUEST}"
    f" UNION ALL SELECT 7, COUNT(*), ((SUM({UPD}) * 100 + 30) // 60) / 100.0 FROM request_log WHERE rat_type = 'VO' AND {HOME} AND COALESCE({FOREIGN}, TRUE) AND {IN_REQUEST} GROUP BY rating_group"
    f" UNION ALL SELECT 11, COUNT(*), SUM(({UPD} * 100 + 30) // 60) / 100.0 FROM request_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MO' AND roaming_destination_id IS DISTINCT FROM 87 AND COALESCE({FOREIGN}, TRUE) AND {IN_REQUEST}",
)
def settlement_documents(q: DataFrame) -> DataFrame:
    """The document store's reading of lines 5, 7 and 11: unknown numbers count, half-even rounding."""
    rules = st.Rules(documents=True, volume="update_used_volume")
    out = st.settle(q, START, END, {5, 7, 11}, rules)
    return out.select("query_id", "total_transaction", F.coalesce("mou_mbs", "mou_minutes").cast("double").alias("measure"))


def document_sql(number: int) -> str:
    """A line as the document store reads it: unknown numbers and destinations count, no length is tested."""
    where, keys, n, _, minutes, mbs = SQL_LINES[number]
    where = where.replace(" AND LENGTH(opposite_number) > 10", "").replace(AWAY, "roaming_destination_id IS DISTINCT FROM 87").replace(FOREIGN, f"COALESCE({FOREIGN}, TRUE)")
    by_minute = _once(UPD, 60) if number == 7 else f"SUM({_even(UPD, 60)}) / 100.0"
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    return (
        f"SELECT {number} AS query_id, {n} AS total_transaction, CAST(SUM({UPD}) AS DOUBLE) AS mou, {by_minute if minutes != NONE else NONE} AS mou_minutes,"
        f" {f'SUM({_even(UPD, 1048576)}) / 100.0' if mbs != NONE else NONE} AS mou_mbs FROM request_log WHERE {where} AND {IN_REQUEST}{group}"
    )


@on_request("settlement_documents_by_line", " UNION ALL ".join(f"({document_sql(i)})" for i in SQL_LINES))
def settlement_documents_by_line(q: DataFrame) -> DataFrame:
    """All lines in the document store's reading."""
    rules = st.Rules(documents=True, volume="update_used_volume")
    return as_doubles(st.settle(q, START, END, None, rules)).drop(*st.KEYS)


def _cell(cell: str) -> str:
    found = tp.PLACEHOLDER.fullmatch(cell)
    if not found:
        return f"'{cell}'"
    value = f"(SELECT {found[2].lower()} FROM s WHERE query_id = {found[1]})"
    return f"COALESCE(regexp_replace(CAST({value} AS VARCHAR), '\\.0$', ''), '')"


REPORT_SQL = f"WITH {REQUEST_CTE}, s AS ({SUMMARY_SQL}) " + " UNION ALL ".join(
    "SELECT " + ", ".join(f"{_cell(cell)} AS {h}" for cell, h in zip(row, tp.HEADER)) for row in tp.TEMPLATE
)


@query("settlement_report", REPORT_SQL)
def settlement_report(spark, sf_dir):  # type: ignore[no-untyped-def]
    return tp.fill(spark, st.summary(fx.request_log(spark, sf_dir), START, END))


@query("template_fill", REPORT_SQL)
def template_fill(spark, sf_dir):  # type: ignore[no-untyped-def]
    return tp.fill(spark, st.summary(fx.request_log(spark, sf_dir), START, END), tp.TEMPLATE, tp.HEADER)


@on_request(
    "collapse_rows",
    f"SELECT 7 AS query_id, SUM(n)::BIGINT AS n, string_agg(rating_group, '; ' ORDER BY rating_group) AS rating_group FROM (SELECT rating_group, COUNT(*) AS n FROM request_log WHERE rat_type = 'VO' AND {IN_REQUEST} GROUP BY 1)",
)
def collapse_rows(q: DataFrame) -> DataFrame:
    groups = q.where("rat_type = 'VO'").where(st.c.report_window("req_time", START, END)).groupBy("rating_group").agg(F.count("*").alias("n"))
    return tp.collapse(groups.withColumn("query_id", F.lit(7)), ["n"], ["rating_group"], "rating_group")


@on_request("format_cell", f"SELECT rat_type, regexp_replace(CAST(SUM(({ACT} * 100 + 30) // 60) / 100.0 AS VARCHAR), '\\.0$', '') AS minutes FROM request_log WHERE rat_type = 'VO' AND {IN_REQUEST} GROUP BY 1")
def format_cells(q: DataFrame) -> DataFrame:
    rows = q.where("rat_type = 'VO'").where(st.c.report_window("req_time", START, END))
    sums = rows.groupBy("rat_type").agg(F.sum(F.round(F.col("act_update_used_volume") / 60, 2)).alias("m"))
    return sums.select("rat_type", tp.format_cell(F.col("m")).alias("minutes"))

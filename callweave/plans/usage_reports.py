"""Voice, SMS and data reports over the usage log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify as c
from ..functions.dates import report_bounds
from ..operators import clustered
from ..operators.lookup import country_by_prefix, country_by_row_number, roaming_network
from ..operators.report import count, grouped, minutes_of_sum, sum_of_rounded, sum_rounded, value_counts
from ..sources import fixtures as fx
from ..sources.scratch import scratch
from .catalogue import DIMENSION_CTES, IN_USAGE, USAGE_CTE, on_request, on_usage, query

# Columns need a running session, so conditions, keys and measures are functions here.
col = F.col
START, END = fx.USAGE_WINDOW
WINDOW = lambda: c.report_window("usage_start_time", START, END)
VOICE, SMS = lambda: col("rat_type") == "VO", lambda: col("rat_type") == "SM"
DATA = lambda: col("rat_type").isin("4G", "5G")
MO, MT = lambda: col("service_type_sub_cd") == "MO", lambda: col("service_type_sub_cd") == "MT"
BILLABLE = lambda: col("act_usage_unit") > 0
HOME = lambda: col("roaming_destination_id") == c.HOME_DESTINATION
ROAMED = c.not_home
FOREIGN, LOCAL = c.number_not_local, lambda: c.starts_home("opposite_number")
BOTH_UNITS = lambda: {"total": count(), "act_units": sum_rounded("act_usage_unit"), "units": sum_rounded("usage_unit")}
SQL_UNITS = "COUNT(*) AS total, CAST(ROUND(SUM(act_usage_unit), 2) AS DOUBLE) AS act_units, CAST(ROUND(SUM(usage_unit), 2) AS DOUBLE) AS units"
SQL_ROAMING = "CASE WHEN roaming_destination_id = 87 THEN 'NON_ROAMING' ELSE 'ROAMING' END"
SQL_MINUTES = "((CAST(SUM(usage_unit) AS BIGINT) * 100 + 30) // 60) / 100.0"
SQL_ACT_MINUTES = "((CAST(SUM(act_usage_unit) AS BIGINT) * 100 + 30) // 60) / 100.0"


def dated(df: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """The report's window as two constant columns (no join with a parameter row)."""
    return df.select(F.to_date(F.lit(start)).alias("report_start_date"), F.to_date(F.lit(end)).alias("report_end_date"), *df.columns)


Lazy = Callable[[], dict]


def simple(name: str, where: Callable[[], Column], keys: Lazy, sql_where: str, sql_keys: dict, measures: Lazy = BOTH_UNITS, sql_measures: str = SQL_UNITS, order: list | None = None) -> None:
    """A report inside the window: one filter, grouped keys, count and both unit sums."""
    select = "".join(f"{e} AS {n}, " for n, e in sql_keys.items())
    group = f" GROUP BY {', '.join(sql_keys.values())}" if sql_keys else ""

    @on_usage(name, f"SELECT {select}{sql_measures} FROM usage_log WHERE {sql_where} AND {IN_USAGE}{group}")
    def run(u: DataFrame) -> DataFrame:
        out = grouped(u, where() & WINDOW(), keys(), measures())
        return out.orderBy(*order) if order else out


@on_usage(
    "voice_recon_final",
    "SELECT service_type_sub_cd AS direction, CASE WHEN rating_group = 'ONNET' THEN 'ONNET' ELSE 'OTHER' END AS charging_type,"
    " CASE WHEN roaming_mccmnc LIKE '60%' THEN 'MY_ORIGIN' ELSE 'NON_MY_ORIGIN' END AS origin_type,"
    " CASE WHEN opposite_number NOT LIKE '60%' THEN 'IDD' ELSE 'LOCAL' END AS destination_type,"
    " CASE WHEN roaming_destination_id = 87 THEN 'DOMESTIC' ELSE 'ROAMING' END AS location_type, " + SQL_UNITS +
    " FROM usage_log WHERE rat_type = 'VO' AND act_usage_unit > 0 AND usage_start_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-19 00:00:00' GROUP BY 1, 2, 3, 4, 5",
)
def voice_recon_final(u: DataFrame) -> DataFrame:
    """The closed window includes the first instant of the day after the end."""
    keys = {
        "direction": col("service_type_sub_cd"),
        "charging_type": c.charging_type(),
        "origin_type": c.origin_type(),
        "destination_type": c.destination_type(),
        "location_type": c.location_type(),
    }
    closed = c.report_window("usage_start_time", START, END, closed=True)
    return grouped(u, VOICE() & BILLABLE() & closed, keys, BOTH_UNITS()).orderBy("charging_type")


simple("voice_mo_by_roaming", lambda: VOICE() & MO() & BILLABLE(), lambda: {"roaming_status": c.roaming_status()}, "rat_type = 'VO' AND service_type_sub_cd = 'MO' AND act_usage_unit > 0", {"roaming_status": SQL_ROAMING})
simple(
    "voice_mo_by_network", lambda: VOICE() & MO() & BILLABLE(),
    lambda: {"roaming_status": c.roaming_status(), "roaming_destination_id": col("roaming_destination_id"), "roaming_mccmnc": col("roaming_mccmnc")},
    "rat_type = 'VO' AND service_type_sub_cd = 'MO' AND act_usage_unit > 0",
    {"roaming_status": SQL_ROAMING, "roaming_destination_id": "roaming_destination_id", "roaming_mccmnc": "roaming_mccmnc"},
)
SQL_GROUP = "CASE WHEN opposite_number LIKE '60%' THEN 'MY_NUMBERS' ELSE 'NON_MY_NUMBERS' END"
simple(
    "voice_mo_by_number_group", lambda: VOICE() & MO(), lambda: {"roaming_status": c.roaming_status(), "number_group": c.opposite_number_group()},
    "rat_type = 'VO' AND service_type_sub_cd = 'MO'", {"roaming_status": SQL_ROAMING, "number_group": SQL_GROUP},
)


@on_usage("voice_mo_by_number_group_all_time", f"SELECT {SQL_ROAMING} AS roaming_status, {SQL_GROUP} AS number_group, {SQL_UNITS} FROM usage_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MO' GROUP BY 1, 2")
def voice_mo_by_number_group_all_time(u: DataFrame) -> DataFrame:
    return grouped(u, VOICE() & MO(), {"roaming_status": c.roaming_status(), "number_group": c.opposite_number_group()}, BOTH_UNITS())


def country_sql(where: str, keys: str) -> str:
    """The LIKE join ranked by code length, as a SQL user writes it; shared codes go to the first country."""
    return f"""WITH {USAGE_CTE}, {DIMENSION_CTES}, longest AS (SELECT MAX(LENGTH(country_code)) AS n FROM country_code_reference),
 ranked AS (SELECT u.*, {SQL_ROAMING} AS roaming_status, r.country, r.country_code, ROW_NUMBER() OVER (PARTITION BY u.usage_log_id
   ORDER BY LENGTH(r.country_code) DESC NULLS LAST, r.country_code DESC, r.country ASC) AS rn
  FROM usage_log u LEFT JOIN country_code_reference r ON u.opposite_number LIKE concat(r.country_code, '%') WHERE {where} AND {IN_USAGE})
 SELECT {keys}COALESCE(country, 'UNMAPPED') AS destination_country, COALESCE(country_code, 'UNMAPPED') AS matched_country_code,
  CASE WHEN country IS NULL THEN LEFT(opposite_number, CAST((SELECT n FROM longest) AS INT)) END AS unmatched_number_prefix, {SQL_UNITS}
 FROM ranked WHERE rn = 1 GROUP BY ALL"""


def by_country(u: DataFrame, codes: DataFrame, where: Column, with_status: bool = True) -> DataFrame:
    """Count and units by destination country: only the final groups are shuffled."""
    calls = country_by_prefix(u.where(where & WINDOW()), codes)
    names = ["destination_country", "matched_country_code", "unmatched_number_prefix"]
    keys = ({"roaming_status": c.roaming_status()} if with_status else {}) | {n: col(n) for n in names}
    order = ["roaming_status"] * with_status + [F.desc("total"), "destination_country"]
    return grouped(calls, None, keys, BOTH_UNITS()).orderBy(*order)


for _name, _where, _sql, _status in (
    ("idd_by_country", lambda: VOICE() & MO() & FOREIGN(), "u.rat_type = 'VO' AND u.service_type_sub_cd = 'MO' AND u.opposite_number NOT LIKE '60%'", True),
    ("roaming_mo_by_country", lambda: VOICE() & MO() & ROAMED(), "u.rat_type = 'VO' AND u.service_type_sub_cd = 'MO' AND u.roaming_destination_id <> 87", False),
    ("voice_mo_by_country", lambda: VOICE() & MO(), "u.rat_type = 'VO' AND u.service_type_sub_cd = 'MO'", True),
    ("sms_by_country", lambda: SMS(), "u.rat_type = 'SM'", True),
):
    query(_name, country_sql(_sql, "roaming_status, " if _status else ""))(
        lambda spark, sf_dir, w=_where, s=_status: by_country(fx.usage_log(spark, sf_dir), fx.country_codes(spark), w(), s)
    )

LONGEST_SQL = f"""WITH {USAGE_CTE}, {DIMENSION_CTES}, ranked AS (SELECT u.usage_log_id, r.country, r.country_code, ROW_NUMBER() OVER (PARTITION BY u.usage_log_id
 ORDER BY LENGTH(r.country_code) DESC NULLS LAST, r.country_code DESC, r.country ASC) AS rn
 FROM usage_log u LEFT JOIN country_code_reference r ON u.opposite_number LIKE concat(r.country_code, '%'))
SELECT usage_log_id, COALESCE(country, 'UNMAPPED') AS destination_country, COALESCE(country_code, 'UNMAPPED') AS matched_country_code FROM ranked WHERE rn = 1"""


@query("country_longest_prefix", LONGEST_SQL)
def country_longest_prefix(spark, sf_dir):  # type: ignore[no-untyped-def]
    return country_by_prefix(fx.usage_log(spark, sf_dir), fx.country_codes(spark)).select("usage_log_id", "destination_country", "matched_country_code")


@query("longest_match_row_number", LONGEST_SQL)
def longest_match_row_number(spark, sf_dir):  # type: ignore[no-untyped-def]
    return country_by_row_number(fx.usage_log(spark, sf_dir), fx.country_codes(spark), "usage_log_id").select("usage_log_id", "destination_country", "matched_country_code")


@on_usage("voice_mou_onoff", f"SELECT 'Voice' AS service_type, CASE rating_group WHEN 'ONNET' THEN 'On Net' ELSE 'Off Net' END AS network_type, 'MO' AS event_direction, {SQL_MINUTES} AS minutes FROM usage_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MO' AND rating_group IN ('ONNET','OFFNET') AND {IN_USAGE} GROUP BY 2")
def voice_mou_onoff(u: DataFrame) -> DataFrame:
    keys = {"service_type": F.lit("Voice"), "network_type": c.network_label(), "event_direction": F.lit("MO")}
    out = grouped(u, VOICE() & MO() & col("rating_group").isin("ONNET", "OFFNET") & WINDOW(), keys, {"minutes": minutes_of_sum("usage_unit")})
    return out.orderBy(F.when(col("network_type") == "On Net", 1).otherwise(2))


BY_GROUP, SQL_BY_GROUP = lambda: {"rating_group": col("rating_group")}, {"rating_group": "rating_group"}
WITH_MINUTES = lambda: {"total": count(), "units": sum_rounded("usage_unit"), "minutes": minutes_of_sum("usage_unit")}
SQL_WITH_MINUTES = f"COUNT(*) AS total, CAST(ROUND(SUM(usage_unit), 2) AS DOUBLE) AS units, {SQL_MINUTES} AS minutes"
simple("voice_home_to_intl", lambda: VOICE() & HOME() & FOREIGN(), BY_GROUP, "rat_type = 'VO' AND roaming_destination_id = 87 AND opposite_number NOT LIKE '60%'", SQL_BY_GROUP, WITH_MINUTES, SQL_WITH_MINUTES)
simple("sms_home_to_intl", lambda: SMS() & HOME() & FOREIGN(), BY_GROUP, "rat_type = 'SM' AND roaming_destination_id = 87 AND opposite_number NOT LIKE '60%'", SQL_BY_GROUP, WITH_MINUTES, SQL_WITH_MINUTES)
simple(
    "voice_domestic", lambda: VOICE() & MO() & col("rating_group").isin("ONNET", "OFFNET") & HOME() & LOCAL() & (F.length("opposite_number") >= 11), BY_GROUP,
    "rat_type = 'VO' AND service_type_sub_cd = 'MO' AND rating_group IN ('ONNET','OFFNET') AND roaming_destination_id = 87 AND opposite_number LIKE '60%' AND LENGTH(opposite_number) >= 11",
    SQL_BY_GROUP, WITH_MINUTES, SQL_WITH_MINUTES,
)
simple(
    "sms_by_prefix", lambda: SMS() & BILLABLE(), lambda: {"roaming_status": c.roaming_status(), "number_group": c.opposite_number_group(home="STARTS_WITH_60", other="NON_60")},
    "rat_type = 'SM' AND act_usage_unit > 0", {"roaming_status": SQL_ROAMING, "number_group": "CASE WHEN opposite_number LIKE '60%' THEN 'STARTS_WITH_60' ELSE 'NON_60' END"},
)


@on_usage("sms_onoff", f"SELECT 'SMS' AS service_type, CASE rating_group WHEN 'ONNET' THEN 'On Net' ELSE 'Off Net' END AS network_type, COUNT(*) AS total FROM usage_log WHERE rat_type = 'SM' AND rating_group IN ('ONNET','OFFNET') AND {IN_USAGE} GROUP BY 2")
def sms_onoff(u: DataFrame) -> DataFrame:
    keys = {"service_type": F.lit("SMS"), "network_type": c.network_label()}
    out = grouped(u, SMS() & col("rating_group").isin("ONNET", "OFFNET") & WINDOW(), keys, {"total": count()})
    return out.orderBy(F.when(col("network_type") == "On Net", 1).otherwise(2))


simple("sms_domestic", lambda: SMS() & HOME(), BY_GROUP, "rat_type = 'SM' AND roaming_destination_id = 87", SQL_BY_GROUP)
simple(
    "data_by_network", lambda: DATA() & BILLABLE(), lambda: {"roaming_mccmnc": col("roaming_mccmnc"), "rat_type": col("rat_type")},
    "rat_type IN ('4G','5G') AND act_usage_unit > 0", {"roaming_mccmnc": "roaming_mccmnc", "rat_type": "rat_type"},
)


@on_usage("data_by_network_4g_all_time", f"SELECT roaming_mccmnc, {SQL_UNITS} FROM usage_log WHERE rat_type = '4G' GROUP BY 1")
def data_by_network_4g_all_time(u: DataFrame) -> DataFrame:
    return grouped(u, col("rat_type") == "4G", {"roaming_mccmnc": col("roaming_mccmnc")}, BOTH_UNITS())


ROAMING_SQL = f"""WITH {USAGE_CTE}, {DIMENSION_CTES}, e AS (SELECT u.*, {SQL_ROAMING.replace('roaming_destination_id', 'u.roaming_destination_id')} AS roaming_status, r.country, r.roaming_destination_name, r.mcc
 FROM usage_log u LEFT JOIN roaming_destination r ON r.roaming_destination_id = u.roaming_destination_id WHERE u.rat_type IN ('4G','5G') AND u.act_usage_unit > 0 AND {IN_USAGE})
SELECT roaming_status, rat_type, COALESCE(country, 'UNMAPPED') AS usage_country, COALESCE(mcc, LEFT(roaming_mccmnc, 3), 'UNMAPPED') AS matched_mcc, roaming_destination_id,
 roaming_destination_name, CASE WHEN country IS NULL THEN roaming_mccmnc END AS unmatched_mccmnc, COUNT(DISTINCT roaming_mccmnc) AS networks_seen, {SQL_UNITS} FROM e GROUP BY ALL"""


@query("roaming_data_by_country", ROAMING_SQL)
def roaming_data_by_country(spark, sf_dir):  # type: ignore[no-untyped-def]
    rows = roaming_network(fx.usage_log(spark, sf_dir).where(DATA() & BILLABLE() & WINDOW()), fx.roaming_destinations(spark))
    keys = {"roaming_status": c.roaming_status(), "rat_type": col("rat_type"), "usage_country": col("roaming_country"), "matched_mcc": col("mcc")}
    keys |= {n: col(n) for n in ("roaming_destination_id", "roaming_destination_name", "unmatched_mccmnc")}
    return grouped(rows, None, keys, {"networks_seen": F.count_distinct("roaming_mccmnc")} | BOTH_UNITS()).orderBy("roaming_status", F.desc("total"), "usage_country", "rat_type")


@query("roaming_country", f"WITH {USAGE_CTE}, {DIMENSION_CTES} SELECT u.usage_log_id, COALESCE(r.country, 'UNMAPPED') AS roaming_country, COALESCE(r.mcc, LEFT(u.roaming_mccmnc, 3), 'UNMAPPED') AS mcc FROM usage_log u LEFT JOIN roaming_destination r ON r.roaming_destination_id = u.roaming_destination_id")
def roaming_country(spark, sf_dir):  # type: ignore[no-untyped-def]
    return roaming_network(fx.usage_log(spark, sf_dir), fx.roaming_destinations(spark)).select("usage_log_id", "roaming_country", "mcc")


MB = lambda: {"total": count(), "mb": sum_of_rounded(col("usage_unit") / 1048576)}
SQL_MB = "COUNT(*) AS total, SUM((CAST(usage_unit AS BIGINT) * 100 + 524288) // 1048576) / 100.0 AS mb"
BY_RAT, SQL_BY_RAT = lambda: {"rat_type": col("rat_type"), "roaming_destination_id": col("roaming_destination_id")}, {"rat_type": "rat_type", "roaming_destination_id": "roaming_destination_id"}
simple("data_domestic_mb", lambda: DATA() & HOME(), BY_RAT, "rat_type IN ('4G','5G') AND roaming_destination_id = 87", SQL_BY_RAT, MB, SQL_MB)
simple("data_roaming_mb", lambda: DATA() & ROAMED(), BY_RAT, "rat_type IN ('4G','5G') AND roaming_destination_id <> 87", SQL_BY_RAT, MB, SQL_MB)

# Reconciliation with the partner network
BOTH_MINUTES = lambda: {"total": count(), "act_minutes": minutes_of_sum("act_usage_unit"), "minutes": minutes_of_sum("usage_unit")}
SQL_BOTH_MINUTES = f"COUNT(*) AS total, {SQL_ACT_MINUTES} AS act_minutes, {SQL_MINUTES} AS minutes"
NETWORK, SQL_NETWORK = c.network_type, "CASE WHEN rating_group = 'ONNET' THEN 'ONNET' WHEN rating_group = 'OFFNET' THEN 'OFFNET' ELSE 'OTHER' END"
DIRECTION, SQL_DIRECTION = c.event_direction, "CASE WHEN service_type_sub_cd = 'MO' THEN 'MO' WHEN service_type_sub_cd = 'MT' THEN 'MT' ELSE 'OTHER' END"
simple("recon_voice", lambda: VOICE() & (col("rating_group") == "OFFNET") & HOME(), lambda: {"network_type": NETWORK(), "event_direction": DIRECTION()}, "rat_type = 'VO' AND rating_group = 'OFFNET' AND roaming_destination_id = 87", {"network_type": SQL_NETWORK, "event_direction": SQL_DIRECTION}, BOTH_MINUTES, SQL_BOTH_MINUTES)
simple("recon_sms", lambda: SMS() & HOME(), lambda: {}, "rat_type = 'SM' AND roaming_destination_id = 87", {})
simple("recon_data", lambda: (col("rat_type") == "4G") & HOME(), lambda: {}, "rat_type = '4G' AND roaming_destination_id = 87", {}, MB, SQL_MB)
simple("recon_intl_voice", lambda: VOICE() & HOME() & FOREIGN(), lambda: {"event_direction": DIRECTION()}, "rat_type = 'VO' AND roaming_destination_id = 87 AND opposite_number NOT LIKE '60%'", {"event_direction": SQL_DIRECTION}, BOTH_MINUTES, SQL_BOTH_MINUTES)
simple("recon_intl_sms", lambda: SMS() & HOME() & FOREIGN(), lambda: {"event_direction": DIRECTION()}, "rat_type = 'SM' AND roaming_destination_id = 87 AND opposite_number NOT LIKE '60%'", {"event_direction": SQL_DIRECTION})
simple("recon_roaming_data", lambda: DATA() & ROAMED(), lambda: {}, "rat_type IN ('4G','5G') AND roaming_destination_id <> 87", {}, MB, SQL_MB)
simple("recon_roaming_voice_mo", lambda: VOICE() & ROAMED(), lambda: {}, "rat_type = 'VO' AND roaming_destination_id <> 87", {}, BOTH_MINUTES, SQL_BOTH_MINUTES)
simple("recon_roaming_voice_mt", lambda: VOICE() & MT() & ROAMED(), lambda: {}, "rat_type = 'VO' AND service_type_sub_cd = 'MT' AND roaming_destination_id <> 87", {}, BOTH_MINUTES, SQL_BOTH_MINUTES)
simple("recon_roaming_sms", lambda: SMS() & ROAMED(), lambda: {}, "rat_type = 'SM' AND roaming_destination_id <> 87", {})

# Subscriber and requirement reports
simple(
    "subscriber_usage", lambda: DATA() & BILLABLE(), lambda: {n: col(n) for n in ("msisdn", "roaming_mccmnc", "rat_type")},
    "rat_type IN ('4G','5G') AND act_usage_unit > 0", {n: n for n in ("msisdn", "roaming_mccmnc", "rat_type")},
)
simple(
    "settlement_buckets", lambda: VOICE() & MO(), lambda: {"roaming_status": c.roaming_status(), "destination_type": c.destination_type()},
    "rat_type = 'VO' AND service_type_sub_cd = 'MO'", {"roaming_status": SQL_ROAMING, "destination_type": "CASE WHEN opposite_number NOT LIKE '60%' THEN 'IDD' ELSE 'LOCAL' END"}, BOTH_MINUTES, SQL_BOTH_MINUTES,
)


@on_usage("facetime_refund_by_msisdn", f"SELECT msisdn, COUNT(*) AS total, CAST(ROUND(SUM(act_usage_unit * 3), 2) AS DOUBLE) AS act_cost, CAST(ROUND(SUM(usage_unit * 5), 2) AS DOUBLE) AS act_price, CAST(ROUND(SUM(act_usage_unit), 2) AS DOUBLE) AS act_units, CAST(ROUND(SUM(usage_unit), 2) AS DOUBLE) AS units FROM usage_log WHERE opposite_number LIKE '44%' AND act_usage_unit > 0 AND {IN_USAGE} GROUP BY 1")
def facetime_refund_by_msisdn(u: DataFrame) -> DataFrame:
    """Refunds for one called number (here: one range), by subscriber."""
    measures = {"total": count(), "act_cost": sum_rounded(col("act_usage_unit") * 3), "act_price": sum_rounded(col("usage_unit") * 5), "act_units": sum_rounded("act_usage_unit"), "units": sum_rounded("usage_unit")}
    return grouped(u, col("opposite_number").startswith("44") & BILLABLE() & WINDOW(), {"msisdn": col("msisdn")}, measures).orderBy(F.desc("total"))


@on_usage("facetime_refund_details", f"SELECT usage_log_id, msisdn, opposite_number, usage_start_time, CAST(act_usage_unit AS DOUBLE) AS act_units FROM usage_log WHERE opposite_number LIKE '44%' AND act_usage_unit > 0 AND {IN_USAGE}")
def facetime_refund_details(u: DataFrame) -> DataFrame:
    return u.where(col("opposite_number").startswith("44") & BILLABLE() & WINDOW()).select("usage_log_id", "msisdn", "opposite_number", "usage_start_time", col("act_usage_unit").cast("double").alias("act_units"))


# Details behind aggregates
@on_usage("detail_listing", f"SELECT usage_log_id, msisdn, opposite_number, roaming_mccmnc, usage_start_time, CAST(usage_unit AS DOUBLE) AS units FROM usage_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MO' AND roaming_destination_id <> 87 AND {IN_USAGE}")
def detail_listing(u: DataFrame) -> DataFrame:
    """Rows ordered by time: a range-partitioned sort, written in parallel."""
    rows = u.where(VOICE() & MO() & ROAMED() & WINDOW()).select("usage_log_id", "msisdn", "opposite_number", "roaming_mccmnc", "usage_start_time", col("usage_unit").cast("double").alias("units"))
    return rows.orderBy("usage_start_time", "usage_log_id")


SMS_DETAIL_SQL = country_sql("u.rat_type = 'SM'", "").split("SELECT COALESCE")[0] + "SELECT usage_log_id, msisdn, usage_start_time, COALESCE(country, 'UNMAPPED') AS destination_country FROM ranked WHERE rn = 1"


@query("sms_country_details", SMS_DETAIL_SQL)
def sms_country_details(spark, sf_dir):  # type: ignore[no-untyped-def]
    rows = country_by_prefix(fx.usage_log(spark, sf_dir).where(SMS() & WINDOW()), fx.country_codes(spark))
    return rows.select("usage_log_id", "msisdn", "usage_start_time", "destination_country").orderBy("usage_start_time", "usage_log_id")


@on_usage("sample_rows", "SELECT usage_log_id, msisdn, opposite_number FROM usage_log WHERE rat_type = 'VO' AND roaming_destination_id <> 87 AND opposite_number LIKE '60%' ORDER BY usage_log_id LIMIT 20")
def sample_rows(u: DataFrame) -> DataFrame:
    return u.where(VOICE() & ROAMED() & LOCAL()).select("usage_log_id", "msisdn", "opposite_number").orderBy("usage_log_id").limit(20)


@on_request("session_lookup", "SELECT request_log_id, session_id, session_req_num, req_time, rat_type FROM request_log WHERE session_id = 's7'")
def session_lookup(q: DataFrame) -> DataFrame:
    """All requests of one session in the order of time."""
    return q.where(col("session_id") == "s7").select("request_log_id", "session_id", "session_req_num", "req_time", "rat_type").orderBy("req_time", "session_req_num")


@on_usage("prefix_lookup", "SELECT usage_log_id, opposite_number FROM usage_log WHERE rat_type = 'VO' AND opposite_number LIKE '1246%'")
def prefix_lookup(u: DataFrame) -> DataFrame:
    return u.where(VOICE() & col("opposite_number").startswith("1246")).select("usage_log_id", "opposite_number").orderBy("usage_log_id")


@on_request("session_lookup_clustered", "SELECT request_log_id, session_id, session_req_num, req_time, rat_type FROM request_log WHERE session_id = 's7'")
def session_lookup_clustered(q: DataFrame) -> DataFrame:
    """The same from a table clustered by session, of which few row groups are read."""
    path = scratch(q.sparkSession, "requests-by-session")
    rows = q.select("request_log_id", "session_id", "session_req_num", "req_time", "rat_type")
    clustered.write_clustered(rows, path, "session_id", 1_000_000, "req_time")
    return clustered.with_key(q.sparkSession, path, "session_id", "s7").orderBy("req_time", "session_req_num")


@on_usage("prefix_lookup_clustered", "SELECT usage_log_id, opposite_number FROM usage_log WHERE rat_type = 'VO' AND opposite_number LIKE '1246%'")
def prefix_lookup_clustered(u: DataFrame) -> DataFrame:
    path = scratch(u.sparkSession, "usage-by-number")
    clustered.write_clustered(u.where(VOICE()).select("usage_log_id", "opposite_number"), path, "opposite_number", 1_000_000, "usage_log_id")
    return clustered.with_prefix(u.sparkSession, path, "opposite_number", "1246").orderBy("usage_log_id")


@on_usage("params_cross", f"SELECT DATE '2024-01-05' AS report_start_date, DATE '2024-01-18' AS report_end_date, rat_type, COUNT(*) AS n FROM usage_log WHERE {IN_USAGE} GROUP BY rat_type")
def params_cross(u: DataFrame) -> DataFrame:
    return dated(value_counts(u, "rat_type", where=WINDOW()))


@on_usage("date_between_inclusive", "SELECT COUNT(*) AS n FROM usage_log WHERE CAST(usage_start_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-18'")
def date_between_inclusive(u: DataFrame) -> DataFrame:
    """DATE(ts) BETWEEN two days, as a range on the column that reaches the scan."""
    return u.where(WINDOW()).agg(F.count("*").alias("n"))


@on_usage("parse_report_date", "SELECT COUNT(*) AS n FROM usage_log WHERE usage_start_time >= TIMESTAMP '2024-01-04 00:00:00' AND usage_start_time < TIMESTAMP '2024-01-19 00:00:00'")
def parsed_report_dates(u: DataFrame) -> DataFrame:
    """Bounds with an offset and with Z: the first day falls back to the UTC date."""
    start, stop = report_bounds("2024-01-05T02:00:00+08:00", "2024-01-18T23:00:00Z")
    return u.where((col("usage_start_time") >= F.lit(start).cast("timestamp_ntz")) & (col("usage_start_time") < F.lit(stop).cast("timestamp_ntz"))).agg(F.count("*").alias("n"))


# Data quality
@on_usage("direction_distribution", "SELECT service_type_sub_cd, COUNT(*) AS n FROM usage_log WHERE rat_type = 'VO' GROUP BY 1")
def direction_distribution(u: DataFrame) -> DataFrame:
    return value_counts(u, "service_type_sub_cd", where=VOICE())


@on_usage("mt_billable_count", "SELECT COUNT(*) AS n FROM usage_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MT' AND act_usage_unit > 0")
def mt_billable_count(u: DataFrame) -> DataFrame:
    return u.where(VOICE() & MT() & BILLABLE()).agg(F.count("*").alias("n"))


@on_usage("mt_full_filter_count", f"SELECT COUNT(*) AS n FROM usage_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MT' AND rating_group IN ('ONNET','OFFNET') AND act_usage_unit > 0 AND {IN_USAGE}")
def mt_full_filter_count(u: DataFrame) -> DataFrame:
    return u.where(VOICE() & MT() & col("rating_group").isin("ONNET", "OFFNET") & BILLABLE() & WINDOW()).agg(F.count("*").alias("n"))


@on_usage("mt_usage", f"SELECT {SQL_UNITS} FROM usage_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MT'")
def mt_usage(u: DataFrame) -> DataFrame:
    return grouped(u, VOICE() & MT(), {}, BOTH_UNITS())


@on_usage("mt_rating_groups", "SELECT rating_group, COUNT(*) AS n FROM usage_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MT' GROUP BY 1")
def mt_rating_groups(u: DataFrame) -> DataFrame:
    return value_counts(u, "rating_group", where=VOICE() & MT())


@on_usage("roaming_to_home", f"SELECT service_type_sub_cd, {SQL_UNITS} FROM usage_log WHERE rat_type = 'VO' AND roaming_destination_id <> 87 AND opposite_number LIKE '60%' GROUP BY 1")
def roaming_to_home(u: DataFrame) -> DataFrame:
    return grouped(u, VOICE() & ROAMED() & LOCAL(), {"service_type_sub_cd": col("service_type_sub_cd")}, BOTH_UNITS())


@on_usage("voice_by_destination_id", "SELECT roaming_destination_id, COUNT(*) AS n FROM usage_log WHERE rat_type = 'VO' GROUP BY 1")
def voice_by_destination_id(u: DataFrame) -> DataFrame:
    return value_counts(u, "roaming_destination_id", where=VOICE()).orderBy(F.desc("n"))


@on_usage("max_usage_time", "SELECT MAX(usage_start_time) AS max_usage_time FROM usage_log")
def max_usage_time(u: DataFrame) -> DataFrame:
    return u.agg(F.max("usage_start_time").alias("max_usage_time"))


def _counts(name: str, columns: list[str], total: str | None = None) -> None:
    keys = ", ".join(columns)
    sums = f", CAST(ROUND(SUM({total}), 2) AS DOUBLE) AS total" if total else ""

    @on_usage(name, f"SELECT {keys}, COUNT(*) AS n{sums} FROM usage_log GROUP BY {keys}")
    def run(u: DataFrame) -> DataFrame:
        return value_counts(u, *columns, total=total)


_counts("value_counts_mccmnc", ["roaming_mccmnc"])
_counts("value_counts_destination", ["roaming_destination_id"], "usage_unit")
_counts("value_counts_rating_group", ["rating_group"])
_counts("value_counts_direction", ["service_type_sub_cd"])
_counts("value_counts_mccmnc_destination", ["roaming_mccmnc", "roaming_destination_id"])


def _distinct(column: str) -> None:
    @on_usage(f"distinct_values_{column}", f"SELECT DISTINCT {column} FROM usage_log")
    def run(u: DataFrame) -> DataFrame:
        return u.select(column).distinct()


for _column in ("rat_type", "rating_group", "roaming_destination_id", "service_type_sub_cd", "roaming_mccmnc"):
    _distinct(_column)


@on_usage("custom_order", f"SELECT {SQL_NETWORK} AS network_type, COUNT(*) AS n FROM usage_log WHERE rat_type = 'VO' GROUP BY 1")
def custom_order(u: DataFrame) -> DataFrame:
    out = grouped(u, VOICE(), {"network_type": NETWORK()}, {"n": count()})
    return out.orderBy(F.when(col("network_type") == "ONNET", 1).when(col("network_type") == "OFFNET", 2).otherwise(3))


@on_usage("ordered_report", f"SELECT {SQL_ROAMING} AS roaming_status, rat_type, COUNT(*) AS total FROM usage_log GROUP BY 1, 2")
def ordered_report(u: DataFrame) -> DataFrame:
    return grouped(u, None, {"roaming_status": c.roaming_status(), "rat_type": col("rat_type")}, {"total": count()}).orderBy("roaming_status", F.desc("total"), "rat_type")

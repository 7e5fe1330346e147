"""One query for each classification column and predicate of the usage log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify as c
from ..sources import fixtures as fx
from .catalogue import on_smsc, on_usage

HOME = "roaming_destination_id = 87"
#: name: (column, SQL expression), over all usage records.
COLUMNS: dict[str, tuple[Callable[[], Column], str]] = {
    "roaming_status": (c.roaming_status, f"CASE WHEN {HOME} THEN 'NON_ROAMING' ELSE 'ROAMING' END"),
    "roaming_status_doc": (c.roaming_status_doc, f"CASE WHEN roaming_destination_id IS NULL THEN NULL WHEN {HOME} THEN 'NON_ROAMING' ELSE 'ROAMING' END"),
    "location_type": (c.location_type, f"CASE WHEN {HOME} THEN 'DOMESTIC' ELSE 'ROAMING' END"),
    "charging_type": (c.charging_type, "CASE WHEN rating_group = 'ONNET' THEN 'ONNET' ELSE 'OTHER' END"),
    "network_type": (c.network_type, "CASE WHEN rating_group = 'ONNET' THEN 'ONNET' WHEN rating_group = 'OFFNET' THEN 'OFFNET' ELSE 'OTHER' END"),
    "event_direction": (c.event_direction, "CASE WHEN service_type_sub_cd = 'MO' THEN 'MO' WHEN service_type_sub_cd = 'MT' THEN 'MT' ELSE 'OTHER' END"),
    "origin_type": (c.origin_type, "CASE WHEN roaming_mccmnc LIKE '60%' THEN 'MY_ORIGIN' ELSE 'NON_MY_ORIGIN' END"),
    "destination_type": (c.destination_type, "CASE WHEN opposite_number NOT LIKE '60%' THEN 'IDD' ELSE 'LOCAL' END"),
    "opposite_number_group": (c.opposite_number_group, "CASE WHEN opposite_number LIKE '60%' THEN 'MY_NUMBERS' ELSE 'NON_MY_NUMBERS' END"),
    "opposite_number_type": (c.opposite_number_type, "CASE WHEN opposite_number IS NULL OR opposite_number = '' THEN NULL WHEN opposite_number LIKE '60%' THEN 'MY' ELSE 'NON_MY' END"),
    "service_type": (c.service_type, "CASE WHEN rat_type = 'VO' OR service_type_sub_cd IN ('MO','MT') THEN 'VOICE' WHEN rat_type = 'SM' OR rating_group = 'SM' THEN 'SMS' WHEN rat_type IN ('4G','5G') THEN 'DATA' ELSE 'UNKNOWN' END"),
    "is_billable": (c.is_billable, "COALESCE(act_usage_unit, 0) > 0"),
    "visited_mcc": (c.visited_mcc, "LEFT(roaming_mccmnc, 3)"),
}
#: name: (condition, SQL condition); the query returns the ids that hold.
PREDICATES: dict[str, tuple[Callable[[], Column], str]] = {
    "report_window": (lambda: c.report_window("usage_start_time", "2024-01-05", "2024-01-18"), "usage_start_time >= TIMESTAMP '2024-01-05 00:00:00' AND usage_start_time < TIMESTAMP '2024-01-19 00:00:00'"),
    "billable_only": (lambda: F.col("act_usage_unit") > 0, "act_usage_unit > 0"),
    "number_not_local": (c.number_not_local, "opposite_number NOT LIKE '60%'"),
    "number_not_local_doc": (lambda: c.number_not_local(keep_unknown=True), "COALESCE(opposite_number NOT LIKE '60%', TRUE)"),
    "not_home": (c.not_home, "roaming_destination_id <> 87"),
    "not_home_doc": (lambda: c.not_home(keep_unknown=True), "roaming_destination_id IS DISTINCT FROM 87"),
    "premium_numbers": (c.premium_number, "opposite_number IN ('600380008000','60103','60100','6015454','6015300','6015353','6015404','6015444','6015777') OR ((opposite_number LIKE '601300%' OR opposite_number LIKE '601700%' OR opposite_number LIKE '601800%') AND LENGTH(opposite_number) < 12)"),
    "number_length": (lambda: F.length("opposite_number") > 10, "LENGTH(opposite_number) > 10"),
}


def _column_query(name: str, column: Callable[[], Column]) -> None:
    @on_usage(name, f"SELECT usage_log_id, {COLUMNS[name][1]} AS {name} FROM usage_log")
    def run(u: DataFrame) -> DataFrame:
        return u.select("usage_log_id", column().alias(name))


def _predicate_query(name: str, condition: Callable[[], Column]) -> None:
    @on_usage(name, f"SELECT usage_log_id FROM usage_log WHERE {PREDICATES[name][1]}")
    def run(u: DataFrame) -> DataFrame:
        return u.where(condition()).select("usage_log_id")


for _name, (_column, _) in COLUMNS.items():
    _column_query(_name, _column)
for _name, (_condition, _) in PREDICATES.items():
    _predicate_query(_name, _condition)


@on_usage("mt_call_type", "SELECT usage_log_id, usage_start_time, CASE WHEN roaming_destination_id = 0 THEN 'CS' WHEN roaming_destination_id = 87 THEN 'Domestic' ELSE 'S8HR' END AS mt_call_type FROM usage_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MT'")
def mt_calls(u: DataFrame) -> DataFrame:
    return u.where("rat_type = 'VO' and service_type_sub_cd = 'MT'").select("usage_log_id", "usage_start_time", c.mt_call_type().alias("mt_call_type"))


@on_usage("usage_document", f"SELECT usage_log_id, {COLUMNS['service_type'][1]} AS service_type, {COLUMNS['roaming_status_doc'][1]} AS roaming_status, {COLUMNS['opposite_number_type'][1]} AS opposite_number_type, {COLUMNS['is_billable'][1]} AS is_billable, rat_type AS rat_family, 'usage_log' AS source_table FROM usage_log")
def usage_document_fields(u: DataFrame) -> DataFrame:
    return usage_document(u, "usage_log").select("usage_log_id", "derived.*", "sync_metadata.source_table")


def usage_document(u: DataFrame, source: str) -> DataFrame:
    """The record with derived{...} and sync_metadata{...}."""
    return u.withColumn("derived", c.derived_usage()).withColumn(
        "sync_metadata", F.struct(F.lit(source).alias("source_table"), F.current_timestamp().alias("synced_at"))
    )


def request_document(q: DataFrame, source: str) -> DataFrame:
    return q.withColumn("sync_metadata", F.struct(F.lit(source).alias("source_table"), F.current_timestamp().alias("synced_at")))


def usage_document_slim(u: DataFrame) -> DataFrame:
    """The short document form; units are doubles, null counts as 0."""
    has = set(u.columns)
    iccid = F.col("iccid") if "iccid" in has else F.lit(None).cast("string")
    return u.select(
        "usage_log_id",
        "sim_id",
        "customer_id",
        F.struct(iccid.alias("iccid"), "msisdn").alias("identifiers"),
        F.struct(c.slim_service().alias("type"), F.col("service_type_sub_cd").alias("direction"), c.slim_rat().alias("rat")).alias("service"),
        F.struct(c.slim_geo().alias("type"), F.col("roaming_mccmnc").alias("mccmnc")).alias("geography"),
        F.struct(
            F.coalesce(F.col("usage_unit").cast("double"), F.lit(0.0)).alias("unit"),
            F.coalesce(F.col("act_usage_unit").cast("double"), F.lit(0.0)).alias("actual_unit"),
            F.col("usage_start_time").alias("timestamp"),
        ).alias("usage"),
    )


@on_usage(
    "usage_document_slim",
    "SELECT usage_log_id, msisdn, CASE WHEN service_type_sub_cd IN ('MO','MT') THEN 'VOICE' WHEN rating_group IN ('SMS','SM') THEN 'SMS' ELSE 'DATA' END AS service,"
    " CASE WHEN rat_type LIKE '%5G%' THEN '5G' WHEN rat_type LIKE '%4G%' OR rat_type LIKE '%LTE%' THEN '4G' ELSE rat_type END AS rat,"
    " CASE WHEN COALESCE(roaming_mccmnc, '') = '' OR roaming_mccmnc LIKE '92%' THEN 'LOCAL' ELSE 'ROAMING' END AS geo,"
    " CAST(COALESCE(usage_unit, 0) AS DOUBLE) AS unit, CAST(COALESCE(act_usage_unit, 0) AS DOUBLE) AS actual_unit FROM usage_log",
)
def slim_fields(u: DataFrame) -> DataFrame:
    return usage_document_slim(u).select(
        "usage_log_id", "identifiers.msisdn", F.col("service.type").alias("service"), "service.rat", F.col("geography.type").alias("geo"), "usage.unit", "usage.actual_unit"
    )


@on_smsc("sender_group", "SELECT line_number, CASE WHEN addr_src_digits LIKE '60%' THEN '60xxxx' ELSE addr_src_digits END AS sender_group FROM smsc")
def sender_groups(s: DataFrame) -> DataFrame:
    return s.select("line_number", c.sender_group().alias("sender_group"))


@on_smsc("a2p_senders", "SELECT line_number FROM smsc WHERE message_type = 'message' AND addr_src_digits IN ('22200','22200Brand','60119990001') AND message_delivery_status IN ('success','success_esme')")
def a2p_lines(s: DataFrame) -> DataFrame:
    return s.where(c.a2p_message(fx.A2P_SENDERS)).select("line_number")


@on_smsc("recipient_is_sender", "SELECT COUNT(*) FILTER (addr_src_digits <> addr_dst_digits) AS different, COUNT(*) FILTER (addr_src_digits = addr_dst_digits) AS same FROM smsc")
def recipient_is_sender(s: DataFrame) -> DataFrame:
    return s.agg(
        F.count_if(F.col("addr_src_digits") != F.col("addr_dst_digits")).alias("different"),
        F.count_if(F.col("addr_src_digits") == F.col("addr_dst_digits")).alias("same"),
    )


CALL_SQL = """SELECT msisdn, imsi, roaming_mccmnc AS plmn, service_type_sub_cd AS direction, opposite_number AS b_party,
 CASE WHEN rating_group = 'ONNET' THEN 'On-net' WHEN opposite_number NOT LIKE '60%' THEN 'IDD' ELSE 'Off-net' END AS destination_type,
 CASE WHEN roaming_destination_id NOT IN (87, 0) AND roaming_mccmnc NOT LIKE '60%' THEN 'Y' ELSE 'N' END AS is_s8hr,
 usage_start_time AS start_time, usage_end_time AS end_time, CAST(act_usage_unit AS DOUBLE) AS actual_seconds, CAST(usage_unit AS DOUBLE) AS charged_seconds,
 CASE WHEN sim_service_plan_id IS NULL THEN 'Y' ELSE 'N' END AS is_payg, CAST(price_amount AS DOUBLE) AS amount,
 sim_service_plan_id AS service_plan_id, CASE WHEN sim_service_plan_id IS NOT NULL THEN last_grant_sim_service_plan_bucket_id END AS bucket_id
FROM usage_log WHERE rat_type = 'VO'"""


@on_usage("call_cdr_view", CALL_SQL)
def call_cdr_view(u: DataFrame) -> DataFrame:
    """Per-call report.  A call abroad that is no circuit-switched one counts as S8HR;
    one without a service plan was charged in money, and names no plan and no bucket."""
    number = F.when(c.charging_type() == "ONNET", "On-net").when(c.number_not_local(), "IDD").otherwise("Off-net")
    s8hr = ~F.col("roaming_destination_id").isin(c.HOME_DESTINATION, 0) & ~c.starts_home("roaming_mccmnc")
    planned = F.col("sim_service_plan_id").isNotNull()
    return u.where("rat_type = 'VO'").select(
        "msisdn",
        "imsi",
        F.col("roaming_mccmnc").alias("plmn"),
        F.col("service_type_sub_cd").alias("direction"),
        F.col("opposite_number").alias("b_party"),
        number.alias("destination_type"),
        F.when(s8hr, "Y").otherwise("N").alias("is_s8hr"),
        F.col("usage_start_time").alias("start_time"),
        F.col("usage_end_time").alias("end_time"),
        F.col("act_usage_unit").cast("double").alias("actual_seconds"),
        F.col("usage_unit").cast("double").alias("charged_seconds"),
        F.when(planned, "N").otherwise("Y").alias("is_payg"),
        F.col("price_amount").cast("double").alias("amount"),
        F.col("sim_service_plan_id").alias("service_plan_id"),
        F.when(planned, F.col("last_grant_sim_service_plan_bucket_id")).alias("bucket_id"),
    )

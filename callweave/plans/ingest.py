"""Sources, loads and streams as queries over files derived from the tables."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import camel, classify as c
from ..operators import dated, settlement as st, template as tp, upsert
from ..sources import delimited, fixtures as fx, smsc
from ..sources.scratch import scratch
from ..streaming import increments
from ..streaming.consumption import consumed, consumption, run_consumption
from ..streaming.sync import sync
from .catalogue import IN_USAGE, REQUEST_CTE, USAGE_CTE, on_request, on_smsc, on_usage, query
from .classification import request_document, usage_document
from .settlement import REPORT_SQL


def as_cells(df: DataFrame, layout: list[tuple[str, str]], given: dict[str, Column]) -> DataFrame:
    """A row of text cells for each row: ``given`` columns, NULL elsewhere."""
    return df.select(*[F.coalesce(given[n].cast("string"), F.lit("NULL")).alias(n) if n in given else F.lit("NULL").alias(n) for n, _ in layout])


def csv_file(df: DataFrame, label: str, sep: str = ",", plain: bool = False) -> str:
    """``plain``: no cell needs quotes, so that the same file can be written as one wide column of joined cells."""
    path = scratch(df.sparkSession, label)
    if plain:
        lines = df.select(F.concat_ws(sep, *df.columns).alias(sep.join(df.columns)))
        lines.write.option("header", True).option("sep", "\1").option("quote", "").csv(path)
        return path
    df.write.option("header", True).option("sep", sep).option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return path


def usage_cells(u: DataFrame, spoil: bool = False) -> DataFrame:
    unit = F.col("usage_unit").cast("string")
    given = {n: F.col(n) for n in ("usage_log_id", "sim_id", "customer_id", "msisdn", "service_type_sub_cd", "roaming_mccmnc", "rat_type", "opposite_number", "roaming_destination_id", "act_usage_unit", "rating_group")}
    given["usage_start_time"] = F.date_format("usage_start_time", "yyyy-MM-dd HH:mm:ss")
    given["usage_unit"] = F.when(F.col("usage_log_id") % 50 == 3, "many").otherwise(unit) if spoil else unit
    given["last_grant_shared_bucket_type_ids"] = F.lit("1,2")
    return as_cells(u, schemas.USAGE_LOG, given)


@on_usage("read_usage_csv", "SELECT usage_log_id, msisdn, rat_type, date_trunc('second', usage_start_time) AS usage_start_time, CAST(usage_unit AS DOUBLE) AS usage_unit, '1,2' AS bucket_types FROM usage_log")
def read_usage_csv(u: DataFrame) -> DataFrame:
    good, _ = delimited.read_usage_csv(u.sparkSession, csv_file(usage_cells(u), "usage-csv"))
    return good.select("usage_log_id", "msisdn", "rat_type", "usage_start_time", F.col("usage_unit").cast("double").alias("usage_unit"), F.col("last_grant_shared_bucket_type_ids").alias("bucket_types"))


@on_usage(
    "quarantine_bad_rows",
    "SELECT 'usage_log' AS table_name, source_file, row_number, row_identifier, column_name, bad_value, error_message FROM"
    " (SELECT usage_log_id, CAST(usage_log_id % 4 AS VARCHAR) AS source_file, ROW_NUMBER() OVER (PARTITION BY usage_log_id % 4 ORDER BY usage_log_id) AS row_number, CAST(usage_log_id AS VARCHAR) AS row_identifier,"
    " 'usage_unit' AS column_name, 'many' AS bad_value, 'not a decimal(32,16)' AS error_message FROM usage_log) WHERE usage_log_id % 50 = 3",
)
def quarantine_bad_rows(u: DataFrame) -> DataFrame:
    """Bad cells in four files, whose rows are in the order of ids and have notes of several lines."""
    cells = usage_cells(u, spoil=True).withColumn("notes", F.when(F.col("usage_log_id").cast("long") % 3 == 0, 'two\nlines, "quoted"').otherwise("NULL"))
    number = F.col("usage_log_id").cast("long")
    files = cells.withColumn("file", number % 4).repartition(4, "file").sortWithinPartitions("file", number)
    path = scratch(u.sparkSession, "usage-csv")
    files.write.partitionBy("file").option("header", True).option("escape", '"').csv(path)
    _, bad = delimited.read_usage_csv(u.sparkSession, path)
    return bad.withColumn("source_file", F.regexp_extract("source_path", "file=([0-9]+)", 1)).drop("source_path")


@on_request("read_request_csv", "SELECT request_log_id, session_id, rating_group, CAST(act_update_used_volume AS DOUBLE) AS volume, req_time FROM request_log")
def read_request_csv(q: DataFrame) -> DataFrame:
    names = ("request_log_id", "session_id", "session_req_num", "msisdn", "rat_type", "rating_group", "service_type_sub_cd", "roaming_destination_id", "opposite_number", "update_used_volume", "act_update_used_volume")
    given = {n: F.col(n) for n in names} | {"req_time": F.date_format("req_time", "yyyy-MM-dd HH:mm:ss")}
    good, _ = delimited.read_request_csv(q.sparkSession, csv_file(as_cells(q, schemas.REQUEST_LOG, given), "request-csv", plain=True))
    return good.select("request_log_id", "session_id", "rating_group", F.col("act_update_used_volume").cast("double").alias("volume"), "req_time")


@query("read_service_plan_csv", "SELECT c_custkey AS sim_service_plan_id, CAST(c_nationkey AS BIGINT) AS customer_id, c_mktsegment AS service_plan_code FROM customer")
def read_service_plan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    given = {"sim_service_plan_id": F.col("c_custkey"), "customer_id": F.col("c_nationkey"), "service_plan_code": F.col("c_mktsegment"), "balance": F.lit("1.5")}
    good, _ = delimited.read_service_plan_csv(spark, csv_file(as_cells(customers, schemas.SERVICE_PLAN, given), "plan-csv"))
    return good.select("sim_service_plan_id", "customer_id", "service_plan_code")


@query("read_country_codes", "SELECT n_name AS country, CAST(n_nationkey + 20 AS VARCHAR) AS country_code FROM nation")
def read_country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.concat(F.lit(" "), "n_name").alias("Country"), (F.col("n_nationkey") + 20).cast("string").alias("Country code"))
    return delimited.read_country_codes(spark, csv_file(nations, "codes-csv"))


@query("read_roaming_destinations", "SELECT s_suppkey AS roaming_destination_id, s_name AS roaming_destination_name, CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE TIMESTAMP '2024-02-03 04:05:00' END AS created_at FROM supplier")
def read_roaming_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        key.cast("string").alias("roamingDestinationId"), F.lit("p").alias("serviceProvider"), F.lit("c").alias("country"), F.col("s_name").alias("roaming Destination Name"),
        F.lit("502").alias("mcc"), F.lit(" ").alias("remarks"), F.when(key % 3 == 0, "N/A").when(key % 3 == 1, "03/02/2024 04:05").otherwise("2024-02-03 04:05:00").alias("Created at"), F.lit("").alias("Updated at"),
    )
    return delimited.read_roaming_destinations(spark, csv_file(rows, "roaming-tsv", "\t")).select("roaming_destination_id", "roaming_destination_name", "created_at")


# SMS-centre files
def raw_lines(s: DataFrame, layout: list[str] = schemas.SMSC_FIELDS, surplus: bool = False) -> DataFrame:
    """Log lines whose payload holds the fields of ``s``, the text quoted."""
    at = F.concat("day", F.lit(" 10:00:00"))
    given = {
        "delivery_date": at, "submit_date": at, "addr_src_digits": F.col("addr_src_digits"), "addr_src_ton": F.lit("1"), "addr_src_npi": F.lit("1"), "addr_dst_digits": F.col("addr_dst_digits"),
        "addr_dst_ton": F.lit("1"), "addr_dst_npi": F.lit("1"), "message_delivery_status": F.coalesce("message_delivery_status", F.lit("null")), "origination_type": F.lit("SMPP"),
        "message_type": F.col("message_type"), "sms_text": F.concat(F.lit('"'), "sms_text", F.lit('"')),
    }
    payload = F.concat_ws(",", *[given.get(f, F.lit("")) for f in layout], *([F.lit("extra1"), F.lit("extra2")] if surplus else []))
    line = F.when(F.col("bad_prefix"), F.lit("no prefix here")).otherwise(F.concat(F.lit("INFO [cdr] "), payload))
    return s.select("source_path", "line_number", line.alias("raw_line"))


PARSED = "source_path, line_number, addr_src_digits, addr_dst_digits, message_delivery_status, message_type, sms_text"


@on_smsc("smsc_parse_lines", f"SELECT {PARSED}, 2 AS surplus FROM smsc WHERE NOT bad_prefix")
def smsc_parse_lines(s: DataFrame) -> DataFrame:
    parsed = smsc.parse_lines(raw_lines(s, surplus=True)).where("error is null")
    return parsed.select(*PARSED.split(", "), F.size("extra_fields").alias("surplus"))


@on_smsc("smsc_layout_30", f"SELECT {PARSED} FROM smsc WHERE NOT bad_prefix")
def smsc_layout_30(s: DataFrame) -> DataFrame:
    return smsc.parse_lines(raw_lines(s, schemas.SMSC_FIELDS_30), schemas.SMSC_FIELDS_30, exact_null=True).where("error is null").select(*PARSED.split(", "))


@on_smsc("smsc_parse_min_fields", "SELECT line_number, CASE WHEN bad_prefix THEN 'INVALID_PREFIX' WHEN line_number % 7 = 0 THEN 'CSV_ERROR' END AS error FROM smsc")
def smsc_parse_min_fields(s: DataFrame) -> DataFrame:
    lines = raw_lines(s)
    cut = F.when((F.col("line_number") % 7 == 0) & F.col("raw_line").startswith("INFO"), "INFO [cdr] a,b,c").otherwise(F.col("raw_line"))
    return smsc.parse_lines(lines.withColumn("raw_line", cut), least_fields=10).select("line_number", "error")


@on_smsc("smsc_file_stats", "SELECT source_path, COUNT(*) AS total, COUNT(*) FILTER (NOT bad_prefix) AS loaded, COUNT(*) FILTER (bad_prefix) AS invalid_prefix, CAST(0 AS BIGINT) AS parse_errors FROM smsc GROUP BY 1")
def smsc_file_stats(s: DataFrame) -> DataFrame:
    return smsc.file_stats(smsc.parse_lines(raw_lines(s)))


def listing(s: DataFrame) -> DataFrame:
    """A directory listing: one file a day, and some that are no logs."""
    path = F.concat(F.lit("/logs/"), "day", F.lit("/"), F.when(F.substring("day", 9, 2) == "13", F.concat("source_path", F.lit(".gz"))).otherwise(F.col("source_path")))
    return s.groupBy(path.alias("path")).agg(F.count("*").alias("length"), F.max(F.col("day").cast("timestamp_ntz")).alias("modification_time"))


LOGS = "SELECT concat('/logs/', day, '/', source_path) AS path, COUNT(*) AS length FROM smsc WHERE substr(day, 9, 2) <> '13' AND day < '1997-01-01' GROUP BY 1"


@on_smsc("smsc_discover_files", LOGS)
def smsc_discover_files(s: DataFrame) -> DataFrame:
    return smsc.discover(listing(s), F.lit("1997-01-01").cast("date")).select("path", "length")


@on_smsc("smsc_skip_processed", f"SELECT * FROM ({LOGS}) WHERE substr(path, 7, 4) <> '1995' OR length % 2 = 0")
def smsc_skip_processed(s: DataFrame) -> DataFrame:
    files = smsc.discover(listing(s), F.lit("1997-01-01").cast("date"))
    manifest = files.where(F.year("file_date") == 1995).withColumn("length", F.when(F.col("length") % 2 == 0, F.col("length") + 1).otherwise(F.col("length")))
    return smsc.skip_processed(files, manifest).select("path", "length")


@on_smsc("manifest_anti", f"SELECT * FROM ({LOGS}) WHERE substr(path, 7, 4) <> '1996'")
def manifest_anti(s: DataFrame) -> DataFrame:
    files = smsc.discover(listing(s), F.lit("1997-01-01").cast("date"))
    return smsc.skip_processed(files, files.where(F.year("file_date") == 1996)).select("path", "length")


# Loads
@on_smsc(
    "upsert_last_wins",
    "SELECT source_path, message_type, MAX(line_number) AS line_number, CASE WHEN substr(source_path, 17, 1) = '1' THEN concat('again ', arg_max(sms_text, line_number)) ELSE arg_max(sms_text, line_number) END AS sms_text FROM smsc GROUP BY source_path, message_type",
)
def upsert_last_wins(s: DataFrame) -> DataFrame:
    """Keys with several rows in one file, of which the last line stays, and files that are loaded again."""
    rows = s.select("source_path", "message_type", "line_number", "sms_text")
    again = rows.where(F.substring("source_path", 17, 1) == "1")
    second = again.withColumn("sms_text", F.concat(F.lit("again "), "sms_text"))
    return upsert.last_wins(rows, [again.withColumn("sms_text", F.lit("first")), second], ["source_path", "message_type"], "line_number")


REQUEST_KEYS = [["request_log_id"], ["session_id", "session_req_num", "rating_group"]]
INSERTED = "SELECT request_log_id FROM request_log QUALIFY ROW_NUMBER() OVER (PARTITION BY session_id, session_req_num, rating_group ORDER BY request_log_id) = 1"


@on_request("insert_first_wins", INSERTED)
def insert_first_wins(q: DataFrame) -> DataFrame:
    return upsert.first_wins(None, q.select("request_log_id", *REQUEST_KEYS[1]), REQUEST_KEYS, "request_log_id").select("request_log_id")


@on_request("target_anti", f"SELECT request_log_id FROM ({INSERTED}) WHERE request_log_id % 3 <> 0")
def target_anti(q: DataFrame) -> DataFrame:
    """Loading again a file of which a third was loaded before."""
    rows = upsert.handed_over(upsert.first_wins(None, q.select("request_log_id", *REQUEST_KEYS[1]), REQUEST_KEYS, "request_log_id"), "loaded")
    return upsert.first_wins(rows.where("request_log_id % 3 = 0"), rows, REQUEST_KEYS, "request_log_id").select("request_log_id")


@on_request("load_audit", f"SELECT COUNT(*) AS valid, (SELECT COUNT(*) FROM ({INSERTED})) AS inserted, COUNT(*) - (SELECT COUNT(*) FROM ({INSERTED})) AS skipped FROM request_log")
def load_audit(q: DataFrame) -> DataFrame:
    counts: dict[str, int] = {}
    upsert.first_wins(None, q.select("request_log_id", *REQUEST_KEYS[1]), REQUEST_KEYS, "request_log_id", audit=counts)
    return q.sparkSession.createDataFrame([(counts["valid"], counts["inserted"], counts["skipped"])], "valid long, inserted long, skipped long")


@on_usage(
    "incremental_by_id",
    "SELECT run, COUNT(*) AS n, MAX(usage_log_id) AS checkpoint FROM (SELECT usage_log_id, CASE WHEN usage_log_id <= 400 THEN 1 WHEN usage_log_id <= 700 THEN 2 ELSE 3 END AS run FROM usage_log) GROUP BY run"
    " UNION ALL SELECT 4, 0, MAX(usage_log_id) FROM usage_log",
)
def incremental_by_id(u: DataFrame) -> DataFrame:
    """Four runs, each from the checkpoint that the one before has committed: over the first
    400 ids, the first 700, the whole log, and once more with nothing new.  The second is
    first run without its commit, as if it had been killed, and done again."""
    spark, sink, state = u.sparkSession, scratch(u.sparkSession, "increments"), scratch(u.sparkSession, "increment-state")
    rows, runs = u.select("usage_log_id", "rat_type"), []
    for run, seen in enumerate([rows.where("usage_log_id <= 400"), rows.where("usage_log_id <= 700"), rows, rows], 1):
        source = increments.frame_source(seen, "usage_log_id")
        if run == 2:
            increments.load_increment(spark, source, sink, state, commit=False)
        runs.append((run, *increments.load_increment(spark, source, sink, state)[1:]))
    done = spark.createDataFrame(runs, "run int, at_load long, checkpoint long")
    # The counts are taken from the copy itself, by the bounds that were committed.
    bounds = increments.checkpoints(spark, state).select((F.col("load") + 1).alias("run"), "upper_id")
    low = bounds.select((F.col("run") + 1).alias("run"), F.col("upper_id").alias("low"))
    bounds = F.broadcast(bounds.join(low, "run", "left"))  # one row a load
    copy = increments.copied(spark, sink, state, rows.schema)
    counts = copy.join(bounds, (F.col("usage_log_id") <= F.col("upper_id")) & (F.col("usage_log_id") > F.coalesce("low", F.lit(-1)))).groupBy("run").agg(F.count("*").alias("n"))
    return done.join(counts, "run", "left").select("run", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "checkpoint")


@query("write_report_csv", REPORT_SQL)
def write_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = tp.fill(spark, st.summary(fx.request_log(spark, sf_dir), *fx.REQUEST_WINDOW))
    path = scratch(spark, "report")
    tp.write_report(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path).na.fill("")


@on_request("request_document", "SELECT request_log_id, rat_type, 'request_log' AS source_table FROM request_log")
def request_documents(q: DataFrame) -> DataFrame:
    return request_document(q, "request_log").select("request_log_id", "rat_type", "sync_metadata.source_table")


# Called-number normalisation
CALLS = """SELECT event_id, CASE event_id % 7 WHEN 0 THEN 83 WHEN 1 THEN 84 ELSE 82 END AS service_key,
 CASE WHEN event_id % 2 = 0 THEN 'termAttemptAuthorized' ELSE 'collectedInfo' END AS event_type,
 CASE event_id % 5 WHEN 0 THEN '60180000000000' WHEN 1 THEN '85290001' WHEN 2 THEN NULL ELSE '6012000001' END AS vlr,
 CASE event_id % 3 WHEN 0 THEN 4 WHEN 1 THEN 1 ELSE 0 END AS ton,
 concat(CASE event_id % 11 WHEN 0 THEN '2081' WHEN 1 THEN '2011' WHEN 2 THEN '60' WHEN 3 THEN '0060' WHEN 4 THEN '00' WHEN 5 THEN '0' WHEN 6 THEN '6018140' WHEN 7 THEN '44' ELSE '20' END, CAST(user_id AS STRING)) AS called_number,
 event_id % 13 = 0 AS redirection_present, CASE WHEN event_id % 26 = 0 THEN '60199' END AS original_called_number,
 CASE WHEN event_id % 4 = 0 THEN '60181000366' ELSE '8529' END AS sccp_clg_pa FROM events"""
_MO, _HOME = "service_key = 82", "vlr LIKE '60%' AND vlr <> '60180000000000'"
_AWAY = "(vlr = '60180000000000' OR vlr NOT LIKE '60%')"
CAMEL_SQL = f"""WITH calls AS ({CALLS}), ruled AS (SELECT *, CASE
 WHEN {_MO} AND redirection_present AND (called_number LIKE '6018140%' OR called_number LIKE '60181334%' OR called_number LIKE '60181335%') THEN 1
 WHEN {_MO} AND redirection_present THEN 2
 WHEN {_MO} AND {_HOME} AND ton = 4 AND called_number LIKE '20%' THEN 3
 WHEN {_MO} AND {_HOME} AND ton = 1 AND called_number LIKE '60%' THEN 4
 WHEN {_MO} AND {_HOME} AND ton = 1 THEN 5
 WHEN {_MO} AND {_HOME} AND ton = 0 AND called_number LIKE '0060%' THEN 6
 WHEN {_MO} AND {_HOME} AND ton = 0 AND called_number LIKE '00%' THEN 7
 WHEN {_MO} AND {_HOME} AND ton = 0 AND called_number LIKE '0%' THEN 8
 WHEN {_MO} AND {_HOME} AND ton = 0 THEN 9
 WHEN {_MO} AND {_AWAY} AND ton = 4 AND called_number LIKE '20%' AND sccp_clg_pa IN ('60181000366','60181000031') THEN 10
 WHEN {_MO} AND {_AWAY} AND ton = 4 AND called_number LIKE '20%' THEN 11
 WHEN {_MO} AND {_AWAY} AND ton = 1 THEN 12
 WHEN {_MO} AND {_AWAY} AND ton = 0 AND called_number LIKE '00%' THEN 13
 WHEN service_key = 83 AND event_type = 'termAttemptAuthorized' THEN 14 WHEN {_MO} THEN 15 ELSE 16 END AS rule FROM calls)
SELECT event_id, rule, CASE WHEN rule IN (1, 14) THEN 'CONTINUE' WHEN rule > 14 THEN 'RELEASE' ELSE 'CONNECT' END AS action,
 CASE rule WHEN 2 THEN called_number WHEN 3 THEN called_number WHEN 4 THEN called_number WHEN 5 THEN concat('C35', called_number) WHEN 6 THEN substr(called_number, 3) WHEN 7 THEN concat('C35', substr(called_number, 3))
  WHEN 8 THEN concat('60', substr(called_number, 2)) WHEN 9 THEN called_number WHEN 10 THEN called_number WHEN 11 THEN substr(called_number, 5) WHEN 12 THEN called_number WHEN 13 THEN substr(called_number, 3) END AS connect_number,
 CASE WHEN rule = 2 THEN COALESCE(original_called_number, called_number) WHEN rule IN (3, 10, 11) THEN concat('60', substr(called_number, 5)) WHEN rule IN (4, 5, 12) THEN called_number WHEN rule IN (6, 7, 13) THEN substr(called_number, 3)
  WHEN rule = 8 THEN concat('60', substr(called_number, 2)) WHEN rule = 9 THEN concat('60', called_number) END AS charging_number,
 COALESCE(rule = 1 OR (rule IN (2, 3) AND called_number LIKE '208_%'), FALSE) AS on_net, rule <> 1 AS is_charged,
 COALESCE(rule BETWEEN 10 AND 13 OR (rule = 15 AND {_AWAY}), FALSE) AS is_roaming, rule = 10 AS is_s8hr, rule IN (11, 12, 13) AS is_cs,
 rule IN (5, 7) OR (rule = 12 AND called_number NOT LIKE '60%') OR (rule = 13 AND called_number NOT LIKE '0060%') AS is_idd FROM ruled"""


@query("camel_normalize", CAMEL_SQL)
def camel_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = fx._view(spark, sf_dir, CALLS, "events")
    return camel.normalize(calls).select("event_id", "rule", "action", "connect_number", "charging_number", "on_net", "is_charged", "is_roaming", "is_s8hr", "is_cs", "is_idd")


# Streams
SERVICE_SQL = "CASE WHEN rat_type = 'VO' OR service_type_sub_cd IN ('MO','MT') THEN 'VOICE' WHEN rat_type = 'SM' OR rating_group = 'SM' THEN 'SMS' WHEN rat_type IN ('4G','5G') THEN 'DATA' ELSE 'UNKNOWN' END"


@on_usage("ops_5min_consumption", f"SELECT time_bucket(INTERVAL '5 minutes', usage_start_time) AS window_start, {SERVICE_SQL} AS service_type, COUNT(*) AS n, CAST(SUM(act_usage_unit) AS DOUBLE) AS units FROM usage_log GROUP BY 1, 2")
def ops_5min_consumption(u: DataFrame) -> DataFrame:
    return consumption(u)


@on_usage("stream_ops_5min", f"SELECT time_bucket(INTERVAL '5 minutes', usage_start_time) AS window_start, {SERVICE_SQL} AS service_type, COUNT(*) AS n, CAST(SUM(act_usage_unit) AS DOUBLE) AS units FROM usage_log GROUP BY 1, 2")
def stream_ops_5min(u: DataFrame) -> DataFrame:
    """The five-minute view as a stream that stops after half of the time and starts again.  The
    second half comes with rows of the first days again, which are later than the watermark and dropped."""
    spark = u.sparkSession
    folder, table, state = scratch(spark, "usage-files"), scratch(spark, "consumption"), scratch(spark, "consumption-state")
    rows = u.select("usage_start_time", "rat_type", "service_type_sub_cd", "rating_group", "act_usage_unit")
    span = rows.agg(F.min("usage_start_time"), F.max("usage_start_time")).first()
    if span[0] is None:
        return consumption(u)
    half, early = (F.lit(span[0] + (span[1] - span[0]) * part).cast("timestamp_ntz") for part in (0.5, 0.25))
    time = F.col("usage_start_time")
    rows.where(time < half).write.parquet(f"{folder}/part=1")
    run_consumption(spark, f"{folder}/part=*", rows.schema, table, state)
    rows.where((time >= half) | (time < early)).write.parquet(f"{folder}/part=2")
    run_consumption(spark, f"{folder}/part=*", rows.schema, table, state)
    return consumed(spark, table)


def _synced(spark: SparkSession, sf_dir: str, table: str, view: str, enrich, keys: list[str], time_col: str, unit: str) -> DataFrame:  # type: ignore[no-untyped-def]
    """A table by day that a stream of files keeps up to date by key."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    path, checkpoint = scratch(spark, "synced"), scratch(spark, "sync-state")

    def document(batch: DataFrame) -> DataFrame:
        rows = enrich(batch.sparkSession.sql(view.replace(f"FROM {table}", "FROM {src}"), src=batch))
        return dated.with_day(rows, time_col, unit)

    sync(spark, sf_dir, schema, checkpoint, lambda batch, _: dated.upsert(batch.sparkSession, path, document(batch), keys, time_col), f"{table}.parquet")
    return dated.stored(spark, path, document(spark.createDataFrame([], schema)).schema)


@query("stream_usage_sync", f"WITH {USAGE_CTE} SELECT usage_log_id, rat_type, {SERVICE_SQL} AS service_type FROM usage_log")
def stream_usage_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _synced(spark, sf_dir, "events", fx.USAGE_LOG, lambda u: usage_document(u, "usage_log"), ["usage_log_id"], "usage_start_time", "day")
    return out.select("usage_log_id", "rat_type", "derived.service_type")


@query("stream_request_sync", f"WITH {REQUEST_CTE} SELECT request_log_id, rat_type FROM request_log")
def stream_request_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synced(spark, sf_dir, "lineitem", fx.REQUEST_LOG, lambda q: request_document(q, "request_log"), ["request_log_id"], "req_time", "month").select("request_log_id", "rat_type")


@on_usage("report_window_dated", f"SELECT usage_log_id, rat_type FROM usage_log WHERE {IN_USAGE}")
def report_window_dated(u: DataFrame) -> DataFrame:
    """A report's window over the usage log stored by day: only the folders of its days are read."""
    spark, path = u.sparkSession, scratch(u.sparkSession, "usage-by-day")
    rows = dated.with_day(u, "usage_start_time")
    dated.load(spark, path, rows, rows.select("usage_log_id").limit(0))
    return dated.in_days(dated.stored(spark, path, rows.schema), "usage_start_time", *fx.USAGE_WINDOW).select("usage_log_id", "rat_type")


@on_usage("upsert_by_day", "SELECT usage_log_id, CASE WHEN usage_start_time >= TIMESTAMP '2024-01-20 00:00:00' AND usage_log_id % 3 = 0 THEN 'again' ELSE rat_type END AS rat_type FROM usage_log")
def upsert_by_day(u: DataFrame) -> DataFrame:
    """Last wins over a table by day: an update of some days, loaded twice, rewrites only these."""
    spark, path = u.sparkSession, scratch(u.sparkSession, "usage-by-day")
    rows = dated.with_day(u, "usage_start_time").select("usage_log_id", "rat_type", "usage_start_time", dated.DAY)
    dated.upsert(spark, path, rows, ["usage_log_id"], "usage_start_time")
    again = rows.where((F.col("usage_start_time") >= F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("usage_log_id") % 3 == 0)).withColumn("rat_type", F.lit("again"))
    for _ in range(2):
        dated.upsert(spark, path, again, ["usage_log_id"], "usage_start_time")
    return dated.stored(spark, path, rows.schema).select("usage_log_id", "rat_type")


@on_usage("detail_listing_by_day", f"SELECT CAST(usage_start_time AS DATE) AS day, usage_log_id, ROW_NUMBER() OVER (PARTITION BY CAST(usage_start_time AS DATE) ORDER BY usage_start_time, usage_log_id) AS place FROM usage_log WHERE rat_type = 'VO' AND service_type_sub_cd = 'MO' AND roaming_destination_id <> 87 AND {IN_USAGE}")
def detail_listing_by_day(u: DataFrame) -> DataFrame:
    """The listing as dated files, read back with each row's place in the files of its day."""
    path = scratch(u.sparkSession, "listing")
    rows = u.where("rat_type = 'VO' and service_type_sub_cd = 'MO' and roaming_destination_id <> 87").where(c.report_window("usage_start_time", *fx.USAGE_WINDOW))
    dated.write_in_order(rows.select("usage_log_id", "msisdn", "opposite_number", "usage_start_time", "usage_unit"), path, "usage_start_time", "usage_log_id")
    listed = u.sparkSession.read.parquet(path).select(dated.DAY, "usage_log_id", F.struct("_metadata.file_name", "_metadata.row_index").alias("at"))
    return listed.select(dated.DAY, "usage_log_id", F.row_number().over(Window.partitionBy(dated.DAY).orderBy("at")).cast("long").alias("place"))


class LogLoad(NamedTuple):
    """What a load of log files did: files found, loaded and skipped, and their lines."""

    files: int
    loaded: int
    skipped: int
    lines: int
    rows: int
    invalid_prefix: int
    parse_errors: int


def _log_rows(lines: DataFrame, layout: list[str] = schemas.SMSC_FIELDS, seen: Observation | str = "log-lines") -> DataFrame:
    """Parsed lines without error, by the day of their file; ``seen`` observes all of them on the way."""
    lines = lines.withColumn("source_path", smsc.plain_path(F.col("source_path")))
    parsed = smsc.parse_lines(lines, layout).observe(seen, *smsc.line_counts())
    return dated.with_day(parsed.where("error is null").drop("error"), smsc.file_date("source_path"))


def _log_table(spark: SparkSession, path: str, layout: list[str] = schemas.SMSC_FIELDS) -> DataFrame:
    lines = spark.createDataFrame([], "source_path string, line_number long, raw_line string")
    return dated.stored(spark, path, _log_rows(lines, layout).schema)


def ingest_logs(spark: SparkSession, logs: str, sink: str, manifest: str, today: str, layout: list[str] = schemas.SMSC_FIELDS) -> tuple[DataFrame, LogLoad]:
    """Loads the log files of complete days that are new or changed, and returns the
    table by day, and what was done.

    The rows of a file replace all its earlier ones, so a file that comes again with
    fewer lines leaves none of the old ones.  The manifest gets the files after
    that: a load that broke off is done again by the next one.
    """
    names = ["path", "length", "modification_time"]
    listed = spark.createDataFrame([], "path string, length long, modification_time timestamp")
    done = _stored(spark, manifest, listed.schema)
    files = smsc.discover(smsc.list_files(spark, logs), F.lit(today).cast("date"))
    found = files.count()
    fresh = upsert.handed_over(smsc.skip_processed(files, done).select(*names, "file_date"), "fresh-files")
    paths = [r["path"] for r in fresh.select("path").collect()]  # the reader takes a list: some hundred files a load
    counts = {"lines": 0, "rows": 0, "invalid_prefix": 0, "parse_errors": 0}
    if paths:
        number = done.select("load").distinct().count()
        seen = Observation("log-load")
        rows = upsert.handed_over(_log_rows(smsc.numbered_lines(spark, paths), layout, seen), "log-rows")
        counts = seen.get
        replaced = fresh.select(smsc.plain_path(F.col("path")).alias("source_path"))
        dated.load(spark, sink, rows, replaced, fresh.select(F.col("file_date").alias(dated.DAY)))
        fresh.select(*names).write.mode("overwrite").parquet(f"{manifest}/load={number}")
    return _log_table(spark, sink, layout), LogLoad(found, len(paths), found - len(paths), **counts)


def _stored(spark: SparkSession, folder: str, schema) -> DataFrame:  # type: ignore[no-untyped-def]
    """The loads in a manifest folder; none where it does not exist yet."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).withColumn("load", F.lit(0))


def log_files(s: DataFrame, layout: list[str] = schemas.SMSC_FIELDS) -> str:
    """A folder of text logs, one file for each year of ``s``, named by its first day."""
    from pyarrow import fs

    folder = scratch(s.sparkSession, "logs")
    lines = raw_lines(s, layout, surplus=True).select(F.concat(F.substring("source_path", 1, 12), F.lit("-01-01")).alias("name"), F.col("line_number"), "raw_line")
    lines.repartition("name").sortWithinPartitions("name", "line_number").select("name", "raw_line").write.partitionBy("name").text(folder)
    files, root = fs.FileSystem.from_uri(folder)
    for info in files.get_file_info(fs.FileSelector(root, recursive=True)):  # some years
        if info.path.endswith(".txt"):
            files.move(info.path, f"{root}/{info.path.split('name=')[1].split('/')[0]}")
    return folder


@on_smsc(
    "smsc_log_ingest",
    "SELECT source_path, ROW_NUMBER() OVER (PARTITION BY source_path ORDER BY line) AS line_number, addr_src_digits, sms_text FROM"
    " (SELECT concat(substr(source_path, 1, 12), '-01-01') AS source_path, line_number AS line, bad_prefix, addr_src_digits, sms_text FROM smsc WHERE day < '1998-01-01')"
    " QUALIFY NOT bad_prefix",
)
def smsc_log_ingest(s: DataFrame) -> DataFrame:
    """Text logs of the complete years up to 1997, from the files to the table, loaded twice: the second finds nothing new."""
    spark, logs = s.sparkSession, log_files(s)
    sink, manifest = scratch(spark, "log-table"), scratch(spark, "log-manifest")
    ingest_logs(spark, logs, sink, manifest, "1998-01-01")
    table, again = ingest_logs(spark, logs, sink, manifest, "1998-01-01")
    if again.loaded:
        raise RuntimeError("a file was loaded twice")
    return table.select(F.element_at(F.split("source_path", "/"), -1).alias("source_path"), "line_number", "addr_src_digits", "sms_text")


@on_smsc(
    "stream_smsc_ingest",
    "SELECT source_path, ROW_NUMBER() OVER (PARTITION BY source_path ORDER BY line) AS line_number, addr_src_digits, sms_text FROM"
    " (SELECT concat(substr(source_path, 1, 12), '-01-01') AS source_path, line_number AS line, bad_prefix, addr_src_digits, sms_text FROM smsc) QUALIFY NOT bad_prefix",
)
def stream_smsc_ingest(s: DataFrame) -> DataFrame:
    """The same logs as a stream of files, whole or in splits, each micro-batch numbered and parsed."""
    spark, logs = s.sparkSession, log_files(s)
    path, checkpoint = scratch(spark, "log-table"), scratch(spark, "sync-state")

    def load(batch: DataFrame, _: int) -> None:
        rows = upsert.handed_over(_log_rows(smsc.numbered(batch)), "log-rows")
        files = upsert.handed_over(batch.select(smsc.plain_path(F.col("source_path")).alias("source_path")).distinct(), "log-files")
        dated.load(batch.sparkSession, path, rows, files, files.select(smsc.file_date("source_path").alias(dated.DAY)))

    sync(spark, logs, StructType.fromDDL("value string"), checkpoint, load, "cdr.log.*", "text", tuple(map(F.expr, smsc.PLACED_LINE)))
    return _log_table(spark, path).select(F.element_at(F.split("source_path", "/"), -1).alias("source_path"), "line_number", "addr_src_digits", "sms_text")

"""Call-record views of the driver's star-schema tables.

The same SQL text runs on Spark and on DuckDB, so a report and its SQL twin see
the same rows: usage log from events, request log from lineitem, SMS-centre
records from orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

USAGE_LOG = """
WITH b AS (
 SELECT event_id, user_id, ts, CAST(ROUND(value*100) AS BIGINT) AS c,
  CASE event_type WHEN 'click' THEN '4G' WHEN 'view' THEN '5G' WHEN 'purchase' THEN 'VO' WHEN 'signup' THEN 'SM'
       ELSE CASE WHEN event_id % 4 <> 0 THEN 'VO' END END AS rat_type,
  CASE WHEN event_id % 10 < 8 THEN 87 WHEN event_id % 60 < 10 THEN 0 WHEN event_id % 60 < 20 THEN 103
       WHEN event_id % 60 < 30 THEN 81 WHEN event_id % 60 < 40 THEN 99 WHEN event_id % 60 < 50 THEN 435 ELSE 9999 END AS rd
 FROM events)
SELECT event_id AS usage_log_id, user_id AS sim_id, user_id % 7 AS customer_id,
 concat('6011', lpad(CAST(user_id AS STRING), 8, '0')) AS msisdn,
 ts AS usage_start_time, ts + INTERVAL '90' SECOND AS usage_end_time, rat_type,
 concat('50218', lpad(CAST(user_id AS STRING), 10, '0')) AS imsi,
 CASE WHEN event_id % 3 <> 0 THEN event_id % 40 END AS sim_service_plan_id,
 CASE WHEN event_id % 3 <> 0 AND event_id % 4 <> 0 THEN event_id % 90 END AS last_grant_sim_service_plan_bucket_id,
 CAST(CASE WHEN event_id % 3 = 0 THEN c ELSE 0 END AS DECIMAL(32,16)) AS price_amount,
 CASE WHEN rat_type = 'VO' THEN CASE WHEN event_id % 50 = 9 THEN 'MT' ELSE 'MO' END WHEN rat_type IS NOT NULL THEN 'N/A' END AS service_type_sub_cd,
 CASE rat_type WHEN 'VO' THEN CASE WHEN event_id % 4 = 1 THEN 'ONNET' ELSE 'OFFNET' END WHEN 'SM' THEN CASE event_id % 5 WHEN 1 THEN 'ONNET' WHEN 2 THEN 'OFFNET' ELSE 'SM' END
   ELSE concat('50000', CAST(1 + event_id % 8 AS STRING)) END AS rating_group,
 CASE WHEN rat_type IN ('4G','5G') THEN CASE rd WHEN 87 THEN '50218' WHEN 103 THEN '52505' WHEN 81 THEN '46001' ELSE concat('454', lpad(CAST(event_id % 6 AS STRING),2,'0')) END
   ELSE CASE WHEN rd = 87 THEN '60180000000502' ELSE concat('852900', CAST(event_id % 9 AS STRING)) END END AS roaming_mccmnc,
 CAST(rd AS BIGINT) AS roaming_destination_id,
 CASE WHEN rat_type IN ('VO','SM') THEN concat(
   CASE (event_id * 7 + user_id) % 13 WHEN 0 THEN '44' WHEN 1 THEN '1' WHEN 2 THEN '1246' WHEN 3 THEN '7' WHEN 4 THEN '852'
     WHEN 5 THEN '92' WHEN 6 THEN '999' WHEN 7 THEN '601300' ELSE '60' END, lpad(CAST((event_id * 37) % 1000000 AS STRING), 6, '0')) END AS opposite_number,
 CAST(CASE WHEN event_id % 9 = 0 THEN 0 WHEN rat_type IN ('4G','5G') THEN c * 4096 WHEN rat_type = 'SM' THEN 1 ELSE c END AS DECIMAL(32,16)) AS act_usage_unit,
 CAST(CASE WHEN event_id % 9 = 0 THEN 0 WHEN rat_type IN ('4G','5G') THEN c * 4096 WHEN rat_type = 'SM' THEN 1 ELSE c + (60 - c % 60) % 60 END AS DECIMAL(32,16)) AS usage_unit
FROM b
"""

COUNTRY_CODES = """
SELECT * FROM (VALUES ('Malaysia','60'),('United Kingdom','44'),('Canada','1'),('United States','1'),('Barbados','1246'),
('Russia','7'),('Kazakhstan','7'),('Hong Kong','852'),('Pakistan','92'),('Singapore','65'),('China','86')) AS t(country, country_code)
"""

ROAMING_DESTINATIONS = """
SELECT * FROM (VALUES (87,'Malaysia','Home','502'),(103,'Singapore','Net A','525'),(81,'China','Net B','460'),
 (99,'Hong Kong','Net C','454')) AS t(roaming_destination_id, country, roaming_destination_name, mcc)
"""

REQUEST_LOG = """
WITH b AS (
 SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, CAST(ROUND(l_extendedprice*100) AS BIGINT) AS c,
   (l_orderkey * 31 + l_partkey * 7 + l_suppkey) % 1000 AS h
 FROM lineitem),
k AS (SELECT b.*, CASE WHEN h < 450 THEN '4G' WHEN h < 650 THEN '5G' WHEN h < 900 THEN 'VO' WHEN h < 990 THEN 'SM' END AS rat_type,
   CASE WHEN h % 20 = 0 THEN 103 WHEN h % 20 = 1 THEN 0 ELSE 87 END AS rd FROM b)
SELECT l_orderkey * 100000000000 + l_partkey * 1000000 + l_suppkey * 1000 + l_linenumber * 100 + c % 100 AS request_log_id,
 concat('s', CAST(l_orderkey AS STRING)) AS session_id, CAST(l_linenumber AS BIGINT) AS session_req_num,
 concat('6011', lpad(CAST(l_suppkey AS STRING), 8, '0')) AS msisdn, l_shipdate AS req_time, rat_type,
 CASE rat_type WHEN 'VO' THEN CASE WHEN h % 4 = 1 THEN 'ONNET' ELSE 'OFFNET' END WHEN 'SM' THEN 'SM' ELSE concat('50000', CAST(1 + h % 8 AS STRING)) END AS rating_group,
 CASE WHEN rat_type = 'VO' THEN CASE WHEN rd <> 87 AND h % 3 = 0 THEN 'MT' ELSE 'MO' END
      WHEN rat_type = 'SM' AND rd <> 87 AND h % 2 = 0 THEN 'MO' ELSE 'N/A' END AS service_type_sub_cd,
 CAST(rd AS BIGINT) AS roaming_destination_id,
 CASE WHEN rat_type IN ('VO','SM') THEN CASE WHEN h % 50 = 7 THEN '60103' WHEN h % 50 = 8 THEN '600380008000' WHEN h % 50 = 9 THEN NULL
   WHEN h % 50 = 11 THEN concat('601300', lpad(CAST(l_partkey % 10000 AS STRING), 4 + CAST(h % 3 AS INT), '0'))
   ELSE concat(CASE h % 6 WHEN 0 THEN '44' WHEN 1 THEN '1' WHEN 2 THEN '852' ELSE '60' END, lpad(CAST(l_partkey % 1000000 AS STRING), 9, '0')) END END AS opposite_number,
 CAST(CASE WHEN rat_type IN ('4G','5G') THEN c * 16 WHEN rat_type = 'SM' THEN 1 ELSE c % 3600 END AS DECIMAL(32,16)) AS update_used_volume,
 CAST(CASE WHEN h % 11 = 0 THEN 0 WHEN rat_type IN ('4G','5G') THEN c * 16 WHEN rat_type = 'SM' THEN 1 ELSE c % 3600 END AS DECIMAL(32,16)) AS act_update_used_volume
FROM k
"""

SMSC_FIELDS = """
SELECT concat('cdr.log.', substr(CAST(CAST(o_orderdate AS DATE) AS STRING),1,10)) AS source_path, o_orderkey + 1 AS line_number,
 substr(CAST(CAST(o_orderdate AS DATE) AS STRING),1,10) AS day,
 CASE o_orderkey % 6 WHEN 0 THEN '22200Brand' WHEN 1 THEN '22200' WHEN 3 THEN '22200Other' WHEN 2 THEN '60119990001' ELSE concat('6011', lpad(CAST(o_custkey AS STRING),8,'0')) END AS addr_src_digits,
 concat('6012', lpad(CAST(o_custkey * 3 AS STRING),8,'0')) AS addr_dst_digits,
 CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'success_esme' ELSE CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'temp_failed' END END AS message_delivery_status,
 CASE WHEN o_orderkey % 4 = 0 THEN 'dlr' ELSE 'message' END AS message_type,
 CASE WHEN o_orderkey % 2 = 0 THEN 'hello, world' ELSE 'plain' END AS sms_text,
 o_orderkey % 97 = 0 AS bad_prefix
FROM orders
"""

#: Senders of application-to-person messages in the SMS-centre view, which also holds one that only begins like them.
A2P_SENDERS = ["22200", "22200Brand", "60119990001"]

#: Report windows (inclusive dates) in which every report has rows.
USAGE_WINDOW = ("2024-01-05", "2024-01-18")
REQUEST_WINDOW = ("1998-01-01", "1998-12-31")
SMSC_WINDOW = ("1996-01-01", "1996-12-31")


def _view(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    src = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(sql.replace(f"FROM {table}", "FROM {src}"), src=src)


def usage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, USAGE_LOG, "events")


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, REQUEST_LOG, "lineitem")


def smsc_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SMSC_FIELDS, "orders")


def country_codes(spark: SparkSession) -> DataFrame:
    return spark.sql(COUNTRY_CODES)


def roaming_destinations(spark: SparkSession) -> DataFrame:
    return spark.sql(ROAMING_DESTINATIONS)

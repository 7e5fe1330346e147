"""Report templates: cells with %query.column% placeholders, filled from results."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PLACEHOLDER = re.compile(r"%\s*([^.%\s]+)\.([^%]+?)\s*%")

HEADER = ["no", "service", "direction", "network", "transactions", "minutes", "sms_units", "volume_mb"]
#: The settlement report: one row a line; lines 4, 15 and 16 have nothing to fill in.
TEMPLATE = [
    ["1", "Voice on net", "MO", "On-Net", "%1.total_transaction%", "%1.mou_minutes%", "N/A", "N/A"],
    ["2", "Voice off net", "MO", "Off-Net", "%2.total_transaction%", "%2.mou_minutes%", "", ""],
    ["3", "SMS on net", "MO", "On-Net", "%3.total_transaction%", "", "%3.mou%", ""],
    ["4", "SMS off net", "MO", "Off-Net", "", "", "", ""],
    ["5", "4G data", "N/A", "N/A", "%5.total_transaction%", "", "", "%5.mou_MBs%"],
    ["6", "5G data", "N/A", "N/A", "%6.total_transaction%", "", "", "%6.mou_MBs%"],
    ["7", "International voice", "MO", "N/A", "%7.total_transaction%", "%7.mou_minutes%", "", ""],
    ["8", "International SMS", "MO", "N/A", "%8.total_transaction%", "", "%8.mou%", ""],
    ["9", "Roaming data 4G", "N/A", "N/A", "%9.total_transaction%", "", "", "%9.mou_MBs%"],
    ["10", "Roaming data 5G", "N/A", "N/A", "%10.total_transaction%", "", "", "%10.mou_MBs%"],
    ["11", "Roaming voice MO", "MO", "N/A", "%11.total_transaction%", "%11.mou_minutes%", "", ""],
    ["12", "Roaming voice MT", "MT", "N/A", "%12.total_transaction%", "%12.mou_minutes%", "", ""],
    ["13", "Roaming SMS MO", "MO", "N/A", "%13.total_transaction%", "", "%13.mou%", ""],
    ["14", "Premium numbers", "N/A", "N/A", "%14.total_transaction%", "%14.mou_minutes%", "", ""],
    ["15", "Non-profit A2P", "MT", "N/A", "", "", "", ""],
    ["16", "Commercial A2P", "MT", "N/A", "", "", "", ""],
]


def format_cell(value: Column) -> Column:
    """Printed plain, without trailing zeros or an exponent; null is blank."""
    text = value.cast("string")
    return F.coalesce(F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text), F.lit(""))


def collapse(rows: DataFrame, numbers: list[str], texts: list[str], order: str, key: str = "query_id") -> DataFrame:
    """One row for each ``key``: numbers are summed; distinct texts are joined by
    "; " in the order of their first ``order``.  Only nulls give null."""
    firsts = rows
    aggregates = [F.sum(n).alias(n) for n in numbers]
    for t in texts:
        seen = F.array_sort(F.collect_list(F.when(F.col(t).isNotNull(), F.struct(F.col(order).alias("o"), F.col(t).alias("t")))))
        joined = F.array_join(F.array_distinct(F.transform(seen, lambda x: x["t"])), "; ")
        aggregates.append(F.when(F.count(t) > 0, joined).alias(t))
    return firsts.groupBy(key).agg(*aggregates)


def placeholders(template: list[list[str]]) -> set[tuple[str, str]]:
    return {(q, col.lower()) for row in template for cell in row for q, col in PLACEHOLDER.findall(cell)}


def fill(spark: SparkSession, summary: DataFrame, template: list[list[str]] = TEMPLATE, header: list[str] = HEADER) -> DataFrame:
    """``template`` with the values of ``summary`` (one row for each query_id).  A
    column that a query lacks is blank; so is a query without rows.  A template
    has some rows and its summary one for each query, so both are small."""
    columns = {name.lower(): name for name in summary.columns}
    wanted = sorted({col for _, col in placeholders(template)} & set(columns))
    rows = summary.select(F.col("query_id").cast("string"), *[format_cell(F.col(columns[w])).alias(w) for w in wanted]).collect()
    values = {(r["query_id"], w): r[w] for r in rows for w in wanted}
    filled = [[PLACEHOLDER.sub(lambda m: values.get((m[1], m[2].lower()), ""), cell) for cell in row] for row in template]
    return spark.createDataFrame([tuple(r) for r in filled], ", ".join(f"{h} string" for h in header))


def write_report(report: DataFrame, path: str) -> None:
    """The filled template (some rows) as one CSV file with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)

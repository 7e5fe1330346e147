"""A corpus pipeline of five stages, each of which writes its documents for the next.

Documents that are predicted to be of low quality or toxic go, one document of
each group of near duplicates stays, documents with a benchmark passage go, and
what is left is encoded.  Labels and the benchmark are read from ``sf_dir``.

Stages with Python workers bound the session's Arrow batches by bytes (4 MB, or
what the session has set), as workers and JVM share an executor's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave.llm import bpe, jaccard, quality, toxicity, winnow
from callweave.llm.storage import bound_batches, small, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the pairwise ranking rejects.

    A row is judged by its text: null, empty and blank ones as texts without
    words, equal ones alike, of any length; ids may be null or repeat, other
    columns may have any name; an empty table stays empty.
    """
    bound_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose chance of being toxic reaches the learned bar.

    Rows and cases as in the quality stage.
    """
    bound_batches(spark)
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: texts that links of a Jaccard
    similarity of 0.8 or more on five-word shingles connect.

    It is the row with the smallest id, nulls last, and the smallest hash among
    rows of that id.  Rows are judged by their texts alone, so different texts
    with the same id, or without one, each stay.  Null and blank texts are one
    group; columns may have any name; an empty table stays empty.

    Operator 2 finds the links: SimHash balls first, and for the pairs that
    fingerprints cannot reach at 0.8, a search on shared first shingles.
    """
    bound_batches(spark)
    named = written(jaccard.near_duplicates(docs), "components")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_a", "row_b")
    groups = named.groupBy("component").agg(F.min(order).alias("least"), F.count("*").alias("rows")).where("rows > 1")
    groups = small(written(groups.select("component", "least.row_a", "least.row_b").withColumnsRenamed({"row_a": "kept_a", "row_b": "kept_b"}), "groups"))
    gone = named.join(groups, "component").where("row_a <> kept_a or row_b <> kept_b").select("row_a", "row_b").distinct()
    out = jaccard.row_hashes(docs).join(small(written(gone, "dropped-rows")), ["row_a", "row_b"], "left_anti")
    if not named.groupBy("row_a", "row_b").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["row_a", "row_b"])  # rows that are equal in all columns
    return out.select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark.

    Null and wordless texts stay, repeated rows stay repeated, ids may be null
    and columns may have any name; an empty table or benchmark drops nothing.
    """
    return winnow.keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document's ids and of the text decoded from them.

    One row a row of ``docs``: null counts as empty, ids may be null or repeat,
    other columns are left out; an empty table gives no rows.
    """
    bound_batches(spark)
    return bpe.digests(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: Trained models and hashing have no SQL twin; tests/llm holds stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

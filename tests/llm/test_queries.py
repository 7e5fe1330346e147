"""Every registered query and the pipeline on a small folder of awkward tables."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from callweave.llm import media, queries
from tests.llm.cases import IDS, TEXTS, documents

COLUMNS = {
    "op1_media_archives": {"n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"},
    "op2_simhash_near_dedup": {"fingerprint", "component_id"},
    "op3_minimax_sharding": {"size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op4_repair_token_shards": {"start", "n_tokens", "ids_crc32"},
    "op5_bloom_language_id": {"held_out", "lang_pred", "score"},
    "op6_ordinal_toxicity": {"severity", "grade", "toxic"},
    "op7_winnowing_decontamination": {"n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op8_speculative_bpe": {"n_tokens", "ids_sha256", "decoded_sha256"},
    "op9_edit_aware_token_counts": {"n_tokens", "n_tokens_after"},
    "op10_bradley_terry_quality": {"held_out", "score", "predicted"},
    "op11_prefix_free_dedup": {"n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op12_fill_in_middle": {"n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"},
}
OF_DOCUMENTS = sorted(set(queries.QUERIES) - {"op13_embedding_whitening"})


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with nulls, empty and long texts, repeated rows and clashing columns."""
    out = str(tmp_path_factory.mktemp("odd"))
    docs = documents(spark).withColumn("row_a", F.lit(1)).withColumn("component", F.lit("c")).withColumn("kept_id", F.lit(2))
    docs.write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(12)] + [(3, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, "same words here again and again"), (2, None)], "item_id int, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


@pytest.mark.parametrize("name", OF_DOCUMENTS)
def test_query_gives_one_row_a_document(spark, folder, name):
    rows = queries.QUERIES[name](spark, folder).collect()
    assert len(rows) == len(TEXTS) and COLUMNS[name] <= set(rows[0].asDict())
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, IDS))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_takes_empty_tables(spark, tmp_path, name):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []


def test_pipeline_takes_odd_rows_and_columns(spark, folder):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns, name
        rows = {tuple(r) for r in docs.collect()}
        assert {tuple(r) for r in after.collect()} <= rows, name
        assert stage(spark, docs.limit(0), folder).collect() == [], name
    assert cp.STAGES[-1][1](spark, docs, folder).count() == docs.count()
    assert cp.run(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pipeline_takes_nested_columns(spark, folder):
    """Maps, structs and arrays, in columns of any name; one map differs between rows of one id and text."""
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("key", F.create_map(F.lit("k"), F.monotonically_increasing_id()))
    docs = docs.withColumn("n", F.struct("doc_id", F.array("lang").alias("odd"))).withColumn("front", F.array(F.create_map(F.lit(1), F.col("source"))))
    for name, stage in cp.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.schema.simpleString() == docs.schema.simpleString() and after.count() <= docs.count(), name
        assert name != "near duplicates" or after.count() > 5


def test_media_features_equal_plain_sums(spark):
    """Mean, root mean square, entropy and crossings of the mean, by plain Python."""
    import math

    rows = {r["payload_sha256"]: r for r in media.media_column(documents(spark)).collect()}
    for text in TEXTS:
        raw = (text or "").encode()
        x = raw + b"\xff" * ((-len(raw)) % 576 or (576 if not raw else 0))
        mean = sum(x) / len(x)
        rms = math.sqrt(sum(b * b for b in x) / len(x))
        entropy = -sum(x.count(b) / len(x) * math.log2(x.count(b) / len(x)) for b in set(x))
        crossings = sum((a > mean) != (b > mean) for a, b in zip(x, x[1:])) / len(x)
        row = rows[hashlib.sha256(x).hexdigest()]
        got = dict(part.split("=") for part in row["feature"].split(";"))
        for key, want, places in (("mean", mean, 3), ("rms", rms, 3), ("entropy", entropy, 4), ("crossings", crossings, 4)):
            assert abs(float(got[key]) - want) < 0.6 * 10**-places + 1e-12, (key, text)
        assert (row["n_bytes"], row["payload_bytes"], row["tail_crc32"]) == (len(raw), len(x), zlib.crc32(x[-32:]))

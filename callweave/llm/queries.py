"""Registered queries of the text operators: each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import infill, language, media, quality, toxicity
from .bpe import digests, roomy_coder
from .edits import edited_counts
from .repair import token_index, write_shards
from .sharding import shard
from .simhash import near_duplicates
from .suffixes import remove_repeats
from .whitening import whiten
from .winnow import decontaminate


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_column(_table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=4, radius=4)


def op3_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_table(spark, sf_dir, "documents"), shards=8)


def op4_repair_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(write_shards(_table(spark, sf_dir, "documents"), end_id=0))


def op5_bloom_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op6_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def op10_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, _table(spark, sf_dir, "labels")))


def op7_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(_table(spark, sf_dir, "documents"), coder_of=roomy_coder)


def op9_edit_aware_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_counts(_table(spark, sf_dir, "documents"))


def op11_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), length=200)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), most=16)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_media_archives,
        op2_simhash_near_dedup,
        op3_minimax_sharding,
        op4_repair_token_shards,
        op5_bloom_language_id,
        op6_ordinal_toxicity,
        op7_winnowing_decontamination,
        op8_speculative_bpe,
        op9_edit_aware_token_counts,
        op10_bradley_terry_quality,
        op11_prefix_free_dedup,
        op12_fill_in_middle,
        op13_embedding_whitening,
    )
}

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

#: The others can't be said in SQL (models, tokenizers, CRC-32, file formats); tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op7_winnowing_decontamination": f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT id, w, least(10, len(w)) AS m FROM item WHERE len(w) > 0),
item_window AS (SELECT DISTINCT id, m, w[i : i + m - 1] AS g FROM (SELECT id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM sized)),
doc_window AS (SELECT r, m, i, w[i : i + m - 1] AS g
    FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, (SELECT DISTINCT m FROM sized) WHERE len(w) >= m)),
hit AS (SELECT r, i, m, id FROM doc_window JOIN item_window USING (m, g)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, id FROM hit WHERE id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)""",
    "op12_fill_in_middle": r"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, sha256(concat('42:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS d FROM documents),
drawn AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2, CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM doc),
formed AS (SELECT doc_id, text, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
cut AS (SELECT doc_id, text, n, form, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 : n], '') AS s FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256, sha256(text) AS restored_sha256
FROM cut""",
}

"""One registered query per operator of this subpackage: the operator with its production parameters
over the whole table, and what of its result the query reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temporal_tree.llm import (
    backoff,
    conversations,
    histogram_sort,
    induced,
    latent,
    licenses,
    merkle,
    packing,
    personal_data,
    quality_forest,
    rlz,
    setsketch,
    toxicity,
)
from temporal_tree.llm import statements as sql
from temporal_tree.llm.documents import tables

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_forest.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op2_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "n_passages")


def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.stupid_backoff(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rlz.substring_dedup(_table(spark, sf_dir, "documents"), words=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), size=1024, with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = induced.suffix_dedup(_table(spark, sf_dir, "documents"), size=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = histogram_sort.document_rows(_table(spark, sf_dir, "documents")).select(
        "doc_id", "key", "size", F.crc32(F.col("text").cast("binary")).alias("text_crc32")
    )
    return histogram_sort.shard_by_bytes(rows, shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=5, percent=75)


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        F.sha2(personal_data.listed(personal_data.base_spans(F.col("found"))), 256).alias("base_sha256"),
        personal_data.listed(F.col("found")).alias("spans"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.document_leaves(_table(spark, sf_dir, "documents"))
    return merkle.manifest(rows).verify()


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    scratch = tables(spark)
    rows = scratch.save(conversations.repair(conversations.damaged(turns), scratch=scratch), "repair")
    counted = conversations.report(rows).withColumnRenamed("conv_id", "_counted")
    digests = conversations.digest(rows).withColumnRenamed("conv_id", "_hashed")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        turns.select("conv_id")
        .distinct()
        .join(counted, F.col("conv_id").eqNullSafe(F.col("_counted")), "left")
        .join(digests, F.col("conv_id").eqNullSafe(F.col("_hashed")), "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )


def queries() -> dict[str, Query]:
    return {
        "op1_quality_forest": op1_quality_forest,
        "op2_toxic_segments": op2_toxic_segments,
        "op3_stupid_backoff": op3_stupid_backoff,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_license_diagonals": op6_license_diagonals,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_latent_decontamination": op8_latent_decontamination,
        "op9_histogram_sort": op9_histogram_sort,
        "op10_near_dedup": op10_near_dedup,
        "op11_personal_data": op11_personal_data,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_conversation_repair": op13_conversation_repair,
    }


_SUBSTRING_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS place, w FROM words WHERE len(w) >= 13
),
windows AS (SELECT doc_id, place, array_to_string(w[place : place + 12], ' ') AS piece FROM starts),
earliest AS (SELECT piece, min(doc_id) AS least FROM windows GROUP BY piece),
removed AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 13)) AS place
  FROM windows JOIN earliest USING (piece) WHERE least < doc_id
),
placed AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS word FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM placed ANTI JOIN removed USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


def statements() -> dict[str, str]:
    return {
        "op4_substring_dedup": _SUBSTRING_SQL,
        "op7_suffix_dedup": sql.REPEATED_BYTES,
        "op10_near_dedup": sql.NEAR_DUPLICATES,
        "op11_personal_data": sql.PERSONAL_DATA,
        "op12_merkle_manifest": sql.MERKLE,
        "op13_conversation_repair": sql.CONVERSATIONS,
    }

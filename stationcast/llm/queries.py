"""The registered queries of this package: each applies its operator, with production
parameters, to its whole table.  ``SQL`` holds DuckDB text where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import centroids, chat, exact_dedup, fill_middle, licenses, mixing, packing, quality_gam, quality_rules, secrets, lm_score, \
    ngram_join, simhash
from .common import documents, read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_decisions(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.quality_scores(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(documents(spark, sf_dir))


def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(read_table(spark, sf_dir, "conversations"))


def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op9_bestfit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_decisions(documents(spark, sf_dir)).drop("raw")


def op11_centroid_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_digests(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_source_mix, op3_quality_gam, op4_ngram_jaccard, op5_lm_score, op6_chat_rotation,
    op7_secret_forest, op8_quality_rules, op9_bestfit_pack, op10_exact_dedup, op11_centroid_orchard, op12_simhash, op13_fill_middle)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op10_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents),
             g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op6_chat_rotation": chat.SQL,
    "op11_centroid_orchard": centroids.SQL,
    "op13_fill_middle": fill_middle.SQL,
}

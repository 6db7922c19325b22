"""The corpus pipeline: quality classifier, exact and near deduplication, source mixing and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs; all but the last return the columns of documents.

Odd rows: each stage's own docstring states them.  In short, a null text counts as an empty one, null ids take part and
give way to others, of repeated rows one stays, an empty table gives no rows, and columns beside doc_id, text and source are
passed through whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationcast.llm import common, exact_dedup, mixing, ngram_join, packing, quality_gam


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    common.prepare(spark)
    return quality_gam.keep_good(docs, common.read_table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    common.prepare(spark)
    return ngram_join.drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def bestfit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    common.prepare(spark)
    return packing.pack(docs)


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact_duplicates),
          ("ngram_jaccard_join", near_duplicates), ("source_mix", source_mixing), ("bestfit_pack", bestfit_packing)]

#: Models, iterations and hash orders decide the rows; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.cut(stage(spark, docs, sf_dir), name)
    return docs

"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import scratch_path, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but the six ASCII white-space characters.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
WORD_CLASS = "[^\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def prepare(spark: SparkSession) -> None:
    """The package on every executor, and Arrow batches of long texts small enough that two tasks of an executor
    hold little beside the heap; a batch size that the application sets itself stays."""
    ship_package(spark)
    if not spark.sparkContext.getConf().contains(BATCH_KEY):
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def text_slices(batch, column: int, size: int):
    """Slices of an Arrow batch whose texts have about ``size`` bytes, each text whole."""
    held, at = 0, 0
    for i, text in enumerate(batch.column(column)):
        held += text.as_buffer().size if text.is_valid else 0
        if held >= size:
            yield batch.slice(at, i + 1 - at)
            held, at = 0, i + 1
    if at < batch.num_rows:
        yield batch.slice(at)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return read_table(spark, sf_dir, "documents")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII texts take the fast ``lower``; for the
    others ``lower`` would also change letters beyond A-Z, so they are translated."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def word_count(c: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends there
    and later uses read files that survive a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc32_mod(c: Column, n: int) -> Column:
    """crc32 of the value's text modulo n; a null value counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))


GROUPS = (1024, 32)     # sketches are merged in groups of tasks, then in groups of groups, before the last task


def frequent(df: DataFrame, col: str, k: int, tracked: int) -> DataFrame:
    """(item, estimate): the at most k most frequent values by a Misra-Gries summary of ``tracked`` counters.  Every task
    makes one summary; they are merged level by level, so the last task reads ``GROUPS[-1]`` of them at any number of tasks."""
    parts = (df.withColumn("__group", F.pmod(F.spark_partition_id(), F.lit(GROUPS[0]))).groupBy("__group")
             .agg(F.expr(f"approx_top_k_accumulate(`{col}`, {int(tracked)})").alias("__sketch")))
    for groups in GROUPS[1:]:
        parts = (parts.groupBy(F.pmod("__group", F.lit(groups)).alias("__group"))
                 .agg(F.expr(f"approx_top_k_combine(__sketch, {int(tracked)})").alias("__sketch")))
    whole = (parts.groupBy(F.lit(0).alias("__group"))      # no row, and so no summary, of an empty table
             .agg(F.expr(f"approx_top_k_combine(__sketch, {int(tracked)})").alias("__sketch")))
    return (whole.select(F.explode(F.expr(f"approx_top_k_estimate(__sketch, {int(k)})")).alias("t"))
            .select(F.col("t.item").alias("item"), F.col("t.count").alias("estimate")))

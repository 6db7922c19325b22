"""Exact deduplication with a heavy-hitter split.

1. One narrow pass writes (row number, doc_id, raw-text hash, digest).
2. A Misra-Gries summary (Spark's mergeable frequent-items sketch, built map-side)
   names the digests that may be frequent.  ``approx_top_k`` with ``tracked`` counters
   misses no digest holding more than 3.5 / tracked of all rows.  It counts 8-byte hashes of the digests.
3. The candidates are counted exactly; the verified ones -- at most ``heavy`` rows, the
   proven bound of the broadcast -- mark their rows map-side, without any shuffle.
4. All other digests are shuffled once; no group there is frequent.

Results for odd rows: a null text equals an empty one; of rows with equal text and equal
largest doc_id exactly one stays; a null doc_id loses against any other; an empty table
gives an empty result; columns besides doc_id and text are passed through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, frequent, lower_ascii

HEAVY = 4096        # most digests that are broadcast
TRACKED = 65536     # counters of the frequent-items summary


def _raw_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Narrow table (rid, doc_id, raw, text_sha256), written to the shared folder."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return cut(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                           _raw_hash(text_col).alias("raw"),
                           F.sha2(lower_ascii(text), 256).alias("text_sha256")), "digests")


def heavy_digests(rows: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """Verified frequent digests: exact count and the row that stays (largest doc_id)."""
    hashed = rows.withColumn("__hash", F.xxhash64("text_sha256"))     # eight bytes a counter
    named = frequent(hashed.select("__hash"), "__hash", heavy, tracked).filter("estimate > 1")
    best = F.max(F.struct("doc_id", "rid")).alias("best")
    return (hashed.join(F.broadcast(named), F.col("__hash") == F.col("item")).groupBy("text_sha256")
            .agg(best, F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"))


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (and raw)."""
    rows = digests(docs, id_col, text_col)
    frequent = cut(heavy_digests(rows, heavy, tracked), "heavy-digests")
    marked = rows.join(F.broadcast(frequent), "text_sha256", "left")
    by_digest = Window.partitionBy("text_sha256")
    rest = (marked.filter(F.col("group_size").isNull()).drop("best", "group_size")
            .withColumn("best", F.max(F.struct("doc_id", "rid")).over(by_digest))
            .withColumn("group_size", F.count(F.lit(1)).over(by_digest)))
    both = marked.filter(F.col("group_size").isNotNull()).unionByName(rest)
    return both.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                       (F.col("rid") == F.col("best.rid")).alias("kept"), "text_sha256", "raw")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    decided = dedup_decisions(docs, id_col, text_col)
    keys = cut(decided.filter("group_size > 1").groupBy("doc_id", "raw")
               .agg(F.max("kept").alias("any_kept"), F.count(F.lit(1)).alias("n")), "dedup-keys")
    gone = keys.filter("not any_kept").select(F.col("doc_id").alias("__gone_id"), F.col("raw").alias("__gone_raw"))
    left = docs.join(gone, F.col("__gone_id").eqNullSafe(docs[id_col])
                     & (F.col("__gone_raw") == F.xxhash64(F.coalesce(docs[text_col], F.lit("")))), "left_anti")
    if keys.filter("any_kept and n > 1").isEmpty():
        return left
    # the same row more than once: one of them stays
    return (left.withColumn("__raw", _raw_hash(text_col)).dropDuplicates([id_col, "__raw"]).drop("__raw"))

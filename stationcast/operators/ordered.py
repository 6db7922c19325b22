"""Next row within a group, without one task per group (skew-safe LEAD).

``LEAD(v) OVER (PARTITION BY key ORDER BY o)`` sends every row of a key to one
task; a key holding a third of all rows would make that task hold a third of
the data.  Here the rows are range-partitioned on (key, order...), so a hot
key is cut into consecutive chunks across tasks.  The lead is taken inside
each (key, chunk); the last row of a chunk then takes the first row of the
next chunk of the same key, found in a table with one row per chunk (a hot
key has at most one chunk per partition).  Only chunk-boundary rows join.

The chunked rows are written to the shared folder before they are used twice:
each use of a range exchange samples its own boundaries, and chunk ids must
agree between the lead and the fix-up.  The files outlive a lost executor, and
nothing stays persisted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize


def next_in_group(df: DataFrame, key: str, order: list[str], values: list[str],
                  prefix: str = "next_", num_partitions: int | None = None) -> DataFrame:
    """Add ``{prefix}{v}`` = value of ``v`` on the next row of the same ``key`` by ``order``."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(n, key, *order).withColumn("_chunk", F.spark_partition_id())
    w = Window.partitionBy(key, "_chunk").orderBy(*order)
    r = materialize(r.withColumns({f"{prefix}{v}": F.lead(v).over(w) for v in values}).withColumn(
        "_is_last", F.lead(F.lit(1)).over(w).isNull()), "chunks")
    firsts = r.groupBy(key, "_chunk").agg(
        F.min_by(F.struct(*[F.col(v).alias(v) for v in values]), F.struct(*order)).alias("_first"))
    nxt = firsts.select(F.col(key).alias("_k"), F.col("_chunk").alias("_c"),
                        F.lead("_first").over(Window.partitionBy(key).orderBy("_chunk")).alias("_nf"))
    inner = r.where(~F.col("_is_last")).drop("_is_last", "_chunk")
    last = (r.where(F.col("_is_last"))
            .join(nxt, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_chunk") == F.col("_c")), "left")
            .withColumns({f"{prefix}{v}": F.col(f"_nf.{v}") for v in values})
            .drop("_is_last", "_chunk", "_k", "_c", "_nf"))
    return inner.unionByName(last)


def rank_distinct(df: DataFrame, col: str, num_partitions: int | None = None) -> DataFrame:
    """(value, 0-based rank among the sorted distinct non-null values), distributed.

    Distinct values are range-partitioned and numbered inside each partition;
    each partition's offset is the number of values in the partitions before
    it, from a table with one row per partition.  No task ever holds all
    values (a global ``row_number`` would).  The numbered rows are written to
    the shared folder so that the partition ids agree between their two uses.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = (df.select(col).where(F.col(col).isNotNull()).distinct()
         .repartitionByRange(n, col).withColumn("_p", F.spark_partition_id()))
    numbered = materialize(
        d.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(col)) - 1), "ranks")
    sizes = numbered.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off"))  # one row per partition
    return (numbered.join(F.broadcast(offsets), "_p")
            .select(col, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_i")).alias("_rank")))

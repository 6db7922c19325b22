from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationcast.operators.ordered import next_in_group


def test_next_in_group_matches_lead_with_a_hot_key(spark):
    # key 0 holds a third of all rows; the range partitioning cuts it into chunks
    rows = [(0 if i % 3 == 0 else i % 50, i, f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, t long, v string")
    got = next_in_group(df, "k", ["t"], ["t", "v"], num_partitions=8)
    w = Window.partitionBy("k").orderBy("t")
    want = df.withColumns({"next_t": F.lead("t").over(w), "next_v": F.lead("v").over(w)})
    cols = ["k", "t", "v", "next_t", "next_v"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.count() == 3000
    chunks = df.repartitionByRange(8, "k", "t").withColumn("p", F.spark_partition_id()) \
        .where("k = 0").select("p").distinct().count()
    assert chunks > 1  # the hot key really is split


def test_rank_distinct_matches_dense_rank(spark):
    from stationcast.operators.ordered import rank_distinct
    rows = [(f"c{(i * 7919) % 997:04d}",) for i in range(5000)] + [(None,)]
    df = spark.createDataFrame(rows, "c string")
    got = {r.c: r._rank for r in rank_distinct(df, "c", num_partitions=8).collect()}
    want = {c: i for i, c in enumerate(sorted({r[0] for r in rows if r[0] is not None}))}
    assert got == want

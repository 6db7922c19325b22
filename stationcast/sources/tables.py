"""Readers for the input tables and the trip view derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_runtime

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_runtime(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The stand-in trip view over ``events`` as the SQL oracle states it: the next
# event of the same user acts as the trip end.  ``{K}`` is the JSON accessor.
TRIPS_VIEW_SQL = """
SELECT CAST(event_id AS STRING) AS ride_id,
       CASE WHEN CAST({K} AS INT) >= 50 THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
       ts AS started_at,
       LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ended_at,
       event_type AS start_station_id,
       LEAD(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_station_id,
       CAST(40.70 + (user_id % 100) * 0.001 AS DOUBLE) AS start_lat,
       CAST(-74.05 + CAST({K} AS INT) * 0.001 AS DOUBLE) AS start_lng,
       CAST(40.70 + (event_id % 100) * 0.001 AS DOUBLE) AS end_lat,
       CAST(-74.05 + (event_id % 37) * 0.001 AS DOUBLE) AS end_lng,
       CASE WHEN user_id % 2 = 0 THEN 'member' ELSE 'casual' END AS member_casual,
       user_id
FROM {events}
"""
DUCK_K = "json_extract_string(props, '$.k')"


def trips_view_sql(events: str = "events") -> str:
    return TRIPS_VIEW_SQL.format(K=DUCK_K, events=events).replace("AS STRING)", "AS VARCHAR)")


TRIP_VIEW_COLUMNS = ("ride_id", "rideable_type", "started_at", "ended_at", "start_station_id", "end_station_id",
                     "start_lat", "start_lng", "end_lat", "end_lng", "member_casual", "user_id")
TRIP_END_COLUMNS = ("ended_at", "end_station_id")


def trips_view(spark: SparkSession, sf_dir: str, ends: bool = False, columns: tuple[str, ...] = TRIP_VIEW_COLUMNS) -> DataFrame:
    """Trips derived from ``events`` (one row per event).

    The trip end (``ended_at``, ``end_station_id``) is the user's next event.  Callers that
    need it ask with ``ends=True``; it comes from ``next_in_group``, which spreads a user
    holding a third of all events over many tasks and writes its rows once: ``columns`` names those that the
    caller reads, so that no others are parsed, shuffled and written.  Without it the view is a plain projection
    of one scan.
    """
    from pyspark.sql import functions as F
    from ..operators.ordered import next_in_group
    events = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    base = events.select(
        F.col("event_id").cast("string").alias("ride_id"),
        F.when(k >= 50, "electric_bike").otherwise("classic_bike").alias("rideable_type"),
        F.col("ts").alias("started_at"),
        F.col("event_type").alias("start_station_id"),
        (F.lit(40.70).cast("decimal(4,2)") + (F.col("user_id") % 100) * F.lit(0.001).cast("decimal(4,3)"))
        .cast("double").alias("start_lat"),
        (F.lit(-74.05).cast("decimal(4,2)") + k * F.lit(0.001).cast("decimal(4,3)")).cast("double").alias("start_lng"),
        (F.lit(40.70).cast("decimal(4,2)") + (F.col("event_id") % 100) * F.lit(0.001).cast("decimal(4,3)"))
        .cast("double").alias("end_lat"),
        (F.lit(-74.05).cast("decimal(4,2)") + (F.col("event_id") % 37) * F.lit(0.001).cast("decimal(4,3)"))
        .cast("double").alias("end_lng"),
        F.when(F.col("user_id") % 2 == 0, "member").otherwise("casual").alias("member_casual"),
        "user_id", "ts", "event_id", "event_type")
    if not ends:
        return base.select(*[c for c in TRIP_VIEW_COLUMNS if c not in TRIP_END_COLUMNS])
    columns = [c for c in TRIP_VIEW_COLUMNS if c in columns]
    base = base.select(*dict.fromkeys([*[c for c in columns if c not in TRIP_END_COLUMNS], "user_id", "ts", "event_id", "event_type"]))
    nxt = next_in_group(base, "user_id", ["ts", "event_id"], ["ts", "event_type"])
    return (nxt.withColumnsRenamed({"next_ts": "ended_at", "next_event_type": "end_station_id"})
            .select(*columns))


def trips_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with the user as the station: the high-cardinality entity."""
    from pyspark.sql import functions as F
    t = trips_view(spark, sf_dir)
    return t.withColumn("start_station_id", F.col("user_id").cast("string"))


# Orders as a multi-year trip table: the customer is the station and the
# customer name the station name.  Shared text with the SQL oracle; {END} is
# the engine's "order date plus (orderkey mod 90) minutes".
ORDERS_TRIPS_SQL = """
SELECT CAST(o.o_orderkey AS STRING) AS ride_id,
       CASE WHEN o.o_orderstatus = 'F' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
       o.o_orderdate AS started_at,
       {END} AS ended_at,
       c.c_name AS start_station_name,
       CAST(o.o_custkey AS STRING) AS start_station_id,
       c.c_name AS end_station_name,
       CAST(o.o_custkey AS STRING) AS end_station_id,
       CAST(40.70 + (o.o_custkey % 100) * 0.001 AS DOUBLE) AS start_lat,
       CAST(-74.05 + (o.o_custkey % 37) * 0.001 AS DOUBLE) AS start_lng,
       CAST(40.70 + (o.o_orderkey % 100) * 0.001 AS DOUBLE) AS end_lat,
       CAST(-74.05 + (o.o_orderkey % 37) * 0.001 AS DOUBLE) AS end_lng,
       CASE WHEN o.o_custkey % 2 = 0 THEN 'member' ELSE 'casual' END AS member_casual
FROM {orders} o LEFT JOIN {customer} c ON o.o_custkey = c.c_custkey
"""
SPARK_END = "timestampadd(MINUTE, o.o_orderkey % 90, o.o_orderdate)"
DUCK_END = "o.o_orderdate + to_minutes(CAST(o.o_orderkey % 90 AS BIGINT))"


def orders_trips_sql(engine: str = "duckdb", orders: str = "orders", customer: str = "customer") -> str:
    end = SPARK_END if engine == "spark" else DUCK_END
    sql = ORDERS_TRIPS_SQL.format(END=end, orders=orders, customer=customer)
    if engine != "spark":
        sql = sql.replace("AS STRING)", "AS VARCHAR)")
    return sql


def orders_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips over 1995-2001 from ``orders`` (13 raw trip columns, typed times)."""
    tag = abs(hash(sf_dir))
    read_table(spark, sf_dir, "orders").createOrReplaceTempView(f"_orders_{tag}")
    read_table(spark, sf_dir, "customer").createOrReplaceTempView(f"_customer_{tag}")
    return spark.sql(orders_trips_sql("spark", f"_orders_{tag}", f"_customer_{tag}"))

"""Registered queries: feature store and offline-store tables
(T1-T5, C18-C20, P6, W9, S7-S9, K3).

Upserts use the per-user hourly series in two overlapping batches (the second
with changed rides); the offline store and partition exports use it and
``lineitem`` by ship date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import prep as PR
from ..operators import store as S
from ..session import scratch_path
from ..sinks.writers import export_partitions
from ..sources.tables import read_table, trips_view
from . import oracle as O
from .q_core import user_series
from .registry import register, round_doubles

GROUP = "hourly_demand"
NOW1 = dt.datetime(2024, 2, 1, 8, 0, 0)
NOW2 = dt.datetime(2024, 2, 2, 9, 30, 0)
CUT1 = "2024-01-20 00:00:00"
CUT2 = "2024-01-15 00:00:00"


def baseline(spark, sf):
    return feat.project_baseline(feat.full_features(user_series(spark, sf)))


def batches(spark, sf):
    b = baseline(spark, sf)
    b1 = b.where(F.col("pickup_hour") < F.lit(CUT1).cast("timestamp_ntz"))
    b2 = (b.where(F.col("pickup_hour") >= F.lit(CUT2).cast("timestamp_ntz"))
          .withColumn("rides", F.col("rides") + 1))
    return b, b1, b2


def ordered_batches(spark, sf):
    """Both batches with a write order; the second writes each key twice, the larger value last.  Its rows are made once."""
    b, b1, b2 = batches(spark, sf)
    writes = F.inline(F.array(*[F.struct((F.col("rides") - less).alias("rides"), F.lit(n).alias("n")) for less, n in ((0, 2), (5, 1))]))
    return b, b1.withColumn("n", F.lit(1)), b2.select(*[c for c in b2.columns if c != "rides"], writes).select(*b2.columns, "n")


BASE_CTES = f"""{O.series_ctes('user')},
b AS (SELECT pickup_hour, start_station_id, rides,
        coalesce(CAST(lag(rides, 24) OVER w AS DOUBLE), 0) AS rides_lag_24h,
        coalesce(CAST(lag(rides, 168) OVER w AS DOUBLE), 0) AS rides_lag_168h
      FROM dense WINDOW w AS (PARTITION BY start_station_id ORDER BY pickup_hour)),
b1 AS (SELECT * FROM b WHERE pickup_hour < TIMESTAMP '{CUT1}'),
b2 AS (SELECT * REPLACE (rides + 1 AS rides) FROM b WHERE pickup_hour >= TIMESTAMP '{CUT2}'),
merged AS (SELECT * FROM b1 WHERE pickup_hour < TIMESTAMP '{CUT2}' UNION ALL SELECT * FROM b2)"""


# --- C18 / C19 -------------------------------------------------------------
@register("feature_json", f"""WITH {BASE_CTES}
SELECT '{GROUP}' AS feature_group, start_station_id AS entity_id,
       strftime(pickup_hour, '%Y-%m-%d %H:%M:%S') AS timestamp,
       to_json(struct_pack(rides := rides, rides_lag_24h := rides_lag_24h,
                           rides_lag_168h := rides_lag_168h))::VARCHAR AS feature_data FROM b""")
def q_feature_json(spark, sf):
    return S.feature_json(baseline(spark, sf), GROUP)


@register("feature_json_unpack", f"""WITH {BASE_CTES}
SELECT '{GROUP}' AS feature_group, start_station_id AS entity_id, pickup_hour AS timestamp,
       rides, rides_lag_24h, rides_lag_168h FROM b""")
def q_feature_json_unpack(spark, sf):
    b = baseline(spark, sf)
    return S.feature_json_unpack(S.feature_json(b, GROUP), S.feature_schema(b))


@register("feature_variant", f"""WITH {BASE_CTES}
SELECT '{GROUP}' AS feature_group, start_station_id AS entity_id, pickup_hour AS timestamp, rides, rides_lag_24h,
       CAST(NULL AS DOUBLE) AS rides_lag_168h FROM b1
UNION ALL
SELECT '{GROUP}', start_station_id, pickup_hour, rides, rides_lag_24h, rides_lag_168h FROM b2""")
def q_feature_variant(spark, sf):
    """C18/C19 where the second batch adds a feature: both in one table, read back by the wider list."""
    _, b1, b2 = batches(spark, sf)
    root = scratch_path(spark, "variant-store")
    for batch in (b1.drop("rides_lag_168h"), b2):
        S.feature_variant(batch, GROUP).write.mode("append").parquet(root)
    return S.feature_variant_unpack(spark.read.parquet(root),
                                    {"rides": "bigint", "rides_lag_24h": "double", "rides_lag_168h": "double"})


# --- T3 / T4 ---------------------------------------------------------------
def upserted(spark, sf):
    b, b1, b2 = ordered_batches(spark, sf)
    root = scratch_path(spark, "keyed-store")
    S.upsert_into_store(spark, root, S.feature_json(b1, GROUP, order_col="n"))
    S.upsert_into_store(spark, root, S.feature_json(b2, GROUP, order_col="n"))
    return S.read_store(spark, root), S.feature_schema(b)


@register("upsert_features", f"""WITH {BASE_CTES}
SELECT '{GROUP}' AS feature_group, start_station_id AS entity_id, pickup_hour AS timestamp,
       rides, rides_lag_24h, rides_lag_168h FROM merged""")
def q_upsert_features(spark, sf):
    store, schema = upserted(spark, sf)
    return S.feature_json_unpack(store, schema)


@register("get_features", f"""WITH {BASE_CTES}
SELECT '{GROUP}' AS feature_group, start_station_id AS entity_id, pickup_hour AS timestamp,
       rides, rides_lag_24h, rides_lag_168h FROM merged
WHERE start_station_id IN ('7', '8', '9')
  AND pickup_hour BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-16 23:00:00'""")
def q_get_features(spark, sf):
    store, schema = upserted(spark, sf)
    return S.get_features(store, GROUP, schema, ["7", "8", 9], "2024-01-10", "2024-01-16 23:00:00")


# --- T1 / T2 (one group per event type; a second registration updates some) --
def _groups(spark, sf):
    ev = trips_view(spark, sf).select("start_station_id").distinct()
    first = ev.select(F.concat(F.lit("demand_"), F.col("start_station_id")).alias("name"),
                      F.concat(F.lit("hourly demand of "), F.col("start_station_id")).alias("description"))
    second = (ev.where(F.col("start_station_id") >= "p")
              .select(F.concat(F.lit("demand_"), F.col("start_station_id")).alias("name"),
                      F.lit("updated").alias("description"))
              .unionByName(ev.select(F.concat(F.lit("trips_"), F.col("start_station_id")).alias("name"),
                                     F.lit("raw trips").alias("description"))))
    reg = S.upsert_feature_group(S.empty_registry(spark), first, NOW1)
    return S.upsert_feature_group(reg, second, NOW2)


REGISTRY_SQL = f"""WITH ev AS (SELECT DISTINCT event_type AS s FROM events),
r1 AS (SELECT 'demand_' || s AS name, 'hourly demand of ' || s AS description,
              TIMESTAMP '{NOW1}' AS created_at, TIMESTAMP '{NOW1}' AS updated_at FROM ev),
g2 AS (SELECT 'demand_' || s AS name, 'updated' AS description FROM ev WHERE s >= 'p'
       UNION ALL SELECT 'trips_' || s, 'raw trips' FROM ev),
reg AS (SELECT coalesce(g2.name, r1.name) AS name, coalesce(g2.description, r1.description) AS description,
               coalesce(r1.created_at, TIMESTAMP '{NOW2}') AS created_at,
               CASE WHEN g2.name IS NOT NULL THEN TIMESTAMP '{NOW2}' ELSE r1.updated_at END AS updated_at
        FROM r1 FULL OUTER JOIN g2 ON r1.name = g2.name)"""


@register("upsert_feature_group", REGISTRY_SQL + "\nSELECT * FROM reg")
def q_upsert_feature_group(spark, sf):
    return _groups(spark, sf)


@register("list_feature_groups", REGISTRY_SQL + "\nSELECT name, description, created_at FROM reg")
def q_list_feature_groups(spark, sf):
    return S.list_feature_groups(_groups(spark, sf))


# --- C20 / T5 / P6 / W9 ------------------------------------------------------
ISO = "'%Y-%m-%dT%H:%M:%SZ'"
FMT_COLS = f"""strftime(pickup_hour, {ISO}) AS pickup_hour, start_station_id, rides, rides_lag_24h,
  rides_lag_168h, start_station_id AS entity_id, strftime(pickup_hour, {ISO}) AS event_time"""


@register("store_format", f"""WITH {BASE_CTES}
SELECT {FMT_COLS}, '{NOW1:%Y-%m-%dT%H:%M:%SZ}' AS record_insertion_time FROM b""")
def q_store_format(spark, sf):
    return S.store_format(baseline(spark, sf), "start_station_id", "pickup_hour", NOW1)


def offline(spark, sf):
    _, b1, b2 = batches(spark, sf)
    root = scratch_path(spark, "offline-store")
    S.append_offline(b1, root, "start_station_id", "pickup_hour", NOW1)
    S.append_offline(b2, root, "start_station_id", "pickup_hour", NOW2)
    return spark.read.parquet(root)


OFFLINE_SQL = f"""WITH {BASE_CTES},
off AS (SELECT {FMT_COLS}, '{NOW1:%Y-%m-%dT%H:%M:%SZ}' AS record_insertion_time,
          CAST(year(pickup_hour) AS INTEGER) AS year, CAST(month(pickup_hour) AS INTEGER) AS month FROM b1
        UNION ALL
        SELECT {FMT_COLS}, '{NOW2:%Y-%m-%dT%H:%M:%SZ}', CAST(year(pickup_hour) AS INTEGER),
          CAST(month(pickup_hour) AS INTEGER) FROM b2)"""


@register("append_offline", OFFLINE_SQL + "\nSELECT * FROM off")
def q_append_offline(spark, sf):
    return offline(spark, sf)


@register("drop_metadata_columns", OFFLINE_SQL + """
SELECT pickup_hour, start_station_id, rides_lag_24h, rides_lag_168h, year, month FROM off""")
def q_drop_metadata_columns(spark, sf):
    return PR.drop_metadata_columns(offline(spark, sf), "rides")


@register("latest_record", OFFLINE_SQL + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_id
             ORDER BY event_time DESC, record_insertion_time DESC) AS rn FROM off)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1""")
def q_latest_record(spark, sf):
    return S.latest_record(offline(spark, sf))


# --- K3 / S7 / S8 / S9 over lineitem by ship date ------------------------------
LI_SQL = """WITH li AS (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS year,
                          CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem)"""


def export_lineitem(spark, sf):
    """All columns of lineitem as CSV under year=/month=: (folder, schema of the files)."""
    li = S.with_year_month(read_table(spark, sf, "lineitem"), "l_shipdate")
    root = scratch_path(spark, "lineitem-export")
    export_partitions(li, root)
    return root, li.schema


def exported(spark, sf):
    root, schema = export_lineitem(spark, sf)
    return spark.read.schema(schema).option("header", True).csv(root)


@register("export_partitions", LI_SQL + "\nSELECT * FROM li")
def q_export_partitions(spark, sf):
    return exported(spark, sf)


@register("scan_partition", LI_SQL + "\nSELECT * FROM li WHERE year = 1998 AND month = 3")
def q_scan_partition(spark, sf):
    return S.scan_partition(exported(spark, sf), 1998, 3)


@register("list_partitions", LI_SQL + "\nSELECT DISTINCT year, month FROM li ORDER BY year, month")
def q_list_partitions(spark, sf):
    return S.list_partitions(spark, export_lineitem(spark, sf)[0])


@register("inventory_partitions", LI_SQL + """
SELECT year, month, count(*) AS rows, true AS has_files, true AS csv_sample FROM li GROUP BY ALL ORDER BY year, month""")
def q_inventory_partitions(spark, sf):
    """S9; the number of files depends on Spark's layout, so the query tells that there are some."""
    root, schema = export_lineitem(spark, sf)
    inv = S.inventory_partitions(spark, root, spark.read.schema(schema).option("header", True).csv(root))
    return inv.select("year", "month", "rows", (F.col("files") > 0).alias("has_files"),
                      F.col("sample_file").endswith(".csv").alias("csv_sample"))

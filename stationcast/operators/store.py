"""Feature store as Spark tables.

Two layouts, both plain Parquet datasets:

* keyed store: ``feature_group, entity_id, timestamp, feature_data`` (JSON
  text of the non-key columns), unique on the first three, partitioned by
  (feature_group, month).  An upsert stages the partitions that its batch touches and
  overwrites exactly those.
* offline store: formatted feature rows appended under ``year=/month=``
  partitions, several versions of a record side by side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import ntz_literal

STORE_KEY = ("feature_group", "entity_id", "timestamp")
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
SECONDS = 10 ** 13      # more than the seconds between any two timestamps
MARK_BITS = 24          # log2 of the marks of newest records; 2 ^ 18 words of 64 go to every task


# --- C18 / C19 ---------------------------------------------------------------
def feature_json(df: DataFrame, feature_group: str, entity_col: str = "start_station_id",
                 ts_col: str = "pickup_hour", order_col: str | None = None) -> DataFrame:
    """Key columns + the other columns packed as JSON (nulls kept).

    ``order_col`` (a long) says which of a batch's rows of one key was written last; it
    travels as ``write_order`` and is not part of the payload."""
    feats = [c for c in df.columns if c not in (entity_col, ts_col, order_col)]
    order = [] if order_col is None else [F.col(order_col).cast("long").alias("write_order")]
    return df.select(
        F.lit(feature_group).alias("feature_group"),
        F.col(entity_col).cast("string").alias("entity_id"),
        F.col(ts_col).cast("string").alias("timestamp"),
        F.to_json(F.struct(*feats), {"ignoreNullFields": "false"}).alias("feature_data"), *order)


def feature_schema(df: DataFrame, entity_col: str = "start_station_id",
                   ts_col: str = "pickup_hour") -> T.StructType:
    """The JSON payload schema of a frame packed with ``feature_json``."""
    return T.StructType([f for f in df.schema.fields if f.name not in (entity_col, ts_col)])


def feature_json_unpack(store: DataFrame, schema: T.StructType) -> DataFrame:
    """Payload -> columns; ``timestamp`` parsed to a timestamp."""
    return store.select(
        "feature_group", "entity_id",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.from_json("feature_data", schema).alias("_f")).select(
        "feature_group", "entity_id", "timestamp", "_f.*")


def feature_variant(df: DataFrame, feature_group: str, entity_col: str = "start_station_id",
                    ts_col: str = "pickup_hour") -> DataFrame:
    """C18 with a VARIANT payload: batches whose features differ share one table, and Spark's Parquet writer can
    shred it, so a reader of one feature need not parse the others."""
    packed = feature_json(df, feature_group, entity_col, ts_col)
    return packed.withColumn("feature_data", F.parse_json("feature_data"))


def feature_variant_unpack(store: DataFrame, fields: dict[str, str]) -> DataFrame:
    """C19 of a VARIANT payload: name -> type of the wanted features; a feature that a row's batch did not have is null."""
    return store.select("feature_group", "entity_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                        *[F.try_variant_get("feature_data", f"$.{n}", t).alias(n) for n, t in fields.items()])


# --- T3 / T4 -----------------------------------------------------------------
def last_written(batch: DataFrame, order_col: str = "write_order") -> DataFrame:
    """One row per key of a batch: the one with the largest ``order_col`` (equal orders: the larger
    payload), by one grouped maximum that is combined map-side."""
    # the hash leads the sort of the grouping: the group name, one text for millions of rows, tells no rows apart
    best = (batch.groupBy(F.xxhash64(*STORE_KEY).alias("_hash"), *STORE_KEY)
            .agg(F.max(F.struct(F.col(order_col).alias("o"), "feature_data")).alias("_best")))
    return best.select(*STORE_KEY, F.col("_best.feature_data").alias("feature_data"))


def upsert_features(existing: DataFrame | None, batches: list[DataFrame],
                    order_col: str = "write_order") -> DataFrame:
    """Insert-or-replace on (feature_group, entity_id, timestamp); last write wins.

    Later batches win over earlier ones and over ``existing``; inside a batch the row with the
    largest ``order_col`` wins.  Each batch is reduced to one row per key first; old rows
    are kept by an anti join on the key and the two are put together -- the old rows are
    neither sorted nor aggregated.
    """
    out = existing
    for batch in batches:
        new = last_written(batch, order_col)
        if out is None:
            out = new
        else:
            out = (out.select(*STORE_KEY, "feature_data").join(new.select(*STORE_KEY), list(STORE_KEY), "left_anti")
                   .unionByName(new))
    return out


def get_features(store: DataFrame, feature_group: str, schema: T.StructType,
                 entity_ids=None, start_time=None, end_time=None) -> DataFrame:
    """T4: one group, optional id list (a single id is accepted), optional
    inclusive [start, end] compared as timestamps; payload unpacked.  Where the store has its
    partition column ``ts_month``, the range is also a predicate on it, which prunes folders."""
    df = store.where(F.col("feature_group") == feature_group)
    if entity_ids is not None and not isinstance(entity_ids, (list, tuple, set)):
        entity_ids = [entity_ids]
    if entity_ids:
        df = df.where(F.col("entity_id").isin([str(e) for e in entity_ids]))
    ts = F.col("timestamp").cast("timestamp_ntz")
    months = "ts_month" in store.columns
    if start_time is not None:
        lo = _as_datetime(start_time)
        df = df.where(ts >= ntz_literal(lo))
        df = df.where(F.col("ts_month") >= f"{lo:%Y-%m}") if months else df
    if end_time is not None:
        hi = _as_datetime(end_time)
        df = df.where(ts <= ntz_literal(hi))
        df = df.where(F.col("ts_month") <= f"{hi:%Y-%m}") if months else df
    return feature_json_unpack(df, schema)


def _as_datetime(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime.combine(v, dt.time.min)
    return dt.datetime.fromisoformat(str(v))


# --- T1 / T2 -----------------------------------------------------------------
REGISTRY_DDL = "name STRING, description STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"


def upsert_feature_group(registry: DataFrame, groups: DataFrame, now: dt.datetime) -> DataFrame:
    """(name, description) rows inserted, or updated (description,
    updated_at) keeping ``created_at``.  A full outer join on the name."""
    new = groups.select(F.col("name").alias("_name"), F.col("description").alias("_desc"))
    j = registry.join(new, registry["name"] == new["_name"], "full_outer")
    ts = ntz_literal(now)
    return j.select(
        F.coalesce("_name", "name").alias("name"),
        F.coalesce("_desc", "description").alias("description"),
        F.coalesce("created_at", ts).alias("created_at"),
        F.when(F.col("_name").isNotNull(), ts).otherwise(F.col("updated_at")).alias("updated_at"))


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_DDL)


def list_feature_groups(registry: DataFrame) -> DataFrame:
    """T2."""
    return registry.select("name", "description", "created_at")


# --- C20 / T5 / W9 -----------------------------------------------------------
def store_format(df: DataFrame, entity_col: str, ts_col: str, now: dt.datetime) -> DataFrame:
    """C20: every timestamp -> ISO-Z text; add entity_id, event_time, record_insertion_time."""
    if ts_col not in df.columns:
        raise ValueError(f"timestamp column {ts_col!r} not found")
    out = df.select(*[F.date_format(F.col(f.name), ISO_Z).alias(f.name)
                      if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
                      for f in df.schema.fields])
    return out.withColumns({
        "entity_id": F.col(entity_col).cast("string"),
        "event_time": F.col(ts_col),
        "record_insertion_time": F.lit(now.strftime("%Y-%m-%dT%H:%M:%SZ")),
    })


def append_offline(df: DataFrame, root: str, entity_col: str, ts_col: str, now: dt.datetime) -> None:
    """T5: formatted rows appended under year=/month= of the event time."""
    out = store_format(df, entity_col, ts_col, now)
    et = F.to_timestamp(F.col("event_time"), ISO_Z)
    out = out.withColumns({"year": F.year(et), "month": F.month(et)})
    out.write.mode("append").partitionBy("year", "month").parquet(root)


def latest_record(offline: DataFrame, entity_ids=None) -> DataFrame:
    """Newest record per entity_id (event_time, then insertion time).

    Both times are packed into one decimal (seconds of the event, then of the insertion), so one hash aggregate,
    combined map-side, finds each entity's newest pair: an entity with a third of all versions costs one row per
    task.  The records that carry the pair are joined back; before that, the older ones are dropped where they are read, by
    one mark bit for the hash of each newest (entity, pair): what is shuffled are the newest records and the few others
    whose bit is set by chance, not the store.  Repeated records give one row; a time that is missing or
    unreadable comes before all others.
    """
    df = offline
    if entity_ids is not None:
        df = df.where(F.col("entity_id").isin([str(e) for e in entity_ids]))

    def seconds(c):
        return F.coalesce(F.unix_seconds(F.to_timestamp(c, ISO_Z)), F.lit(-SECONDS // 2)) + SECONDS // 2

    timed = df.withColumn("_when", (seconds("event_time").cast("decimal(18,0)") * SECONDS + seconds("record_insertion_time"))
                          .cast("decimal(38,0)"))
    newest = timed.groupBy("entity_id").agg(F.max("_when").alias("_top"))

    def place(when):
        return F.pmod(F.xxhash64("entity_id", when), F.lit(1 << MARK_BITS))

    def bit(at):
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))

    marks = (newest.select(place("_top").alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word"))
             .agg(F.bit_or(bit(F.col("_at"))).alias("_bits")))
    marked = (timed.withColumn("_at", place("_when")).withColumn("_word", F.shiftright("_at", 6))
              .join(F.broadcast(marks), "_word").where(F.col("_bits").bitwiseAND(bit(F.col("_at"))) != 0)
              .drop("_word", "_bits", "_at"))
    return (marked.join(newest, "entity_id").where(F.col("_when") == F.col("_top")).drop("_when", "_top")
            .dropDuplicates(["entity_id"]))


# --- S7-S9 / K3 --------------------------------------------------------------
def scan_partition(table: DataFrame, year: int, month: int) -> DataFrame:
    """One (year, month) partition; pruned at the scan."""
    return table.where((F.col("year") == year) & (F.col("month") == month))


def partition_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per data file under ``root``: (path, year, month), from the file listing alone."""
    return spark.read.format("binaryFile").load(root).select("path", "year", "month")


def list_partitions(spark: SparkSession, root: str) -> DataFrame:
    """Distinct (year, month) of the folders, ordered; no data is read."""
    return partition_files(spark, root).select("year", "month").distinct().orderBy("year", "month")


def inventory_partitions(spark: SparkSession, root: str, table: DataFrame) -> DataFrame:
    """Per (year, month): number of data files (those without rows too), rows and one sample file name."""
    name = F.element_at(F.split("path", "/"), -1)
    files = (partition_files(spark, root).groupBy("year", "month")
             .agg(F.count(F.lit(1)).alias("files"), F.min(name).alias("sample_file")))
    rows = table.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))
    return (files.join(rows, ["year", "month"], "left")
            .select("year", "month", "files", F.coalesce("rows", F.lit(0)).alias("rows"), "sample_file")
            .orderBy("year", "month"))


def with_year_month(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts_col), "month": F.month(ts_col)})


# --- partition-scoped upsert into a keyed store ------------------------------
STORE_PARTS = ("feature_group", "ts_month")
FILES = 8     # least number of files of a partition, by entity: more than one task writes a large month
ROWS_A_FILE = 1_000_000
STORE_DDL = "entity_id STRING, timestamp STRING, feature_data STRING, feature_group STRING, ts_month STRING"


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """The keyed store as (entity_id, timestamp, feature_data, feature_group, ts_month), partitioned by the last two:
    predicates on them prune folders.  A store that nothing was written to is empty."""
    try:
        return spark.read.schema(STORE_DDL).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORE_DDL)


def publish(spark: SparkSession, root: str, staged: str) -> None:
    """Put staged partitions into the store: each partition that the staged table has is overwritten, the others stay.
    The staged table has those partitions whole, so a run that was lost here is finished by publishing again."""
    _overwrite_partitions(spark.read.schema(STORE_DDL).parquet(staged), root)


def _by_file(rows: DataFrame, n: int) -> DataFrame:
    """n rows, dealt to the tasks that write them: the files of a partition grow in number with the rows, not in size."""
    files = max(FILES, -(-n // ROWS_A_FILE))
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = [] if files <= width else [files]      # a given number is not lowered by the session
    return rows.repartition(*fixed, *STORE_PARTS, F.pmod(F.xxhash64("entity_id"), F.lit(files)))


def _overwrite_partitions(rows: DataFrame, root: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*STORE_PARTS).parquet(root)


def touched_rows(store: DataFrame, touched: DataFrame) -> DataFrame:
    """The store's rows in the touched partitions: first and last of each partition column (one row) prune the folders
    at planning, the semi join leaves out the others between them."""
    span = touched.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in STORE_PARTS for f in (F.min, F.max)]).first()
    for c in STORE_PARTS:
        store = store.where(F.col(c).between(span[f"min_{c}"], span[f"max_{c}"]))
    return store.join(touched, list(STORE_PARTS), "left_semi")


def upsert_into_store(spark: SparkSession, root: str, batch: DataFrame, order_col: str = "write_order",
                      staged: str | None = None) -> DataFrame:
    """T3 applied to a stored table, touching only the partitions the batch hits: (feature_group, ts_month) of those.

    The old rows of exactly those partitions are read (``touched_rows``), merged with the batch and staged as a table of their own in the shared folder; then the
    touched partitions are overwritten from it.  Lost before ``publish``: the store is as it was.  Lost inside it:
    ``publish(spark, root, staged)`` finishes the job.  Names are escaped by Spark's partition writer and read with an
    explicit schema, so a group may be called ``007`` or ``city:bike=1``.  One writer at a time.
    """
    from ..session import materialize, scratch_path
    new = materialize(last_written(batch, order_col).withColumn("ts_month", F.substring("timestamp", 1, 7)), "batch")
    touched = new.select(*STORE_PARTS).distinct()
    old = touched_rows(read_store(spark, root), touched)
    n_old, n_new = old.count(), new.count()      # from the files' footers
    if staged is None and not n_old:
        # new partitions hold the batch and nothing else, and the batch is a table already
        _overwrite_partitions(_by_file(new, n_new), root)
        return touched
    staged = staged or scratch_path(spark, "staged")
    by = ["_hash", *STORE_KEY]                   # the hash leads the sort of the join, as in ``last_written``
    kept = (old.withColumn("_hash", F.xxhash64(*STORE_KEY))
            .join(new.select(F.xxhash64(*STORE_KEY).alias("_hash"), *STORE_KEY), by, "left_anti"))
    columns = [f.split()[0] for f in STORE_DDL.split(", ")]
    rows = _by_file(kept.select(*columns).unionByName(new.select(*columns)), n_old + n_new)
    rows.write.partitionBy(*STORE_PARTS).parquet(staged)     # laid out as the store, which is then a copy without a shuffle
    publish(spark, root, staged)
    return touched

"""Trip files: monthly CSV layout, month-range scans and archive members."""

from __future__ import annotations

import csv
import io
import sys
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle as _cp
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TRIP_COLUMNS, TRIP_SCHEMA
from ..session import ensure_runtime
from .files import open_stream

_cp.register_pickle_by_value(sys.modules[__name__])

REQUIRED_COLUMNS = ("ride_id", "started_at", "ended_at", "start_station_id", "end_station_id")
MALFORMED = "_malformed"

# Text formats trips are published in (ISO, and month-first with minutes).
ISO_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MONTH_FIRST_TEXT = "MM-dd-yyyy HH:mm"


def write_trip_csv(trips: DataFrame, root: str, alt_format_when=None) -> None:
    """Write trips as header CSV under ``root/year=Y/month=M/`` (one job).

    Times become text; rows matching ``alt_format_when`` use the month-first
    format, the rest ISO text.
    """
    def text(c):
        iso = F.date_format(F.col(c), ISO_TEXT)
        if alt_format_when is None:
            return iso
        return F.when(alt_format_when, F.date_format(F.col(c), MONTH_FIRST_TEXT)).otherwise(iso)

    out = trips.select(
        *[text(c).alias(c) if c in ("started_at", "ended_at") else F.col(c).cast(TRIP_SCHEMA[c].dataType)
          for c in TRIP_COLUMNS],
        F.year("started_at").alias("year"), F.month("started_at").alias("month"))
    out.write.mode("overwrite").partitionBy("year", "month").option("header", True).csv(root)


def _first_lines(batches):
    for batch in batches:
        headers = []
        for path in batch.column("path").to_pylist():
            with open_stream(path) as f, io.TextIOWrapper(f, encoding="utf-8-sig") as text:
                headers.append(next(csv.reader(text), []))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(headers, pa.list_(pa.string()))],
                                         names=["path", "year", "month", "header"])


def header_catalogue(spark: SparkSession, root: str, first: int, last: int) -> dict[tuple[str, ...], list[str]]:
    """header -> month folders, of the months first..last (year * 12 + month) under ``root/year=Y/month=M/``.

    One pass: the listing is pruned by the partition columns, and each task reads the first record of its files.  Files of one
    folder must have the same header.  What comes to the driver is a row per month."""
    try:
        files = spark.read.format("binaryFile").load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    if not {"year", "month"} <= set(files.columns):
        return {}
    files = files.where((F.col("year") * 12 + F.col("month")).between(first, last)).select("path", "year", "month")
    headers = files.mapInArrow(_first_lines, "path string, year int, month int, header array<string>")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    months = (headers.groupBy("year", "month", folder.alias("folder")).agg(F.collect_set("header").alias("headers"))
              .orderBy("year", "month", "folder").collect())
    out: dict[tuple[str, ...], list[str]] = {}
    for m in months:
        if len(m["headers"]) > 1:
            raise ValueError(f"{m['folder']}: the files have different headers")
        out.setdefault(tuple(m["headers"][0]), []).append(m["folder"])
    return out


def read_trip_csv(spark: SparkSession, root: str, folders: list[str], header: tuple[str, ...]) -> DataFrame:
    """The trip files of folders with one header, columns taken by their names; ``year`` and ``month`` are the partition columns.

    The header gives the order; ``enforceSchema`` off makes Spark compare each
    file's own header with it, so a file that differs is an error and never read by position.
    Columns that trips need must be there; the others are null where the files lack them.
    Rows with too many or unreadable fields keep their text in ``_malformed``.
    """
    ensure_runtime(spark)
    missing = [c for c in REQUIRED_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"{folders[0]}: required columns are missing: {missing}")
    known = {f.name: f.dataType for f in TRIP_SCHEMA.fields}
    schema = T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in header]
                          + [T.StructField(MALFORMED, T.StringType())])
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("basePath", root)
          .option("columnPruning", False)   # a row is compared with the whole header, whatever is selected
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).csv(folders))
    return df.select(*[F.col(c) if c in header else F.lit(None).cast(known[c]).alias(c) for c in TRIP_COLUMNS], MALFORMED,
                     F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))


def malformed_rows(trips: DataFrame) -> DataFrame:
    """One row: how many rows could not be read as they stand, and how many have a ride id."""
    return trips.agg(F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"),
                     F.count("ride_id").alias("with_id"))


def _scan_months(spark: SparkSession, root: str, first: int, last: int) -> DataFrame:
    """The months first..last: one scan for each header order, whatever the number of months."""
    shapes = header_catalogue(spark, root, first, last)
    return union_months([read_trip_csv(spark, root, folders, header) for header, folders in shapes.items()])


def scan_trips(spark: SparkSession, root: str, year: int, month_start: int,
               month_end: int | None = None) -> DataFrame:
    """One year's months [month_start, month_end]; no such month is an error."""
    return _scan_months(spark, root, year * 12 + month_start, year * 12 + (month_end or month_start))


def month_range_scan(spark: SparkSession, root: str, start: tuple[int, int],
                     end: tuple[int, int]) -> DataFrame:
    """S3: (year, month) range across years: start-year months m..12, whole middle years and
    end-year months 1..m.  Absent months contribute nothing; a range without any is an error."""
    for _, m in (start, end):
        if not 1 <= m <= 12:
            raise ValueError(f"invalid month {m}")
    return _scan_months(spark, root, start[0] * 12 + start[1], end[0] * 12 + end[1])


def union_months(frames: list[DataFrame]) -> DataFrame:
    """L3: vertical concat (UNION ALL by name)."""
    if not frames:
        raise ValueError("no data loaded for the requested period")
    return reduce(lambda a, b: a.unionByName(b), frames)

"""Trip CSVs inside zip archives, read as a Spark job.

``binaryFile`` lists the archives and deals them out by size; their content is no column.  A ``mapInArrow``
task opens an archive where it lies, with seeks: the directory at its end names the first ``.csv`` member that is
not under ``__MACOSX/`` and not a dotfile, and only that member's bytes are read, unpacked as a stream and emitted
chunk by chunk as text columns.  So an archive may be larger than an executor's memory, and nothing passes the driver.
``every_member=True`` reads all such members of an archive, each in a task of its own.
"""

from __future__ import annotations

import io
import sys
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle as _cp
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TRIP_COLUMNS
from ..session import materialize
from .files import file_system, open_seekable, qualified

_cp.register_pickle_by_value(sys.modules[__name__])

TEXT_SCHEMA = ", ".join(f"{c} string" for c in TRIP_COLUMNS) + ", archive string"
ARROW_SCHEMA = pa.schema([(c, pa.string()) for c in [*TRIP_COLUMNS, "archive"]])
CHUNK_ROWS = 100_000


def csv_members(names: list[str]) -> list[str]:
    """CSV members that are neither macOS metadata nor hidden files."""
    return [n for n in names if n.lower().endswith(".csv") and not n.startswith("__MACOSX/")
            and not n.rsplit("/", 1)[-1].startswith(".")]


def pick_member(names: list[str]) -> str | None:
    return next(iter(csv_members(names)), None)


def _rows(zf: zipfile.ZipFile, archive: str, member: str):
    with zf.open(member) as fh:
        for chunk in pd.read_csv(fh, dtype=str, keep_default_na=False, chunksize=CHUNK_ROWS):
            out = chunk.reindex(columns=TRIP_COLUMNS).replace({"": None})
            out["archive"] = archive
            yield pa.RecordBatch.from_pandas(out, schema=ARROW_SCHEMA, preserve_index=False)


def _extract(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_seekable(path) as file, zipfile.ZipFile(file) as zf:
                member = pick_member(zf.namelist())
                if member is not None:
                    yield from _rows(zf, path, member)


def _list_members(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_seekable(path) as file, zipfile.ZipFile(file) as zf:
                names = csv_members(zf.namelist())
            yield pa.RecordBatch.from_pydict({"archive": pa.array([path] * len(names), pa.string()),
                                              "member": pa.array(names, pa.string())})


def _extract_member(batches):
    for batch in batches:
        for path, member in zip(*(batch.column(c).to_pylist() for c in ("archive", "member"))):
            with open_seekable(path) as file, zipfile.ZipFile(file) as zf:
                yield from _rows(zf, path, member)


def scan_zipped_csv(spark: SparkSession, pattern: str, every_member: bool = False) -> DataFrame:
    """Rows of every archive matching ``pattern`` (text columns + archive path)."""
    files = spark.read.format("binaryFile").load(pattern).select("path")
    if not every_member:
        return files.mapInArrow(_extract, TEXT_SCHEMA)
    members = materialize(files.mapInArrow(_list_members, "archive string, member string"), "members")
    return members.repartition(max(1, members.count())).mapInArrow(_extract_member, TEXT_SCHEMA)


def _pack(pdf: pd.DataFrame, root: str) -> pd.DataFrame:
    """Write one group's trips as ``<root>/<yyyymm>-<part>-trips.zip`` with junk members."""
    key = f"{pdf['_month'].iloc[0]}-{pdf['_part'].iloc[0]}"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("__MACOSX/._trips.csv", "junk")
        zf.writestr(".hidden.csv", "junk")
        zf.writestr(f"{key}-trips.csv", pdf[TRIP_COLUMNS].to_csv(index=False))
    fs, folder = file_system(root)
    fs.create_dir(folder, recursive=True)
    name = f"{key}-trips.zip"
    with fs.open_output_stream(f"{folder}/{name}") as out:
        out.write(buf.getvalue())
    return pd.DataFrame({"archive": [f"{root.rstrip('/')}/{name}"], "rows": [len(pdf)]})


def write_archives(trips: DataFrame, root: str, rows_per_archive: int = 20_000) -> DataFrame:
    """Package trips into zips of about ``rows_per_archive`` rows, by month and a hash of the ride: no
    group grows with the data.  ``root`` is a folder that all executors share; without a scheme it
    belongs to the session's default file system."""
    root = qualified(trips.sparkSession, root)
    parts = max(1, trips.count() // rows_per_archive)
    text = trips.select(*[F.col(c).cast("string").alias(c) for c in TRIP_COLUMNS],
                        F.date_format("started_at", "yyyyMM").alias("_month"),
                        F.pmod(F.xxhash64("ride_id"), F.lit(parts)).alias("_part"))
    return text.groupBy("_month", "_part").applyInPandas(lambda pdf: _pack(pdf, root), "archive string, rows long")

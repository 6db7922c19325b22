"""Files opened inside tasks: any path that Spark names, as a stream or with seeks."""

from __future__ import annotations

import sys
from urllib.parse import urlsplit

import pyarrow.fs as pafs
from pyspark import cloudpickle as _cp
from pyspark.sql import SparkSession

_cp.register_pickle_by_value(sys.modules[__name__])

SCHEMES = {"s3a": "s3", "s3n": "s3", "viewfs": "hdfs"}      # names that the storage library knows by another one


def file_system(path: str):
    """(file system, path on it) of a path as Spark writes it, ``file:/a b`` or ``hdfs://host/a``; names are not escaped."""
    scheme, _, rest = path.partition(":")
    if "/" in scheme or not rest:
        raise ValueError(f"{path!r} names no file system")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    host = urlsplit(path).netloc
    fs, base = pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{host}/")
    return fs, base.rstrip("/") + "/" + rest[2 + len(host):].lstrip("/")


def open_stream(path: str):
    """Sequential reader; compressed files are unpacked by their extension."""
    fs, name = file_system(path)
    return fs.open_input_stream(name, compression="detect")


def open_seekable(path: str):
    fs, name = file_system(path)
    return fs.open_input_file(name)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without belongs to the session's default file system, on every machine."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()

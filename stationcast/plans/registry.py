"""Query registry: one Spark callable (spark, sf_dir) -> DataFrame per operator
key, and where SQL can state it, the DuckDB oracle text for the same result.

Queries read the given tables (or what Spark derives from them) in full.  All
double columns are rounded to 6 places on both sides so that the two engines'
last-bit differences do not count as mismatches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def round_half_away(c, places: int = 6):
    """Round the binary double value: sign(x) * floor(|x| * 10^p + 0.5) / 10^p.

    This is the rule DuckDB's ``round(double, p)`` applies; Spark's ``round``
    works on the shortest decimal string instead, which splits exact ties
    (e.g. microseconds / 6e7) the other way.  The floor is taken in double
    arithmetic (w - w % 1), so no cast to bigint can overflow and no CASE
    is needed (a CASE per column tripled the cost of wide projections).
    """
    scale = float(10 ** places)
    x = F.col(c) if isinstance(c, str) else c
    w = F.abs(x) * scale + 0.5
    return F.signum(x) * (w - w % 1.0) / scale


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    cols = [round_half_away(f.name, places).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def load_all() -> None:
    """Import every module that registers queries (idempotent)."""
    from . import q_core, q_trips, q_reports, q_prep, q_store, q_models  # noqa: F401

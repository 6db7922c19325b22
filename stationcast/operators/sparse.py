"""Time-series features straight from the sparse hourly counts (J1 + W1-W5 without a dense grid).

Between two hours with trips nothing but the calendar changes on its own: every lag is one count or zero, and a rolling
window's sums are the difference of two prefix sums over the station's events.  So features need only the events and
the hours that are asked for:

* events and asked-for hours are hash-partitioned by station and sorted once; what is shuffled grows with them, not
  with stations x hours;
* an Arrow task holds whole stations (a station has one event per hour at most), numbers hours within a station so that
  no window reaches into another one, and answers all asked-for hours together: lags and window ends by binary search,
  mean and sample std from exact 64-bit prefix sums of counts and squares, the maximum from a doubling table over events
  (hours without trips count as 0);
* where every hour is asked for, rows are made in slices of ``SLICE``, never a station range at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import time_features
from ..session import ship_package
from .features import DEFAULT_WINDOW_SIZE, LAG_HOURS, ROLL_WINDOWS, full_feature_names, lag_names, rolling_names
from .series import hour_bounds, hourly_demand, series_partitions

HOUR_US = 3_600_000_000
HELD = 1 << 16          # sparse rows that a task answers together, whole stations
SLICE = 1 << 15         # rows that a task gives out at a time


class Events:
    """Counts of some stations at keys ``station * stride + hour``, sorted."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.sums = np.concatenate([[0], np.cumsum(counts)])
        self.squares = np.concatenate([[0], np.cumsum(counts * counts)])
        self.tops = [counts]                                  # tops[j][i]: maximum of 2^j events from i on
        while 2 << (len(self.tops) - 1) <= len(counts):
            last, step = self.tops[-1], 1 << (len(self.tops) - 1)
            self.tops.append(np.maximum(last[:-step], last[step:]))

    def at(self, keys: np.ndarray) -> np.ndarray:
        """The counts at some keys, 0 where there is none."""
        place = np.searchsorted(self.keys, keys)
        hit = place < len(self.keys)
        hit[hit] = self.keys[place[hit]] == keys[hit]
        out = np.zeros(len(keys), np.int64)
        out[hit] = self.counts[place[hit]]
        return out

    def window(self, keys: np.ndarray, end: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
        """(mean, max, sample std) over the last ``width`` hours; ``end``: events up to each key, ``rows``: hours so far."""
        begin = np.searchsorted(self.keys, keys - width, "right")
        m = np.minimum(rows, width).astype(float)
        a = (self.sums[end] - self.sums[begin]).astype(float)
        q = (self.squares[end] - self.squares[begin]).astype(float)
        pairs = m * (m - 1)
        spread = np.divide(m * q - a * a, pairs, out=np.zeros(len(m)), where=pairs > 0)
        n = end - begin
        top = np.zeros(len(keys), np.int64)
        level = np.frexp(np.maximum(n, 1))[1] - 1             # floor(log2 n)
        for j in np.unique(level[n > 0]):
            on = np.flatnonzero((level == j) & (n > 0))
            top[on] = np.maximum(self.tops[j][begin[on]], self.tops[j][end[on] - (1 << j)])
        # a window with an hour without trips reaches 0; one that is all events does not
        top = np.where((n > 0) & (n < m), np.maximum(top, 0), top)
        return a / m, top.astype(float), np.sqrt(np.maximum(spread, 0.0))


def _answers(events: Events, keys: np.ndarray, rows: np.ndarray, window_size: int) -> list[np.ndarray]:
    """rides, the lags and the rolling columns of the asked-for keys, in the order of the names."""
    lags = [events.at(keys - k).astype(float) for k in LAG_HOURS if k <= window_size]
    end = np.searchsorted(events.keys, keys, "right")
    rolls = [c for w in ROLL_WINDOWS if w <= window_size for c in events.window(keys, end, rows, w)]
    return [events.at(keys), *lags, *rolls]


def sparse_features(hourly: DataFrame, asked: DataFrame | None = None, bounds: DataFrame | None = None,
                    window_size: int = DEFAULT_WINDOW_SIZE, num_partitions: int | None = None) -> DataFrame:
    """Keys, rides, lags and rolling columns at the asked-for hours.

    hourly: (pickup_hour, start_station_id, rides), one row per station and hour with trips, rides an integer.
    asked: (pickup_hour, start_station_id) rows, each answered as often as it is asked; None asks for every hour of the
    global range and every station of ``hourly``.  A station without trips has zeros, an hour before the range has none
    behind it.  bounds: (_lo, _hi) of the series, else taken from ``hourly``.
    """
    spark = hourly.sparkSession
    ship_package(spark)
    if bounds is None:
        bounds = hourly.agg(F.min("pickup_hour").alias("_lo"), F.max("pickup_hour").alias("_hi"))
    rows = hourly.select("start_station_id", "pickup_hour", F.coalesce(F.col("rides").cast("bigint"), F.lit(0)).alias("rides"))
    if asked is not None:
        rows = rows.unionByName(asked.select("start_station_id", "pickup_hour", F.lit(None).cast("bigint").alias("rides")))
    n = num_partitions or series_partitions(spark)
    rows = (rows.crossJoin(F.broadcast(bounds)).repartition(n, "start_station_id")
            .sortWithinPartitions("start_station_id", "pickup_hour"))
    names = [*lag_names(window_size), *rolling_names(window_size)]
    station_type = hourly.schema["start_station_id"].dataType
    schema = T.StructType([T.StructField("pickup_hour", T.TimestampNTZType()), T.StructField("start_station_id", station_type),
                           T.StructField("rides", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in names]])
    every, widest = asked is None, max([1, *LAG_HOURS, *ROLL_WINDOWS])

    def answer(held: pa.Table) -> Iterator[pa.RecordBatch]:
        stations = pa.concat_arrays(held.column(0).chunks).dictionary_encode(null_encoding="encode")
        code = stations.indices.to_numpy().astype(np.int64)
        hour, low, high = (held.column(i).cast(pa.int64()).to_numpy() // HOUR_US for i in (1, 3, 4))
        low, hours = int(low[0]), int(high[0] - low[0]) + 1
        hour = hour - low
        is_event = held.column(2).is_valid().to_numpy()
        early, late = min(0, int(hour.min())), max(hours, int(hour.max()) + 1)      # asked-for hours may lie outside
        stride = late - early + widest + 1
        keys = code * stride + hour - early
        counts = held.column(2).fill_null(0).to_numpy()
        events = Events(keys[is_event], counts[is_event])
        wanted = len(stations.dictionary) * hours if every else int((~is_event).sum())
        given = None if every else (code[~is_event], hour[~is_event])
        for a in range(0, wanted, SLICE):
            if every:
                c, h = np.divmod(np.arange(a, min(a + SLICE, wanted)), hours)
            else:
                c, h = (x[a:a + SLICE] for x in given)
            columns = _answers(events, c * stride + h - early, np.maximum(h + 1, 1), window_size)
            yield pa.RecordBatch.from_arrays(
                [pa.array((h + low) * HOUR_US, pa.timestamp("us")), stations.dictionary.take(pa.array(c)),
                 *map(pa.array, columns)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) < HELD:
                continue
            whole = pa.Table.from_batches(held).combine_chunks()
            code = pa.concat_arrays(whole.column(0).chunks).dictionary_encode(null_encoding="encode").indices.to_numpy()
            cut = int(np.searchsorted(code, code[-1]))        # the last station may go on
            if cut:
                yield from answer(whole.slice(0, cut))
            held = whole.slice(cut).to_batches()
        if held and sum(x.num_rows for x in held):
            yield from answer(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema)


def full_features_from_trips(trips: DataFrame, asked: DataFrame | None = None, window_size: int = DEFAULT_WINDOW_SIZE,
                             num_partitions: int | None = None) -> DataFrame:
    """W5 from trips: 3 keys/target + 15 calendar + 12 lags + 9 rolling columns, at every hour or the asked-for ones."""
    out = sparse_features(hourly_demand(trips), asked, hour_bounds(trips), window_size, num_partitions)
    return time_features(out, "pickup_hour").select(*full_feature_names(window_size))

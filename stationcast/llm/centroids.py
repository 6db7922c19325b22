"""Centroid clustering by Orchard search.

Every round sends the centroids -- a few hundred numbers -- to the tasks.  Each centroid has a list of the others,
nearest first.  A vector starts at some centroid and reads that centroid's list: a closer one found there makes it jump
to the closer one's list, centroids already met are marked and not measured again, and it stops at the first entry
strictly farther from its centroid than twice the vector's own distance: by the triangle inequality all from there on
are strictly farther from the vector.  Distances are exact integers, compared as squares (gap > 4 * distance), and
ties go to the smaller number, so the result is that of a full search.

Tasks add up what they assign (numbers per cluster and component), Spark adds up the tasks' rows as decimals, and
the driver only sees the k * (dims + 1) sums.  The fixed-point vectors are written once to the shared folder; rounds
read them from there, so a lost executor repeats its own part of one round.

Results for odd rows: vectors of another length, null vectors and those with a null, NaN or infinite component are
left out; components beyond +-2^26 after scaling are held there, so that squared distances fit a long; a null vec_id
takes part and is hashed as empty text; equal hashes (repeated ids) are ordered by components; fewer kept vectors than
k give as many centroids, none give no rows; equal centroids leave all vectors to the smaller number; inertias beyond a long
are held at its largest value; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.session import ship_package

from .common import cut

K, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
LIMIT = 1 << 26
_LONG = 2**63 - 1


def fixed_point(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS,
                scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the kept vectors as integers floor(scale * x), written to the shared folder."""
    v = F.col(f"`{vec_col}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.lit(float(-LIMIT)), F.least(
        F.lit(float(LIMIT)), F.lit(float(scale)) * x.cast("double")))).cast("int"))
    return cut(vectors.filter((F.size(v) == dims) & finite).select(F.col(f"`{id_col}`").alias("vec_id"), whole.alias("v")),
               "fixed-point")


def first_centroids(rows: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:vec_id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select(key.alias("h"), "v").orderBy("h", "v").limit(k).collect()      # k rows
    return np.array([r["v"] for r in first], np.int64)


class Neighbours:
    """For each centroid the others, nearest first, with squared gaps."""

    def __init__(self, centres: np.ndarray):
        self.centres, k = centres, len(centres)
        gaps = np.array([((centres - c) ** 2).sum(axis=1) for c in centres])
        lists = [[s for s in np.lexsort((np.arange(k), gaps[c])) if s != c] for c in range(k)]
        self.order = np.array(lists, np.int64).reshape(k, k - 1)
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)
        spread = centres.max(axis=0) - centres.min(axis=0)
        self.widest = int(spread.argmax())
        self.along = np.argsort(centres[:, self.widest], kind="stable")

    def guess(self, x: np.ndarray) -> np.ndarray:
        """Where to start: the centroid nearest in the component in which the centroids differ most."""
        line = self.centres[self.along, self.widest]
        right = np.searchsorted(line, x[:, self.widest]).clip(0, len(line) - 1)
        left = (right - 1).clip(0)
        nearer = np.abs(x[:, self.widest] - line[left]) <= np.abs(x[:, self.widest] - line[right])
        return self.along[np.where(nearer, left, right)]

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest centroid, squared distance) of every row of x."""
        k = len(self.centres)
        at = self.guess(x)
        best = ((x - self.centres[at]) ** 2).sum(axis=1)
        met = np.zeros((len(x), k), bool)
        met[np.arange(len(x)), at] = True
        place = np.zeros(len(x), np.int64)
        going = np.arange(len(x) if k > 1 else 0)
        while len(going):
            other = self.order[at[going], place[going]]
            # gap > 4 * best without an overflow: strictly beyond twice the distance nothing can be as near
            near = (self.gaps[at[going], place[going]] + 3) // 4 <= best[going]
            going, other = going[near], other[near]
            new = ~met[going, other]
            rows, seen = going[new], other[new]
            met[rows, seen] = True
            far = ((x[rows] - self.centres[seen]) ** 2).sum(axis=1)
            closer = (far < best[rows]) | ((far == best[rows]) & (seen < at[rows]))
            place[going] += 1
            jump = rows[closer]
            at[jump], best[jump], place[jump] = seen[closer], far[closer], 0
            going = going[place[going] < k - 1]
        return at, best


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def moved(rows: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means; a centroid without vectors stays."""
    k, dims = centres.shape
    lists = Neighbours(centres)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), np.int64)          # the last column counts
        for b in batches:
            x = _matrix(b, dims)
            cluster, _ = lists.search(x)
            by = np.argsort(cluster, kind="stable")
            present, first = np.unique(cluster[by], return_index=True)
            if len(present):
                sums[present, :dims] += np.add.reduceat(x[by], first, axis=0)
                sums[:, dims] += np.bincount(cluster, minlength=k)
        c, d = np.nonzero(np.broadcast_to(sums[:, dims:] > 0, sums.shape))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(sums[c, d])],
                                         names=["cluster", "dim", "total"])

    summed = (rows.mapInArrow(add_up, "cluster int, dim int, total long").groupBy("cluster", "dim")
              .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())     # k * (dims + 1) rows
    totals = {(r["cluster"], r["dim"]): int(r["total"]) for r in summed}
    out = centres.copy()
    for c in range(k):
        if n := totals.get((c, dims)):
            out[c] = [totals[c, d] // n for d in range(dims)]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, id_col: str = "vec_id", vec_col: str = "embedding",
            dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 and centroid
    (its final centroid's components)."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = fixed_point(vectors, id_col, vec_col, dims, scale)
    id_type = rows.schema["vec_id"].dataType
    centres = first_centroids(rows, k, seed)
    schema = T.StructType([T.StructField("vec_id", id_type), T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])
    known = ("cluster int, centroid_sha256 string, centroid array<long>")
    if not len(centres):
        assigned, named = spark.createDataFrame([], schema), spark.createDataFrame([], known)
    else:
        for _ in range(rounds):
            centres = moved(rows, centres)
        lists = Neighbours(centres)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at, best = lists.search(_matrix(b, dims))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.int32()), pa.array(best)], names=schema.names)

        assigned = cut(rows.mapInArrow(assign, schema), "assigned")
        texts = [",".join(map(str, c)) for c in centres.tolist()]
        named = spark.createDataFrame([(c, hashlib.sha256(t.encode()).hexdigest(), centres[c].tolist())
                                       for c, t in enumerate(texts)], known)
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    held = lambda c: F.least(c, F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    per = assigned.groupBy("cluster").agg(total.alias("c"))                       # k rows at most
    whole = per.agg(F.sum("c").alias("t"))
    sums = (per.crossJoin(F.broadcast(whole)).join(F.broadcast(named), "cluster")
            .select("cluster", held(F.col("c")).alias("cluster_inertia"), held(F.col("t").cast("decimal(38,0)")).alias("inertia"),
                    "centroid_sha256", "centroid"))
    return assigned.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def _sql(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same rounds by full search.  d * k + c orders by distance, then number."""
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
                    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
                FROM embeddings WHERE len(embedding) = {dims}
                  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dims})""",
             f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, p) - 1 AS BIGINT) AS c, p AS q FROM (
                SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, p FROM v ORDER BY h, p LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT rid, min(list_sum(list_transform(range(1, {dims + 1}),
                    lambda i: (p[i] - q[i]) * (p[i] - q[i]))) * {k} + c) AS best FROM v CROSS JOIN c{i} GROUP BY rid)""")
        if i < rounds:
            parts.append(f"""m{i} AS MATERIALIZED (SELECT c, list(f ORDER BY i) AS q FROM (
                    SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS f FROM (
                        SELECT best % {k} AS c, i, sum(p[i]) AS s, count(*) AS n
                        FROM a{i} JOIN v USING (rid) CROSS JOIN (SELECT unnest(range(1, {dims + 1})) AS i) GROUP BY 1, 2)) GROUP BY c)""")
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT old.c, coalesce(new.q, old.q) AS q
                FROM c{i} AS old LEFT JOIN m{i} AS new ON new.c = old.c)""")
    return "WITH " + ",\n".join(parts) + f"""
        SELECT vec_id, CAST(best % {k} AS INTEGER) AS cluster, CAST(best // {k} AS BIGINT) AS distance,
               CAST(sum(best // {k}) OVER (PARTITION BY best % {k}) AS BIGINT) AS cluster_inertia,
               CAST(sum(best // {k}) OVER () AS BIGINT) AS inertia, sha256(array_to_string(q, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} ON c = best % {k}"""


SQL = _sql()

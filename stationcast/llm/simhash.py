"""SimHash near duplicates by bit-sliced comparison.

1. *Fingerprints.*  One narrow pass hashes every 3-word shingle (XXH64, repeats included) and sets the bits that more
   than half of the hashes have.  Equal fingerprints are one class with its smallest doc_id.
2. *Buckets.*  Two fingerprints within the radius agree on one of radius + 1 parts of their bits, so every class goes to
   radius + 1 buckets.  A bucket with more than LIMIT classes is not compared: its classes move on to radius + 1
   finer ones, in which a further part of the remaining bits must agree too.  Classes differ, so a bucket over r
   remaining bits holds 2^r at most, and after a few levels every bucket fits: no cap, no pair lost.
3. *Bit-sliced comparison.*  Buckets lie next to each other as lanes; the 64 bits of the lanes are stored as 64 vertical
   planes of machine words.  All lanes are compared with the lanes j places on at once: plane by plane the differing
   bits go into carry-save counters (one word holds a counter bit of 64 comparisons), and a word is abandoned once all
   its comparisons exceed the radius, lie in two buckets or join what is joined already.
4. A bucket gives the links that join its classes (fewer than it has classes), never all pairs; connected components
   of those links decide.

Results for odd rows: null texts and texts without words have fingerprint zero and link like any other; fewer than
three words are one shingle; repeated rows share a class; a row with a null doc_id takes part, and its component
has the smallest doc_id that is not null (null if there is none); an empty table gives no rows; other columns are ignored.
Long texts are hashed in blocks of BLOCK bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.session import ship_package

from .common import cut
from .components import connected

WORDS, RADIUS, SEED, BITS = 3, 2, 42, 64
LIMIT = 4096            # most classes of a bucket that is compared
LANES = 1 << 15         # classes that are compared together, whole buckets
STRIP = 1 << 14         # words of 64 comparisons that are counted together
BLOCK = 1 << 20         # bytes of a text that are cut into words at a time
HOT = 4096              # classes with more than 1 / HOT of all rows are broadcast: fewer than HOT

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; bytes.split knows the six ASCII white-space characters only."""
    at = 0
    while at < len(text):
        gap = _SPACE.search(text, at + BLOCK) if at + BLOCK < len(text) else None
        end = gap.start() if gap else len(text)
        yield text[at:end].split()
        at = end + 1


def shingle_hashes(words: list[bytes], width: int = WORDS) -> np.ndarray:
    """XXH64 of every run of ``width`` words, space-joined; fewer words are one run."""
    joined, width = b" ".join(words), min(width, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashed = xxhash.xxh64_intdigest
    return np.fromiter([hashed(joined[a:b], SEED) for a, b in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())],
                       np.uint64)


def fingerprint(text: str | None) -> int:
    """Bits set in over half of the shingles' hashes, as a signed integer."""
    ones, total, rest = np.zeros(BITS, np.int64), 0, []
    for words in word_blocks((text or "").encode().lower()):
        rest += words
        if len(rest) >= WORDS:
            ones, total = _count(rest, ones, total)
            rest = rest[1 - WORDS:]
    if not total and rest:
        ones, total = _count(rest, ones, total)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def _count(words: list[bytes], ones: np.ndarray, total: int) -> tuple[np.ndarray, int]:
    hashes = shingle_hashes(words)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return ones + bits.sum(axis=0, dtype=np.int64), total + len(hashes)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = [fingerprint(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks, pa.int64())], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def finer(mask: int, radius: int = RADIUS) -> list[int]:
    """radius + 1 masks: the bits of ``mask`` and one part each of those that it leaves open."""
    left = [b for b in range(BITS) if not mask >> b & 1]
    parts = [left[i * len(left) // (radius + 1):(i + 1) * len(left) // (radius + 1)] for i in range(radius + 1)]
    return [mask | sum(1 << b for b in part) for part in parts if part]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def next_level(rows: DataFrame, masks: list[int], radius: int) -> tuple[DataFrame, list[int]]:
    """rows (fp, mask) once for each finer mask of their mask; all masks of the new level."""
    step = {m: finer(m, radius) for m in masks}
    table = F.create_map(*[x for m, new in step.items()
                           for x in (F.lit(signed(m)), F.array(*[F.lit(signed(n)) for n in new]))])
    fine, out = sorted({n for new in step.values() for n in new}), rows.select("fp", F.explode(table[F.col("mask")]).alias("mask"))
    # later levels come to some masks by two ways
    return (out if len(fine) == sum(map(len, step.values())) else out.distinct()), fine


def buckets(classes: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> list[DataFrame]:
    """Tables (mask, key, fp) with at most ``limit`` classes in each (mask, key); two classes within the
    radius meet in at least one bucket.  classes: fp, distinct."""
    done, masks = [], [0]
    rows = classes.select("fp", F.lit(0).cast("long").alias("mask"))
    while True:
        rows, masks = next_level(rows, masks, radius)
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        most = max(BITS - m.bit_count() for m in masks)
        if 1 << most <= limit:
            return [*done, rows]
        crowded = cut(rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > limit)
                      .select("mask", "key"), "crowded")
        if crowded.isEmpty():
            return [*done, rows]
        done.append(rows.join(crowded, ["mask", "key"], "left_anti"))
        rows = cut(rows.join(crowded, ["mask", "key"], "left_semi").select("fp", "mask"), "moved-on")


def exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius, or was."""
    above, equal = np.zeros_like(over), np.full_like(over, _ALL)
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal = equal & counters[i]
        else:
            above, equal = above | equal & counters[i], equal & ~counters[i]
    return over | above


def near_lanes(planes: np.ndarray, word: np.ndarray, lag: np.ndarray, over: np.ndarray, radius: int) -> tuple:
    """(places, lanes): the words of comparisons, by their place, in which some lane is within the radius of the lane
    ``lag`` places on, and those lanes.  over: lanes that need no comparison."""
    place, counters = np.arange(len(word)), [np.zeros(len(word), np.uint64) for _ in range(radius.bit_length())]
    q, r = word + (lag >> 6), (lag & 63).astype(np.uint64)
    back = np.uint64(63) - r
    for b in range(BITS):
        line = planes[b]
        carry = line[word] ^ (line[q] >> r | line[q + 1] << back << np.uint64(1))
        for i, c in enumerate(counters):
            counters[i], carry = c ^ carry, c & carry
        over = over | carry
        if b % 8 == 7:
            over = exceeds(counters, over, radius)
            alive = over != _ALL
            if b == BITS - 1 or 4 * np.count_nonzero(alive) < 3 * len(alive):
                place, word, q, r, back, over = (x[alive] for x in (place, word, q, r, back, over))
                counters = [c[alive] for c in counters]
                if not len(place):
                    break
    return place, ~over


def joined(fps: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that join the classes of each bucket which chains of near ones connect: fewer than there are classes.
    fps: unsigned; bucket: numbers, equal ones next to each other."""
    _, number, size = np.unique(bucket, return_inverse=True, return_counts=True)
    sized = size[number]
    by = np.lexsort((number, -sized))                       # large buckets first, so that long lags need few words
    by = by[:np.count_nonzero(sized > 1)]
    fps, number, sized, n = fps[by], number[by], sized[by], len(by)
    if not n:
        return []
    longest = int(sized[0])
    bits = np.zeros((-(-n // 64) + longest // 64 + 2) * 64, np.uint8)
    planes = np.empty((BITS, len(bits) // 64), np.uint64)
    for b in range(BITS):
        bits[:n] = fps >> np.uint64(b) & np.uint64(1)
        planes[b] = np.packbits(bits, bitorder="little").view(np.uint64)
    root, links, lag = np.arange(n), [], 1
    while lag < longest:
        lanes = int(np.searchsorted(-sized, -lag))          # those in buckets of more than ``lag`` classes
        wide = -(-lanes // 64)
        lags = np.arange(lag, min(longest, lag + max(1, STRIP // wide)))
        wanted = np.zeros((len(lags), wide * 64), np.uint8)
        for i, j in enumerate(lags):
            m = min(lanes, n - j)
            wanted[i, :m] = (number[:m] == number[j:j + m]) & (root[:m] != root[j:j + m])
        need = np.packbits(wanted, axis=1, bitorder="little").view(np.uint64)
        i, word = np.nonzero(need)
        place, near = near_lanes(planes, word, lags[i], ~need[i, word], radius)
        if len(place):
            at, bit = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            left = word[place[at]] * 64 + bit
            jump = lags[i[place[at]]]
            for j in np.unique(jump):
                a = left[jump == j]
                a = a[root[a] != root[a + j]]
                links += _join(root, a, a + j)
                while (root != (flat := root[root])).any():
                    root = flat
        lag = int(lags[-1]) + 1
    return [(int(fps[a]), int(fps[b])) for a, b in links]


def _join(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Union by the smaller place; the pairs that joined something."""
    used = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = a, b
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            used.append((a, b))
    return used


def bucket_links(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links within the buckets of rows (mask, key, fp).  Buckets are bounded, so any share of them fits a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), np.int64)

        def links(rows: np.ndarray) -> pa.RecordBatch:
            new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)] if len(rows) else np.empty(0, bool)
            pairs = np.array(joined(rows[:, 2].copy().view(np.uint64), np.cumsum(new), radius), np.uint64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, i].copy().view(np.int64)) for i in (0, 1)], names=["a", "b"])

        for b in batches:
            held = np.concatenate([held, np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)])
            if len(held) >= LANES:
                last = np.flatnonzero((held[:, :2] != held[-1, :2]).any(axis=1))     # the last bucket may go on
                if len(last):
                    yield links(held[:last[-1] + 1])
                    held = held[last[-1] + 1:]
        yield links(held)

    return (rows.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
            .mapInArrow(run, "a long, b long"))


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                       limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that links reach), n_links
    (links of its fingerprint's class that were used to join the component)."""
    if not 1 <= radius < BITS or limit > LIMIT:
        raise ValueError(f"radius must be 1 to {BITS - 1} and limit at most {LIMIT}")
    table = cut(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = cut(table.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("k")), "classes")
    found = [bucket_links(rows, radius) for rows in buckets(classes, radius, limit)]
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    edges = cut(edges.distinct(), "links-found")
    ends = edges.select(F.explode(F.array("a", "b")).alias("fp"))
    nodes = ends.groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    found = connected(nodes.select(F.col("fp").alias("cls"), F.col("fp").alias("comp")), edges)
    of = (classes.join(found.withColumnRenamed("cls", "fp"), "fp", "left").join(nodes, "fp", "left")
          .select("fp", "least", "k", F.coalesce("comp", "fp").alias("comp"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    first = of.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = cut(of.join(first, "comp").select("fp", "k", "component_id", "n_links"), "components")
    # fingerprints of many rows are looked up without a shuffle: fewer than HOT, as their shares add up to one
    total = known.agg(F.sum("k").alias("total"))
    hot = cut(known.crossJoin(F.broadcast(total)).filter(F.col("k") * HOT > F.col("total"))
              .select("fp", "component_id", "n_links"), "hot-classes")
    by_hot = table.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), "fp", "left")
    rest = (by_hot.filter("__hot is null").select("doc_id", "fp")
            .join(known.select("fp", "component_id", "n_links"), "fp"))
    both = by_hot.filter("__hot").select("doc_id", "fp", "component_id", "n_links").unionByName(
        rest.select("doc_id", "fp", "component_id", "n_links"))
    return both.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")

"""SimHash near duplicates against all pairs of fingerprints."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stationcast.llm import simhash
from odd import SCHEMA, given, odd_docs


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(marks, radius=2):
    """Smallest index that links reach, over all pairs."""
    root = list(range(len(marks)))
    for i, x in enumerate(marks):
        for j in range(i):
            if (x ^ marks[j]).bit_count() <= radius:
                a, b = i, j
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                root[max(a, b)] = min(a, b)
    out = []
    for i in range(len(marks)):
        while root[i] != i:
            i = root[i]
        out.append(i)
    return out


def brute(rows):
    marks = [plain_fingerprint(t) for _, t in rows]
    of, least = components(marks), {}
    for (d, _), r in zip(rows, of):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted(((d, f"{m:016x}", least.get(r)) for (d, _), m, r in zip(rows, marks, of)), key=str)


def result(docs, **args):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.simhash_duplicates(docs, **args).collect()), key=str)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    assert result(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_given_table(spark):
    docs = given(spark, sf="/root/testdata/sf0.01")
    assert result(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark):
    assert result(odd_docs(spark, [])) == []


def test_spark_hash_is_the_same(spark):
    words = ["a b c", "ä ö ü", ""]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()]
    assert [g % (1 << 64) for g in got] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_blocks_of_a_long_text():
    random.seed(3)
    text = "  ".join(random.choice(["Aa", "b", "ccc", "ä"]) + random.choice(["", "\t", "\n\n"]) for _ in range(4000))
    before, simhash.BLOCK = simhash.BLOCK, 37
    try:
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)
    finally:
        simhash.BLOCK = before


def cluster_of_marks(seed, n=700):
    """Random marks, chains of marks one or two bits apart, and dense balls around some centres."""
    rnd = random.Random(seed)
    marks = {rnd.getrandbits(64) for _ in range(n // 4)}
    for size, bits in ((n // 4, 64), (n // 4, 12), (n // 4, 5)):
        x = rnd.getrandbits(64)
        for _ in range(size):
            y = x
            for _ in range(rnd.choice([1, 2, 3])):
                y ^= 1 << rnd.randrange(bits)
            marks.add(y)
            if rnd.random() < 0.3:
                x = y
    return sorted(marks)


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_comparison_in_buckets(radius):
    """The bit-sliced comparison joins what all pairs join, in each bucket alone and with fewer links than classes."""
    marks = np.array(cluster_of_marks(radius), np.uint64)
    bucket = np.sort(np.random.default_rng(radius).integers(0, 5, len(marks)))
    bucket[-90:] = np.arange(90) + 10
    links = simhash.joined(marks, bucket, radius)
    place = {int(m): i for i, m in enumerate(marks)}
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        assert (a ^ b).bit_count() <= radius and bucket[place[a]] == bucket[place[b]] and find(place[a]) != find(place[b])
        root[max(find(place[a]), find(place[b]))] = min(find(place[a]), find(place[b]))
    for k in np.unique(bucket):
        at = np.flatnonzero(bucket == k)
        want = components([int(m) for m in marks[at]], radius)
        groups = {}
        for i, w in zip(at, want):
            groups.setdefault(w, set()).add(find(int(i)))
        assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


@pytest.mark.parametrize("limit", [16, 4096])
def test_crowded_buckets_are_refined(spark, limit):
    """Small limits send most classes through several levels; nothing is lost and every bucket holds to the limit."""
    marks = cluster_of_marks(11)
    classes = spark.createDataFrame([(simhash.signed(m),) for m in marks], "fp long")
    levels = simhash.buckets(classes, 2, limit)
    assert len(levels) > 1 if limit == 16 else len(levels) == 1
    found = set()
    for rows in levels:
        sizes = [r["count"] for r in rows.groupBy("mask", "key").count().collect()]
        assert max(sizes, default=0) <= limit
        found |= {(r["a"], r["b"]) for r in simhash.bucket_links(rows).collect()}
    place = {simhash.signed(m): i for i, m in enumerate(marks)}
    root = list(range(len(marks)))
    for a, b in sorted(found):
        x, y = place[a], place[b]
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        root[max(x, y)] = min(x, y)
    got = []
    for i in range(len(marks)):
        while root[i] != i:
            i = root[i]
        got.append(i)
    assert got == components(marks)


def test_five_levels_bound_every_bucket():
    level = {0}
    for _ in range(5):
        level = {m for mask in level for m in simhash.finer(mask)}
    assert 1 << max(64 - m.bit_count() for m in level) <= simhash.LIMIT


def test_hot_fingerprint_and_clashing_columns(spark):
    rows = [(i, "the same few words here", "en", "a", 1, "x", None, 7, "y", "z") for i in range(300)]
    rows += [(1000 + i, f"w{i} x{i} y{i} z{i}", "en", "a", 1, "x", None, 7, "y", "z") for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit(1)).withColumn("__hot", F.lit(2)).withColumn("key", F.lit("k"))
    got = {d: c for d, _, c in result(docs)}
    assert all(got[i] == 0 for i in range(300)) and len(got) == 400

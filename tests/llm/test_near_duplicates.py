"""The n-gram Jaccard join against all pairs of small tables."""

import random
from collections import defaultdict

import numpy as np
import pytest

from stationcast.llm import ngram_join
from stationcast.llm.components import connected
from odd import SCHEMA, given, odd_docs


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in by[x] if j < i}:
            shared = len(s & sets[j])
            if 100 * shared >= 80 * (len(s) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows) if d is not None)


def result(docs):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()
                  if r["doc_id"] is not None)


@pytest.mark.parametrize("which", ["odd", "given"])
def test_against_all_pairs(spark, which):
    docs = odd_docs(spark) if which == "odd" else given(spark, sf="/root/testdata/sf0.01")
    assert result(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def near_copies(seed, groups=6, size=25, passage=60):
    """Groups of edited copies, with edits around the threshold, and a passage that many texts share."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    common = rng.choices(vocabulary, k=passage)
    out = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice((6, 12, 40, 120, 300)))
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 5))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words += [rng.choice(vocabulary)] * rng.randint(1, 3)
            if rng.random() < 0.2:
                words = common + words
            out.append(" ".join(words))
    out += [" ".join(common + rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(40)]
    rng.shuffle(out)
    return [(i, t, "en", "s", 1, None, None, None, None, None) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_copies_and_shared_passages(spark, seed):
    rows = near_copies(seed)
    want = brute([(r[0], r[1]) for r in rows])
    assert result(odd_docs(spark, rows)) == want
    assert len({c for _, _, c in want}) < len(rows)


def test_listing_all_pairs_at_once_gives_the_same(spark, monkeypatch):
    rows = near_copies(3, groups=4)
    want = brute([(r[0], r[1]) for r in rows])
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "COST", 2)
    assert result(odd_docs(spark, rows)) == want


def test_one_document_of_each_group_stays(spark):
    docs = odd_docs(spark, near_copies(4, groups=3))
    groups = {c for _, _, c in result(docs)}
    left = ngram_join.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == groups
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_join.near_duplicates(empty).count() == 0 and ngram_join.drop_near_duplicates(empty).count() == 0


def test_one_row_stays_with_repeated_and_null_ids(spark):
    base = " ".join(f"t{i}" for i in range(60))
    rows = [(1, base), (1, base), (None, base), (4, base + " more"), (None, "quite another text of some more words here"),
            (None, "quite another text of some more words here"), (7, ""), (7, ""), (None, None)]
    docs = odd_docs(spark, [(i, t, "en", "s", 1, None, None, None, None, None) for i, t in rows])
    left = sorted(((r["doc_id"], r["text"]) for r in ngram_join.drop_near_duplicates(docs).collect()), key=str)
    assert left == sorted([(1, base), (None, rows[4][1]), (7, ""), (7, ""), (None, None)], key=str)


def test_misra_gries_counts_are_lower_bounds():
    rng = np.random.default_rng(3)
    keys = np.concatenate([np.full(4000, 7), np.full(2500, 9), rng.integers(100, 10 ** 9, 6000)])
    rng.shuffle(keys)
    top = ngram_join.Frequent(50)
    for part in np.array_split(keys, 9):
        top.add(part)
    found = dict(zip(top.keys.tolist(), top.counts.tolist()))
    assert 4000 - len(keys) / 51 <= found[7] <= 4000 and 2500 - len(keys) / 51 <= found[9] <= 2500


def test_differing_bits_are_a_lower_bound():
    rng = np.random.default_rng(9)
    for _ in range(50):
        x = np.unique(rng.integers(-2 ** 62, 2 ** 62, rng.integers(1, 900)))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.8], rng.integers(-2 ** 62, 2 ** 62, 40)]))
        differ = np.unpackbits((ngram_join.parity_bits(x) ^ ngram_join.parity_bits(y)).view(np.uint8)).sum()
        assert differ <= len(np.setxor1d(x, y))


def test_long_chain_of_components(spark):
    nodes = spark.createDataFrame([(i, i) for i in range(200)], "cls long, comp long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(120)] + [(150, 160)], "a long, b long")
    got = {r["cls"]: r["comp"] for r in connected(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(121)) and got[160] == 150 and got[199] == 199


def test_shuffled_path_of_components(spark):
    ids = list(range(3000))
    random.Random(5).shuffle(ids)
    nodes = spark.createDataFrame([(i, i) for i in ids], "cls long, comp long")
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    assert {r["comp"] for r in connected(nodes, edges).collect()} == {0}


def test_pairs_of_long_texts_are_listed_whole(spark):
    """Pairs that share many groups meet at a few of them only; none is lost, whatever they need."""
    rng = random.Random(3)
    sets = {c: {t for t in range(300) if rng.random() < share} for c, share in
            enumerate([0.9, 0.9, 0.7, 0.5, 0.3, 0.1, 0.05, 0.02, 0.02, 0.01, 0.01, 0.01])}
    matches = {c: 1 + c % 4 for c in sets}
    comp = {c: c // 2 for c in sets}
    rows = [(t, c, 1000, matches[c], comp[c], 1, [0] * (ngram_join.BITS // 64)) for c, s in sets.items() for t in s]
    table = spark.createDataFrame(rows, "token long, cls long, n long, matches int, comp long, weight long, bits array<long>")
    got = {(r["a"], r["b"]) for r in ngram_join.all_pairs(table).collect()}
    assert got == {(a, b) for a in sets for b in sets if a < b and comp[a] != comp[b]
                   and len(sets[a] & sets[b]) >= min(matches[a], matches[b])}

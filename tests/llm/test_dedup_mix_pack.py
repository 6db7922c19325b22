"""Exact dedup, source mix and packing against plain Python."""

import zlib
from collections import Counter, defaultdict
from itertools import combinations, combinations_with_replacement

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationcast.llm import common, exact_dedup, mixing, packing
from odd import SCHEMA, given, low, odd_docs


@pytest.mark.parametrize("which", ["odd", "given"])
def test_dedup_against_dictionary(spark, which):
    docs = odd_docs(spark) if which == "odd" else given(spark)
    rows = docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[low(r["text"])].append(r["doc_id"])
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    got = exact_dedup.dedup_decisions(docs).collect()
    want = Counter((r["doc_id"], best[low(r["text"])], len(groups[low(r["text"])])) for r in rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert Counter(low(r["text"]) for r in kept.collect()) == Counter(groups.keys())


def test_heavy_and_light_digests_agree(spark):
    """With two counters nearly all groups take the shuffled path; the decisions stay the same."""
    rows = [(i, f"t{i % 5}" if i % 3 else "hot", "en", "s", 1, None, None, None, None, None) for i in range(300)]
    docs = odd_docs(spark, rows)
    key = lambda d: sorted(tuple(r) for r in d.collect())
    assert key(exact_dedup.dedup_decisions(docs)) == key(exact_dedup.dedup_decisions(docs, heavy=1, tracked=8))
    assert exact_dedup.heavy_digests(exact_dedup.digests(docs)).count() == 6


def reshared(sizes, share=1.5, cap=2.0):
    """Targets by repeated resharing: over-full sources stop at the cap, the rest share on."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), {}
    while True:
        left = {s: weight[s] for s in names if s not in full}
        budget = total - sum(full.values())
        target = {s: budget * w / sum(left.values()) for s, w in left.items()}
        over = {s: cap * sizes[s] for s in left if target[s] > cap * sizes[s] + 1e-9}
        if not over:
            return {**full, **target}
        full |= over


@pytest.mark.parametrize("which", ["odd", "given"])
def test_mix_against_resharing(spark, which):
    docs = odd_docs(spark) if which == "odd" else given(spark, sf="/root/testdata/sf0.01")
    rows = docs.collect()
    sizes = defaultdict(int)
    size = lambda t: len((t or "").encode().split())
    for r in rows:
        sizes[r["source"]] += size(r["text"])
    want = reshared(sizes)
    got = mixing.mix_decisions(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r["doc_id"], size(r["text"])) for r in rows)
    by_id = {r["doc_id"]: r["source"] for r in rows}
    taken = defaultdict(int)
    for r in got:
        source = by_id[r["doc_id"]]
        assert r["source_size"] == sizes[source] and abs(r["target"] - want[source]) < 1e-6 * max(1, want[source])
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"]
        taken[source] += r["taken"]
    for s, t in want.items():
        largest = max((size(r["text"]) for r in rows if r["source"] == s), default=0)
        limit = largest if which == "odd" else 0.03 * t + 20
        assert abs(taken[s] - t) <= limit, (s, t, taken[s])
    again = mixing.mix_decisions(docs.repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mixed_documents_are_the_decided_copies(spark):
    docs = given(spark)
    want = Counter({r["doc_id"]: r["copies"] for r in mixing.mix_decisions(docs).collect()})
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.schema == docs.schema
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == +want
    odd = odd_docs(spark)
    assert mixing.mix_documents(odd).columns == odd.columns


def test_dual_meets_constraints_with_unequal_base_rates(spark):
    cells = spark.createDataFrame([("sa", 0.5, 400), ("sa", 1.5, 600), ("sb", 1.0, 100), ("sb", 3.0, 50)],
                                  "skey string, base double, tokens long")
    targets = spark.createDataFrame([("sa", 1000, 1.0, 1900.0), ("sb", 150, 1.0, 90.0)],
                                    "skey string, source_size long, weight double, target double")
    lam = {r["skey"]: r["lam"] for r in mixing.solve_dual(cells, targets).collect()}
    for s, want in (("sa", 1900.0), ("sb", 90.0)):
        got = sum(r["tokens"] * min(2.0, r["base"] * np.exp(lam[s])) for r in cells.filter(F.col("skey") == s).collect())
        assert abs(got - want) < 1e-5 * want


@pytest.mark.parametrize("which", ["odd", "given"])
def test_document_rates_match_a_scalar_search(spark, which):
    """Every rate is base * exp(lambda) below the cap, lambda found anew by bisection; rates differ within a source."""
    docs = odd_docs(spark) if which == "odd" else given(spark, sf="/root/testdata/sf0.01")
    by_source = defaultdict(list)
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    for r in mixing.mix_decisions(docs).collect():
        base = 0.5 + min(len(f"{r['size']:b}"), 8) / 16
        by_source[source[r["doc_id"]]].append((r["size"], base, r["rate"], r["target"]))
    spread = 0
    for rows in by_source.values():
        size, base, rate, target = map(np.array, zip(*rows))
        if not target[0]:
            continue
        low, high = -60.0, 60.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if (size * np.minimum(2.0, base * np.exp(mid))).sum() < target[0] else (low, mid)
        some = size > 0         # no constraint holds a document without words
        assert np.allclose(rate[some], np.minimum(2.0, base * np.exp(high))[some], atol=1e-6)
        spread += len(set(rate[some])) > 1
    assert spread


def encoded(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = encoded.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


@pytest.mark.parametrize("which", ["odd", "given"])
def test_packing_round_trip(spark, which):
    docs = (odd_docs(spark) if which == "odd" else given(spark))
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"])
    got = packing.pack(docs).collect()
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids = encoded(texts[i][0])
        starts = packing.cut_points(len(ids), 1024)
        assert sorted((p["piece"], p["start"]) for p in pieces) == sorted(list(enumerate(starts)) * len(texts[i]))
        for p in pieces:
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes())
            assert p["length"] == 1024 or p["piece"] == 0
        assert sum(p["length"] for p in pieces) == len(ids) * len(texts[i])
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(r["length"] for r in got) // 1024) + 1


def test_patterns_use_every_piece_once():
    rng = np.random.default_rng(5)
    for _ in range(30):
        counts = Counter(rng.integers(1, 65, rng.integers(1, 400)).tolist())
        patterns = packing.plan_patterns(dict(counts), 64)
        used = Counter()
        for lengths, k in patterns:
            assert sum(lengths) <= 64
            for n in lengths:
                used[n] += k
        assert used == counts


def test_exact_complements_are_found():
    assert packing.plan_patterns({60: 2, 4: 2}, 64) == [((60, 4), 2)]
    assert packing.plan_patterns({40: 3, 20: 3, 4: 3}, 64) == [((40, 20, 4), 3)]
    assert packing.plan_patterns({30: 1, 20: 1, 10: 1, 4: 1}, 64) == [((30, 20, 10, 4), 1)]


def lengths_of(spark, sf):
    """Histogram of the pieces' lengths of a given table, made without Spark."""
    counts = Counter()
    for r in given(spark, sf=sf).select("text").collect():
        n = len(packing.encode(r["text"] or "", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken")) + 1
        starts = packing.cut_points(n, 1024)
        counts.update(b - a for a, b in zip(starts, [*starts[1:], n]))
    return dict(counts)


def test_few_sequences_and_triples_on_the_given_table(spark):
    counts = lengths_of(spark, "/root/testdata/sf0.01")
    patterns = packing.plan_patterns(counts, 1024)
    assert sum(k for _, k in patterns) <= 964
    assert any(len(lengths) == 4 and sum(lengths) == 1024 for lengths, _ in patterns)


def test_sum_index_against_all_combinations():
    rng = np.random.default_rng(8)
    for _ in range(40):
        left = np.zeros(25, np.int64)
        for n in rng.integers(1, 24, rng.integers(1, 9)):
            left[n] += rng.integers(1, 3)
        index = packing.SumIndex(left)
        for _ in range(4):
            have = [n for n in np.flatnonzero(left).tolist()]
            for gap in range(1, 24):
                sets = [c for m in (1, 2, 3) for c in combinations_with_replacement(have, m)
                        if sum(c) == gap and all(left[n] >= c.count(n) for n in c)]
                got = index.complement((), gap, 25)
                assert (got is None) == (not sets), (left, gap)
                if got:
                    assert len(got) == min(map(len, sets)) and tuple(sorted(got)) in sets
            left[rng.choice(have)] = 0 if len(have) > 1 else 1     # a length runs out


def test_small_packings_are_near_the_optimum():
    def best(pieces, cap):
        if not pieces:
            return 0
        first, rest, found = pieces[0], pieces[1:], len(pieces)
        for m in range(len(rest) + 1):
            for c in combinations(range(len(rest)), m):
                if first + sum(rest[i] for i in c) <= cap:
                    found = min(found, 1 + best([p for i, p in enumerate(rest) if i not in c], cap))
        return found

    rng = np.random.default_rng(4)
    for _ in range(60):
        pieces = sorted(rng.integers(1, 21, 7).tolist(), reverse=True)
        ours = sum(k for _, k in packing.plan_patterns(dict(Counter(pieces)), 20))
        assert ours <= best(pieces, 20) + 1


def test_frequent_values_are_the_same_at_any_number_of_tasks(spark):
    rows = spark.range(60_000).selectExpr("if(id % 3 = 0, 'a b', if(id % 5 = 0, 'c', concat('x', id))) AS w")
    for parts in (1, 3, 70):
        top = {r["item"]: r["estimate"] for r in common.frequent(rows.repartition(parts), "w", 5, 1024).collect()}
        assert len(top) <= 5 and abs(top["a b"] - 20_000) < 250 and abs(top["c"] - 8_000) < 250
    exact = common.frequent(rows.filter("w in ('a b', 'c')"), "w", 5, 1024).collect()
    assert {r["item"]: r["estimate"] for r in exact} == {"a b": 20_000, "c": 8_000}
    assert common.frequent(rows.limit(0), "w", 5, 1024).count() == 0


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.dedup_decisions(empty).count() == 0
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert mixing.mix_decisions(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0
    assert packing.pack(empty).count() == 0

"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of hashed 5-word shingles; two link when |x & y| / |x | y| >= 0.8.  Equal word sequences
are one class, so exact copies never meet as pairs.  Per class:

1. *Order.*  Shingles of many documents (Misra-Gries counters kept by every task and merged) come last, the
   rest in hash order.
2. *First prefix.*  Any partner shares at least need = ceil(0.8 n) shingles.  The first n - need + extra
   shingles of both then share at least min(extra_x, extra_y); extra is a share of n, so with the partner's
   size bounded by 0.8 n the document knows the least number m of shared prefix shingles.
3. *Second, adaptive prefix.*  Of those, only s shingles occur in other documents at all.  With s < m the
   document has no partner.  Otherwise the s - m + l rarest of them suffice, a pair then sharing l.  l grows from
   1 with the estimated cost (the sum of their document counts): common shingles must match more often.
4. *Candidates without all pairs.*  Shingles that occur in the same classes are one group with a weight.
   In each group every class outside the group's largest component meets one member of that component: first the
   most central one (its shingles are the most shared: the text that others were copied from), in later rounds
   another one.  Verified links merge components.  Only when rounds stop (``ROUNDS``) the remaining
   cross-component pairs are listed in full, the multi-match count applied, and verified.  Pairs inside one
   component cannot change the result.
   Every class carries a parity bitmap of its whole set: the bits in which two bitmaps differ are never more than
   the shingles in which the sets differ, and a link allows at most (|x| + |y|) / 9 of those.  The bound is part of
   the join condition, so pairs that are not similar end there.
5. *Verification* intersects whole shingle sets, so the result is exact.

Results for odd rows: null texts and texts without words have 0 shingles and are linked with nothing; 1 to 4 words
are one shingle; repeated rows are one class and linked to each other; a row whose doc_id is null takes part, gets the
smallest doc_id of its group that is not null (null if there is none) and leaves before any other row of it; an empty table gives no rows; other columns are ignored.  Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_CLASS, cut, frequent, prepare, text_slices
from .components import connected

WORDS = 5
TOP, BOTTOM = 4, 5             # the similarity 0.8 as a fraction
EXTRA = 0.1                    # share of its size by which a document's first prefix is lengthened
COUNTERS, COMMON = 1 << 16, 1 << 15   # Misra-Gries counters of a task; common shingles that are broadcast
COST = 64                      # estimated candidates above which a document asks for more matches
MOST_MATCHES = 4
ROUNDS = 2
BITS = 1024                    # of a parity bitmap
BEFORE = 16                    # shingles of a class that its row remembers, those before its own in order
TOKEN_HOT, TOKEN_TRACKED = 4096, 65536
PAIR_COLUMNS = ("cls", "n", "matches", "comp", "bits", "before")
SLICE = 1 << 20                # bytes of text whose shingles a task holds at a time
REMEMBERED = 100_000           # word hashes that a task remembers

_MUL = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word -> 64-bit hash, remembered for frequent words; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MUL
    return h ^ (h >> np.uint64(29))


def shingles(words: list[bytes], hashes: WordHashes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct signed 64-bit hashes of all n-word shingles; fewer words are one shingle."""
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    k = len(h) - width + 1
    acc = np.full(k, width, np.uint64)
    for j in range(width):
        acc = _mix(acc + h[j:j + k])
    return np.unique(acc.view(np.int64))


def tokens(text: str | None) -> list[bytes]:
    """bytes.lower changes A-Z only, and bytes.split knows the six ASCII white-space characters only."""
    return (text or "").encode().lower().split()


def need(n: np.ndarray | int):
    return (TOP * n + BOTTOM - 1) // BOTTOM


def extra(n):
    return max(1, int(EXTRA * n))


class Frequent:
    """Misra-Gries summary: at most ``size`` counters, never above the true counts."""

    def __init__(self, size: int):
        self.size, self.keys, self.counts = size, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        keys = np.concatenate([self.keys, keys])
        counts = np.concatenate([self.counts, np.ones(len(keys) - len(self.keys), np.int64) if counts is None else counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(self.keys) > self.size:
            self.counts = self.counts - np.partition(self.counts, -self.size - 1)[-self.size - 1]
            alive = self.counts > 0
            self.keys, self.counts = self.keys[alive], self.counts[alive]


def common_shingles(rows: DataFrame) -> np.ndarray:
    """The shingles with the largest Misra-Gries counts over all documents, at most COMMON, sorted."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, top, held, size = WordHashes(), Frequent(COUNTERS), [], 0
        for b in batches:
            for text in b.column(0):
                held.append(shingles(tokens(text.as_py()), hashes))
                size += len(held[-1])
                if size > 400_000:
                    top.add(np.concatenate(held))
                    held, size = [], 0
        if held:
            top.add(np.concatenate(held))
        often = top.counts > 1
        yield pa.RecordBatch.from_arrays([pa.array(top.keys[often]), pa.array(top.counts[often])], names=["token", "n"])

    summed = rows.select("text").mapInArrow(summarise, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    best = summed.filter("n >= 8").orderBy(F.desc("n"), "token").limit(COMMON).collect()
    return np.sort(np.array([r["token"] for r in best], np.int64))


def first_prefixes(rows: DataFrame, common: np.ndarray) -> DataFrame:
    """doc_id, raw, cls (hash of the word sequence), n, prefix.  rows: doc_id, text, raw (hash of the text)."""
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in (part for batch in batches for part in text_slices(batch, 1, SLICE)):
            cls, size, prefix = [], [], []
            for text in b.column(1):
                words = tokens(text.as_py())
                s = shingles(words, hashes)
                n = len(s)
                if n and len(common):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    often = common[at] == s
                    s = np.concatenate([s[~often], s[often]])
                cls.append(xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63) if n else None)
                size.append(n)
                prefix.append(s[:n - need(n) + extra(n)].copy())      # not a view that keeps the whole set
            flat = np.concatenate([*prefix, np.empty(0, np.int64)])
            ends = np.cumsum([0, *map(len, prefix)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(cls, pa.int64()), pa.array(size, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["doc_id", "raw", "cls", "n", "prefix"])

    return rows.mapInArrow(prefixes, "doc_id long, raw long, cls long, n long, prefix array<long>")


def second_prefixes(table: DataFrame, reps: DataFrame) -> DataFrame:
    """(token, cls, n, matches, central): what each class still has to look up, only shingles that occur
    twice or more.  table: rid, cls, n, prefix."""
    loose = table.select("rid", F.explode("prefix").alias("token"))
    hot = frequent(loose.select("token"), "token", TOKEN_HOT, TOKEN_TRACKED)
    hot = F.broadcast(hot.filter("estimate > 64").select(F.col("item").alias("token")))     # TOKEN_HOT rows at most
    exact = cut(loose.join(hot, "token").groupBy("token").agg(F.count(F.lit(1)).alias("df")), "hot-shingles")
    marked = loose.join(F.broadcast(exact), "token", "left")            # hot ones are counted without a shuffle
    rest = marked.filter("df is null").withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token")))
    shared = marked.filter("df is not null").unionByName(rest).filter("df > 1")
    # one row of each class goes on; copies' rows end here
    of_class = (shared.join(reps, "rid").groupBy("cls", "n")
                .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("s")))  # a document's prefix at most
    partner = F.expr(f"cast((n * {TOP} + {BOTTOM - 1}) div {BOTTOM} as bigint)")
    least = F.greatest(F.lit(1), F.floor(F.lit(EXTRA) * partner)).cast("int")
    spare = F.size("s") - F.col("m")
    cost = F.expr("aggregate(slice(s, 1, size(s) - m + 1), 0L, (a, x) -> a + x.df)")
    matches = F.least(F.greatest(F.lit(1), F.floor(F.log2(cost / F.lit(float(COST))) + 1)), F.lit(MOST_MATCHES), F.col("m"))
    return (of_class.withColumn("m", least).filter(F.size("s") >= F.col("m"))
            .withColumn("matches", matches.cast("int"))
            .withColumn("central", (F.expr("aggregate(s, 0D, (a, x) -> a + x.df)") / F.col("n")).cast("float"))
            .withColumn("s", F.slice("s", F.lit(1), (spare + F.col("matches")).cast("int")))
            .select("cls", "n", "matches", "central", F.explode("s").alias("x"))
            .select(F.col("x.token").alias("token"), "cls", "n", "matches", "central"))


def merged_groups(looked: DataFrame) -> DataFrame:
    """One shingle for all shingles with the same classes, ``weight`` telling how many they are; shingles of
    one class only go.  Edits leave runs of shingles together, so this removes most rows of small groups."""
    one, two = F.xxhash64("cls"), F.xxhash64("cls", F.lit(1))
    sets = looked.groupBy("token").agg(F.bit_xor(one).alias("x"), F.bit_xor(two).alias("y"), F.count(F.lit(1)).alias("k"))
    kept = sets.filter("k > 1").groupBy("x", "y", "k").agg(F.min("token").alias("token"), F.count(F.lit(1)).alias("weight"))
    return looked.join(kept.select("token", "weight"), "token")


def may_link(a: str, b: str, a_bits: str, b_bits: str):
    """Sizes within the similarity, and no more differing bits than a link's sets may differ in."""
    differ = sum((F.bit_count(F.col(a_bits)[i].bitwiseXOR(F.col(b_bits)[i])) for i in range(BITS // 64)), F.lit(0))
    # |x & y| >= t / (1 + t) * (|x| + |y|) leaves (1 - t) / (1 + t) of both sizes to differ in
    return ((F.lit(BOTTOM) * F.least(a, b) >= F.lit(TOP) * F.greatest(a, b))
            & (F.lit(BOTTOM + TOP) * differ <= F.lit(BOTTOM - TOP) * (F.col(a) + F.col(b))))


def round_pairs(open_rows: DataFrame, turn: int) -> DataFrame:
    """(a, b): each class outside the largest component of a group with one member of that component, the
    most central one in the first round; for each class the partner that it met most often."""
    first = F.col("central") if turn == 0 else F.xxhash64("cls", F.lit(turn))
    per = (open_rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"),
                                                  F.max(F.struct(first.alias("s"), "cls", "n", "bits")).alias("c")))
    centre = per.groupBy("token").agg(F.max(F.struct("k", "c", "comp")).alias("best")).select(
        "token", F.col("best.comp").alias("ccomp"), F.col("best.c.cls").alias("b"), F.col("best.c.n").alias("bn"),
        F.col("best.c.bits").alias("b_bits"))
    met = (open_rows.join(centre, "token").filter((F.col("comp") != F.col("ccomp")) & may_link("n", "bn", "bits", "b_bits"))
           .groupBy(F.col("cls").alias("a"), "b").agg(F.sum("weight").alias("k")))
    return met.groupBy("a").agg(F.max(F.struct("k", "b")).alias("x")).select("a", F.col("x.b").alias("b"))


def all_pairs(open_rows: DataFrame) -> DataFrame:
    """(a, b): every pair of a group in different components that shares enough shingles.  One side leaves out
    the largest component of the group, so its members never meet each other.

    A pair of long texts may share thousands of groups, of which the multi-match count needs a few.  Each row remembers
    the ``BEFORE`` groups before it in its class' order; where two rows remember as many common ones as the pair needs,
    the pair has met already.  The first groups that a pair shares never have so many before them, so none is lost."""
    before = Window.partitionBy("cls").orderBy("token").rowsBetween(-BEFORE, -1)
    open_rows = open_rows.withColumn("before", F.collect_list("token").over(before))
    per = open_rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
    big = per.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("x")).select("token", F.col("x.comp").alias("big"))
    rows = open_rows.join(big, "token")
    left = rows.filter("comp <> big").select("token", "weight", *[F.col(c).alias("a_" + c) for c in PAIR_COLUMNS])
    right = rows.select("token", "big", *[F.col(c).alias("b_" + c) for c in PAIR_COLUMNS])
    needed = F.least("a_matches", "b_matches")
    met = left.join(right, "token").filter(
        (F.col("a_comp") != F.col("b_comp")) & ((F.col("b_comp") == F.col("big")) | (F.col("a_cls") < F.col("b_cls")))
        & may_link("a_n", "b_n", "a_bits", "b_bits")
        & (F.size(F.array_intersect("a_before", "b_before")) < needed))
    counted = (met.groupBy(F.least("a_cls", "b_cls").alias("a"), F.greatest("a_cls", "b_cls").alias("b"))
               .agg(F.sum("weight").alias("k"), F.min(needed).alias("l")))
    return counted.filter("k >= l").select("a", "b")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(cls, blob, bits): whole shingle sets as sorted 8-byte integers, and their parity bitmaps.  rows: cls, text."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in (part for batch in batches for part in text_slices(batch, 1, SLICE)):
            whole = [shingles(tokens(t.as_py()), hashes) for t in b.column(1)]
            bits = np.concatenate([parity_bits(s) for s in whole])
            ends = np.arange(len(whole) + 1, dtype=np.int32) * (BITS // 64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s.tobytes() for s in whole], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(bits))], names=["cls", "blob", "bits"])

    return rows.mapInArrow(sets, "cls long, blob binary, bits array<long>")


def parity_bits(s: np.ndarray) -> np.ndarray:
    """BITS bits as 64-bit integers: each one the parity of the number of shingles that hash to it."""
    places = (s.view(np.uint64) >> np.uint64(17)) % np.uint64(BITS)
    return np.packbits(np.bincount(places.astype(np.int64), minlength=BITS) & 1).view(np.int64)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(BOTTOM * shared >= TOP * (len(both) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("blob").alias("x")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("blob").alias("y")), "b").select("a", "b", "x", "y"))
    return both.mapInArrow(check, "a long, b long")


def link_classes(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(cls, comp) for every class that is linked with another one."""
    reps = cut(table.filter("cls is not null").groupBy("cls").agg(F.min("rid").alias("rid"), F.min("n").alias("n")), "classes")
    looked = cut(second_prefixes(table.select("rid", "prefix"), reps), "looked-up")
    looked = cut(merged_groups(looked), "candidates")
    involved = looked.select("cls").distinct()
    nodes = cut(involved.withColumn("comp", F.col("cls")), "nodes")
    if nodes.isEmpty():
        return nodes
    # whole texts of the involved classes' first rows only
    wanted = involved.join(reps, "cls").select("cls", F.col("rid").alias("__rid"))
    wanted = wanted.join(table.select("rid", "doc_id", "raw"), F.col("rid") == F.col("__rid")).select("cls", "doc_id", "raw")
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (F.xxhash64(docs["text"]) == wanted["raw"]))
    sets = cut(shingle_sets(texts.select("cls", "text").dropDuplicates(["cls"])), "sets")
    looked = looked.join(sets.select("cls", "bits"), "cls")
    for turn in range(ROUNDS + 1):
        rows = looked.join(nodes, "cls")
        mixed = rows.groupBy("token").agg((F.min("comp") != F.max("comp")).alias("two")).filter("two").select("token")
        rows = cut(rows.join(mixed, "token"), "open")
        if rows.isEmpty():
            break
        pairs = round_pairs(rows, turn) if turn < ROUNDS else all_pairs(rows)
        edges = cut(verified(pairs, sets), "links-found")
        nodes = cut(connected(nodes, edges), "nodes")
    return nodes


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, raw, n, and first (doc_id, raw) of its group: ids that are not null come first."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.withColumn("raw", F.xxhash64("text"))
    table = first_prefixes(keyed, common_shingles(rows)).withColumn("rid", F.monotonically_increasing_id())
    table = cut(table, "prefixes")
    nodes = link_classes(rows, table)
    narrow = table.select("doc_id", "cls", "n", "raw")
    comp = narrow.join(nodes, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "raw")).alias("first")
    return (comp.join(comp.filter("cls is not null").groupBy("comp").agg(first), "comp", "left")
            .select("doc_id", "raw", "n", "first"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id that links reach)."""
    return _grouped(docs, id_col, text_col).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("first.doc_id", "doc_id").alias("component_id"), "raw")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group stays, with all its columns: the smallest doc_id that is not null, of equal ids the smallest
    text hash, of equal rows any.  Documents without words stay, each row of them."""
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("raw") == F.col("first.raw"))
    keys = cut(_grouped(docs, id_col, text_col).filter("n > 0").groupBy("doc_id", "raw")
               .agg(F.max(stays).alias("stays"), F.count(F.lit(1)).alias("k")), "group-keys")
    gone = keys.filter("not stays").select(F.col("doc_id").alias("__gone_id"), F.col("raw").alias("__gone_raw"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    left = docs.withColumn("__raw", F.xxhash64(text))
    left = left.join(gone, F.col("__gone_id").eqNullSafe(F.col(f"`{id_col}`").cast("long"))
                     & (F.col("__gone_raw") == F.col("__raw")), "left_anti")
    if not keys.filter("stays and k > 1").isEmpty():
        # the same row more than once: one of them stays
        own = F.when(~text.rlike(WORD_CLASS), F.monotonically_increasing_id())
        left = left.withColumn("__own", own).dropDuplicates([id_col, "__raw", "__own"]).drop("__own")
    return left.drop("__raw")

"""Best-fit packing of token sequences by exact-complement hashing.

Only lengths decide a packing, and there are at most ``capacity`` different ones.  So:
1. every text is tokenised once, in Spark tasks; only pieces (start, length, crc32) are kept;
2. the histogram of lengths (``capacity`` rows at most) is packed on the driver, longest first: complements
   that fill a sequence exactly are looked up in an index of single, pair and triple length sums under the
   counts still available; where no combination fills a gap, the best-fitting piece goes in and the rest of the
   gap is looked up again;
3. the resulting patterns (bounded by the lengths, not by the data) are dealt to the pieces by
   their rank within the length.  Ranks come from salted groups and offsets, so a length that holds
   a third of all pieces is spread like any other.

Results for odd rows: a null text is empty and gives one piece holding the end id; repeated rows
are packed each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

CAPACITY = 1024
END_ID = 2
SALT_ROWS = 1000
REACH = 16       # a complement's longest piece is at most capacity / REACH shorter than the longest that fits
SPECIAL = "<|endoftext|>"   # the tokenizer file's special string: such texts take the slower library
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_ENCODERS: dict = {}


def _fast(ranks: str):
    """The rank file holds the same vocabulary and merges as the tokenizer file; its library is four times as fast."""
    if ranks not in _ENCODERS:
        import base64

        import public_tokenizers
        import tiktoken
        with open(public_tokenizers.path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[ranks] = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                             special_tokens={})
    return _ENCODERS[ranks]


def _slow(vocab: str):
    """Made only when a text needs it: it takes 40 MB."""
    if vocab not in _ENCODERS:
        import public_tokenizers
        from tokenizers import Tokenizer
        _ENCODERS[vocab] = Tokenizer.from_file(public_tokenizers.path(vocab))
    return _ENCODERS[vocab]


def forget_encoders() -> None:
    _ENCODERS.clear()


def encode(text: str, vocab: str, ranks: str) -> np.ndarray:
    if SPECIAL in text:
        return np.array(_slow(vocab).encode(text, add_special_tokens=False).ids, "<u4")
    return _fast(ranks).encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of n ids: only the first may be shorter than the capacity."""
    first = n if n <= capacity else (n % capacity or capacity)
    return [0, *range(first, n, capacity)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, vocab: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(encode(text.as_py() or "", vocab, ranks), np.uint32(end_id)).astype("<u4")
                starts = cut_points(len(ids), capacity)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    for column, value in zip(out, (doc.as_py(), k, a, b - a, zlib.crc32(ids[a:b].tobytes()))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
        forget_encoders()       # Spark keeps the worker for other tasks

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tokenise, PIECES)


class SumIndex:
    """Lengths by the sums that one, two or three of them make, over counts that only fall.

    Built once from the lengths that occur.  ``pairs[s]``: the longer lengths of the pairs of sum s; ``triples[s]``: the
    longest lengths of the triples of sum s; both longest first.  Entries whose lengths have run out are dropped when met."""

    def __init__(self, left: np.ndarray):
        self.left, capacity = left, len(left) - 1
        have = np.flatnonzero(left)
        a, b = (x.ravel() for x in np.meshgrid(have, have, indexing="ij"))
        self.pairs = self._by_sum(a, a + b, (b <= a) & (a + b <= capacity))
        shortest = np.full(capacity + 1, capacity + 1)        # of the longer lengths of each pair sum
        for s, longer in self.pairs.items():
            shortest[s] = longer[-1]
        a, s = (x.ravel() for x in np.meshgrid(have, np.fromiter(self.pairs, np.int64, len(self.pairs)), indexing="ij"))
        self.triples = self._by_sum(a, a + s, (a + s <= capacity) & (shortest[s] <= a) if len(s) else s > 0)

    @staticmethod
    def _by_sum(longest: np.ndarray, sums: np.ndarray, valid: np.ndarray) -> dict[int, np.ndarray]:
        longest, sums = longest[valid], sums[valid]
        order = np.lexsort((-longest, sums))
        longest, sums = longest[order], sums[order]
        edges = np.flatnonzero(np.diff(sums)) + 1
        return {int(g[0]): v for g, v in zip(np.split(sums, edges), np.split(longest, edges)) if len(g)}

    def longest(self, gap: int) -> int:
        """The longest available length of at most ``gap``, or 0."""
        some = np.flatnonzero(self.left[:gap + 1])
        return int(some[-1]) if len(some) else 0

    def available(self, lengths: tuple[int, ...]) -> bool:
        return all(self.left[n] >= lengths.count(n) for n in set(lengths))

    def _pairs(self, total: int) -> np.ndarray:
        longer = self.pairs.get(total, np.empty(0, np.int64))
        alive = (self.left[longer] > 0) & (self.left[total - longer] > 0)
        if not alive.all():
            longer = self.pairs[total] = longer[alive]
        return longer

    def complement(self, head: tuple[int, ...], gap: int, reach: int) -> tuple[int, ...] | None:
        """One, two or three available lengths of sum ``gap``, the fewest first.  Their longest is at most ``reach`` below the
        longest that fits: filling a gap with short lengths only would take them from sequences that need them."""
        if self.available((*head, gap)):
            return (gap,)
        least = self.longest(gap - 1) - reach
        for a in self._pairs(gap):
            if a < least:
                break
            if self.available((*head, int(a), gap - int(a))):
                return int(a), gap - int(a)
        longest = self.triples.get(gap, np.empty(0, np.int64))
        for a in longest[(longest >= least) & (self.left[longest] > 0)].tolist():
            for b in self._pairs(gap - a).tolist():
                if b <= a and self.available((*head, a, b, gap - a - b)):
                    return a, b, gap - a - b
        return None


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths, sequences)]: how many sequences hold exactly these lengths.  The longest open length looks up its
    exact complement; where there is none, the longest piece that fits goes in (best fit) and the smaller gap is looked up
    again.  A pattern is taken as often as its counts allow, so the steps follow the lengths and not the pieces."""
    left = np.zeros(capacity + 1, np.int64)
    for n, k in counts.items():
        left[n] = k
    index, out = SumIndex(left), []
    for n in range(capacity, 0, -1):
        while left[n]:
            lengths, gap = (n,), capacity - n
            while gap:
                found = index.complement(lengths, gap, capacity // REACH)
                if found:
                    lengths, gap = (*lengths, *found), 0
                    continue
                fitting = np.flatnonzero(left[:gap + 1])[::-1].tolist()
                best = next((a for a in fitting if index.available((*lengths, a))), 0)
                if not best:
                    break
                lengths, gap = (*lengths, best), gap - best
            need = {m: lengths.count(m) for m in lengths}
            k = min(int(left[m]) // times for m, times in need.items())
            for m, times in need.items():
                left[m] -= k * times
            out.append((lengths, k))
    return out


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length: rows (first rank, first sequence, offset), one per place in a pattern.
    Piece r of that length stands in sequence first_sequence + r - first_rank."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for lengths, k in patterns:
        at = 0
        for n in lengths:
            out.setdefault(n, []).append((used.get(n, 0), base, at))
            used[n] = used.get(n, 0) + k
            at += n
        base += k
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def ranked(rows: DataFrame, counts: dict[int, int], salt_rows: int = SALT_ROWS) -> DataFrame:
    """Adds rank: 0, 1, ... within each length, the same at every run.  ``counts``: pieces of each length;
    a length is dealt into as many salted groups as its count asks for."""
    salts = rows.sparkSession.createDataFrame([(n, max(1, k // salt_rows)) for n, k in counts.items()], "length long, __salts long")
    salted = (rows.join(F.broadcast(salts), "length")     # a row per length: capacity rows at most
              .withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("__salts"))).drop("__salts"))
    ahead = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__ahead", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).drop("__n"))
    own = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.withColumn("__own", F.row_number().over(own) - 1).join(offsets, ["length", "__salt"])
            .withColumn("rank", F.col("__own") + F.col("__ahead")).drop("__own", "__ahead", "__salt"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, **names) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = cut(pieces(docs, id_col, text_col, capacity, **names), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = slots(plan_patterns(counts, capacity))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sequence, offset = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
            lengths, rank = f["length"].to_numpy(), f["rank"].to_numpy()
            order = np.argsort(lengths, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(f) else []:
                starts, bases, offsets = table[int(lengths[at[0]])].T
                k = np.searchsorted(starts, rank[at], side="right") - 1
                sequence[at], offset[at] = bases[k] + rank[at] - starts[k], offsets[k]
            yield pd.DataFrame({"row": f["row"], "sequence_id": sequence, "offset": offset})

    # the piece itself passes as one untouched column, so null ids stay as they are
    packed = ranked(rows, counts).select(F.struct("doc_id", "piece", "start", "length", "ids_crc32").alias("row"), "length", "rank")
    kind = packed.schema["row"].dataType.simpleString()
    return packed.mapInPandas(deal, f"row {kind}, sequence_id long, offset long").select("row.*", "sequence_id", "offset")

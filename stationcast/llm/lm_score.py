"""Language-model scores by online logistic context mixing.

A text is coded as binary decisions: every word takes the path of a Huffman tree over the frequent training
words; the others share an escape, behind which a word has its part (count + 1) of the tail's counts and all unknown
words together have one part, as in the base score.  Each decision is predicted by several models -- the tree's own
counts and bit counters in tables indexed by hashes of the context (the last word, the last two, the one before
the last) -- whose log odds are added with weights chosen by a gate (the depth of the decision).  Weights and a
bias adapt to each text while it is read, after every ``BLOCK`` words; a last table refines the mixed odds.  The sum is
a proper probability over the base's events (training words and one for the unknown); bits per byte follow.

What is gathered from the corpus:
* token counts of all training documents (one shuffle); words outside the tree are joined with them, for the score and
  the base score, so every training word counts however rare;
* bit counters: each task fills its own tables and they are added up.  Tables have a slot for four training tokens, up to
  2 ^ ``MOST_SLOT_BITS`` (they go to every task; more is a parameter and a question of memory);
* start weights and refining table: fitted on all training rows by the tasks.  The rows are two halves by a hash of the
  row, each half is read with the counters of the other, which have not seen it, and every text's last weights and every
  decision's odds enter the sums.  The counters of both halves together cover the whole training part.

Results for odd rows: a null text is empty and consists of the end token; repeated rows are scored each; without any
training document all counts are 0 and the model starts from even odds; an empty table gives no rows; other columns
are ignored.  A null doc_id belongs to the fold of the empty text.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, cut, prepare

FOLDS, HELD_OUT = 7, 2
HEAD = 1 << 16                # words of the tree, which goes to every task
MIN_COUNT = 2                 # words seen less often teach the escape
LEAST_SLOT_BITS, MOST_SLOT_BITS = 16, 21      # log2 of a table's slots
CHUNK = 1 << 14               # slots of one shuffled piece of a table
CONTEXTS = 3
GATES, INPUTS = 16, 5         # inputs: tree, three contexts, bias
BLOCK = 64
RATE, PRIOR_ROWS = 1.0, 24.0
RUNS = 400                    # texts whose decisions in a block are mixed together
BATCH_WORDS = 100_000
SCORE_WORDS = 500_000         # a text's score does not depend on the others beside it
COUNT_WORDS, PART_WORDS = 250_000, 2048       # words whose decisions are counted together; made together
FIT_DOCS, EPOCHS = 400, 6     # texts that a task reads before it moves its weights; how often it reads its first ones
START = (0.3, 0.3, 0.3, 0.3, 0.0)
REFINE, SPREAD = 24, 8.0
STEPS = 16                    # steps of a table's log odds in one nat
FLUSH = 500_000
END = b""                     # no word is empty


def tokens(text: str | None) -> list[bytes]:
    """Words (A-Z lower-cased, split at the six ASCII white-space bytes), then the end token."""
    return [*(text or "").encode().lower().split(), END]


def split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another and their number in each text: as ``tokens``, without the end tokens."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(column, ""))))
    words = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    no_word = pc.equal(pc.binary_length(words), 0)      # a text without words has one empty word here
    if pc.any(no_word).as_py():
        sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[no_word.to_numpy(zero_copy_only=False)], minlength=len(sizes))
        words = words.filter(pc.invert(no_word))
    return words.cast(pa.binary()), sizes


def huffman(weights: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, node, bit): the paths of all symbols one after another, nodes numbered from 0."""
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, side = np.full(2 * n - 1, -1, np.int64), np.zeros(2 * n - 1, np.int8)
    for new in range(n, 2 * n - 1):
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x] = parent[y] = new
        side[y] = 1
        heapq.heappush(heap, (a + b, new))
    length, at = np.zeros(n, np.int64), np.arange(n)
    while (up := parent[at] >= 0).any():        # all symbols climb together
        length += up
        at = np.where(up, parent[at], at)
    node, bit = np.empty(int(length.sum()), np.int64), np.empty(int(length.sum()), np.int8)
    place, at = np.cumsum(length) - 1, np.arange(n)
    for step in range(int(length.max(initial=0))):
        on = length > step
        node[place[on] - step], bit[place[on] - step] = parent[at[on]] - n, side[at[on]]
        at = np.where(on, parent[at], at)
    return length, node, bit


class Trees:
    """The word tree as flat arrays: symbol -> decisions (node, bit, depth).  Symbols: 0 is the escape, then the head words."""

    def __init__(self, head: list[tuple[bytes, int]], rest: int):
        self.words = {w: i + 1 for i, (w, _) in enumerate(head)}
        self.words.setdefault(END, len(self.words) + 1)
        self.vocabulary = pa.array(self.words, pa.binary())
        weights = [max(rest, 1), *(n for _, n in head)]
        weights += [1] * (len(self.words) + 1 - len(weights))
        length, node, bit = huffman(weights)
        self.length, self.bit = length.astype(np.int32), bit
        self.offset = np.cumsum(np.r_[0, self.length[:-1]], dtype=np.int64)
        self.gate = np.minimum(np.arange(len(node)) - np.repeat(self.offset, length), GATES - 1).astype(np.int8)
        counts = np.repeat(np.array(weights, float), length)
        nodes = int(node.max()) + 1
        one, both = np.bincount(node, counts * bit, nodes), np.bincount(node, counts, nodes)
        self.path_odds = np.log((one + 0.5) / (both - one + 0.5)).astype(np.float32)[node]
        self.spread = (node.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)


def _hash32(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint32)
    for p in parts:
        h = (h ^ p.astype(np.uint32)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return h


class Words:
    """Texts as symbols of the tree, one after another, each with its end token."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes, self.ends = ids, sizes, np.r_[0, np.cumsum(sizes)]

    def __len__(self) -> int:
        return len(self.sizes)

    def slice(self, a: int, b: int) -> Words:
        return Words(self.ids[self.ends[a]:self.ends[b]], self.sizes[a:b])

    def groups(self, most: int) -> Iterator[Words]:
        """Runs of texts of about ``most`` tokens, each text whole."""
        a = 0
        while a < len(self):
            b = min(int(np.searchsorted(self.ends, self.ends[a] + most)), len(self))
            yield self.slice(a, b)
            a = b


def symbols(trees: Trees, words: pa.Array) -> np.ndarray:
    """The symbol of each word; 0 is the escape."""
    return pc.index_in(words, value_set=trees.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False) + np.int32(1)


def numbered(trees: Trees, column: pa.Array) -> tuple[Words, pa.Array]:
    """The texts of a column, and their words outside the tree."""
    words, sizes = split(column)
    found = symbols(trees, words)
    ids = np.full(len(found) + len(sizes), trees.words[END], np.int32)
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(sizes + 1) - 1] = False
    ids[inner] = found
    return Words(ids, sizes + 1), words.filter(pa.array(found == 0))


class Part(NamedTuple):
    """Decisions of some words: all first decisions in the order of the words, then all second ones and so on."""
    at: np.ndarray            # places in the tree's arrays
    bit: np.ndarray
    slots: list[np.ndarray]   # of each context
    each: np.ndarray          # decisions of each depth
    on: np.ndarray            # depth x word: has the word a decision there


class Coded:
    """The words of a batch of texts, in the order (block of words, text), or as they come if they are only counted.  Their
    decisions are made when asked for, a few words at a time, so that they stay in the processor's cache."""

    def __init__(self, trees: Trees, texts: Words | list[list[bytes]], slot_bits: int, counted: bool = False):
        if not isinstance(texts, Words):
            texts = Words(symbols(trees, pa.array(chain.from_iterable(texts), pa.binary())), np.array([len(t) for t in texts], np.int64))
        self.trees, self.shift = trees, np.uint32(32 - slot_bits)
        self.ids, sizes = texts.ids, texts.sizes.astype(np.int32)
        ids = self.ids
        self.doc = doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        place = np.arange(len(ids), dtype=np.int32) - np.repeat(np.cumsum(sizes, dtype=np.int32) - sizes, sizes)
        before1 = np.where(place > 0, np.r_[0, ids[:-1]].astype(np.int32) + 1, 0)
        before2 = np.where(place > 1, np.r_[0, 0, ids[:-2]][:len(ids)].astype(np.int32) + 1, 0)
        if not counted:
            block = place // BLOCK
            order = np.argsort(block, kind="stable")
            ids, doc, block, before1, before2 = (x[order] for x in (ids, doc, block, before1, before2))
            new = np.r_[True, (block[1:] != block[:-1]) | (doc[1:] != doc[:-1])][:len(ids)]
            self.runs = np.r_[np.flatnonzero(new), len(ids)]     # where the words of a text in a block begin
            self.run_doc, block = doc[new], block[new]
            ends = np.r_[np.flatnonzero(block[1:] != block[:-1]) + 1, len(block)].tolist()
            self.pieces = [(a, min(a + RUNS, end)) for begin, end in zip([0, *ends], ends) for a in range(begin, end, RUNS)]
        self.decisions, self.path = trees.length.astype(np.uint8).take(ids), trees.offset.take(ids)
        self.contexts = _hash32(before1), _hash32(before1, before2), _hash32(before2 + np.int32(3_000_000))

    def part(self, a: int, b: int) -> Part:
        """The decisions of the words from a to b."""
        many = self.decisions[a:b]
        each = len(many) - np.cumsum(np.bincount(many))[:-1]
        depth = np.arange(len(each))
        on = many > depth.astype(np.uint8)[:, None]
        word = np.flatnonzero(on)
        word -= np.repeat(depth * len(many), each)
        at = self.path[a:b].take(word, mode="clip")      # all places exist; this mode is the fast one
        at += np.repeat(depth, each)
        spread, slots = self.trees.spread.take(at, mode="clip"), []
        for context in self.contexts:
            h = context[a:b].take(word, mode="clip")
            h ^= spread
            h *= np.uint32(0xC2B2AE35)
            h >>= self.shift
            slots.append(h.view(np.int32))
        return Part(at, self.trees.bit.take(at, mode="clip"), slots, each, on)

    @cached_property
    def whole(self) -> Part:
        return self.part(0, len(self.ids))

    @property
    def slots(self) -> list[np.ndarray]:
        return self.whole.slots

    @property
    def bit(self) -> np.ndarray:
        return self.whole.bit


class Mixer:
    """Start weights per gate, counter tables as log odds, and the refining table."""

    def __init__(self, tables: list[np.ndarray], weights: np.ndarray | None = None, refine: np.ndarray | None = None):
        self.tables, self.slot_bits = tables, len(tables[0]).bit_length() - 1
        self.weights = np.tile(np.array(START, np.float32), (GATES, 1)) if weights is None else weights
        grid = (np.arange(REFINE) + 0.5) * (2 * SPREAD / REFINE) - SPREAD
        self.refine = np.tile(grid.astype(np.float32), (GATES, 1)) if refine is None else refine

    def read(self, coded: Coded, texts: int, refining: bool = False, priced: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cost of each text in nats unless not asked for, its weights at the end, counts for the refining table if asked for)."""
        order = [INPUTS - 1, *range(INPUTS - 1)]       # the bias first
        weights = np.repeat(self.weights.T[order, :, None].astype(np.float32), texts, axis=2)
        cost = np.zeros(texts)
        seen = np.zeros((2, GATES * REFINE))
        flat = self.refine.ravel()
        step = np.float32(1 / STEPS)
        for first, last in coded.pieces:
            docs, runs = coded.run_doc[first:last], coded.runs[first:last + 1]
            part = coded.part(runs[0], runs[-1])
            n, depths = len(part.at), len(part.each)
            gates = np.minimum(np.arange(depths), GATES - 1)
            # decisions of one text at one depth are neighbours and share their weights
            count = np.zeros((max(depths, GATES), len(docs)))
            count[:depths] = np.add.reduceat(part.on.view(np.uint8), runs[:-1] - runs[0], axis=1, dtype=np.uint8)
            some = np.flatnonzero(count)
            sizes = count.ravel()[some].astype(np.intp)
            begin = np.cumsum(sizes) - sizes
            own = weights[:, :, docs]
            inputs = np.empty((INPUTS, n), np.float32)
            inputs[0] = 1
            coded.trees.path_odds.take(part.at, mode="clip", out=inputs[1])
            for x, table, slots in zip(inputs[2:], self.tables, part.slots):
                np.multiply(table.take(slots.astype(np.intp), mode="clip"), step, out=x)
            mixed = np.repeat(own[:, gates].reshape(INPUTS, -1)[:, some], sizes, axis=1)
            mixed *= inputs
            z = np.add.reduce(mixed, axis=0)
            np.clip(z, -SPREAD + 0.01, SPREAD - 0.01, out=z)
            bit = part.bit.astype(np.float32)
            if priced or refining:
                cell = ((z + SPREAD) * (REFINE / (2 * SPREAD))).astype(np.intp)
                cell += np.repeat(gates * REFINE, part.each)
            if priced:
                refined = flat.take(cell, mode="clip")
                refined += z
                refined *= np.float32(0.5)
                refined *= 1 - 2 * bit
                np.exp(refined, out=refined)
                refined += 1
                wide = np.log(refined, out=refined).astype(float)
                price = np.zeros(count.shape)
                price.reshape(-1)[some] = np.add.reduceat(wide, begin)
                cost[docs] += price.sum(0)
            error = np.exp(np.negative(z, out=z), out=z)
            error += 1
            np.subtract(bit, np.divide(1, error, out=error), out=error)
            inputs *= error
            sums = np.zeros((INPUTS, *count.shape))
            sums.reshape(INPUTS, -1)[:, some] = np.add.reduceat(inputs.astype(float), begin, axis=1)
            for x in (count, *sums):
                x[GATES - 1] += x[GATES:].sum(0)
            own += RATE / (count[:GATES] + PRIOR_ROWS) * sums[:, :GATES]
            weights[:, :, docs] = own
            if refining:
                cell += part.bit * np.intp(GATES * REFINE)
                seen += np.bincount(cell, minlength=seen.size).reshape(seen.shape)
        return cost, weights[np.argsort(order)].transpose(2, 1, 0).reshape(-1, INPUTS), seen

    def start(self, trees: Trees, groups: list[Words | list[list[bytes]]]) -> Coded | None:
        """Start weights move to the mean of the texts' last weights.  Groups of texts are coded when they are read, so only
        one of them is held; a single one is coded once, and returned."""
        only = Coded(trees, groups[0], self.slot_bits) if len(groups) == 1 else None
        for _ in range(EPOCHS):
            total, n = np.zeros((GATES, INPUTS)), 0
            for group in groups:
                _, w, _ = self.read(only or Coded(trees, group, self.slot_bits), len(group), priced=False)
                total += w.reshape(len(group), GATES, INPUTS).sum(0)
                n += len(group)
            if n:
                self.weights = (total / n).astype(np.float32)
        return only

    def fit(self, trees: Trees, groups: list[Words | list[list[bytes]]]) -> None:
        """The start weights, then the refining table."""
        only = self.start(trees, groups)
        counts = sum((self.read(only or Coded(trees, g, self.slot_bits), len(g), True, False)[2] for g in groups), np.zeros((2, GATES * REFINE)))
        self.set_fit(self.weights, 1, counts)

    def set_fit(self, weights: np.ndarray, texts: int, counts: np.ndarray) -> None:
        """Start weights from the sum of the texts' last weights, the refining table from their decisions."""
        if texts:
            self.weights = (weights / texts).astype(np.float32)
        grid = self.refine.ravel()
        pull = 20.0   # counts as much as this many decisions at the grid's own odds
        p = 1 / (1 + np.exp(-grid))
        self.refine = np.log((counts[1] + pull * p) / (counts[0] + pull * (1 - p))).astype(np.float32).reshape(GATES, REFINE)


def log_odds(counts: np.ndarray) -> np.ndarray:
    """counts: slots x 2.  Log odds in steps of 1 / STEPS, a byte each."""
    odds = np.log((counts[:, 1] + np.float32(0.4)) / (counts[:, 0] + np.float32(0.4)))
    return np.rint(np.clip(odds * STEPS, -127, 127)).astype(np.int8)


def add_counts(tables: np.ndarray, slots: Sequence[Sequence[np.ndarray]], bits: Sequence[np.ndarray]) -> None:
    """slots: for each context the slots of some batches; bits: of the same batches."""
    bit = np.concatenate(bits).view(np.uint8)
    for table, batches in zip(tables, slots):
        counts, places = table.reshape(-1), np.concatenate(batches).view(np.uint32)
        places <<= np.uint32(1)
        places |= bit
        places.sort()           # neighbours are added one after another
        np.add.at(counts, places.astype(np.intp), counts.dtype.type(1))


def token_counts(rows: DataFrame) -> DataFrame:
    """(token, n) over the texts; every task adds up what it can hold before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> pa.Table:
            return pa.Table.from_batches(held).group_by("token").aggregate([("n", "sum")]).rename_columns(["token", "n"])

        for b in batches:
            words, sizes = split(b.column(0))
            seen = pc.value_counts(words)
            held += [pa.record_batch([seen.field(0), seen.field(1)], ["token", "n"]),
                     pa.record_batch([pa.array([END], pa.binary()), pa.array([len(sizes)], pa.int64())], ["token", "n"])]
            size += len(seen)
            if size > 2 * FLUSH:
                table = merged()
                held, size = table.to_batches(), table.num_rows
                if size > FLUSH:
                    yield from held
                    held, size = [], 0
        if held:
            yield from merged().to_batches()

    return rows.select("text").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def slot_bits(tokens: int) -> int:
    """The tables grow with the training tokens, up to a size that every task can hold."""
    return min(MOST_SLOT_BITS, max(LEAST_SLOT_BITS, (tokens // 4).bit_length()))


def packed(part: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(part), codec="zstd", asbytes=True)


def unpacked(blob: bytes, kind: type, slots: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, slots * 2 * np.dtype(kind).itemsize, codec="zstd"), kind).reshape(slots, 2)


def bit_counters(rows: DataFrame, trees: Trees, bits: int, tasks: int) -> np.ndarray:
    """CONTEXTS x 2^bits x 2 counters over all texts of rows: each task's tables travel in compressed chunks
    and are added up chunk by chunk; the sums, at most CONTEXTS x 2^MOST_SLOT_BITS, come to the driver."""
    slots = 1 << bits
    size = min(CHUNK, slots)
    per = slots // size
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        tables = np.zeros((CONTEXTS, slots, 2), np.int32)
        for b in batches:
            for group in numbered(trees, b.column(0))[0].groups(COUNT_WORDS):
                coded = Coded(trees, group, bits, counted=True)
                made = (coded.part(a, a + PART_WORDS) for a in range(0, len(coded.ids), PART_WORDS))
                places, bit = zip(*((p.slots, p.bit) for p in made))
                add_counts(tables, list(zip(*places)), bit)
        for k in range(CONTEXTS):
            for c in range(per):
                part = tables[k, c * size:(c + 1) * size]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k * per + c], pa.int32()), pa.array([packed(part)], pa.binary())],
                        names=["chunk", "blob"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, blob in zip(b.column(0).to_pylist(), b.column(1)):
                part = unpacked(blob.as_py(), np.int32, size).astype(np.float32)
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        for chunk, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([packed(part)], pa.binary())],
                                             names=["chunk", "blob"])

    kind = "chunk int, blob binary"
    parts = rows.select("text").coalesce(tasks).mapInArrow(fill, kind).repartition("chunk").mapInArrow(add, kind).collect()
    out = np.zeros((CONTEXTS, slots, 2), np.float32)    # log odds need no more
    while parts:
        r = parts.pop()
        k, c = divmod(r["chunk"], per)
        out[k, c * size:(c + 1) * size] = unpacked(r["blob"], np.float32, size)
    return out


def fit_sums(rows: DataFrame, trees: Trees, odds: list[list[np.ndarray]], tasks: int) -> tuple[np.ndarray, int, np.ndarray]:
    """(sum of the texts' last weights, texts, counts of the refining table) over all rows (text, half); ``odds``: for each
    half the tables that it is read with.  A task starts each step of FIT_DOCS texts with the mean of the last weights of
    the step before; its first step, read EPOCHS times before, is counted once as well.  A row of a few hundred numbers a task comes back."""
    shared = rows.sparkSession.sparkContext.broadcast((trees, odds))
    sizes = GATES * INPUTS, 2 * GATES * REFINE

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, odds = shared.value
        mixers = [Mixer(t) for t in odds]
        start, total, texts, seen = mixers[0].weights, np.zeros((GATES, INPUTS)), 0, np.zeros((2, GATES * REFINE))
        for b in batches:
            for h, mixer in enumerate(mixers):
                own = b.filter(pc.equal(b.column(1), h)).column(0)
                for group in numbered(trees, own)[0].groups(BATCH_WORDS):
                    for at in range(0, len(group), FIT_DOCS):
                        step = group.slice(at, min(at + FIT_DOCS, len(group)))
                        mixer.weights = start
                        coded = None if texts else mixer.start(trees, [step])
                        _, last, counts = mixer.read(coded or Coded(trees, step, mixer.slot_bits), len(step), True, False)
                        last = last.reshape(len(step), GATES, INPUTS).sum(0, dtype=np.float64)
                        start = (last / len(step)).astype(np.float32)
                        total, texts, seen = total + last, texts + len(step), seen + counts
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64())), pa.array([texts], pa.int64()),
                                          pa.array([seen.ravel()], pa.list_(pa.float64()))], names=["weights", "texts", "seen"])

    parts = rows.coalesce(tasks).mapInArrow(fit, "weights array<double>, texts long, seen array<double>").collect()
    weights, seen = (sum((np.array(r[c]) for r in parts), np.zeros(n)) for c, n in zip(("weights", "seen"), sizes))
    return weights.reshape(GATES, INPUTS), sum(r["texts"] for r in parts), seen.reshape(2, GATES * REFINE)


def train(training: DataFrame, counts: DataFrame, n_training: int, total: int) -> tuple[Trees, Mixer, dict[bytes, int]]:
    """Trees, mixer and the head's counts.  training: key (hash of id and text), text."""
    frequent = counts.filter((F.col("n") >= MIN_COUNT) & (F.length("token") > 0)).orderBy(F.desc("n"), "token").limit(HEAD)
    head = [(bytes(r["token"]), r["n"]) for r in frequent.collect()]
    head += [(END, n_training)] if n_training else []     # one end token for each training document
    trees = Trees(head, total - sum(n for _, n in head))
    tasks = 2 * training.sparkSession.sparkContext.defaultParallelism
    bits = slot_bits(total)
    half = F.pmod("key", F.lit(2))          # equal rows are in one half
    tables = [bit_counters(training.filter(half == h), trees, bits, tasks) for h in (0, 1)]
    odds = [[log_odds(t) for t in tables[1 - h]] for h in (0, 1)]
    tables = np.add(*tables, out=tables[0])
    fitted = fit_sums(training.select("text", half.cast("int").alias("half")), trees, odds, tasks)
    mixer = Mixer([log_odds(t) for t in tables])
    mixer.set_fit(*fitted)
    return trees, mixer, dict(head)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (crc32_mod(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"),
                       F.col(text_col).alias("text"))
    training = rows.filter(~F.col("held_out")).select(F.xxhash64("doc_id", "text").alias("key"), "text")
    counts = cut(token_counts(training), "token-counts")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
                      F.coalesce(F.sum(F.when(F.length("token") == 0, F.col("n"))), F.lit(0)).alias("docs")).first()
    total, space = sums["n"], sums["n"] + sums["v"] + 1
    trees, mixer, head = train(training, counts, sums["docs"], total)
    # behind the escape: the words outside the head by their counts, and one share for all unknown ones
    tail = space - sum(n + 1 for n in head.values())
    symbols = len(trees.length)
    context = docs.sparkSession.sparkContext
    base, counted = np.zeros(symbols), np.zeros(symbols, bool)
    for w, i in trees.words.items():
        base[i], counted[i] = math.log10((head.get(w, 0) + 1) / space), w in head
    shared = context.broadcast((trees, mixer, base, counted))    # HEAD words, CONTEXTS * 2^MOST_SLOT_BITS bytes at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, mixer, base, counted = shared.value
        for b in batches:
            at, begin = 0, 0
            texts, words = numbered(trees, b.column(2))
            for group in texts.groups(SCORE_WORDS):
                n = len(group)
                coded = Coded(trees, group, mixer.slot_bits)
                nats, _, _ = mixer.read(coded, n)
                head_base = np.bincount(coded.doc, base[coded.ids], n)
                known = np.bincount(coded.doc, counted[coded.ids], n).astype(np.int64)
                ends = begin + np.r_[0, np.cumsum(np.bincount(coded.doc[coded.ids == 0], minlength=n))].astype(np.int32)
                begin = ends[-1]
                size = pc.binary_length(b.column(2).slice(at, n)).fill_null(0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, n), b.column(1).slice(at, n), pa.array(group.sizes, pa.int64()),
                     pa.array(known), pa.array(head_base), pa.array(-nats / math.log(10)), size.cast(pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), words)],
                    names=["doc_id", "held_out", "n_tokens", "known", "head_base", "head_score", "bytes", "rare"])
                at += n

    scored = rows.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, known long, head_base double, "
                                    "head_score double, bytes long, rare array<binary>")
    scored = cut(scored.withColumn("rid", F.monotonically_increasing_id()), "scored")
    rare = (scored.select("rid", F.explode("rare").alias("token")).join(counts, "token", "left").groupBy("rid")
            .agg(F.count(F.lit(1)).alias("k"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("logs"),
                 F.count("n").alias("rare_known")))
    k, logs = F.coalesce("k", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    score_of = F.col("head_score") + logs - k * F.lit(math.log10(tail))
    return scored.drop("rare").join(rare, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + logs - k * F.lit(math.log10(space))).alias("base_score"), score_of.alias("score"),
        (-score_of * F.lit(math.log2(10)) / F.greatest("bytes", F.lit(1))).alias("bits_per_byte"))

"""Licence scans: an exact set-similarity join of text blocks with licence templates.

Tokens are put in one global order, rarest first, by their document counts over the whole corpus.  A block
contains a template when at least ``THRESHOLD`` of the template's distinct tokens occur in it.  Then at least
one of the first |T| - need + 1 tokens of the template (its prefix) occurs in the block; blocks that are too
short, or whose place of the first shared token leaves too few tokens, are dropped before counting.  No filter
loses a match, so the join is exact.

Blocks are windows of 2 * L words (L: the longest template), L apart, over the words of the whole text, so each
run of L words lies whole in one block, also across line ends.  Lines of more than L words are blocks too (in the
same windows from the line's start), as a line's words may be farther apart.  The template side is a parameter of a
few dozen rows: its prefix index goes to the tasks, and the documents are never shuffled.

Results for odd rows: null and empty texts have no words, no label and score 0; repeated rows are scanned each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.9

# Phrases of the base scan and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("reserved", "copyright all rights reserved"),
]

#: A-Z become a-z; digits, letters and bytes of characters beyond ASCII stay; all else separates.
_TABLE = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_COLUMNS = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
            "labels string, score double, template string, block int")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def token_counts(docs: DataFrame, vocabulary: set[bytes], text_col: str) -> dict[bytes, int]:
    """In how many documents each template token occurs: summed map-side, one row per token left."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                seen.update(vocabulary.intersection(words_of((t.as_py() or "").encode())))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()),
                                          pa.array(list(seen.values()), pa.int64())], names=["token", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "token string, n long")
    return {r["token"].encode(): r["n"] for r in found.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class TemplateIndex:
    """Templates as token lists in the global order, and their prefixes' inverted index."""

    def __init__(self, templates, counts: dict[bytes, int], threshold: float):
        sets = [(label, text, set(words_of(text.encode()))) for label, text in templates]
        vocabulary = set().union(*(s for _, _, s in sets))
        self.rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
        self.longest = max(len(words_of(t.encode())) for _, t in templates)
        self.labels = [label for label, _, _ in sets]
        self.names = [text for _, text, _ in sets]
        self.tokens = [sorted(self.rank[w] for w in s) for _, _, s in sets]
        self.sets = [frozenset(t) for t in self.tokens]
        self.need = [math.ceil(threshold * len(t) - 1e-9) for t in self.tokens]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for k, (t, need) in enumerate(zip(self.tokens, self.need)):
            for i, r in enumerate(t[:len(t) - need + 1]):
                self.prefix.setdefault(r, []).append((k, i))
        words = list(self.rank)
        self.keys = frozenset(words[r] for r in self.prefix)

    def matches(self, block: list[bytes]) -> dict[int, float]:
        """Template number -> containment, of the templates that this block contains."""
        own = sorted({self.rank[w] for w in block if w in self.rank})
        out: dict[int, float] = {}
        dropped = set()
        for j, r in enumerate(own):
            for k, i in self.prefix.get(r, ()):
                if k in out or k in dropped:
                    continue
                need, size = self.need[k], len(self.tokens[k])
                # length and positional filters: this is the first token that both share
                if len(own) < need or 1 + min(size - i - 1, len(own) - j - 1) < need:
                    dropped.add(k)
                    continue
                shared = len(self.sets[k].intersection(own))
                if shared >= need:
                    out[k] = shared / size
                else:
                    dropped.add(k)
        return out


def blocks(text: bytes, longest: int) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the line where the block begins, its words)."""
    words: list[bytes] = []
    lines: list[int] = []
    for n, line in enumerate(text.split(b"\n")):
        own = words_of(line)
        words += own
        lines += [n] * len(own)
        if len(own) > longest:
            for a in range(0, len(own) - longest, longest):
                yield n, own[a:a + 2 * longest]
    if words and (lines[0] != lines[-1] or len(words) <= longest):
        for a in range(0, max(1, len(words) - longest), longest):
            yield lines[a], words[a:a + 2 * longest]


def base_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place of every phrase."""
    text = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        key = b" " + phrase.encode() + b" "
        at, seen, counted = text.find(key), 0, 0
        while at >= 0:
            counted += text.count(b" ", seen, at)
            seen = at
            out.append((counted, label))
            at = text.find(key, at + 1)
    return out


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
                 phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the base counts and labels, the labels of both, the best containment (score),
    the best template's text and the number of the line where its block begins (block)."""
    vocabulary = {w for _, t in templates for w in words_of(t.encode())}
    index = TemplateIndex(templates, token_counts(docs, vocabulary, text_col), threshold)

    def scan_one(text: bytes) -> tuple:
        words = words_of(text)
        places = base_places(words, phrases)
        best, labels, where = 0.0, {x for _, x in places}, (None, None)
        if not index.keys.isdisjoint(words):
            for line, block in blocks(text, index.longest):
                for k, share in index.matches(block).items():
                    labels.add(index.labels[k])
                    if share > best:
                        best, where = share, (index.names[k], line)
        starts = [a for a, _ in places]
        return (len(words), len(places), min(starts, default=None), max(starts, default=None),
                ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), 1.0 if places else best, *where)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string(), pa.int32()]
        for b in batches:
            rows = [scan_one((t.as_py() or "").encode()) for t in b.column(1)]
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "template", "block"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, _COLUMNS)

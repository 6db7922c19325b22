"""Fill-in-middle transformation over piece tables.

A document is a list of descriptors (buffer, start, length) over two immutable buffers: its text and the sentinels.
Cutting splits a descriptor, an arrangement permutes descriptors and puts sentinel descriptors between them, and the
inverse permutation restores the order.  No text is copied until an output is asked for: hashes read the descriptors'
bytes as a stream.  Every row is handled alone in one narrow pass (Arrow tasks), so nothing is shuffled and a lost
executor only repeats its own rows.

Units are the matches of ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: every one but a last run of white space
ends where a word ends.  Only ASCII bytes are white space, so units of UTF-8 bytes are units of code points.

Results for odd rows: a null text equals an empty one, both plain with 0 units; a text that holds a sentinel stays
plain; a null doc_id is hashed as empty text; repeated rows are handled alike; a cut may leave empty parts; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.session import ship_package

PREFIX, MIDDLE, SUFFIX = 0, 1, 2
MARKS = {PREFIX: b"<P>", SUFFIX: b"<S>", MIDDLE: b"<M>"}
#: order of the three parts in each form; each stands behind its own sentinel
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
SENTINELS = b"".join(MARKS[p] for p in (PREFIX, SUFFIX, MIDDLE))
TEXT, SENTINEL = 0, 1           # the buffers
RATE, SPM, SEED = 50, 80, 42    # per cent rearranged, per cent of those as spm, seed of the hashes

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

PIECES = T.ArrayType(T.StructType([T.StructField("buffer", T.IntegerType()), T.StructField("start", T.LongType()),
                                   T.StructField("length", T.LongType())]))


class PieceTable:
    """Descriptors over immutable buffers."""

    def __init__(self, buffers: tuple[bytes, ...], pieces: list[tuple[int, int, int]] | None = None):
        self.buffers = buffers
        self.pieces = [(TEXT, 0, len(buffers[TEXT]))] if pieces is None else pieces

    def cut(self, piece: int, at: int) -> None:
        """Split a descriptor in two, at its byte ``at``; either may be empty."""
        buffer, start, length = self.pieces[piece]
        self.pieces[piece:piece + 1] = [(buffer, start, at), (buffer, start + at, length - at)]

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield memoryview(self.buffers[buffer])[start:start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def __bytes__(self) -> bytes:
        return b"".join(self.stream())


def unit_ends(text: bytes) -> np.ndarray:
    """Byte offsets at which the units of a text end."""
    if not text:
        return np.empty(0, np.int64)
    space = _SPACE[np.frombuffer(text, np.uint8)]
    return np.append(np.flatnonzero(space[1:] > space[:-1]) + 1, len(text))


def code_points(text: bytes, start: int, end: int) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8, end - start, start) & 0xC0) != 0x80)) if end > start else 0


def arrange(text: bytes, key: str, rate: int = RATE, spm: int = SPM, seed: int = SEED):
    """(piece table of the output, number of units, form, code points of prefix and middle or None)."""
    ends = unit_ends(text)
    n, table = len(ends), PieceTable((text, SENTINELS))
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    one, two, three, four = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or three % 100 >= rate or any(m in text for m in MARKS.values()):
        return table, n, "plain", None, None
    low, high = (int(ends[k - 1]) if k else 0 for k in sorted((one % (n + 1), two % (n + 1))))
    table.cut(0, low)
    table.cut(1, high - low)
    form = "spm" if four % 100 < spm else "psm"
    parts = table.pieces
    table.pieces = [d for p in ORDER[form]
                    for d in ((SENTINEL, SENTINELS.index(MARKS[p]), len(MARKS[p])), parts[p])]
    return table, n, form, code_points(text, 0, low), code_points(text, low, high)


def restored(output: bytes, form: str) -> PieceTable:
    """The piece table of the text that an output was made of, over the output alone.  No part holds a sentinel and
    sentinels do not overlap themselves, so the first match of each behind the one before is the one that was put in."""
    table = PieceTable((output,))
    if form == "plain":
        return table
    at = 0
    for i, part in enumerate(ORDER[form]):
        mark = MARKS[part]
        begin = output.index(mark, at)
        table.cut(2 * i, begin - at)                  # what stands before the sentinel
        table.cut(2 * i + 1, len(mark))               # the sentinel, and the rest
        at = begin + len(mark)
    behind = table.pieces[2::2]                       # the descriptor behind each sentinel, in the form's order
    inverse = sorted(range(3), key=ORDER[form].__getitem__)
    table.pieces = [behind[i] for i in inverse]
    return table


def _mapped(docs: DataFrame, id_col: str, text_col: str, fields: list[T.StructField], row: Callable) -> DataFrame:
    """doc_id and what row(text, key) returns."""
    ship_package(docs.sparkSession)
    quoted = F.col(f"`{id_col}`")
    rows = docs.select(quoted.alias("doc_id"), F.coalesce(quoted.cast("string"), F.lit("")).alias("key"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *fields])
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                made = [row(text.as_py(), key.as_py()) for key, text in zip(part.column(1), part.column(2).cast(pa.binary()))]
                columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


_COMMON = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm: int = SPM,
                   seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, pieces (the output's descriptors; buffer 0 is the text's UTF-8,
    buffer 1 the sentinels) and output, the rendered text."""
    def row(text: bytes, key: str):
        table, *known = arrange(text, key, rate, spm, seed)
        pieces = [{"buffer": b, "start": s, "length": n} for b, s, n in table.pieces]
        return (*known, pieces, bytes(table))

    return _mapped(docs, id_col, text_col,
                   [*_COMMON, T.StructField("pieces", PIECES), T.StructField("output", T.StringType())], row)


def restore(filled: DataFrame) -> DataFrame:
    """doc_id and text, rebuilt from nothing but output and form."""
    ship_package(filled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [bytes(restored(o.as_py(), f.as_py())) for o, f in zip(b.column(1).cast(pa.binary()), b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    schema = T.StructType([T.StructField("doc_id", filled.schema["doc_id"].dataType), T.StructField("text", T.StringType())])
    return filled.select("doc_id", "output", "form").mapInArrow(run, schema)


def fill_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm: int = SPM,
                 seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 (streamed over the descriptors) and restored_sha256
    (streamed over the descriptors of the text that is rebuilt from the output)."""
    def row(text: bytes, key: str):
        table, *known = arrange(text, key, rate, spm, seed)
        return (*known, table.sha256(), restored(bytes(table), known[1]).sha256())

    return _mapped(docs, id_col, text_col, [*_COMMON, T.StructField("output_sha256", T.StringType()),
                                            T.StructField("restored_sha256", T.StringType())], row)


SQL = r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                      regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                      sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
         k AS (SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a,
                      CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
                      CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
                           WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
         c AS (SELECT *, coalesce(array_to_string(list_slice(u, 1, least(a, b)), ''), '') AS p,
                      coalesce(array_to_string(list_slice(u, least(a, b) + 1, greatest(a, b)), ''), '') AS m,
                      coalesce(array_to_string(list_slice(u, greatest(a, b) + 1, n), ''), '') AS s FROM k)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(text) AS restored_sha256 FROM c"""

"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into quantile bins and owns a lookup table.  Boosting goes round the features in turn;
every step fits a shallow tree to the current residuals over one feature's bins (three leaves) and adds it to
that feature's table.  Then the pairs with the largest gain get a two-dimensional table, boosted the same
way by trees of one cut per feature.  A score is the sum of the looked-up values through the logistic function.

The model is fitted on at most ``train_rows`` labelled documents (in hash order); their features are computed
in Spark and only those numbers reach the driver.  Scoring runs over all documents in one pass: features and
table additions in the same task, no shuffle.

Results for odd rows: a null text counts as empty and is scored like any text; a document labelled both 0 and 1
and null labels are not learned from; without both classes every score is 0.5 (kept); repeated rows are scored
each; an empty table gives no rows; other columns are ignored by ``quality_scores`` and kept by ``keep_good``.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod

TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 48, 12, 5
ROUNDS, PAIR_ROUNDS, RATE, LEAST_ROWS = 120, 40, 0.15, 20
FOLDS, HELD_OUT = 3, 1

#: Byte classes counted in one histogram product.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
           "space": b" \t\n\r\x0b\x0c", "newline": b"\n", "symbol": b"#*$%&<>", "pipe": b"|", "loud": b"!?", "stop": b".,;:",
           "high": bytes(range(128, 256))}
MASKS = np.array([[b in c for c in CLASSES.values()] for b in range(256)], float)
NAMES = ["log_bytes", "log_words", "word_bytes", "longest", "upper", "digit", "symbol", "pipe", "loud", "stop", "high",
         "words_a_line", "dup_lines", "distinct_words", "next_equal", "dup_windows"]


def features(text: bytes) -> list[float]:
    words = text.split()
    n, k = len(text), max(len(words), 1)
    counts = dict(zip(CLASSES, np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ MASKS)) if n else dict.fromkeys(CLASSES, 0.0)
    letters = max(counts["upper"] + counts["lower"], 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = len(words) - 2
    return [np.log1p(n), np.log1p(len(words)), (n - counts["space"]) / k, max(map(len, words), default=0),
            counts["upper"] / letters, counts["digit"] / k, counts["symbol"] / k, counts["pipe"] / k, counts["loud"] / k,
            counts["stop"] / k, counts["high"] / max(n, 1), len(words) / max(len(lines), 1),
            1 - len(set(lines)) / max(len(lines), 1), len(set(words)) / k,
            sum(map(operator.eq, words, words[1:])) / k,
            1 - len(set(zip(words, words[1:], words[2:]))) / windows if windows > 0 else 0.0]


def feature_rows(texts) -> np.ndarray:
    rows = [features((t.as_py() or "").encode()) for t in texts]
    return np.array(rows, float).reshape(len(rows), len(NAMES))


@dataclass
class AdditiveModel:
    """edges and table per feature; (i, j) -> two-dimensional table over coarse bins."""
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            z += table[np.searchsorted(edges, x[:, f], side="right")]
        for (i, j), table in self.pairs.items():
            z += table[np.searchsorted(self.coarse[i], x[:, i], side="right"),
                       np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Leaf value for every bin of a three-leaf tree: the best cut, then the best further one."""
    cuts = [0, len(g)]
    for _ in range(2):
        best, where = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            cg, ch, cn = (np.cumsum(v[a:b]) for v in (g, h, n))
            lg, lh, ln = cg[:-1], ch[:-1], cn[:-1]
            gain = lg ** 2 / (lh + 1) + (cg[-1] - lg) ** 2 / (ch[-1] - lh + 1) - cg[-1] ** 2 / (ch[-1] + 1)
            gain[(ln < LEAST_ROWS) | (cn[-1] - ln < LEAST_ROWS)] = -1
            if gain.max(initial=-1) > best:
                best, where = gain.max(), a + int(gain.argmax()) + 1
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """One cut in each of two features (four leaves): leaf values of all cells, and the gain."""
    def quarters(m):
        c = m.cumsum(0).cumsum(1)
        a = c[:-1, :-1]
        right, below = c[:-1, -1:] - a, c[-1:, :-1] - a
        return np.stack([a, right, below, c[-1, -1] - a - right - below])
    qg, qh = quarters(g), quarters(h)
    gains = (qg ** 2 / (qh + 1)).sum(0) - g.sum() ** 2 / (h.sum() + 1)
    r, c = np.unravel_index(int(gains.argmax()), gains.shape)
    v = _leaf(qg[:, r, c], qh[:, r, c])
    out = np.empty(g.shape)
    out[:r + 1, :c + 1], out[:r + 1, c + 1:], out[r + 1:, :c + 1], out[r + 1:, c + 1:] = v
    return out, float(gains[r, c])


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting over features, then over the pairs with the largest first gain."""
    if len(y) == 0 or y.min() == y.max():
        return AdditiveModel()
    share = y.mean()
    m = AdditiveModel(float(np.log(share / (1 - share))))
    z = np.full(len(y), m.intercept)
    bins, low = [], []
    for f in range(x.shape[1]):
        m.edges.append(np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])))
        m.coarse.append(np.unique(np.quantile(x[:, f], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])))
        bins.append(np.searchsorted(m.edges[f], x[:, f], side="right"))
        low.append(np.searchsorted(m.coarse[f], x[:, f], side="right"))
        m.tables.append(np.zeros(len(m.edges[f]) + 1))
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, m.tables)]

    def residual():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, (b, t) in enumerate(zip(bins, m.tables)):
            g, h = residual()
            step = RATE * _shallow_tree(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)), sizes[f])
            t += step
            z += step[b]
    cells = {}
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            shape = (len(m.coarse[i]) + 1, len(m.coarse[j]) + 1)
            if min(shape) > 1:
                cells[i, j] = (low[i] * shape[1] + low[j], shape)

    def cross(key):
        at, shape = cells[key]
        g, h = residual()
        k = shape[0] * shape[1]
        return _cross_tree(np.bincount(at, g, k).reshape(shape), np.bincount(at, h, k).reshape(shape))

    chosen = sorted(cells, key=lambda key: -cross(key)[1])[:PAIRS]
    m.pairs = {key: np.zeros(cells[key][1]) for key in chosen}
    for _ in range(PAIR_ROUNDS):
        for key in chosen:
            step = RATE * cross(key)[0]
            m.pairs[key] += step
            z += step.ravel()[cells[key][0]]
    return m


def training_ids(labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``train_rows`` labelled ids that are not held out, in hash order."""
    one = (labels.filter("quality is not null and doc_id is not null").groupBy("doc_id")
           .agg(F.min("quality").alias("a"), F.max("quality").alias("b")).filter("a = b"))
    return (one.filter(crc32_mod(F.col("doc_id"), FOLDS) != HELD_OUT).orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(train_rows).select(F.col("doc_id").alias("__id"), F.col("a").cast("int").alias("__label")))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          train_rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Features of the sampled rows (numbers only) come to the driver, ``train_rows`` at most."""
    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = feature_rows(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "label", "x"])

    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
              .join(F.broadcast(training_ids(labels, train_rows)), F.col("id") == F.col("__id"))
              .select(F.col("id").cast("long"), "text", "__label"))
    rows = sample.mapInArrow(featured, "id long, label int, x array<double>").toPandas().sort_values("id", kind="stable")
    rows = rows[:train_rows]  # an id may have several rows
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(NAMES))
    order = np.lexsort((*x.T, rows["id"].to_numpy()))
    return fit(x[order], rows["label"].to_numpy(float)[order])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = train(docs, labels, id_col, text_col, train_rows)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.round(model.score(feature_rows(b.column(2))), 9)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype("int32"))],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (crc32_mod(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents predicted good, whole rows with all their columns."""
    model = train(docs, labels, id_col, text_col, train_rows)
    at = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.round(model.score(feature_rows(b.column(at))), 9)
            yield b.filter(pa.array(s >= 0.5))

    return docs.mapInArrow(kept, docs.schema)

"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a whole text are cut into bins. Cyclic boosting visits the features in turn; each visit fits a shallow tree of
that feature alone to the gradient of the logistic loss and adds it to the feature's lookup table. Then the pairs of features whose
joint bins explain the residual best get two-dimensional tables in the same way. A score is a sum of table entries.

The model is fitted on a bounded sample of labelled rows: about ``SAMPLE`` of them, chosen by the hash of their id. Every document is scored.
Null and empty texts have all features 0 and are scored too. Without labels of both classes the score is the share of ones
(0.5 without any). Only the text enters a score. Repeated rows are scored alike; other columns are kept, whatever their names.
Very long texts are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from .scratch import add_columns, share
from .wordhash import Words

SAMPLE = 20_000
BINS = 24
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.1
LEAST_ROWS = 12.0
SHRINK = 4.0
#: Features of a text, in the order of the columns.
FEATURES = ["log_words", "word_bytes", "word_bytes_spread", "upper", "digit", "mark", "odd_mark", "high_byte", "distinct_words", "distinct_pairs", "top_word", "line_words", "repeated_lines", "repeated_line_bytes", "same_word_runs", "sentence_words", "short_words", "bracket_or_code"]
THRESHOLD = 0.3


def _byte_classes() -> np.ndarray:
    """One column for each kind of byte: upper, digit, mark, odd mark, high, newline, sentence end, bracket or code."""
    kinds = np.zeros((256, 8), np.float64)
    kinds[65:91, 0] = 1
    kinds[48:58, 1] = 1
    kinds[[ord(c) for c in ".,;:!?'\"-"], 2] = 1
    kinds[[ord(c) for c in "#$%&*@^~|+=_!"], 3] = 1
    kinds[128:, 4] = 1
    kinds[10, 5] = 1
    kinds[[ord(c) for c in ".!?"], 6] = 1
    kinds[[ord(c) for c in "<>{}[]()/\\"], 7] = 1
    return kinds


def _row(b: np.ndarray, counts: np.ndarray, words: np.ndarray, lengths: np.ndarray, p: np.ndarray, q: np.ndarray) -> list[float]:
    """Features of a text from its bytes, word hashes and word lengths; p and q are powers for hashes of its lines and their inverses."""
    n, size = len(words), max(1, len(b))
    if not n:
        return [0.0] * len(FEATURES)
    by_byte = np.bincount(b, minlength=256) @ counts
    _, uses = np.unique(words, return_counts=True)
    pairs = words[1:] * np.uint64(3) + words[:-1]
    ends = np.concatenate([np.flatnonzero(b == 10), [len(b)]])
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) * p[: len(b)], out=sums[1:])
    starts = np.concatenate([[0], ends[:-1] + 1])
    line = (sums[ends] - sums[starts]) * q[np.minimum(starts, len(b) - 1)]
    _, first, line_uses = np.unique(line, return_index=True, return_counts=True)
    line_bytes = (ends - starts)[first]
    upper, digit, mark, odd, high, _, stops, code = by_byte
    return [
        np.log1p(n), lengths.mean(), lengths.std(), upper / size, digit / size, mark / size, odd / size, high / size,
        len(uses) / n, len(np.unique(pairs)) / max(1, n - 1), uses.max() / n, n / len(ends),
        1 - len(first) / len(ends), float((line_bytes * (line_uses - 1)).sum()) / size,
        float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0, n / (stops + 1), float((lengths <= 3).mean()), code / size,
    ]


def _extractor():
    """A function from a string array to a matrix of features of whole texts."""
    words, counts = Words(), _byte_classes()

    def extract(column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), len(FEATURES)))
        strings = column.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
        for first, bounds, hashes, b, starts, ends in words.chunks(strings, with_bytes=True):
            for i in range(len(bounds) - 1):
                low, high = offsets[first + i] - offsets[first], offsets[first + i + 1] - offsets[first]
                own = slice(bounds[i], bounds[i + 1])
                out[first + i] = _row(b[low:high], counts, hashes[own], ends[own] - starts[own], words.p, words.q)
        return out

    return extract


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """(kept columns, features array) of every whole text; the array's name gets underscores in front if a kept column has it."""

    def start():
        extract = _extractor()
        return lambda column: [pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * len(FEATURES)), pa.array(extract(column).ravel()))]

    return add_columns(docs, [F.col("text")], keep, {"features": ArrayType(DoubleType())}, start)


@dataclass
class Gam:
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    bias: float
    tables: np.ndarray
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: np.ndarray = field(default_factory=lambda: np.zeros((0, PAIR_BINS, PAIR_BINS)))

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)], axis=1) if len(x) else np.zeros((0, len(edges)), np.int64)

    def logits(self, x: np.ndarray) -> np.ndarray:
        fine = self.bins(x, self.edges)
        out = self.bias + self.tables[np.arange(fine.shape[1]), fine].sum(axis=1)
        coarse = self.bins(x, self.coarse)
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[coarse[:, i], coarse[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return g.sum() / (h.sum() + SHRINK)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """Values by bin of the best tree of this depth on one ordered feature, from gradient, curvature and rows of each bin."""
    if depth and len(g) > 1:
        gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
        gain = gl**2 / (hl + SHRINK) + (g.sum() - gl) ** 2 / (h.sum() - hl + SHRINK) - g.sum() ** 2 / (h.sum() + SHRINK)
        gain[(nl < LEAST_ROWS) | (n.sum() - nl < LEAST_ROWS)] = 0
        cut = int(gain.argmax())
        if gain[cut] > 1e-9:
            return np.concatenate([_tree(g[: cut + 1], h[: cut + 1], n[: cut + 1], depth - 1), _tree(g[cut + 1 :], h[cut + 1 :], n[cut + 1 :], depth - 1)])
    return np.full(len(g), _leaf(g, h))


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of the best table with one cut along each axis, and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    gt, ht = cg[-1, -1], ch[-1, -1]
    parts = []
    for c, t in ((cg, gt), (ch, ht)):
        top, left = c[:-1, -1:], c[-1:, :-1]
        a = c[:-1, :-1]
        parts.append((a, top - a, left - a, t - top - left + a))
    gain = sum(pg**2 / (ph + SHRINK) for pg, ph in zip(*parts, strict=True))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = _leaf(g[rows, cols], h[rows, cols])
    return out, float(gain[i, j] - gt**2 / (ht + SHRINK))


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    f = x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    cut = lambda k: [np.unique(np.quantile(x[:, j], np.arange(1, k) / k)) if len(x) else np.zeros(0) for j in range(f)]
    model = Gam(cut(BINS), cut(PAIR_BINS), float(np.log(share / (1 - share))), np.zeros((f, BINS)))
    if not len(y) or y.min() == y.max():
        return model
    fine, coarse = model.bins(x, model.edges), model.bins(x, model.coarse)
    score = np.full(len(y), model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for j in range(f):
            g, h = slopes()
            by = [np.bincount(fine[:, j], w, BINS) for w in (g, h, np.ones(len(y)))]
            step = RATE * _tree(*by, 2)
            model.tables[j] += step
            score += step[fine[:, j]]
    g, h = slopes()
    cells = {(i, j): coarse[:, i] * PAIR_BINS + coarse[:, j] for i in range(f) for j in range(i + 1, f)}
    grid = lambda c, w: np.bincount(c, w, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)
    gains = {k: _pair_tree(grid(c, g), grid(c, h))[1] for k, c in cells.items()}
    model.pairs = sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]
    model.pair_tables = np.zeros((len(model.pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for k, pair in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _pair_tree(grid(cells[pair], g), grid(cells[pair], h))[0]
            model.pair_tables[k] += step
            score += step.ravel()[cells[pair]]
    return model


def _marked(labels: DataFrame) -> DataFrame:
    """About SAMPLE labelled rows (l_id, quality), by the hash of their id."""
    marked = labels.where("quality is not null").select(F.col("doc_id").alias("l_id"), "quality")
    lot = F.pmod(F.xxhash64("l_id"), F.lit(1 << 30)) / float(1 << 30)
    return marked.where(lot < min(1.0, SAMPLE / max(1, marked.count())))


def _fit_rows(rows: DataFrame) -> Gam:
    rows = rows.select("doc_id", "features", "quality").toArrow()
    x = np.asarray(rows["features"].combine_chunks().flatten()).reshape(-1, len(FEATURES)) if len(rows) else np.zeros((0, len(FEATURES)))
    order = np.lexsort((np.asarray(rows["quality"]), np.asarray(rows["doc_id"])))
    return fit(x[order], np.asarray(rows["quality"])[order].astype(float))


def train(featured: DataFrame, labels: DataFrame) -> Gam:
    """Fit on (doc_id, features) joined with (doc_id, quality)."""
    return _fit_rows(_marked(labels).join(featured, F.col("l_id") == F.col("doc_id")))


def train_on(docs: DataFrame, labels: DataFrame) -> Gam:
    """Fit on (doc_id, text) joined with (doc_id, quality); the labelled rows are few enough to broadcast, as SAMPLE bounds them."""
    return _fit_rows(features(docs.select("doc_id", "text").join(F.broadcast(_marked(labels)), F.col("doc_id") == F.col("l_id")), ["doc_id", "quality"]))


def _scores(x: np.ndarray, model: Gam) -> list[pa.Array]:
    p = model.score(x)
    return [pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))]


RESULTS = {"score": DoubleType(), "predicted": IntegerType()}


def classify(docs: DataFrame, model: Gam) -> DataFrame:
    """``docs`` with score and predicted, in one pass over the texts. Names that it has already get underscores in front."""
    shared = share(docs.sparkSession, model)

    def start():
        extract, model = _extractor(), shared()
        return lambda column: _scores(extract(column), model)

    return add_columns(docs, [F.col("text")], docs.columns, RESULTS, start)


def score(featured: DataFrame, model: Gam, features_col: str = "features") -> DataFrame:
    """``featured`` with score and predicted in place of its features. Names that it has already get underscores in front."""
    shared = share(featured.sparkSession, model)

    def start():
        model = shared()
        return lambda column: _scores(np.asarray(column.flatten()).reshape(-1, len(FEATURES)), model)

    return add_columns(featured, [F.col(f"`{features_col}`")], [c for c in featured.columns if c != features_col], RESULTS, start, 10_000)

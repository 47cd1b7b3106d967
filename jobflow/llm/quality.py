"""Operator 3: text quality by a generalised additive model with pairwise interactions.

Features of a text are counted in numpy over whole Arrow batches.  The model is fitted on a bounded
sample of labelled rows: cyclic boosting visits one feature after the other and adds a shrunken
shallow tree over that feature's bins to its lookup table; then the most useful pairs of features
get tables over a coarser grid the same way.  Scoring adds looked-up values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobflow.llm.common import WindowNames, fold, slices, utf8_view

MOST_ROWS = 20_000
FEATURES = ("log_bytes", "log_words", "word_length", "short_words", "signs", "stops", "digits", "upper", "non_ascii",
            "distinct_words", "repeated_next", "top_word", "log_lines", "repeated_lines", "letterless_words",
            "sign_ends", "longest_word", "line_length", "distinct_pairs", "letters")

_b = np.arange(256)
_space = (_b == 32) | ((_b >= 9) & (_b <= 13))
_digit = (_b >= 48) & (_b <= 57)
_upper = (_b >= 65) & (_b <= 90)
_letter = _upper | ((_b >= 97) & (_b <= 122)) | (_b >= 128)
_stop = np.isin(_b, list(b".,;:'\"!?-()"))
_sign = ~(_space | _digit | _letter | _stop) & (_b > 32)


def _per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _spans(inside: np.ndarray, off: np.ndarray):
    """First and end of the runs of ``inside``, cut at row bounds, and their rows."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[off] = True
    before = np.append(False, inside[:-1]) & ~edge[:-1] if len(inside) else inside
    first = np.flatnonzero(inside & ~before)
    after = np.append(inside[1:], False) & ~edge[1:] if len(inside) else inside
    end = np.flatnonzero(inside & ~after) + 1
    return first, end, np.searchsorted(off, first, side="right") - 1


def _distinct(row: np.ndarray, name: np.ndarray, n: int):
    """Distinct names and the count of the most frequent name, per row."""
    order = np.lexsort([name, row])
    r, x = row[order], name[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(r)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, r[at], times)
    return np.bincount(r[at], minlength=n), top


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text."""
    n, size = len(off) - 1, np.diff(off)
    out = np.zeros((n, len(FEATURES)))
    if not len(data):
        return out
    some, names = np.maximum(size, 1), WindowNames(data)

    def name(first, end):
        return (names.sums[end] - names.sums[first]) * names.inverses[first] + (end - first).astype(np.uint64)

    w0, w1, wr = _spans(~_space[data], off)
    words = np.bincount(wr, minlength=n)
    any_word, length = np.maximum(words, 1), w1 - w0
    w = name(w0, w1)
    same_next = np.zeros(len(w), bool)
    same_next[1:] = (w[1:] == w[:-1]) & (wr[1:] == wr[:-1])
    kinds, top = _distinct(wr, w, n)
    pair = w[1:] * np.uint64(3) + w[:-1]
    inner = wr[1:] == wr[:-1]
    pairs, _ = _distinct(wr[1:][inner], pair[inner], n)
    line0, line1, lr = _spans(data != 10, off)
    lines = np.bincount(lr, minlength=n)
    line_kinds, _ = _distinct(lr, name(line0, line1), n)
    letter = _letter[data]
    has_letter = np.append(0, np.cumsum(letter))
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, wr, length)
    out.T[:] = (
        np.log1p(size), np.log1p(words), np.bincount(wr, length, n) / any_word,
        np.bincount(wr, length <= 3, n) / any_word, _per_row(_sign[data], off) / some,
        _per_row(_stop[data], off) / some, _per_row(_digit[data], off) / some, _per_row(_upper[data], off) / some,
        _per_row(data >= 128, off) / some, kinds / any_word, np.bincount(wr, same_next, n) / any_word, top / any_word,
        np.log1p(lines), 1 - line_kinds / np.maximum(lines, 1),
        np.bincount(wr, has_letter[w1] == has_letter[w0], n) / any_word, np.bincount(wr, _sign[data[w1 - 1]], n) / any_word,
        np.log1p(longest), np.log1p(size / np.maximum(lines, 1)), pairs / np.maximum(words - 1, 1),
        _per_row(letter, off) / some)
    return out


@dataclass
class Gam:
    """Bin edges, one lookup table per feature and per pair, and the intercept."""
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    intercept: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every feature row."""
        z = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            z += t[np.searchsorted(self.edges[j], x[:, j])]
        for a, b, t in self.pairs:
            z += t[np.searchsorted(self.coarse[a], x[:, a]), np.searchsorted(self.coarse[b], x[:, b])]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf")) for c in x.T]


def _split(g: np.ndarray, h: np.ndarray, ridge: float):
    """Gain and place of the best cut of ordered bins (0: none)."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = left_g ** 2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g ** 2 / (all_h + ridge)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Values of a shallow tree over ordered bins, grown by the best gain."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_split(g[a:b], h[a:b], ridge), i) for i, (a, b) in enumerate(parts)]
        gain, at, i = max(cuts)
        if gain <= 1e-9 or not at:
            break
        a, b = parts[i]
        parts[i:i + 1] = [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, cycles: int = 150, pair_cycles: int = 60, most_pairs: int = 8,
        rate: float = 0.1, ridge: float = 5.0) -> Gam:
    """Fit on rows ``x`` with labels ``y``; without both labels the score is their smoothed share."""
    model = Gam(_edges(x, bins) if len(x) else [], _edges(x, 8) if len(x) else [])
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.intercept = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return model
    at = np.stack([np.searchsorted(e, c) for e, c in zip(model.edges, x.T, strict=True)])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(len(y), model.intercept)
    for _ in range(cycles):
        for j, t in enumerate(model.tables):
            p = 1 / (1 + np.exp(-z))
            g = np.bincount(at[j], y - p, len(t))
            h = np.bincount(at[j], p * (1 - p), len(t))
            step = rate * _tree(g, h, 3, ridge)
            t += step
            z += step[at[j]]
    low = np.stack([np.searchsorted(e, c) for e, c in zip(model.coarse, x.T, strict=True)])
    wide = [len(e) + 1 for e in model.coarse]
    p = 1 / (1 + np.exp(-z))

    def grid(a, b, v):
        return np.bincount(low[a] * wide[b] + low[b], v, wide[a] * wide[b]).reshape(wide[a], wide[b])

    def gain(a, b):
        g, h = grid(a, b, y - p), grid(a, b, p * (1 - p))
        return (g ** 2 / (h + ridge)).sum()

    ranked = sorted(((gain(a, b), a, b) for a in range(len(wide)) for b in range(a) if wide[a] > 1 and wide[b] > 1),
                    reverse=True)[:most_pairs]
    model.pairs = [(a, b, np.zeros((wide[a], wide[b]))) for _, a, b in ranked]
    for _ in range(pair_cycles):
        for a, b, t in model.pairs:
            p = 1 / (1 + np.exp(-z))
            g, h = grid(a, b, y - p), grid(a, b, p * (1 - p))
            step = rate * _cross(g, h, ridge)
            t += step
            z += step[low[a], low[b]]
    return model


def _cross(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Values of a tree of two levels over a grid: the best row cut, then the best column cut on either side."""
    def worth(g, h):
        left_g, left_h = np.cumsum(g, -1), np.cumsum(h, -1)
        right_g, right_h = left_g[..., -1:] - left_g, left_h[..., -1:] - left_h
        return (left_g ** 2 / (left_h + ridge) + right_g ** 2 / (right_h + ridge)).max(-1)

    top_g, top_h = np.cumsum(g, 0), np.cumsum(h, 0)
    cut = int((worth(top_g, top_h) + worth(top_g[-1] - top_g, top_h[-1] - top_h)).argmax()) + 1
    out = np.zeros_like(g)
    for rows in (slice(0, cut), slice(cut, None)):
        out[rows] = _tree(g[rows].sum(0), h[rows].sum(0), 2, ridge)
    return out


def _featured(docs: DataFrame, keep: str, schema: str) -> DataFrame:
    def run(batches):
        for b in slices(batches, "__text", 1 << 21):
            x = features(*utf8_view(b.column("__text")))
            yield pa.RecordBatch.from_arrays([b.column(keep), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=[keep, "x"])

    return docs.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
          most_rows: int = MOST_ROWS) -> Gam:
    """Fit on the rows of ``docs`` whose key has a label 0 or 1.

    ``most_rows`` bounds the sample: the labelled keys of smallest hash are taken, and of their rows (a key may have many) the feature rows of
    smallest hash.  Null keys and other labels are left out.
    """
    some = (labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("y"))
            .filter("y in (0, 1)").dropna().distinct().orderBy(F.xxhash64("__key"), "__key", "y").limit(most_rows))
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).join(
        F.broadcast(some), "__key").select("y", "__text")  # at most most_rows small rows
    got = _featured(rows, "y", "y int, x binary").orderBy(F.xxhash64("x", "y"), "x", "y").limit(most_rows).toPandas()
    got = got.sort_values(["x", "y"])  # the fit must not depend on the order in which tasks end
    x = np.frombuffer(b"".join(got.x), float).reshape(-1, len(FEATURES))
    return fit(x, got.y.to_numpy().astype(float))


def predict(docs: DataFrame, model: Gam, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` for every row; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    schema = docs.select(key).schema.add("score", "double")

    def run(batches):
        for b in slices(batches, "__text", 1 << 21):
            s = shared.value.score(features(*utf8_view(b.column("__text"))))
            yield pa.RecordBatch.from_arrays([b.column("__key"), pa.array(s)], names=schema.names)

    return rows.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: learned from labelled rows whose id fold is not 2, for all rows."""
    known = labels.filter(fold(F.col("doc_id"), 4) != 2)
    model = train(docs, known)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def table_frame(model: Gam) -> pd.DataFrame:
    """The single-feature tables as rows (feature, upper edge, value), to read what was learned."""
    return pd.DataFrame([(f, e, v) for f, edges, t in zip(FEATURES, model.edges, model.tables, strict=True)
                         for e, v in zip([*edges, np.inf], t, strict=True)], columns=["feature", "upper", "value"])

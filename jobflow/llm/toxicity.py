"""Operator 6: toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples (a bounded sample of labelled rows) form an inverted index: postings by term, cut into blocks of examples,
with each block's largest weight per term.  A text's terms bound every block's best cosine from
above; only blocks whose bound reaches the k-th best cosine are scored, so the k
nearest are exact.  Similar examples stand in one block, which keeps the bounds low.  Distance-weighted votes of the neighbours become a probability by a
curve fitted on the examples' own left-one-out votes; the neighbours are the evidence.

Terms are all words and word beginnings of the examples; their document frequencies count all documents.  A term
whose share of examples does not differ between the labels beyond chance (G2 test) weighs a part of its
inverse frequency, in texts and examples alike, so a copy of an example has cosine 1 with it; which part of ``PLAIN`` is the one
whose left-one-out votes fit the examples' labels best.  The ``DENSE`` terms held by most examples have postings in nearly every block:
they are summed for all blocks at once by a matrix product in single precision, blocks bound and score the other terms, and
what may be among the nearest is summed exactly.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobflow.llm.common import WindowNames, fold, materialize, mix, slices, table_of, utf8_view

MOST_TOXIC, MOST_CLEAN = 2000, 4000
BLOCK = 64
WHOLE = 0.4  # share of blocks needed from which a term's whole posting list is read
SLACK = 1e-4  # single-precision sums of at most 1024 products are nearer than this
NEIGHBOURS = 12
PART = 1 << 16
STEM = 4
LEAST_G2 = 24.0  # chance of a term this uneven by luck: about one in a million
PLAIN = (1.0, 0.3, 0.1, 0.03)
TRIED = 1000  # examples whose left-one-out votes choose among them
DENSE, ROWS = 1024, 64
PIECE, PARTS, CUT = 1 << 19, 16, "at long, size long, piece binary"  # bytes in a row of the model, and files of these rows

_b = np.arange(256)
_lower = np.where((_b >= 65) & (_b <= 90), _b + 32, _b).astype(np.uint8)
_word = ((_lower >= 97) & (_lower <= 122)) | (_b >= 128) | (_b == 39)


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words (runs of letters and apostrophes, ASCII letters lowered) and of the first
    ``STEM`` bytes of longer ones, and their rows."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _lower[data]
    inside = _word[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = np.flatnonzero(inside & ~(np.append(False, inside[:-1]) & ~edge[:-1]))
    end = np.flatnonzero(inside & ~(np.append(inside[1:], False) & ~edge[1:])) + 1
    names = WindowNames(low)
    row = np.searchsorted(off, first, side="right") - 1

    def name(first, end):
        return (names.sums[end] - names.sums[first]) * names.inverses[first] + (end - first).astype(np.uint64)

    long = end - first > STEM
    stems = name(first[long], first[long] + STEM) + np.uint64(1 << 40)
    return mix(np.concatenate([name(first, end), stems])), np.concatenate([row, row[long]])


def bags(data: np.ndarray, off: np.ndarray, vocabulary: np.ndarray):
    """Distinct (row, term number) of words in ``vocabulary`` with their counts, by row."""
    names, row = terms(data, off)
    kinds, of = np.unique(names, return_inverse=True)
    at = np.searchsorted(vocabulary, kinds)
    at[at == len(vocabulary)] = 0
    known = vocabulary[at] == kinds if len(vocabulary) else np.zeros(len(kinds), bool)
    keep = known[of]
    key = row[keep] * max(1, len(vocabulary)) + at[of][keep]
    key, count = np.unique(key, return_counts=True)
    return key // max(1, len(vocabulary)), key % max(1, len(vocabulary)), count


def small(x: np.ndarray) -> np.ndarray:
    """Counts in the narrowest type that holds them."""
    return x.astype(np.min_scalar_type(x.max(initial=0)))


@dataclass
class Index:
    """Postings by (term, block): ``entry`` delimits a term's blocks, ``post`` an entry's postings.

    ``dense`` holds the weights of the commonest terms by (term, example) as well, ``rough`` the same in single precision; ``column`` is a
    term's row in them or -1.  ``peak`` has the largest weight of each (term, block).
    """
    vocabulary: np.ndarray
    idf: np.ndarray
    ids: list
    toxic: np.ndarray
    entry: np.ndarray
    block: np.ndarray
    post: np.ndarray
    example: np.ndarray
    count: np.ndarray
    weight: np.ndarray
    column: np.ndarray
    dense: np.ndarray
    rough: np.ndarray
    peak: np.ndarray
    curve: tuple[float, ...] = (0.0, 1.0, 0.0)
    share: float = 0.0

    @classmethod
    def build(cls, vocabulary, df, n_docs, ids, toxic, row, term, count, plain: float) -> Index:
        idf = np.log((n_docs + 1) / (df + 1)) + 1e-3
        idf = idf * np.where(telling(row, term, toxic, len(vocabulary)), 1.0, plain)
        order = np.lexsort([row, term])
        return cls.of(vocabulary, idf, ids, toxic, np.bincount(term, minlength=len(vocabulary)), row[order], count[order])

    @classmethod
    def of(cls, vocabulary, idf, ids, toxic, held, row, count) -> Index:
        """The index of ``held`` postings for each term in turn, as examples and counts."""
        blocks = len(ids) // BLOCK + 1
        term = np.repeat(np.arange(len(vocabulary)), held)
        w = (1 + np.log(count)) * idf[term]
        norm = np.sqrt(np.bincount(row, w * w, len(ids)))
        w = w / np.maximum(norm[row], 1e-300)
        first = np.flatnonzero(np.diff(term * blocks + row // BLOCK, prepend=-1))
        most = np.maximum.reduceat(w, first) if len(first) else w
        peak = np.zeros((len(vocabulary), blocks), np.float32)
        peak[term[first], row[first] // BLOCK] = most
        column = np.full(len(vocabulary), -1)
        common = np.argsort(-held, kind="stable")[:DENSE]
        column[common] = np.arange(len(common))
        dense = np.zeros((len(common), blocks * BLOCK))
        some = column[term] >= 0
        dense[column[term[some]], row[some]] = w[some]
        return cls(vocabulary, idf, ids, toxic, np.searchsorted(term[first], np.arange(len(vocabulary) + 1)),
                   row[first] // BLOCK, np.append(first, len(row)), row, count, w, column, dense,
                   dense.astype(np.float32), peak)

    def __getstate__(self):  # weights, blocks and dense rows are made anew where it is read: a tenth of the bytes travels
        return (self.vocabulary, self.idf, self.ids, self.toxic, small(np.diff(self.post[self.entry])),
                small(self.example), small(self.count)), self.curve, self.share

    def __setstate__(self, state):
        parts, curve, share = state
        vocabulary, idf, ids, toxic, held, row, count = parts
        made = Index.of(vocabulary, idf, ids, toxic, held.astype(np.int64), row.astype(np.int64), count.astype(np.int64))
        self.__dict__.update(made.__dict__ | {"curve": curve, "share": share})

    @property
    def blocks(self) -> int:
        return len(self.ids) // BLOCK + 1

    def nearest(self, term: np.ndarray, count: np.ndarray, k: int, skip: int = -1):
        """Examples of largest cosine, best first (ties to the smaller number), and the cosines, zeros left out."""
        skips = None if skip < 0 else np.array([skip])
        return next(self.search(np.zeros(len(term), np.int64), term, count, 1, k, skips))

    def search(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, k: int, skip: np.ndarray | None = None):
        """``nearest`` of each of ``n`` bags, given as (row, term, count) by row, in turn."""
        w = (1 + np.log(count)) * self.idf[term]
        norm = np.sqrt(np.bincount(row, w * w, n))
        w = w / np.maximum(norm[row], 1e-300)
        cut = np.searchsorted(row, np.arange(n + 1))
        at = self.column[term]
        common = at >= 0
        for lo in range(0, n, ROWS):
            hi = min(lo + ROWS, n)
            own = slice(cut[lo], cut[hi])
            c, some = at[own], common[own]
            q = np.zeros((hi - lo, len(self.dense)))
            q[row[own][some] - lo, c[some]] = w[own][some]
            rough = q.astype(np.float32) @ self.rough
            for i in range(lo, hi):
                bag = slice(cut[i], cut[i + 1])
                rare = ~common[bag]
                yield self._best(rough[i - lo], q[i - lo], term[bag][rare], w[bag][rare], k, -1 if skip is None else skip[i])

    def _best(self, rough: np.ndarray, q: np.ndarray, term: np.ndarray, w: np.ndarray, k: int, skip: int):
        """The nearest of one bag from its ``rough`` sums over the commonest terms (``q``), within SLACK of the exact ones, and the weights of the
        others: blocks whose bound reaches the k-th best are scored; what may be among the best is summed exactly."""
        score = rough.astype(float)
        if skip >= 0:
            score[skip] = -1
        bound = w.astype(np.float32) @ self.peak[term] + score.reshape(-1, BLOCK).max(1)
        least = np.partition(score, -k)[-k] if k <= len(score) else 0.0
        needed = (bound > 0) & (bound >= least - SLACK)  # the k-th best can only rise
        lo, n = self.entry[term], self.entry[term + 1] - self.entry[term]
        if needed.mean() > WHOLE:  # nearly whole posting lists: cheaper than picking their blocks out
            a, m, v = self.post[lo], self.post[lo + n] - self.post[lo], w
        else:
            ends = np.cumsum(n)
            entry = np.repeat(lo - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)
            take = needed[self.block[entry]]
            entry, v = entry[take], np.repeat(w, n)[take]
            a, m = self.post[entry], self.post[entry + 1] - self.post[entry]
        to = np.cumsum(m)
        if len(to):
            at = np.repeat(a - to + m, m) + np.arange(to[-1])
            score += np.bincount(self.example[at], np.repeat(v, m) * self.weight[at], len(score))
        if skip >= 0:
            score[skip] = -1
        least = np.partition(score, -k)[-k] if k <= len(score) else 0.0
        some = np.flatnonzero(score >= max(least - SLACK, 1e-300))
        own = np.flatnonzero(q)
        exact = q[own] @ self.dense[np.ix_(own, some)] + (score[some] - rough[some])
        some, exact = some[exact > 1e-300], exact[exact > 1e-300]
        best = np.lexsort([some, -exact])[:k]
        return some[best], np.minimum(exact[best], 1.0)

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> tuple[float, float]:
        """Log odds of the toxic share of the neighbours' votes, each weighted by the inverse of its distance, and
        that times how near the nearest is: a far neighbour proves less."""
        if not len(found):
            return -4.0, 0.0
        weight = cosine / (1.0 - cosine + 0.05)
        share = (weight * self.toxic[found]).sum() / weight.sum()
        odds = float(np.log((share + 0.01) / (1 - share + 0.01)))
        return odds, odds * float(cosine[0])

    def probability(self, votes) -> np.ndarray:
        z = np.array(votes, float).reshape(-1, 2) @ np.array(self.curve[1:]) + self.curve[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def calibrate(self, row, term, count, k: int, weights: np.ndarray, some: np.ndarray) -> float:
        """Logistic curve from the left-one-out votes of ``some`` examples, weighted back to the labels' true shares; returns the mean loss."""
        number = np.full(len(self.ids), -1)
        number[some] = np.arange(len(some))
        own = number[row] >= 0
        v = np.array([(1.0, *self.vote(*x)) for x in self.search(number[row[own]], term[own], count[own], len(some), k, some)])
        toxic, weights = self.toxic[some], weights[some]
        prior = np.array([0.0, 1.0, 0.0])
        w = prior.copy()
        for _ in range(50):  # Newton's steps with a small ridge towards the plain vote
            p = 1 / (1 + np.exp(-np.clip(v @ w, -30, 30)))
            grad = v.T @ (weights * (toxic - p)) - 0.01 * (w - prior)
            step = np.linalg.solve((v * (weights * p * (1 - p))[:, None]).T @ v + 0.01 * np.eye(3), grad)
            w = w + step
            if abs(step).max() < 1e-9:
                break
        self.curve = tuple(float(x) for x in w)
        p = np.clip(1 / (1 + np.exp(-np.clip(v @ w, -30, 30))), 1e-9, 1 - 1e-9)
        return float(-(weights * (toxic * np.log(p) + (1 - toxic) * np.log(1 - p))).sum() / weights.sum())


def alike(row: np.ndarray, term: np.ndarray, weight: np.ndarray, vocabulary: np.ndarray, n: int) -> np.ndarray:
    """An order of the ``n`` examples in which similar ones are neighbours: sign projections, grouped by a few rounds of k-means."""
    signs = ((mix(vocabulary)[:, None] >> np.arange(16, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1
    x = np.zeros((n, 16))
    cut = np.searchsorted(row, np.arange(0, n + 256, 256))
    for k, (lo, hi) in enumerate(zip(cut, cut[1:], strict=False)):
        part = signs[term[lo:hi]] * weight[lo:hi, None]
        for d in range(16):
            x[k * 256:(k + 1) * 256, d] = np.bincount(row[lo:hi] - k * 256, part[:, d], 256)[:n - k * 256]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    centre = x[np.linspace(0, n - 1, min(n, 48)).astype(int)]
    for _ in range(8):
        of = (x @ centre.T).argmax(1)
        for c in np.unique(of):
            centre[c] = x[of == c].mean(0)
    return np.lexsort([x[:, 0], of])


def telling(row: np.ndarray, term: np.ndarray, toxic: np.ndarray, n_terms: int) -> np.ndarray:
    """Whether each term's examples are split over the labels beyond chance; all terms if none is."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    a = np.bincount(term, toxic[row], n_terms)
    b = np.bincount(term, 1 - toxic[row], n_terms)
    share = (a + b) / (n1 + n0)

    def part(x, expected):
        return x * np.log(np.where(x > 0, x, 1) / np.maximum(expected, 1e-300))

    g2 = 2 * (part(a, n1 * share) + part(b, n0 * share)
              + part(n1 - a, n1 * (1 - share)) + part(n0 - b, n0 * (1 - share)))
    return g2 >= LEAST_G2 if (g2 >= LEAST_G2).any() else np.ones(n_terms, bool)


def frequencies(docs: DataFrame, vocabulary: np.ndarray, text: str = "text") -> tuple[np.ndarray, int]:
    """Number of documents with each term, over all rows, and the number of rows."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(text).cast("string").alias("__text"))
    schema = "part int, lane int, counts binary"

    def count(batches):
        total, n = np.zeros(len(shared.value), np.int64), 0
        for b in slices(batches, "__text", 1 << 21):
            _, term, _ = bags(*utf8_view(b.column("__text")), shared.value)
            total += np.bincount(term, minlength=len(total))
            n += b.num_rows
        if n:
            parts = range(0, len(total), PART)
            yield table_of(part=pa.array([-1, *range(len(parts))], pa.int32()),
                           lane=pa.array([TaskContext.get().partitionId() % 64] * (len(parts) + 1), pa.int32()),
                           counts=pa.array([np.int64([n]).tobytes(), *(total[p:p + PART].tobytes() for p in parts)],
                                           pa.binary()))

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in pdf.counts)
        return pdf.iloc[:1].assign(lane=0, counts=[total.tobytes()])

    got = (rows.mapInArrow(count, schema).groupBy("part", "lane").applyInPandas(add, schema)
           .groupBy("part").applyInPandas(add, schema)).collect()
    by = {r.part: np.frombuffer(bytes(r.counts), np.int64) for r in got}
    n = int(by.pop(-1, np.zeros(1, np.int64))[0])
    return np.concatenate([by[p] for p in sorted(by)]) if by else np.zeros(len(vocabulary), np.int64), n


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
          most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN, k: int = NEIGHBOURS) -> Fitted | float:
    """Index over a bounded sample of labelled rows; without both labels, the smoothed share of label 1.

    The sample holds the labelled keys of smallest hash, ``most_toxic`` of label 1 and ``most_clean`` of label 0, and of their rows (a
    key may have many) as many, those of smallest hash.
    """
    known = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("y")).filter("y in (0, 1)").dropna()
    totals = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    known = known.distinct()
    some = [known.filter(F.col("y") == y).orderBy(F.xxhash64("__key"), "__key").limit(n)
            for y, n in ((1, most_toxic), (0, most_clean))]
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).join(
        F.broadcast(some[0].unionByName(some[1])), "__key")  # at most most_toxic + most_clean small rows

    def words(batches):
        for b in slices(batches, "__text", 1 << 21):
            names, row = terms(*utf8_view(b.column("__text")))
            order = np.lexsort([names, row])
            names, row = names[order], row[order]
            cut = np.searchsorted(row, np.arange(b.num_rows + 1))
            out = []
            for lo, hi in zip(cut, cut[1:], strict=False):
                kinds, count = np.unique(names[lo:hi], return_counts=True)
                out.append((kinds.tobytes(), count.astype(np.int64).tobytes()))
            yield table_of(k=b.column("__key").cast(pa.string()), y=b.column("y"),
                           names=pa.array([x for x, _ in out], pa.binary()),
                           counts=pa.array([x for _, x in out], pa.binary()))

    found = materialize(rows.mapInArrow(words, "k string, y int, names binary, counts binary"), "examples")
    mark = F.xxhash64("k", "names", "counts")
    chosen = [found.filter(F.col("y") == y).orderBy(mark, "k").limit(n) for y, n in ((1, most_toxic), (0, most_clean))]
    sample = materialize(chosen[0].unionByName(chosen[1]), "sample")  # most_toxic + most_clean rows
    if sample.select("y").distinct().count() < 2:
        return (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)

    def distinct(batches):
        names = [np.unique(np.frombuffer(b"".join(pdf.names), np.uint64)) for pdf in batches]
        if names:
            yield from cuts(np.unique(np.concatenate(names)).tobytes())

    # the sample is bounded; one task reads it, and the driver passes on what it finds, a piece at a time
    vocabulary = np.frombuffer(whole(in_pieces(sample.select("names").repartition(1).mapInPandas(distinct, CUT), "vocabulary")), np.uint64)
    df, n = frequencies(docs, vocabulary, text)
    known_terms = docs.sparkSession.sparkContext.broadcast((vocabulary, df))

    def learn(batches):
        got = pd.concat(list(batches))
        if len(got):
            yield from cuts(pickle.dumps(fit(got, *known_terms.value, n, totals, k)))

    return Fitted(whole(in_pieces(sample.repartition(1).mapInPandas(learn, CUT), "model")))


def cuts(data: bytes):
    """Rows of ``PIECE`` bytes at most; one without bytes if there are none."""
    for at in range(0, max(1, len(data)), PIECE):
        yield pd.DataFrame({"at": [at], "size": [len(data)], "piece": [data[at:at + PIECE]]})


def in_pieces(pieces: DataFrame, name: str) -> DataFrame:
    """``cuts`` stored in several files, so that the driver gets a few of them at a time."""
    return materialize(pieces.repartition(PARTS, "at"), name)


def whole(pieces: DataFrame) -> bytes:
    """The bytes of which ``pieces`` are ``cuts``.

    A collected frame comes over a socket, and if the driver's JVM runs out of memory while it sends, the rows just end.
    """
    got = sorted((r["at"], r["size"], bytes(r.piece)) for r in pieces.toLocalIterator())
    data = b"".join(x for *_, x in got)
    if not got or len(data) != got[0][1]:
        raise RuntimeError(f"only {len(data)} of {got[0][1] if got else 'all'} bytes of the model came to the driver")
    return data


@dataclass
class Fitted:
    """An index as bytes; it is laid out where it is first used, once in a worker."""
    data: bytes

    @cached_property
    def index(self) -> Index:
        return pickle.loads(self.data)


def fit(got: pd.DataFrame, vocabulary: np.ndarray, df: np.ndarray, n: int, totals: dict[int, int], k: int) -> Index:
    """Index and curve from the examples (k, y, names, counts), with the weight of plain terms whose left-one-out votes fit best."""
    got = got.sort_values(["names", "counts", "y", "k"]).reset_index(drop=True)
    size = np.array([len(x) // 8 for x in got.names])
    term = np.searchsorted(vocabulary, np.frombuffer(b"".join(got.names), np.uint64))
    count = np.frombuffer(b"".join(got.counts), np.int64)
    row, toxic = np.repeat(np.arange(len(got)), size), got.y.to_numpy().astype(float)
    order = alike(row, term, (1 + np.log(count)) * np.log((n + 1) / (df[term] + 1)), vocabulary, len(got))
    place = np.argsort(order)
    sort = np.argsort(place[row], kind="stable")
    row, term, count, toxic, ids = place[row][sort], term[sort], count[sort], toxic[order], got.k.to_numpy()[order].tolist()
    own = {y: (toxic == y).sum() for y in (0, 1)}
    weights, every = np.array([totals[int(y)] / own[y] for y in toxic]), np.arange(len(ids))
    tried = every[np.linspace(0, len(ids) - 1, min(len(ids), TRIED)).astype(int)]

    def built(plain: float) -> Index:
        return Index.build(vocabulary, df, n, ids, toxic, row, term, count, plain)

    loss = {plain: built(plain).calibrate(row, term, count, k, weights, tried) for plain in PLAIN}
    index = built(min(PLAIN, key=lambda plain: loss[plain]))
    index.calibrate(row, term, count, k, weights, every)
    index.share = totals[1] / sum(totals.values())
    return index


def predict(docs: DataFrame, model: Fitted | float, key: str = "doc_id", text: str = "text",
            k: int = NEIGHBOURS) -> DataFrame:
    """``key``, ``score`` and ``evidence`` (neighbours as key, label, cosine) for every row.

    A null, empty or wordless text, or one that shares no term with an example, has no evidence and the score of no votes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    schema = docs.select(key).schema.add("score", "double").add(
        "evidence", T.ArrayType(T.StructType().add("key", "string").add("label", "integer").add("cosine", "double")))
    kind = pa.list_(pa.struct([("key", pa.string()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def run(batches):
        model = shared.value if isinstance(shared.value, float) else shared.value.index
        for b in slices(batches, "__text", 1 << 21):
            if isinstance(model, float):
                score, evidence = np.full(b.num_rows, model), [[]] * b.num_rows
            else:
                row, term, count = bags(*utf8_view(b.column("__text")), model.vocabulary)
                near = list(model.search(row, term, count, b.num_rows, k))
                score = model.probability([model.vote(*x) for x in near])
                evidence = [[{"key": model.ids[i], "label": int(model.toxic[i]), "cosine": float(c)}
                             for i, c in zip(*x, strict=True)] for x in near]
            yield pa.RecordBatch.from_arrays([b.column("__key"), pa.array(score, pa.float64()),
                                              pa.array(evidence, kind)], names=schema.names)

    return rows.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence: learned from labelled rows whose id fold is not 0, for all rows."""
    known = labels.filter(fold(F.col("doc_id"), 5) != 0)
    model = train(docs, known)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")

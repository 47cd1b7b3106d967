"""Operator 10: language ID by multinomial naive Bayes over hashed character n-grams.

Training counts hashed 1- to 3-grams of letters (other characters become one
blank) over all training rows: each task keeps one count vector per language,
and the vectors are summed in two shuffles of bounded rows.  The log-probability
matrix (languages x 2**bits) is broadcast; rows are scored in numpy batches.  More than ``MOST_LANGS``
languages are scored in blocks of as many, one broadcast and one pass each, and the blocks' best languages and sums of
probabilities are combined by row: the result does not depend on the blocks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobflow.llm.common import fold, materialize, table_of

ORDERS = (1, 2, 3)
SLICE = 4096
MOST_LANGS = 1024  # of 2**15 grams: a broadcast of 128 MB
BATCH_CHARS = 1 << 19


@dataclass
class Model:
    """A block of the languages in name order, log-probabilities (2**bits x languages), log priors over all languages."""
    langs: list[str]
    logp: np.ndarray
    prior: np.ndarray


@dataclass
class Trained:
    """The stored gram counts of all languages and the rows of each; ``blocks`` are read one at a time."""
    counts: DataFrame | None
    seen: dict[str, int]
    bits: int
    alpha: float

    def blocks(self, most: int | None = None) -> Iterator[Model]:
        langs, most = sorted(self.seen), most or MOST_LANGS
        rows = sum(self.seen.values())
        for at in range(0, len(langs), most):
            yield self._block(langs[at:at + most], rows)

    def _block(self, langs: list[str], rows: int) -> Model:
        dims = 1 << self.bits
        own = self.counts.filter(F.col("lang").between(langs[0], langs[-1]) & (F.col("part") >= 0))
        column = {k: i for i, k in enumerate(langs)}
        counts = np.zeros((dims, len(langs)), np.float32)
        for r in own.toLocalIterator():  # a slice of one language at a time
            counts[r.part * SLICE:(r.part + 1) * SLICE, column[r.lang]] = np.frombuffer(bytes(r.counts), np.int64)
        total = counts.sum(0, dtype=np.float64) + self.alpha * dims
        logp = np.log((counts + self.alpha) / total)
        return Model(langs, logp.astype(np.float32), np.log(np.array([self.seen[k] for k in langs], float) / rows))


_letters = None


def letters() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def grams(texts: list[str], bits: int):
    """(hashed grams, row of each gram) of every order, and whether a row has a letter."""
    low = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, low), np.int64, len(low)))
    row = np.repeat(np.arange(len(low), dtype=np.int32), np.diff(ends, prepend=0))
    is_letter = letters()[code]
    code = np.where(is_letter, code, 32).astype(np.uint64)
    keep = is_letter.copy()
    keep[:-1] |= is_letter[1:]
    keep[0] = True
    code, row, is_letter = code[keep], row[keep], is_letter[keep]
    out, h = [], np.zeros(len(code), np.uint64)
    for n in ORDERS:
        m = len(code) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1:] + np.uint64(1)
        x = h * np.uint64(0xD6E8FEB86659FD93)
        ok = row[:m] == row[n - 1:]
        out.append(((x >> np.uint64(64 - bits)).astype(np.int64)[ok], row[:m][ok]))
    return out, np.bincount(row[is_letter], minlength=len(low)) > 0


def _chunks(texts: list[str]):
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_CHARS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", bits: int = 15, alpha: float = 0.5) -> Trained:
    """Fit on every row of ``docs`` with a text and a language (null in either: left out)."""
    dims = 1 << bits
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).dropna()

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = defaultdict(int)
        lane = TaskContext.get().partitionId() % 64

        def flush():
            for name, c in sums.items():
                parts = range(0, dims, SLICE)
                yield table_of(lang=pa.array([name] * (len(parts) + 1)),
                               part=pa.array([*range(len(parts)), -1], pa.int32()),
                               lane=pa.array([lane] * (len(parts) + 1), pa.int32()),
                               counts=pa.array([*(c[p:p + SLICE].tobytes() for p in parts),
                                                np.int64([seen[name]]).tobytes()], pa.binary()))
            sums.clear()
            seen.clear()

        for b in batches:
            texts, langs = b.column("text").to_pylist(), b.column("lang").to_pylist()
            for lo, hi in _chunks(texts):
                names, of = np.unique(np.array(langs[lo:hi], object), return_inverse=True)
                found, _ = grams(texts[lo:hi], bits)
                total = sum(np.bincount(of[r] * dims + h, minlength=len(names) * dims) for h, r in found)
                for i, name in enumerate(names):
                    part = total[i * dims:(i + 1) * dims].astype(np.int64)
                    sums[name] = sums[name] + part if name in sums else part
                    seen[name] += int((of == i).sum())
                if len(sums) > 256:
                    yield from flush()
        yield from flush()

    schema = "lang string, part int, lane int, counts binary"

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = 0
        for c in pdf.counts:
            total = total + np.frombuffer(c, np.int64)
        return pd.DataFrame({"lang": [key[0]], "part": [key[1]], "lane": [0], "counts": [total.tobytes()]})

    parts = (rows.mapInArrow(count, schema).groupBy("lang", "part", "lane").applyInPandas(add, schema)
             .groupBy("lang", "part").applyInPandas(add, schema))
    parts = materialize(parts, "langid")
    seen = {r.lang: int(np.frombuffer(bytes(r.counts), np.int64)[0]) for r in parts.filter("part = -1").collect()}  # a number a language
    return Trained(parts, seen, bits, alpha)


def score_texts(model: Model, bits: int, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Per text the block's best language (``und`` without a letter), its tempered log joint, and the log sum of all of the block's.

    Tempered means divided by the square root of the text's grams, prior and likelihood alike, which keeps their order.
    """
    names, best_joint, total = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    texts = [t or "" for t in texts]
    if not model.langs:
        return names, best_joint, total
    for lo, hi in _chunks(texts):
        found, lettered = grams(texts[lo:hi], bits)
        joint = np.zeros((hi - lo, len(model.langs)))
        n = np.zeros(hi - lo)
        for h, r in found:
            if not len(r):
                continue
            first = np.flatnonzero(np.diff(r, prepend=-1))
            joint[r[first]] += np.add.reduceat(model.logp[h], first, axis=0, dtype=np.float64)
            n += np.bincount(r, minlength=hi - lo)
        joint = (joint + model.prior) / np.sqrt(np.maximum(n, 1))[:, None]
        best = joint.argmax(1)
        top = joint[np.arange(hi - lo), best]
        best_joint[lo:hi], total[lo:hi] = top, top + np.log(np.exp(joint - top[:, None]).sum(1))
        for i in np.flatnonzero(lettered):
            names[lo + i] = model.langs[best[i]]
    return names, best_joint, total


def _scored(rows: DataFrame, model: Model, bits: int) -> DataFrame:
    """``rows`` without their ``__text``, with the block's __lang, __best and __total (``score_texts``)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = rows.drop("__text").schema.add("__lang", "string").add("__best", "double").add("__total", "double")

    def score(batches):
        for b in batches:
            found = score_texts(shared.value, bits, b.column("__text").to_pylist())
            rest = b.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(found[0], pa.string()), *map(pa.array, found[1:])],
                                             names=[*rest.schema.names, "__lang", "__best", "__total"])

    return rows.mapInArrow(score, schema)


def predict(docs: DataFrame, model: Trained, key: str = "doc_id", text: str = "text", bits: int = 15,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``keep`` columns, ``lang_pred`` and ``score`` for every row.

    ``score`` is the softmax of the tempered log joint (``score_texts``) over all languages.  A null, empty or letterless text is
    ``und`` with score 0, as is every text when nothing could be learned; equal scores go to the first language by name.
    ``keep`` columns keep their names, whatever these are; they may not be ``lang_pred`` or ``score``.
    """
    named = [key, *keep]  # travel under internal names, so that none can clash
    own = [F.col(c).alias(f"__k{i}") for i, c in enumerate(named)]
    rows = docs.select(*own, F.col(text).cast("string").alias("__text"))
    back = [F.col(f"__k{i}").alias(c) for i, c in enumerate(named)]
    confidence = F.when(F.col("__lang") == "und", 0.0).otherwise(F.exp(F.col("__best") - F.col("__total")))
    if len(model.seen) <= MOST_LANGS:
        block = next(model.blocks(), Model([], np.zeros((1 << bits, 0)), np.zeros(0)))
        return _scored(rows, block, bits).select(*back, F.col("__lang").alias("lang_pred"), confidence.alias("score"))
    rows = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "langid-rows")
    parts = [materialize(_scored(rows.select("__row", "__text"), block, bits), "langid-block") for block in model.blocks()]
    each = reduce(DataFrame.unionAll, parts)
    most = F.max("__total").over(Window.partitionBy("__row"))  # as many rows as there are blocks
    total = F.max("__most") + F.log(F.sum(F.exp(F.col("__total") - F.col("__most"))))
    # of equal scores the first name wins: blocks are in name order
    best = each.withColumn("__most", most).withColumn("__n", F.row_number().over(
        Window.partitionBy("__row").orderBy(F.col("__best").desc(), "__lang"))).groupBy("__row").agg(
        F.max(F.when(F.col("__n") == 1, F.col("__lang"))).alias("__lang"), F.max("__best").alias("__best"), total.alias("__total"))
    return rows.drop("__text").join(best, "__row").select(*back, F.col("__lang").alias("lang_pred"), confidence.alias("score"))


def language_id(docs: DataFrame, bits: int = 15) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from rows whose id fold is not 0, applied to all rows."""
    rows = docs.select("doc_id", "text", "lang", (fold(F.col("doc_id"), 5) == 0).alias("held_out"))
    model = train(rows.filter(~F.col("held_out")), bits=bits)
    return predict(rows, model, bits=bits, keep=("held_out",)).select("doc_id", "held_out", "lang_pred", "score")

"""Operator 1: repeated byte strings by a difference-cover suffix order built bucket by bucket.

Only the order's ties at a depth of ``length`` bytes matter: a byte goes if it lies in a
``length``-byte string that also starts elsewhere.  The work follows the blockwise
difference-cover construction:

1. Cover sample.  Positions whose offset modulo 73 is in a perfect difference set are sampled
   (nine of 73).  For any two equal strings some shift below 73 puts both on sampled positions,
   so at least one sampled suffix inside them ties at depth ``length - 72``.
   The sample is dealt into buckets by name, each bucket is sorted alone, and only the
   sample suffixes that tie keep a rank; all others are proven unique.
2. Suffix buckets.  A suffix is a candidate only if a tying sample suffix starts within its first
   73 bytes.  Candidates are dealt into buckets, one bucket is sorted at a time, and neighbours that
   tie at the full depth are repeated strings.

Long ties are never compared byte by byte: a suffix is sorted by the name (hash) of its leading bytes instead of by its letters,
so a bucket holds about nine bytes per sample suffix, thirteen per candidate, and no text.  Sample names have 64 bits; two that
collide only make more candidates.  Candidate names are 96 bits of XXH3 under a seed drawn anew for each run, so that no text can be
made to collide with another: among n candidates two different strings share one with a chance of about n^2 / 2^97 (6e-10 at 10^10).
A name that repeats within a task leaves it once; its other positions are known ties.
"""

from __future__ import annotations

import hashlib
import secrets

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobflow.llm.common import WindowNames, bucket_bits, even_keys, materialize, table_of, utf8_view

PERIOD = 73
COVER = (1, 2, 4, 8, 16, 32, 37, 55, 64)  # every difference modulo 73 exactly once
UNIT_BYTES = 2 << 20
NAMES_AT_ONCE = 1 << 16
ENTRY = "unit long, kind int, bucket int, names binary, more binary, places binary"


def _sorted(names: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal names are neighbours, and whether each is equal to the one before."""
    order = np.argsort(names)
    same = names[order][1:] == names[order][:-1]
    if len(more):
        if (same & (more[order][1:] != more[order][:-1])).any():  # equal first parts of different names: sort by both
            order = np.lexsort([more, names])
            same = names[order][1:] == names[order][:-1]
        same &= more[order][1:] == more[order][:-1]
    return order, np.append(False, same)[:len(order)]


def _steps(pos: np.ndarray) -> bytes:
    """Ascending positions as 16-bit steps; a step of 65535 or more takes 65535s before its rest."""
    step = np.diff(pos, prepend=0)
    more = step // 0xFFFF
    at = np.cumsum(more + 1) - 1
    out = np.full(int(at[-1]) + 1 if len(at) else 0, 0xFFFF, np.uint16)
    out[at] = step % 0xFFFF
    return out.tobytes()


def _positions(raw: bytes) -> np.ndarray:
    step = np.frombuffer(raw, np.uint16)
    return np.cumsum(step, dtype=np.int64)[step != 0xFFFF]


def _seeded_names(data: np.ndarray, pos: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of XXH3 of the windows: the first 64 as names, the others as ``more``."""
    raw, digest = data.tobytes(), xxhash.xxh3_128_digest
    out = np.zeros((len(pos), 2), np.uint64)
    for at in range(0, len(pos), NAMES_AT_ONCE):
        some = pos[at:at + NAMES_AT_ONCE].tolist()
        out[at:at + len(some)] = np.frombuffer(b"".join([digest(raw[p:p + length], seed) for p in some]), np.uint64).reshape(-1, 2)
    return out[:, 0].copy(), (out[:, 1] >> np.uint64(32)).astype(np.uint32)


class _Unit:
    """Text pieces laid end to end; a piece is up to UNIT_BYTES starts of one text and the overlap behind them."""

    def __init__(self):
        self.sha, self.start, self.starts, self.data, self.size, self.ties = [], [], [], [], 0, []

    def add(self, sha: bytes, start: int, starts: int, data: np.ndarray, ties=None) -> None:
        self.sha.append(sha)
        self.start.append(start)
        self.starts.append(starts)
        self.data.append(data)
        self.size += len(data)
        self.ties.append(ties)

    def layout(self):
        """(bytes, first byte of each piece, bytes of each piece)."""
        n = np.fromiter(map(len, self.data), np.int64, len(self.data))
        return np.concatenate(self.data), np.cumsum(n) - n, n


def _units(batches, overlap: int, with_ties: bool):
    """Units of about UNIT_BYTES; a longer text is cut into overlapping pieces."""
    unit = _Unit()
    for b in batches:
        data, off = utf8_view(b.column("text"))
        shas = b.column("sha").to_pylist()
        ties = b.column("ties").to_pylist() if with_ties else None
        for k, sha in enumerate(shas):
            row = data[off[k]: off[k + 1]]
            tie = np.sort(np.frombuffer(b"".join(ties[k]), np.int64)) if with_ties else None
            for at in range(0, max(len(row), 1), UNIT_BYTES):
                starts = min(UNIT_BYTES, len(row) - at)
                unit.add(sha, at, starts, row[at: at + starts + overlap], tie)
                if unit.size >= UNIT_BYTES:
                    yield unit
                    unit = _Unit()
    if unit.size:
        yield unit


def _deal(unit: _Unit, number: int, pos: np.ndarray, names: np.ndarray, more: np.ndarray, keys: np.ndarray):
    """Rows of one unit: kind 1 describes its pieces, kind 2 has ties known here, kind 0 one bucket's suffixes.

    ``more`` widens the names; empty where 64 bits are enough.  ``keys`` has a grouping key for each bucket.
    """
    bits = len(keys).bit_length() - 1
    order, again = _sorted(names, more)
    tied = again.copy()
    tied[:-1] |= again[1:]
    known = np.sort(pos[order[tied]])
    once = np.sort(order[~again])
    pos, names, more = pos[once], names[once], more[once] if len(more) else more
    bucket = (names >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    pos, names, more, bucket = pos[order], names[order], more[order] if len(more) else more, bucket[order]
    cut = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    got = np.flatnonzero(np.diff(cut)).tolist()
    low = names.view(np.uint8).reshape(-1, 8)[:, :7]  # the bucket tells the rest
    info = b"".join(unit.sha) + np.array([unit.start, unit.starts, [len(d) for d in unit.data]], np.int64).tobytes()
    kinds, buckets = [1, 2] + [0] * len(got), [int(keys[((number >> 32) * 7919 + number) % len(keys)])] * 2 + keys[got].tolist()
    blobs = [info, b""] + [low[cut[k]:cut[k + 1]].tobytes() for k in got]
    wider = [b"", b""] + [more[cut[k]:cut[k + 1]].tobytes() if len(more) else b"" for k in got]
    places = [b"", _steps(known)] + [_steps(pos[cut[k]:cut[k + 1]]) for k in got]
    return table_of(unit=pa.array([number] * len(kinds), pa.int64()), kind=pa.array(kinds, pa.int32()),
                    bucket=pa.array(buckets, pa.int32()), names=pa.array(blobs, pa.binary()), more=pa.array(wider, pa.binary()),
                    places=pa.array(places, pa.binary()))


def _sort_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sort one bucket's suffixes by name and keep the positions that tie with another."""
    here = pdf.kind == 0
    rest = pdf[~here]
    pdf = pdf[here]
    n = np.fromiter((len(x) // 7 for x in pdf.names), np.int64, len(pdf))
    full = np.zeros((int(n.sum()), 8), np.uint8)
    if len(full):
        full[:, :7] = np.frombuffer(b"".join(pdf.names), np.uint8).reshape(-1, 7)
    names = full.view(np.uint64).ravel()
    order, again = _sorted(names, np.frombuffer(b"".join(pdf.more), np.uint32))
    tie = np.zeros(len(names), bool)
    tie[order[again]] = True
    tie[order[:-1][again[1:]]] = True
    ends = np.cumsum(n)
    keep, places = [], []
    for k, (raw, lo, hi) in enumerate(zip(pdf.places, ends - n, ends, strict=True)):
        if tie[lo:hi].any():
            keep.append(k)
            places.append(_steps(_positions(raw)[tie[lo:hi]]))
    out = pdf.iloc[keep].assign(places=places, names=b"", more=b"")
    return pd.concat([rest, out])[["unit", "kind", "bucket", "names", "more", "places"]]


def _gather(shape):
    """Applied to all rows of a unit: ``shape(sha, start, positions)`` gives a piece's blob from its ties."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pos = np.unique(np.concatenate([_positions(p) for p in pdf.places]))
        info = pdf.names[pdf.kind == 1].iloc[0]
        pieces = len(info) // (32 + 24)
        start, starts, size = np.frombuffer(info[32 * pieces:], np.int64).reshape(3, -1)
        at = np.concatenate([[0], np.cumsum(size)])
        cut = np.searchsorted(pos, at)
        rows = [(info[32 * k:32 * k + 32], shape(pos[cut[k]:cut[k + 1]] - at[k] + start[k]))
                for k in np.flatnonzero(np.diff(cut))]
        return pd.DataFrame(rows, columns=["sha", "blob"])
    return run


def _round(texts: DataFrame, deal, shape, name: str) -> DataFrame:
    """One round: deal suffixes into buckets, sort each, gather the ties by text: rows (sha, blobs)."""
    ties = (texts.mapInArrow(deal, ENTRY).groupBy("bucket").applyInPandas(_sort_bucket, ENTRY)
            .groupBy("unit").applyInPandas(_gather(shape), "sha binary, blob binary"))
    return materialize(ties, name).groupBy("sha").agg(F.collect_list("blob").alias("ties"))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = 200) -> DataFrame:
    """(sha, n_copies, ties) for every distinct text with a repeated ``length``-byte string.

    ``sha`` is the text's SHA-256; ``ties`` lists blobs of (first, end) byte pairs, as 64-bit
    integers, of its repeated stretches; it is null for a text that occurs more than once,
    all of which is repeated.
    """
    if length <= PERIOD:
        raise ValueError(f"the cover sample needs strings longer than {PERIOD} bytes")
    depth = length - PERIOD + 1
    seed = secrets.randbits(64)
    spark = docs.sparkSession
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def number() -> int:
        return TaskContext.get().partitionId() << 32

    def deal_sample(batches):
        for k, unit in enumerate(_units(batches, length - 1, False)):
            data, at, size = unit.layout()
            pos = np.concatenate([np.flatnonzero(cover[(np.arange(s) + first) % PERIOD]) + a
                                  for a, s, first in zip(at, unit.starts, unit.start, strict=True)])
            piece = np.searchsorted(at, pos, side="right") - 1
            inside = (pos - at[piece] < np.array(unit.starts)[piece]) & (pos + depth <= (at + size)[piece])
            pos = pos[inside]
            yield _deal(unit, number() + k, pos, WindowNames(data).at(pos, depth), np.zeros(0, np.uint32), keys)

    def deal_candidates(batches):
        for k, unit in enumerate(_units(batches, length - 1, True)):
            data, at, size = unit.layout()
            marks = np.zeros(len(data) + 1, np.int32)
            last = np.zeros(len(size), np.int64)
            for j, (a, s, first, starts, ties) in enumerate(
                    zip(at, size, unit.start, unit.starts, unit.ties, strict=True)):
                last[j] = max(0, min(starts, s - length + 1))
                near = ties[np.searchsorted(ties, first): np.searchsorted(ties, first + s)] - first
                # starts of a piece end before the next piece's bytes, so no mark crosses it
                np.add.at(marks, a + np.minimum(np.maximum(near - PERIOD + 1, 0), last[j]), 1)
                np.add.at(marks, a + np.minimum(near + 1, last[j]), -1)
            pos = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            yield _deal(unit, number() + k, pos, *_seeded_names(data, pos, length, seed), keys)

    def spans(pos: np.ndarray) -> bytes:
        new = np.flatnonzero(np.diff(pos, prepend=-length - 1) > length)
        end = pos[np.append(new[1:], len(pos)) - 1] + length
        return np.stack([pos[new], end], 1).astype(np.int64).tobytes()

    # rows of one text collapse before they travel: a copied text is sorted once
    coded = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # a candidate takes 13 bytes at most, and every byte may start one
    size = coded.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    keys = even_keys(spark, bucket_bits(spark, 13 * size))
    distinct = (coded.filter(F.octet_length("text") >= length)
                .select(F.unhex(F.sha2("text", 256)).alias("sha"), "text")
                .groupBy("sha").agg(F.first("text").alias("text"), F.count("*").alias("n_copies")))
    sample = _round(distinct.select("sha", "text"), deal_sample, lambda p: p.astype(np.int64).tobytes(), "sample")
    found = _round(distinct.join(sample, "sha").select("sha", "text", "ties"), deal_candidates, spans, "suffixes")
    copies = (coded.filter(F.octet_length("text") >= length).select(F.unhex(F.sha2("text", 256)).alias("sha"))
              .groupBy("sha").agg(F.count("*").alias("n_copies")).filter("n_copies > 1"))
    return copies.join(found, "sha", "full").select("sha", F.coalesce("n_copies", F.lit(1)).alias("n_copies"), "ties")


def cut_repeats(docs: DataFrame, text: str = "text", length: int = 200) -> DataFrame:
    """All columns of ``docs`` and, for every row, ``spans``, ``kept`` and ``kept_text``.

    ``spans`` are the maximal stretches [first, end) of removed bytes, ``kept`` the remaining bytes,
    ``kept_text`` the whole characters among them.
    A byte is removed if a ``length``-byte string over it also starts anywhere else: in another row, an
    equal row or the same row; overlaps count.  Matches never cross rows.  A null text counts as
    empty; texts shorter than ``length`` bytes stay whole.  Input columns of the new names are replaced.
    """
    found = repeated_spans(docs, text, length).select(
        F.col("sha").alias("__sha"), F.col("n_copies").alias("__copies"), F.col("ties").alias("__ties"))
    docs = docs.drop("spans", "kept", "kept_text")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumn("__body", body).withColumn("__key", F.unhex(F.sha2("__body", 256))).join(
        found, F.col("__key") == F.col("__sha"), "left").drop("__key", "__sha")
    pair = T.ArrayType(T.StructType().add("first", "long").add("end", "long"))
    schema = T.StructType([*docs.schema.fields]).add("spans", pair).add("kept", "binary").add("kept_text", "string")
    names = docs.columns

    def run(batches):
        for b in batches:
            data, off = utf8_view(b.column("__body"))
            spans, kept = [], []
            for k, (copies, ties) in enumerate(zip(b.column("__copies").to_pylist(), b.column("__ties").to_pylist(),
                                                   strict=True)):
                row = data[off[k]: off[k + 1]]
                if copies and copies > 1:
                    found = np.array([[0, len(row)]])
                elif ties:
                    found = np.frombuffer(b"".join(ties), np.int64).reshape(-1, 2)
                    found = found[np.argsort(found[:, 0])]
                    if len(found) > 1:  # pieces of a long text may touch
                        top = np.maximum.accumulate(found[:, 1])
                        new = np.flatnonzero(np.append(True, found[1:, 0] > top[:-1]))
                        found = np.stack([found[new, 0], top[np.append(new[1:], len(top)) - 1]], 1)
                else:
                    spans.append([])
                    kept.append(row.tobytes())
                    continue
                stay = np.ones(len(row), bool)
                for lo, hi in found:
                    stay[lo:hi] = False
                spans.append([{"first": int(lo), "end": int(hi)} for lo, hi in found])
                kept.append(row[stay].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary()), pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())],
                names=[*names, "spans", "kept", "kept_text"])

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the kept bytes."""
    cut = cut_repeats(docs.select("doc_id", "text"), length=length)
    size = F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long")
    return cut.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[bytes], length: int = 200) -> list[tuple[int, int, str]]:
    """(n_removed, n_spans, kept sha) per text by a dictionary of all strings; for tests."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out

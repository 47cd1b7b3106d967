"""Operator 5: SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most three bits apart meet in a variant that one reaches with
at most two flips and the other with at most one.  An odd number of differing
bits means different bit parity, so even fingerprints emit the larger ball and
odd ones the smaller.  Of any three bit positions two lie in the same 32-bit
half, so only same-half pairs of flips are needed: 1057 or 65 variants each.

Variants travel packed: one row per (task batch, variant bucket) holds nine bytes
per variant.  A bucket sorts its variants, verifies colliding fingerprints by bit
distance and keeps a spanning forest of the verified links.  Links become classes by
alternating large-star and small-star rounds over distinct fingerprints.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobflow.llm.common import bucket_bits, even_keys, materialize, table_of, utf8_view

BITS = 64
ONE = np.uint64(1)


def ball(radius: int) -> np.ndarray:
    """Flip masks of the larger (radius 2) or smaller (radius 1) ball; both start with no flip."""
    single = [1 << i for i in range(BITS)]
    pairs = [(1 << i) | (1 << j) for half in (range(32), range(32, 64)) for i, j in itertools.combinations(half, 2)]
    return np.array([0, *single, *(pairs if radius > 1 else [])], np.uint64)


def fingerprints_of(texts: list[bytes], shingle: int) -> np.ndarray:
    """64-bit SimHash of each text: bit set if set in more than half of its shingle hashes."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)

    def settle(lo: int, hi: int) -> None:
        h = np.array(hashes, np.uint64)
        hashes.clear()
        n = counts[lo:hi]
        full = np.flatnonzero(n)
        if not len(full):
            return
        first = (np.cumsum(n) - n)[full]
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        set_bits = (2 * ones > n[full][:, None]).astype(np.uint8)
        out[lo + full] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()

    lo = 0
    for i, t in enumerate(texts):
        words = t.lower().split()
        if not words:
            continue
        if len(words) <= shingle:
            hashes.append(digest(b" ".join(words), 42))
            counts[i] = 1
        else:
            parts = zip(*(words[k:] for k in range(shingle)), strict=False)
            hashes.extend([digest(s, 42) for s in map(b" ".join, parts)])
            counts[i] = len(words) - shingle + 1
        if len(hashes) > 200_000:
            settle(lo, i + 1)
            lo = i + 1
    settle(lo, len(texts))
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``fp`` (the 64 bits as a signed long) and the columns ``keep`` for every row.

    Upper-case ASCII letters are lowered, words are runs without ASCII white
    space, repeated shingles count each time.  Fewer words than a shingle hash as
    one sequence; a null, empty or blank text has fingerprint zero.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"), *keep)
    schema = T.StructType().add("key", "long").add("fp", "long")
    for c in keep:
        schema = schema.add(docs.schema[c])

    def run(batches):
        for b in batches:
            data, off = utf8_view(b.column("text"))
            raw, off = data.tobytes(), off.tolist()
            texts = [raw[i:j] for i, j in zip(off, off[1:], strict=False)]
            yield table_of(key=b.column("key"), fp=fingerprints_of(texts, shingle).view(np.int64),
                           **{c: b.column(c) for c in keep})

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value of the links (a, b) with the smallest value it is connected to."""
    values, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a):]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return values, values[root]
        root = new


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Links (u > v) that connect exactly the fingerprints at most ``distance`` (0 to 3) bits apart.

    ``fps`` has one row per distinct ``fp``.  Not every close pair is listed:
    inside a bucket the verified pairs shrink to a spanning forest.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the balls of radius two and one find distances up to 3")
    large, small = ball(2), ball(1)
    keys = even_keys(fps.sparkSession, bucket_bits(fps.sparkSession, 10 * len(large) * fps.count()))
    bits = len(keys).bit_length() - 1

    def emit(batches):
        for batch in batches:
            every = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), 2000):
                fp = every[at:at + 2000]
                odd = (np.bitwise_count(fp) & 1).astype(bool)
                variant = np.concatenate([(fp[~odd][:, None] ^ large).ravel(), (fp[odd][:, None] ^ small).ravel()])
                code = np.concatenate([np.tile(np.arange(len(large), dtype=np.uint16), int((~odd).sum())),
                                       np.tile(np.arange(len(small), dtype=np.uint16), int(odd.sum()))])
                # a variant's bucket is its mixed low bits, as fingerprints need not be spread evenly
                spread = (variant * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
                order = np.argsort(spread.astype(np.uint16 if bits <= 16 else np.uint32), kind="stable")
                variant, code, spread = variant[order], code[order], spread[order]
                cut = np.searchsorted(spread, np.arange((1 << bits) + 1, dtype=np.uint64))
                got = np.flatnonzero(np.diff(cut))
                yield table_of(bucket=pa.array(keys[got]),
                               variants=pa.array([variant[cut[k]:cut[k + 1]].tobytes() for k in got], pa.binary()),
                               codes=pa.array([code[cut[k]:cut[k + 1]].tobytes() for k in got], pa.binary()))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        variant = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf.variants])
        code = np.concatenate([np.frombuffer(x, np.uint16) for x in pdf.codes])
        order = np.argsort(variant)
        variant, code = variant[order], code[order]
        same = variant[1:] == variant[:-1]
        shared = np.zeros(len(variant), bool)
        shared[1:] |= same
        shared[:-1] |= same
        variant, fp = variant[shared], (variant ^ large[code])[shared]
        us, vs = [], []
        lag = 1
        while lag < len(fp):
            at = np.flatnonzero(variant[lag:] == variant[:-lag])
            if not len(at):
                break
            a, b = fp[at], fp[at + lag]
            near = np.bitwise_count(a ^ b) <= distance
            us.append(a[near])
            vs.append(b[near])
            lag += 1
            if sum(map(len, us)) > 1 << 21:
                values, root = _roots(np.concatenate(us), np.concatenate(vs))
                us, vs = [values], [root]
        if not us:
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        values, root = _roots(np.concatenate(us), np.concatenate(vs))
        apart = values != root
        return pd.DataFrame({"u": values[apart].view(np.int64), "v": root[apart].view(np.int64)})

    found = (fps.select("fp").mapInArrow(emit, "bucket int, variants binary, codes binary")
             .groupBy("bucket").applyInPandas(meet, "u long, v long"))
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u > v): root is the smallest node of its class.

    Alternating large-star and small-star rounds; each round's links are written to the shared folder,
    and only their count and checksum reach the driver.
    """
    def state(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    edges = materialize(edges, "links")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
            .filter("u != v").distinct())
        edges = materialize(small, "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v"), F.col("v"))).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    distance: int = 3) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row.

    Fingerprints at most ``distance`` bits apart are linked; ``component_id`` is the smallest key
    reachable.  Blank texts share fingerprint zero and are linked like any other;
    repeated rows and equal fingerprints are in one class.  A null key never is a
    class id unless its class has no other.
    """
    fps = materialize(fingerprints(docs, key, text, shingle), "simhash")
    distinct = fps.groupBy("fp").agg(F.min(key).alias("low"))
    classes = connected(links(distinct, distance))
    linked = distinct.join(classes, distinct.fp == classes.node).select("fp", "low", "root")
    lows = linked.groupBy("root").agg(F.min("low").alias("least"))
    of_class = linked.join(lows, "root").select(F.col("fp").alias("linked_fp"), "least")
    # stored, so that the join has an exchange on either side and a very common fingerprint's rows can be split
    alone = materialize(distinct.join(of_class, distinct.fp == of_class.linked_fp, "left").select(
        "fp", F.coalesce("least", "low").alias("component_id")), "simhash-classes")
    return fps.join(alone, "fp").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs``, one of each class of fingerprints linked at ``distance`` bits.

    The row of smallest key stays, a null key only if its class has no other; among rows that share the key, null or not,
    the one of smallest text hash, then of smallest other columns.  Rows equal in every column are one row.  Columns
    must have an order (no maps).
    """
    rest = [F.col(c) for c in docs.columns if c not in (key, text)]
    named = docs.withColumn("__row", F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"),
                                              F.unhex(F.sha2(F.col(text), 256)).alias("digest"), *rest))
    fps = materialize(fingerprints(named, key, text, shingle, keep=("__row",)), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("__row").alias("low"))
    classes = connected(links(distinct, distance))
    stay = (distinct.join(classes, distinct.fp == classes.node, "left").groupBy(F.coalesce("root", "fp").alias("class"))
            .agg(F.min("low").alias("low")))
    kept = named.join(stay, F.col("__row") == F.col("low"), "left_semi")  # fields that are null in both are equal
    return kept.dropDuplicates(["__row"]).drop("__row")

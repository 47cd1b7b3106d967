"""Suffix dedup and SimHash against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from jobflow.llm import simhash, suffix_dedup
from llm_fixtures import no_docs, odd_docs, odd_texts  # noqa: F401
from pyspark.sql import functions as F


def test_cover_has_every_difference_once():
    d = suffix_dedup.COVER
    found = sorted((a - b) % suffix_dedup.PERIOD for a in d for b in d if a != b)
    assert found == list(range(1, suffix_dedup.PERIOD))


@pytest.mark.parametrize("unit", [1 << 21, 257])
def test_suffix_dedup_matches_brute_force(odd_docs, odd_texts, unit, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "UNIT_BYTES", unit)  # small units cut texts into overlapping pieces
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in suffix_dedup.digests(odd_docs).collect())
    raw = [(t or "").encode() for _, t in odd_texts]
    want = sorted((str(i), len(t), *b) for (i, _), t, b in zip(odd_texts, raw, suffix_dedup.brute_force(raw), strict=True))
    assert got == want


def test_colliding_names_remove_nothing(odd_docs, odd_texts, monkeypatch, spark):
    """The first 64 bits of every name are forced to a handful of values; the other hash tells the strings apart."""
    own = suffix_dedup._deal
    monkeypatch.setattr(suffix_dedup, "_deal", lambda unit, number, pos, names, more, keys: own(
        unit, number, pos, names & np.uint64(0x8000000000000003), more, keys))
    raw = [(t or "").encode() for _, t in odd_texts]
    got = sorted((str(r.doc_id), r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(odd_docs).collect())
    want = sorted((str(i), *b) for (i, _), b in zip(odd_texts, suffix_dedup.brute_force(raw), strict=True))
    assert got == want


# pairs of strings whose windows share both linear names, the second one's base being its own or the first one's
COLLIDING = [
    ((b"nt6ssciIupBDRZOvysWepbHGmmapKmnkxkq2UWCcwbq67 l2vfAOpdljXpQr. FHS ZdX4 0BWadgBtqc .Y8cPtPKwsO0dRmOuO"
          b"c8H8mcLZ3qKpns an35b6RMhWLm7yslr6yYNffd4p5ChSSsLQLUqNUjFZdtdKBwgZpC2LYlSDY83G u7qP.JM0lZe2Er-collide"),
     (b"MKEYnI4 nFxMyygda1FE.XNzg9iryaSzCIKXJhVAXAXdBFw4Ps FgHYOuiEFvNvKLlW3WsmHPYA jJJo9VbkxCMS1rS77U9nmc78"
          b"A.26owRzORcykdBfTRhch7NaRUCqovqG1t6p6ko G68bUB9q7F8hn5wc2wval0CB6 Ou.oSbhGaB0ULhQiMAR2y8jbDA-collide")),
    ((b"lfPR2JY13nf0UyzFaL0b.Ss4rkLoXAwHDfYgcDSrFdjMBM0hoNTgVeXlYjVJ.py8IhMvQICyWk3FOcRYc3DcdnkkcBGwP.toxTI5"
          b"jhvP2loMv6Anxqc2kKvGXCDcB5V4r.n9azIJb1JneCGwJUgSruMHso481 Bi3lREckpW0crz8rh7EgGvI9IoJbJK8uyx-collide"),
     (b"JK rzrJTnoJUl8jFMqKeSKUSdqRPkikurfxDfdkRFZJn1Ie4tNL09EpDmVKRirO7Lr99BplQN.I iJEOoJH4L4qGFxA7csijK5kB"
          b"zNJMYZ5Tj3dwfyEDBSBK5XeEyEs9RYv9UUpsiR8IGxorinER9Y1pFS2YZIpehYrHUhoetj1ddYxWL7SqQqNkDfiblbEF-collide"))]


@pytest.mark.parametrize("pair", COLLIDING)
def test_crafted_strings_are_told_apart(spark, pair):
    """A byte changed at the end keeps the samples of both strings tied, so both are candidates."""
    texts = [t.decode() for s in pair for t in (s, s[:-1] + b"!")]
    got = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup.digests(got.coalesce(1)).orderBy("doc_id").collect()] == [0, 0, 0, 0]


def test_suffix_dedup_spans_and_columns(odd_docs, no_docs):
    cut = suffix_dedup.cut_repeats(odd_docs)
    assert cut.columns == [*odd_docs.columns, "spans", "kept", "kept_text"]
    row = cut.filter("doc_id = 18").first()
    assert [(s.first, s.end) for s in row.spans] == [(0, 900)] and bytes(row.kept) == b""
    assert suffix_dedup.digests(no_docs).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.repeated_spans(odd_docs, length=70)


def fingerprint(text, shingle=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def components(fps):
    root = {f: f for f in fps}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    names = sorted(root)
    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in names}


def test_simhash_matches_brute_force(odd_docs, odd_texts, no_docs):
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd_docs).collect())
    fps = [fingerprint(t) for _, t in odd_texts]
    root = components(set(fps))
    low = {}
    for (i, _), f in zip(odd_texts, fps, strict=True):
        if i is not None:
            low[root[f]] = min(low.get(root[f], i), i)
    assert got == sorted((str(i), f"{f:016x}", low.get(root[f])) for (i, _), f in zip(odd_texts, fps, strict=True))
    assert simhash.near_duplicates(no_docs).count() == 0


def test_ball_links_chains_of_every_distance(spark):
    rng = random.Random(1)
    fps = set()
    for _ in range(40):  # chains of one to four flips, and a dense ball
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            for _ in range(rng.randint(1, 4)):
                f ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a)}
    signed = [(int(np.array([f], np.uint64).view(np.int64)[0]),) for f in fps]
    classes = simhash.connected(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()
    got = {}
    for r in classes:
        got.setdefault(r.root, set()).add(r.node % 2**64)
    want = {}
    for f, r in components(fps).items():
        want.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_star_rounds_join_a_long_path(spark):
    n = 300
    order = list(range(n))
    random.Random(2).shuffle(order)
    edges = [(max(a, b), min(a, b)) for a, b in zip(order, order[1:], strict=False)]
    got = simhash.connected(spark.createDataFrame(edges, "u long, v long")).agg(
        F.count("*"), F.min("root"), F.max("root")).first()
    assert tuple(got) == (n, 0, 0)


def test_brute_force_keeps_short_texts():
    assert suffix_dedup.brute_force([b"abc", b"abc"]) == [(0, 0, hashlib.sha256(b"abc").hexdigest())] * 2

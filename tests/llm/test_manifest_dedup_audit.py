"""Merkle manifest, exact dedup and filter audit against plain Python."""

import hashlib
import itertools
import re
import zlib

import pytest
from jobflow.llm import exact_dedup, filter_audit, manifest
from llm_fixtures import no_docs, odd_docs, odd_texts  # noqa: F401
from pyspark.sql import functions as F

CLASHES = ["row", "id", "norm", "size", "prefix", "at", "hash", "grp", "lo", "hi", "h", "n", "kids", "path", "top", "part", "mask", "own"]


@pytest.fixture(scope="module")
def wide_docs(odd_docs):
    """The odd documents with columns named like the operators' own, and sources and line feeds that differ."""
    docs = odd_docs.withColumns({c: F.lit("x") for c in CLASHES})
    return docs.withColumn("text", F.when(F.col("doc_id") % 4 == 1, F.replace("text", F.lit(" "), F.lit("\n"))).otherwise(F.col("text"))).cache()


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return sha(*[enc(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])


def tree(nodes):
    """Root and, per leaf, the (left, right) siblings of each level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // 3 * 3
            ways[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 3])))
            at[k] = i // 3
        nodes = [sha(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], ways


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in keys:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = tree([x[2] for x in groups[s]])
    root, tops = tree([trees[s][0] for s in keys])
    out = []
    for s, top in zip(keys, tops, strict=True):
        for (_, _, leaf, r), way in zip(groups[s], trees[s][1], strict=True):
            hit = zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 2 == 0
            h = leaf_of(r, r.text.replace("\n", "") if hit and r.text is not None else r.text)
            for left, right in way + top:
                h = sha(left, h, right)
            out.append((r.doc_id, leaf, trees[s][0], root, sha(*[a + b for a, b in way + top]), h, h == root))
    return out


def by_text(rows):
    return sorted(rows, key=repr)


def test_manifest_matches_plain_python(wide_docs, no_docs):
    rows = wide_docs.collect()
    got = [tuple(r) for r in manifest.document_proofs(wide_docs).collect()]
    assert by_text(got) == by_text(plain_manifest(rows))
    assert {r[-1] for r in got} == {True, False}
    assert manifest.document_proofs(no_docs).count() == 0
    one = wide_docs.filter("doc_id = 5")
    assert [tuple(r) for r in manifest.document_proofs(one).collect()] == plain_manifest(one.collect())


@pytest.mark.parametrize("n", [1, 3, 28, 100])
def test_manifest_of_every_shape(spark, n):
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("a\n"), F.col("id").cast("string")).alias("text"),
                                 F.lit(None).cast("string").alias("lang"), F.when(F.col("id") % 7 > 0, F.lit("é")).alias("source"),
                                 F.lit(3).alias("n_chars"))
    assert by_text(tuple(r) for r in manifest.document_proofs(docs).collect()) == by_text(plain_manifest(docs.collect()))


def test_intervals_nest(wide_docs):
    made = manifest.build(wide_docs, group=F.col("source"), order=F.col("doc_id"), leaf=manifest.leaf_hash([F.col("text")]))
    nodes = made.nodes().filter("tree = 'source'").collect()
    for a in nodes:
        parents = [b for b in nodes if b.grp == a.grp and b.level == a.level + 1 and b.lo <= a.lo and a.hi <= b.hi]
        top = not any(b.level > a.level and b.grp == a.grp for b in nodes)
        assert len(parents) == (0 if top else 1)


def lower_ascii(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("bits", [15, 26])
def test_exact_dedup_matches_plain_python(spark, wide_docs, no_docs, bits):
    more = spark.createDataFrame([(70, "ÀBC É"), (71, "Àbc É"), (72, "àbc é"), (73, "x" * 64 + "A"), (74, "x" * 64 + "b"), (75, "X" * 64 + "a")],
                                 "doc_id long, text string")
    docs = wide_docs.select("doc_id", "text", *CLASHES).unionByName(more, allowMissingColumns=True)
    rows = docs.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(lower_ascii(r.text), []).append(r.doc_id)
    want = []
    for t, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        want += [(i, ids[-1], len(ids), k == len(ids) - 1, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    got = exact_dedup.refine(docs, also={"text_sha256": F.sha2(exact_dedup.normalised("text"), 256)}, bits=bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert by_text(tuple(r) for r in got.collect()) == by_text(want)
    assert exact_dedup.exact_duplicates(no_docs).count() == 0


def test_only_survivors_get_a_full_hash(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "abd"), (3, "abcd"), (4, "ABCD"), (5, "abcde")], "doc_id long, text string")
    slim = docs.select(*exact_dedup._pair(exact_dedup.normalised("text")))
    bits = exact_dedup.survivors(slim).agg(F.sum(F.bitmap_count("bitmap"))).first()[0]
    assert bits == 1  # abcd and ABCD; abc and abd share a length but not a prefix


def plain_audit(rows, labels):
    first, masks = {}, {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t]]
        masks.setdefault(s or "", []).append((i, {x for x, f in zip("ABCDE", fails, strict=True) if f}))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    out = []
    for part, docs in masks.items():
        shapley = dict.fromkeys("ABCDE", 0)
        mine = []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for k, x in enumerate(order):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                early = [d for d in docs if x in d[1] and d[1] & set(order[:k])]
                shapley[x] += len(gone)
                mine.append([part, "".join(order), k + 1, len(left), len(gone), len(early), sum(d[1] == {x} for d in docs),
                             sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), x])
        out += [(*m[:-1], shapley[m[-1]]) for m in mine]
    return out


def test_filter_audit_matches_plain_python(spark, wide_docs, no_docs):
    more = spark.createDataFrame([(60, "word " * 250 + "#", None), (61, "word " * 250 + "#", "s1"), (62, "ABC\x0bdef\tghi\rjkl\x85x", ""),
                                  (63, " ".join(map(str, range(300))), "s9"), (64, " ".join(map(str, range(300))), "s9"), (64, "$", "s9")],
                                 "doc_id long, text string, source string")
    docs = wide_docs.unionByName(more, allowMissingColumns=True)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    labels = [(0, 1, 0), (3, 0, 1), (3, 1, None), (9, None, 1), (61, 1, 1), (61, 1, 1), (64, 0, 0), (999, 1, 1), (None, 1, 1), (63, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(5))
    labels = [x for x in labels if x[0] is not None]
    got = filter_audit.filter_interactions(docs, table)
    want = plain_audit(rows, labels)
    assert by_text(tuple(r) for r in got.collect()) == by_text(want) and len(want) % 600 == 0
    assert filter_audit.filter_interactions(no_docs, table).count() == 0
    assert filter_audit.filter_interactions(docs, table.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_has_no_row_limit(spark):
    cells = spark.range(4000).select(F.col("id").cast("string").alias("part"), F.lit(3).alias("mask"), F.lit(2).cast("long").alias("n"),
                                     F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    steps = filter_audit.enumerate_prefixes(cells)  # 1.3 million recursion rows
    assert steps.count() == 4000 * 325

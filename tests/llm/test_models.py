"""Quality, toxicity, nearest neighbours, token counts and suffix-tree scores."""

import base64
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from jobflow.llm import ann, quality, suffix_tree_lm, token_counts, toxicity
from jobflow.llm.common import table
from jobflow.session import scratch_path
from llm_fixtures import SF_SMALL, no_docs, odd_docs, odd_texts  # noqa: F401
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.arange(1, len(order) + 1)[np.asarray(label)[order] == 1].sum()
    n = sum(label)
    return (rank - n * (n + 1) / 2) / (n * (len(label) - n))


def feature(text, name):
    raw = text.encode()
    off = np.array([0, len(raw)])
    return quality.features(np.frombuffer(raw, np.uint8), off)[0][quality.FEATURES.index(name)]


def test_features_of_small_texts():
    assert feature("a b a b a", "distinct_words") == 2 / 5
    assert feature("a a b", "repeated_next") == 1 / 3
    assert feature("x\nx\ny", "repeated_lines") == pytest.approx(1 / 3)
    assert feature("ab ## cd", "letterless_words") == pytest.approx(1 / 3)
    assert feature("ab, c", "stops") == 1 / 5
    assert not quality.features(np.zeros(0, np.uint8), np.array([0, 0])).any()


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert auc(model.score(x), y) > 0.95
    assert (0, 1) in {tuple(sorted(p[:2])) for p in model.pairs}


def test_quality_scores(spark, odd_docs, no_docs):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert ((got.score >= 0.7).astype(int) == got.predicted).all()
    own = spark.createDataFrame([(1, 1), (4, 0), (5, None), (2, 1), (3, 0)], "doc_id long, quality int")
    scores = quality.quality_scores(odd_docs, own).collect()
    assert len(scores) == odd_docs.count() and all(0 <= r.score <= 1 for r in scores)
    none = quality.quality_scores(odd_docs, own.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_scores(no_docs, own).count() == 0


def cosines(index, bags):
    """Exact cosines of term-count bags against all examples of an index."""
    dense = np.zeros((len(index.ids), len(index.vocabulary)))
    at = np.repeat(np.arange(len(index.vocabulary)), np.diff(index.post[index.entry]))
    dense[index.example, at] = index.weight
    out = []
    for term, count in bags:
        w = (1 + np.log(count)) * index.idf[term]
        out.append(dense[:, term] @ (w / np.sqrt((w * w).sum())) if len(term) else np.zeros(len(index.ids)))
    return out


@pytest.mark.parametrize("whole", [-1.0, 0.4, 2.0])
def test_block_max_search_is_exact(spark, whole, monkeypatch):
    monkeypatch.setattr(toxicity, "WHOLE", whole)  # always whole posting lists, as in production, always picked blocks
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    index = toxicity.train(docs, labels).index
    assert index.blocks > 3
    texts = [r.text.encode() for r in docs.orderBy("doc_id").limit(150).collect()]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, term, count = toxicity.bags(np.frombuffer(b"".join(texts), np.uint8), off, index.vocabulary)
    bags = [(term[row == i], count[row == i]) for i in range(len(texts))]
    for (t, c), want in zip(bags, cosines(index, bags), strict=True):
        found, cosine = index.nearest(t, c, 12)
        best = np.sort(want)[::-1][:12]
        assert np.allclose(cosine, np.minimum(best[best > 1e-12], 1)[:len(cosine)])
        assert np.allclose(want[found], cosine) and len(found) == min(12, (want > 1e-12).sum())


def test_a_copy_of_an_example_finds_it(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.train(docs, labels)
    copies = docs.filter(F.col("doc_id").cast("string").isin(model.index.ids) & F.col("text").rlike("[A-Za-z]")).select(
        (-1 - F.col("doc_id")).alias("doc_id"), "text")
    got = toxicity.predict(copies, model).collect()
    assert len(got) > 300 and all(r.evidence and r.evidence[0].cosine == pytest.approx(1) for r in got)


def test_the_model_comes_whole_or_not_at_all(spark, monkeypatch):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    monkeypatch.setattr(toxicity, "PIECE", 10_000)
    one = toxicity.train(docs, labels)
    index = one.index
    assert len(one.data) < 12 * len(index.weight)  # counts travel, weights are made anew
    w = (1 + np.log(index.count)) * index.idf[np.repeat(np.arange(len(index.vocabulary)), np.diff(index.post[index.entry]))]
    assert np.allclose(index.weight, w / np.sqrt(np.bincount(index.example, w * w))[index.example])
    data = bytes(range(256)) * 100
    rows = spark.createDataFrame([(at, len(data), data[at:at + 1000]) for at in range(0, len(data), 1000)], toxicity.CUT).repartition(5)
    assert toxicity.whole(rows) == data
    for some in (rows.filter("at > 0"), rows.limit(0)):  # the serving thread died: the rows just ended
        with pytest.raises(RuntimeError, match="bytes of the model"):
            toxicity.whole(some)


def test_document_frequencies_count_all_rows(spark):
    docs = spark.createDataFrame([("one two two",), ("two three",), (None,), ("",)], "text string")
    raw = b"one two three"
    names = np.unique(toxicity.terms(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])
    df, n = toxicity.frequencies(docs, names)
    assert n == 4 and sorted(df.tolist()) == [1, 1, 1, 2]  # three, its beginning, one; two


def test_toxicity_scores(spark, odd_docs, no_docs):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert auc(held.score.to_numpy(), held.toxic.to_numpy()) > 0.8
    assert (held.predicted == held.toxic).mean() >= max(0.9, (held.toxic == 0).mean())
    own = spark.createDataFrame([(1, 1), (4, 0), (5, None), (2, 1), (3, 0), (6, 0)], "doc_id long, toxic int")
    for some in (own, own.limit(0), own.filter("toxic = 0")):
        scores = toxicity.toxicity_scores(odd_docs, some).collect()
        assert len(scores) == odd_docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.toxicity_scores(no_docs, own).count() == 0


def brute_nearest(rows, queries, k):
    out = []
    for q, v in queries:
        found = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return out


def test_nearest_on_odd_vectors(spark):
    rng = np.random.default_rng(3)
    same = [1.0, 2.0, 0.0]
    good = [(i, [float(x) for x in rng.integers(-3, 4, 3)]) for i in range(1, 60)]
    good = [(i, v) for i, v in good if any(v)] + [(100 + i, same) for i in range(80)]
    bad = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]), (203, [math.nan, 1.0, 1.0]), (204, [math.inf, 1.0, 1.0]),
           (205, []), (206, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in good + bad + good[:5]],
                                  "vec_id long, embedding array<double>, leaf int, cell string")
    got = ann.nearest(frame, frame.filter("vec_id % 20 = 0"), recall=1.0).collect()
    queries = [(i, v) for i, v in good if i % 20 == 0]
    assert sorted(map(tuple, got)) == sorted(brute_nearest(good, queries, 20))
    two = spark.createDataFrame([(20, [2.0, 0.0, 1.0]), (20, [1.0, 5.0, 0.0]), (20, [1.0, 4.0, 9.0])], "vec_id long, embedding array<double>")
    got = ann.nearest(frame, two, recall=1.0).collect()
    assert sorted(map(tuple, got)) == sorted(brute_nearest(good, [(20, [1.0, 4.0, 9.0])], 20))
    few = spark.createDataFrame(good[:3], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, ann.nearest(few, few).collect())) == sorted(brute_nearest(good[:3], good[:3], 20))
    assert ann.nearest(few.limit(0), few).count() == 0


def test_nearest_recall(spark):
    frame = table(spark, SF, "embeddings")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in frame.collect()]
    want = defaultdict(set)
    for q, _, i, _ in brute_nearest(rows, [(i, v) for i, v in rows if i % 20 == 0], 20):
        want[q].add(i)
    got = ann.nearest(frame, frame.filter("vec_id % 20 = 0")).collect()
    assert len(got) == 20 * len(want)
    assert sum(r.vec_id in want[r.query_id] for r in got) >= 0.9 * len(got)
    by = dict(rows)
    assert all(abs(r.score - by[r.query_id] @ by[r.vec_id]) < 1e-12 for r in got)


def test_cells_and_chunks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 7)
    frame = table(spark, SF_SMALL, "embeddings").limit(200)
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in frame.collect()]
    some = [(i, v) for i, v in rows if i % 20 == 0]
    got = {(r.query_id, r.vec_id) for r in ann.nearest(frame, frame.filter("vec_id % 20 = 0"), recall=1.0).collect()}
    assert got == {(q, i) for q, _, i, _ in brute_nearest(rows, some, 20)}


def test_rollup_commits_are_idempotent(spark, odd_docs, no_docs):
    path = scratch_path(spark, "rollup")
    roll = token_counts.Rollup(spark, path)
    assert roll.totals().count() == 0
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    for _ in range(2):
        roll.commit("a", token_counts.inserts(odd_docs, "v1", n))
    roll.commit("b/1", token_counts.inserts(no_docs, "v1", n))
    want = odd_docs.groupBy("source", "lang").agg(F.count("*").alias("d"), F.sum(n).alias("t")).collect()
    want = {(r.source, r.lang, "v1", r.d, r.t) for r in want}

    def totals(r):
        return {tuple(x) for x in r.totals().collect()}
    assert totals(roll) == want and set(roll.log()) == {"a", "b/1"}
    roll = token_counts.Rollup(spark, path)  # a restarted writer finds all commits
    assert totals(roll) == want
    roll.commit("c", token_counts.revisions(odd_docs, "v1", n, n + 2))
    assert totals(roll) == {(s, c, v, d, t + 2 * d) for s, c, v, d, t in want}
    roll.commit("c", token_counts.revisions(odd_docs, "v1", n, n))  # the same batch again, mended
    assert totals(roll) == want
    token_counts.inserts(odd_docs, "v1", n).write.parquet(f"{path}/deltas/half-done")  # a writer lost before its log entry
    assert totals(token_counts.Rollup(spark, path)) == want
    roll.compact()
    assert not roll.log() and totals(token_counts.Rollup(spark, path)) == want
    roll.commit("a", token_counts.inserts(odd_docs, "v1", n))  # folded: a late replay changes nothing
    roll.commit("d", token_counts.inserts(odd_docs.limit(1), "v2", F.lit(7)))
    assert len(totals(roll)) == len(want) + 1
    roll.commit("d", token_counts.inserts(no_docs, "v2", n))
    roll.compact()
    roll.commit("e", token_counts.deletes(odd_docs, "v1", n))
    assert token_counts.Rollup(spark, path).totals().count() == 0


def test_corpus_rollup_matches_the_library(spark, odd_docs, no_docs):
    names = ("byte_bpe_50k", "byte_bpe_multi_50k")
    files = {x: public_tokenizers.path(f"{x}.tiktoken") for x in names}
    docs = odd_docs.unionByName(spark.createDataFrame([(None, "twice", "en", "s0"), (None, "twice", "en", "s0"), (None, None, None, None)],
                                                      "doc_id long, text string, lang string, source string"), allowMissingColumns=True)
    want, seen = Counter(), {}
    for r in docs.collect():
        place = (r.doc_id is None, r.doc_id or 0)
        if place < seen.get(r.text or "", ((True, 1 << 60), None))[0]:
            seen[r.text or ""] = (place, (r.source, r.lang))
    for t, (_, (source, lang)) in seen.items():
        for x in names:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(files[x], "rb"))}
            lib = tiktoken.Encoding(x, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            want[source, lang, x, "d"] += 1
            want[source, lang, x, "t"] += len(lib.encode_ordinary(t))
    got = token_counts.corpus_rollup(docs, scratch_path(spark, "rollup"), files, public_tokenizers.PATTERN).totals().collect()
    assert {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in got} == {
        (s, c, x): (want[s, c, x, "d"], want[s, c, x, "t"]) for s, c, x, k in want if k == "d"}
    assert token_counts.corpus_rollup(no_docs, scratch_path(spark, "rollup"), files, public_tokenizers.PATTERN).totals().count() == 0


def brute_suffix_tree(rows, depth, least, lam, least_gain):
    """The same model from plain dictionaries: (n_tokens, n_known, base, score) per row."""
    texts = [((t or "").encode().lower().split(), held) for t, held in rows]
    longest = max(len(w) for w, _ in texts)
    depth = longest if depth is None else depth
    count, nexts = Counter(), [None, defaultdict(Counter)]
    for w, held in texts:
        if not held:
            count.update([*w, None])
    n, v = sum(count.values()), len(count)

    def base(x):
        return (count[x] + 1) / (n + v + 1)

    kept = set()

    def prob(context, x):
        p = base(x)
        for d in range(1, len(context) + 1):
            s = tuple(context[-d:])
            if s not in kept:
                break
            p = (nexts[d][s][x] + lam * p) / (sum(nexts[d][s].values()) + lam)
        return p

    for d in range(1, depth + 1):
        new = set()
        for seq in ([*w, None] for w, held in texts if not held):
            for i in range(d, len(seq)):
                nexts[d][tuple(seq[i - d:i])][seq[i]] += 1
        nexts.append(defaultdict(Counter))
        for s, f in nexts[d].items():
            total = sum(f.values())
            if total >= least and (d == 1 or s[1:] in kept):
                q = {x: float(np.float32(prob(s[1:], x))) for x in f}
                gain = sum(c * math.log((c - 1 + lam * q[x]) / (total - 1 + lam) / q[x]) for x, c in f.items())
                if gain > least_gain:
                    new.add(s)
        if not new:
            break
        kept |= new
    out = []
    for w, _ in texts:
        seq = [*w, None]
        out.append((len(seq), sum(count[x] > 0 for x in seq), sum(math.log10(base(x)) for x in seq),
                    sum(math.log10(prob(seq[max(0, i - len(nexts)):i], x)) for i, x in enumerate(seq))))
    return out, n, kept


@pytest.mark.parametrize(("unit", "depth"), [(1 << 22, None), (300, None), (300, 1)])
def test_suffix_tree_matches_brute_force(spark, odd_texts, unit, depth, monkeypatch):
    rng = random.Random(9)
    chain = defaultdict(lambda: [rng.choice("abcd") for _ in range(2)])
    texts = []
    for _ in range(60):
        w = [rng.choice("abcd")]
        for _ in range(rng.randrange(80)):  # the next word depends on three
            w.append(rng.choice(chain[tuple(w[-3:])]))
        texts.append(" ".join(w).upper())
    texts += [t for _, t in odd_texts]
    rows = [(t, zlib.crc32(str(i).encode()) % 7 == 2) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, h, 1, "k") for i, (t, h) in enumerate(rows)],
                                  "doc_id long, text string, held_out boolean, unit int, rows string").repartition(3)
    monkeypatch.setattr(suffix_tree_lm, "HOT_LEAST", 40)  # many contexts count as hot and are split
    got = {r.doc_id: r for r in suffix_tree_lm.suffix_tree_scores(frame, least=4, lam=3.0, least_gain=2.0, unit_bytes=unit, depth=depth).collect()}
    want, n, kept = brute_suffix_tree(rows, depth, 4, 3.0, 2.0)
    assert max(len(s) for s in kept) > 2 if depth is None else {len(s) for s in kept} == {1}
    for i, (tokens, known, base, score) in enumerate(want):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, n, rows[i][1])
        assert r.base_score == pytest.approx(base, abs=1e-8) and r.score == pytest.approx(score, abs=1e-8)


def test_distinct_values_that_share_their_leading_bits():
    rng = np.random.default_rng(3)
    for x in (rng.integers(0, 50, 1000), rng.integers(0, 1 << 62, 1000), np.array([7, 5, 7, 5, 6]), np.zeros(0, int)):
        x = x.astype(np.uint64)
        values, of, order, first = suffix_tree_lm.distinct(x)
        want, inverse, count = np.unique(x, return_inverse=True, return_counts=True)
        assert values.tolist() == want.tolist() and of.tolist() == inverse.tolist()
        assert x[order[first]].tolist() == want.tolist() and np.diff(np.append(first, len(x))).tolist() == count.tolist()


def test_suffix_tree_units_are_not_shuffled(spark, odd_docs):
    scores = suffix_tree_lm.document_scores(odd_docs)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    units, answers = plan.split("FlatMapCoGroupsInPandas")[1].split("+- Exchange")[0], plan.split("FlatMapCoGroupsInPandas")[1]
    assert "Bucketed: true" in units and "Exchange" not in units and answers.count("Exchange") == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tokens_")]


def test_names_keep_their_low_bytes():
    x = np.array([0, 1, 255, 256, (1 << 24) - 1, (1 << 48) - 1], np.uint64)
    for k in (3, 6):
        data = suffix_tree_lm.trimmed(x, k).tobytes()
        assert len(data) == k * len(x) and suffix_tree_lm.untrimmed(data, k).tolist() == (x % (1 << 8 * k)).tolist()
    assert [suffix_tree_lm.name_bytes(n) for n in (0, 255, 256, 1 << 16)] == [1, 1, 2, 3]
    assert [suffix_tree_lm.context_bytes(d, 1 << 20) for d in (1, 2, 3)] == [3, 6, 8] and suffix_tree_lm.context_bytes(2, 1 << 33) == 8


def test_large_counts_take_two_bytes_more():
    x = np.array([0, 254, 255, 256, 65534, 65535, 1 << 40, 3])
    some = [x, np.zeros(0, int), np.full(100, 300)]
    assert suffix_tree_lm.unpacked([suffix_tree_lm.packed(y) for y in some]).tolist() == np.concatenate(some).tolist()
    assert len(suffix_tree_lm.packed(some[2])) == 16 + 3 * 100


def test_ascending_names_as_distances():
    for x in ([], [0], [7, 300, (1 << 64) - 1]):
        assert suffix_tree_lm.unspaced(suffix_tree_lm.spaced(np.array(x, np.uint64))).tolist() == x


def test_few_texts_left_need_no_units(spark, monkeypatch):
    rng = random.Random(4)
    chain = defaultdict(lambda: [rng.choice("pqr") for _ in range(2)])
    rows = [(" ".join(f"n{rng.randrange(2000)}" for _ in range(100)), i % 7 == 2) for i in range(150)] + [(None, True)]
    for i in range(20):  # only here contexts grow long
        w = ["p"]
        while len(w) < 100:
            w.append(rng.choice(chain[tuple(w[-5:])]))
        rows.append((" ".join(w), i % 7 == 2))
    frame = spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(rows)], "doc_id long, text string, held_out boolean").repartition(3)
    steps, stored = [], suffix_tree_lm.stored

    def spied(df, name):
        if name == "states":
            steps.append(df._jdf.queryExecution().analyzed().toString())
        return stored(df, name)
    monkeypatch.setattr(suffix_tree_lm, "stored", spied)
    scores = suffix_tree_lm.suffix_tree_scores(frame, least=4, lam=3.0, least_gain=2.0)
    assert "FlatMapCoGroupsInPandas" in steps[0] and "FlatMapCoGroupsInPandas" not in steps[-1]  # states alone
    assert "FlatMapCoGroupsInPandas" not in scores._jdf.queryExecution().executedPlan().toString()
    want, n, kept = brute_suffix_tree(rows, None, 4, 3.0, 2.0)
    assert max(len(s) for s in kept) > 3
    for r in scores.collect():
        tokens, known, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n)
        assert r.base_score == pytest.approx(base, abs=1e-8) and r.score == pytest.approx(score, abs=1e-8)


def test_suffix_tree_edges(spark, odd_docs, no_docs):
    got = suffix_tree_lm.document_scores(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r.score <= 0 and r.n_tokens > 0 for r in got)
    assert suffix_tree_lm.document_scores(no_docs).count() == 0
    held = suffix_tree_lm.suffix_tree_scores(odd_docs.withColumn("held_out", F.lit(True))).collect()
    assert all((r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0) for r in held)


def test_suffix_tree_beats_its_base(spark):
    got = suffix_tree_lm.document_scores(table(spark, SF, "documents")).toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()

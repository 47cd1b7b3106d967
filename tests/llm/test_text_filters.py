"""Decontamination and language ID."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from jobflow.llm import decontaminate, langid
from jobflow.llm.common import table
from llm_fixtures import SF_SMALL, no_docs, odd_docs, odd_texts  # noqa: F401


def edits(a: bytes, b: bytes) -> int:
    """Fewest edits of ``a`` against any stretch of ``b``."""
    row = [0] * (len(b) + 1)
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def norm(t: str) -> bytes:
    raw = np.frombuffer((t or "").encode(), np.uint8)
    return decontaminate.normalize(raw, np.array([0, len(raw)]))[0].tobytes().strip()


def test_regions_match_brute_force(spark, no_docs):
    rng = random.Random(3)
    words = ["lamp", "stone", "river", "garden", "quiet", "morning", "letter", "window", "paper", "music"]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (6, 14, 30, 40)] + ["tiny", "", None]
    docs = []
    for t in items[:4]:
        for changes in (0, 1, 2, 4, 8, 16):
            s = list(t.upper() if changes == 1 else t.replace(" ", " \n"))
            for _ in range(changes):
                p = rng.randrange(len(s))
                s[p:p + 1] = rng.choice([["q"], [], [s[p], "q"]])
            docs.append(" ".join(rng.choice(words) for _ in range(30)) + ", " + "".join(s) + ". " +
                        " ".join(rng.choice(words) for _ in range(20)))
    docs += [None, "", "  ", " ".join(words), items[2] + " " + items[2], items[1]]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    rows = decontaminate.contaminated(frame, bench).collect()
    want = set()
    for d, t in enumerate(docs):
        for i, x in enumerate(items):
            a = norm(x)
            k = decontaminate.budget(len(a))
            if k >= 0 and (e := edits(a, norm(t))) <= k:
                want.add((d, i, e))
    best = {}
    for r in rows:
        best[r.doc_id, r.item_id] = min(r.edits, best.get((r.doc_id, r.item_id), 99))
    assert {(d, i, e) for (d, i), e in best.items()} == want
    exact = [r for r in rows if r.doc_id == len(docs) - 2 and r.item_id == 2]
    assert len(exact) == 2  # both copies in one text
    for r in exact:
        assert docs[r.doc_id].encode()[r.first:r.end].decode() == items[2]
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(frame, bench.limit(0)).count() == 0
    kept = {r.doc_id for r in decontaminate.clean(frame, bench).collect()}
    assert kept == set(range(len(docs))) - {d for d, _, _ in want}


def test_item_groups_cover_the_benchmark(spark, monkeypatch):
    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    one = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    whole = sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 2000)
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == one
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == whole


def test_language_id(spark, odd_docs, odd_texts, no_docs):
    docs = table(spark, SF_SMALL, "documents")
    got = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and held
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    odd = {str(r.doc_id): r for r in langid.language_id(odd_docs).collect()}
    for i, t in odd_texts:
        if t is None or not any(c.isalpha() for c in t):
            assert (odd[str(i)].lang_pred, odd[str(i)].score) == ("und", 0.0)
    assert {r.lang_pred for r in odd.values()} <= {"en", "und"}
    assert langid.language_id(no_docs).count() == 0


@pytest.mark.parametrize("bits", [12, 15])
def test_counts_match_brute_force(spark, bits):
    docs = table(spark, SF_SMALL, "documents")
    model = next(langid.train(docs, bits=bits).blocks())
    rows = docs.select("text", "lang").collect()
    want = np.zeros((1 << bits, len(model.langs)))
    for r in rows:
        for h, _ in langid.grams([r.text], bits)[0]:
            np.add.at(want[:, model.langs.index(r.lang)], h, 1)
    want = np.log((want + 0.5) / (want.sum(0) + 0.5 * (1 << bits)))
    assert np.allclose(model.logp, want, atol=1e-4)


def plain_bayes(rows, text, bits, alpha=0.5):
    """Language and tempered posterior of a text by dictionaries: the same hash of every 1- to 3-gram, counted one by one."""
    def hashed(t):
        s = "".join(c if c.isalpha() else " " for c in f" {t.lower()} ")
        s = "".join(c for i, c in enumerate(s) if c != " " or i == 0 or s[i + 1:i + 2].strip())
        out = []
        for n in (1, 2, 3):
            for i in range(len(s) - n + 1):
                h = 0
                for c in s[i:i + n]:
                    h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2**64
                out.append(h * 0xD6E8FEB86659FD93 % 2**64 >> (64 - bits))
        return out
    counts, seen = defaultdict(Counter), Counter()
    for t, lang in rows:
        if t is not None and lang is not None:
            counts[lang].update(hashed(t))
            seen[lang] += 1
    grams = hashed(text)
    joint = {}
    for lang in sorted(seen):
        total = sum(counts[lang].values()) + alpha * 2**bits
        log = math.log(seen[lang] / sum(seen.values())) + sum(math.log((counts[lang][g] + alpha) / total) for g in grams)
        joint[lang] = log / math.sqrt(max(1, len(grams)))
    best = max(sorted(joint), key=lambda k: joint[k])
    return best, math.exp(joint[best]) / sum(math.exp(v) for v in joint.values())


@pytest.mark.parametrize("most", [1024, 2])
def test_predictions_match_plain_bayes(spark, most, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGS", most)  # two: several blocks
    rows = [("der Hund und die Katze", "de"), ("das Haus ist klein", "de"), ("the dog and the cat", "en"), ("a small house", "en"), ("tiny", "en"),
            ("el perro y el gato", "es"), ("la casa es pequeña", "es"), ("le chien et le chat", "fr"), ("e", "xx"), (None, "en"), ("no label", None)]
    rows += [("common words here", "en")] * 20
    train = spark.createDataFrame(rows, "text string, lang string")
    texts = ["der kleine Hund", "e", "the", "perro", "común", "x y z", "chat", "", None, "12", "und the"]
    docs = spark.createDataFrame([(i, t, 0.5, "k", 3) for i, t in enumerate(texts)], "doc_id long, text string, total double, lang string, row int").repartition(3)
    model = langid.train(train, bits=12)
    got = {r.doc_id: r for r in langid.predict(docs, model, bits=12, keep=("total", "lang", "row")).collect()}
    for i, t in enumerate(texts):
        if not t or not any(c.isalpha() for c in t):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
        else:
            lang, score = plain_bayes(rows, t, 12)
            assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, abs=1e-4)
        assert (got[i].total, got[i].lang, got[i].row) == (0.5, "k", 3)


def test_the_prior_counts_in_full(spark):
    """Priors 0.95 and 0.05, and a text that is only a little likelier in the rare language: Bayes picks the common one."""
    model = langid.Model(["common", "rare"], np.zeros((4096, 2), np.float32), np.log([0.95, 0.05]))
    model.logp[:, 1] = 0.05
    names, best, total = langid.score_texts(model, 12, ["abcdefghij"])
    n = sum(len(r) for _, r in langid.grams(["abcdefghij"], 12)[0])
    assert names == ["common"] and 0.05 * n < np.log(0.95 / 0.05)
    names, *_ = langid.score_texts(model, 12, ["abcdefghij" * 10])
    assert names == ["rare"]


def test_decontamination_edges(spark):
    item = "a long enough benchmark item about seventeen silver herons"
    long = "filler words " * 200_000
    docs = spark.createDataFrame([(1, f"x {item.upper()} y", 1, "r"), (1, "another text of the same id", 2, "r"), (None, item, 3, "r"),
                                  (None, "clean without an id", 4, "r"), (2, long + item, 5, "r"), (2, long + item, 6, "r"), (3, long, 7, "r"), (4, None, 8, "r")],
                                 "doc_id long, text string, first long, item string").repartition(4)
    bench = spark.createDataFrame([(9, item), (5, item), (5, item), (7, "tiny"), (8, None), (None, item)], "item_id long, text string")
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns and sorted(r.first for r in clean.collect()) == [2, 4, 7, 8]
    found = decontaminate.contaminated(docs, bench).collect()
    assert {r.item_id for r in found} == {5} and sorted(str(r.doc_id) for r in found) == ["1", "2", "2", "None"]
    assert [r.first for r in found if r.doc_id == 2] == [len(long)] * 2
    assert decontaminate.clean(docs.limit(0), bench).count() == 0

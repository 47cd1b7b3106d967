"""Fixtures of these tests; a second conftest would hide the one above."""

import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"
WORDS = ["the", "of", "and", "river", "stone", "Garden", "lamp", "über", "niño", "été", "42", "x-y", "don't", "…"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) if rng.random() < 0.4 else rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts with nulls, empty and blank texts, copies, near copies, shared passages, repeated rows and a long text."""
    rng = random.Random(5)
    base = [prose(rng, 120) for _ in range(8)]
    passage = prose(rng, 70)
    texts = [*base, base[0], base[0], base[1].replace("river", "lake", 1), None, "", "   \n\t", "a", "one two",
             base[2][:300] + passage + base[3][:200], passage + base[4], "z" * 900, "Z" * 450,
             prose(rng, 4000), base[5] + "\n" + base[5]]
    rows: list[tuple[int | None, str | None]] = list(enumerate(texts))
    return [*rows, (0, texts[0]), (None, base[6] + " tail")]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The odd texts as documents, with columns named like the operators' own ones."""
    rows = [(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 2}" if i != 3 else None, len(t or ""), 1, "u", "b", 0.5, "k")
            for i, t in odd_texts]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score int, unit string, bucket string, fp double, sha string"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

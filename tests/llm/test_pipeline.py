"""The pipeline's stages against plain Python on small documents."""

import base64
import hashlib

import corpus_pipeline
import public_tokenizers as P
import pytest
import tiktoken
from jobflow.llm import suffix_dedup
from jobflow.session import scratch_path
from llm_fixtures import SF_SMALL, odd_docs, odd_texts  # noqa: F401
from pyspark.sql import functions as F
from test_dedup import components, fingerprint

BENCH = "seventeen silver herons crossed the frozen harbour before anyone had noticed the lamps were out"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, odd_docs):
    """The odd documents with one leak and one letterless row, as a folder of tables."""
    path = scratch_path(spark, "pipeline-in")
    more = spark.createDataFrame([(50, f"before it all, {BENCH.upper()}! and after it", "en", "s", 0), (51, "12 34 ** 56", "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    odd_docs.select(*COLUMNS[:-1], F.col("n_chars").cast("int").alias("n_chars")).unionByName(more).write.parquet(path + "/documents.parquet")
    spark.createDataFrame([(0, BENCH)], "item_id long, text string").write.parquet(path + "/benchmark.parquet")
    return path


def test_stages_match_plain_python(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet").cache()
    rows = {r.doc_id: r.text for r in docs.filter("doc_id IS NOT NULL").collect()}
    kept = corpus_pipeline.stage_language(spark, docs, folder)
    assert kept.columns == COLUMNS
    lettered = {i: t for i, t in rows.items() if t and any(c.isalpha() for c in t)}
    assert {r.doc_id for r in kept.collect()} - {None} == set(lettered)

    kept = kept.filter("doc_id IS NOT NULL")
    alone = corpus_pipeline.stage_simhash(spark, kept, folder).cache()
    fps = {i: fingerprint(t) for i, t in lettered.items()}
    root = components(set(fps.values()))
    low = {}
    for i in sorted(fps, reverse=True):
        low[root[fps[i]]] = i
    assert sorted(r.doc_id for r in alone.collect()) == sorted(low.values()) and alone.columns == COLUMNS

    cut = corpus_pipeline.stage_suffix(spark, alone, folder).cache()
    before = {r.doc_id: r.text for r in alone.collect()}
    want = dict(zip(before, suffix_dedup.brute_force([t.encode() for t in before.values()]), strict=True))
    digests = {r.doc_id: r.kept_sha256 for r in suffix_dedup.digests(alone).collect()}
    assert {i: w[2] for i, w in want.items()} == digests
    for r in cut.collect():
        assert (r.text == before[r.doc_id]) == (want[r.doc_id][0] == 0) and r.n_chars == len(r.text)

    clean = corpus_pipeline.stage_decontaminate(spark, cut, folder).cache()
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in cut.collect()} - {50} and clean.columns == COLUMNS

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(corpus_pipeline.TOKENIZER), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = corpus_pipeline.stage_bpe(spark, clean, folder)
    for r in last.collect():
        ids = library.encode_ordinary(r.text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_simhash_keeps_one_row_of_each_class_whatever_its_id(spark):
    words = [f"{w} " * 3 + f"{w}{w}" for w in ("alder", "birch", "cedar", "dogwood", "elm", "fir")]
    rows = [(None, words[0], None, "s", 1), (None, words[0], None, "s", 1), (None, words[1], "en", "s", 1),  # null ids only
            (7, words[2], "en", "s", 1), (7, words[3], "en", "s", 1), (7, words[3], "en", "s", 1),  # one id, two texts
            (None, words[4], "en", "s", 1), (9, words[4], "en", "s", 1), (8, words[4], "de", "s", 1), (8, words[4], "en", None, 1),
            (None, words[5], "en", None, 1), (None, words[5], None, "s", 1), (5, None, "en", "s", 0), (None, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(5)
    assert len(components({fingerprint(w) for w in words})) == len(set(components({fingerprint(w) for w in words}).values())) == 6
    got = {tuple(r) for r in corpus_pipeline.stage_simhash(spark, docs, "").collect()}
    assert got == {rows[i] for i in (0, 2, 3, 4, 8, 11, 12)}
    assert corpus_pipeline.stage_simhash(spark, docs, "").count() == 7


def test_run_applies_all_stages(spark, folder):
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    ids = [r.doc_id for r in got]
    assert len(corpus_pipeline.STAGES) == 5 and got and len(ids) == len(set(ids))
    assert 50 not in {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_stages_keep_other_columns_whatever_their_names(spark, folder):
    names = ["score", "lang_pred", "spans", "kept", "kept_text", "n_tokens", "ids_sha256", "n_tokens_in", "Decoded_SHA256", "fp", "row", "__row", "__best"]
    docs = spark.read.parquet(folder + "/documents.parquet").select(*[F.lit(f"mine {c}").alias(c) for c in names[:7]], "*",
                                                                     *[F.lit(f"mine {c}").alias(c) for c in names[7:]])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "bpe":
            assert out.columns == docs.columns
        docs = spark.read.parquet(_written(spark, out))
        assert docs.count() > 0
    own = {"n_tokens": "n_tokens_in_in", "ids_sha256": "ids_sha256_in", "Decoded_SHA256": "Decoded_SHA256_in"}
    for r in docs.collect():
        assert all(r[own.get(c, c)] == f"mine {c}" for c in names) and isinstance(r["n_tokens"], int)


def _written(spark, df):
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return path

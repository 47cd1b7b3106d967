"""Registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from jobflow.llm import (
    ann,
    bpe,
    decontaminate,
    exact_dedup,
    filter_audit,
    langid,
    manifest,
    quality,
    simhash,
    suffix_dedup,
    suffix_tree_lm,
    token_counts,
    toxicity,
)
from jobflow.llm.common import table
from jobflow.session import scratch_path

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                                public_tokenizers.PATTERN, digests=True)


def op3_quality(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_nearest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    versions = {name: public_tokenizers.path(f"{name}.tiktoken") for name in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    return token_counts.corpus_rollup(table(spark, sf_dir, "documents"), scratch_path(spark, "rollup"), versions,
                                      public_tokenizers.PATTERN).totals()


def op8_suffix_tree(spark, sf_dir):
    return suffix_tree_lm.document_scores(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark, sf_dir):
    return langid.language_id(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    return manifest.document_proofs(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark, sf_dir):
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_byte_bpe, op3_quality, op4_nearest, op5_simhash, op6_toxicity, op7_token_counts,
    op8_suffix_tree, op9_decontaminate, op10_language_id, op11_merkle_manifest,
    op12_exact_dedup, op13_filter_audit)}
ORACLE = {
    "op11_merkle_manifest": manifest.ORACLE,
    "op12_exact_dedup": exact_dedup.ORACLE, "op13_filter_audit": filter_audit.ORACLE}

"""Five-stage corpus pipeline over ``documents``; each stage calls one operator of ``jobflow.llm``.

A stage takes what its predecessor kept, as the columns of ``documents``, and works on all of it:

1. ``language_id``: the language model is learned from the rows with a language; rows without a letter,
   or whose best language is less likely than ``MIN_CONFIDENCE``, go.
2. ``simhash``: of each class of fingerprints linked at three bits (three-word shingles) the row of smallest
   doc_id stays, a null doc_id only if its class has no other; rows that share it are told apart by text hash
   and other columns, and one stays.
3. ``suffix_dedup``: bytes under any 200-byte string that occurs more than once are cut from the text.
   Bytes left of a character that was cut go with it.  A row stays even if its whole text goes.
4. ``decontaminate``: rows in which a benchmark item is found go.
5. ``bpe``: the token ids of every text, with the columns of ``documents``.

Null texts have no language and go in the first stage.  ``n_chars`` follows the text.  Columns beyond those of ``documents`` stay with
their rows, whatever their names; one that is named like a result of the last stage comes back as ``<name>_in``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobflow.llm import bpe, decontaminate, langid, simhash, suffix_dedup
from jobflow.llm.common import importable, materialize, table

MIN_CONFIDENCE = 0.5
TOKENIZER = "byte_bpe_multi_50k.tiktoken"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _apart(stage: Stage) -> Stage:
    """``stage`` with the other columns of its input under names of their own, so that they can't clash with the operators' columns."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        inner = {c: c if c in COLUMNS else f"__other_{i}" for i, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(name) for c, name in inner.items()]), sf_dir)
        new = [c for c in out.columns if c not in inner.values()]
        names, taken = [], {c.lower() for c in (*docs.columns, *new)}
        for c in inner:
            name = c
            while name.lower() in {x.lower() for x in new} or name != c and name.lower() in taken:
                name += "_in"
            taken.add(name.lower())
            names.append(name)
        return out.select(*[F.col(inner[c]).alias(name) for c, name in zip(inner, names, strict=True)], *new)

    return run_stage


@_apart
def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs)
    kept = langid.predict(docs, model, keep=tuple(c for c in docs.columns if c != "doc_id"))
    return kept.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_CONFIDENCE)).select(*docs.columns)


@_apart
def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=3, distance=3)


@_apart
def stage_suffix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.cut_repeats(docs)
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.col("kept_text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast(
        docs.schema["n_chars"].dataType)).select(*docs.columns)


@_apart
def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@_apart
def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN,
                                keep=tuple(docs.columns), digests=True)


STAGES = [
    ("language_id", stage_language),
    ("simhash", stage_simhash),
    ("suffix_dedup", stage_suffix),
    ("decontaminate", stage_decontaminate),
    ("bpe", stage_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs


ORACLE_SQL = None  # suffix order, bit balls and BPE merges have no SQL form; see tests/llm
QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}

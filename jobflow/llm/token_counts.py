"""Operator 7: token counts as delta-maintained rollups.

A batch is a set of signed changes: inserts add a document and its tokens, deletes take them away,
revisions take the old count and add the new one.  A batch is summed by source, language and
tokenizer version, written to a folder of its own and made to count by one empty file in the log,
``_log/<batch>.<number>.<folder>``; creating it is atomic.  The log is the only state: a restarted writer finds all
batches, a batch without its file does not count, and a batch id that is committed again replaces its own folder, so a
repeated commit counts once.

``compact`` folds all batches into a snapshot (a versioned dataset: the totals, and the ids folded into them).  A folded
batch is final: committing it again changes nothing.  Totals are the snapshot plus the log's other batches.
"""

from __future__ import annotations

import base64
import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobflow.llm.common import materialize
from jobflow.sources import versions

KEYS = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long"
BYTES_PER_TOKEN = 4  # first estimate of a text whose tokens are not counted yet


def inserts(docs: DataFrame, version: Column | str, tokens: Column) -> DataFrame:
    version = F.lit(version) if isinstance(version, str) else version
    return docs.select(*(F.col(c).cast("string").alias(c) for c in KEYS[:2]), version.alias("version"),
                       F.lit(1).cast("long").alias("n_docs"), tokens.cast("long").alias("n_tokens"))


def deletes(docs: DataFrame, version: Column | str, tokens: Column) -> DataFrame:
    return inserts(docs, version, tokens).select(*KEYS, (-F.col("n_docs")).alias("n_docs"),
                                                 (-F.col("n_tokens")).alias("n_tokens"))


def revisions(docs: DataFrame, version: Column | str, old: Column, new: Column) -> DataFrame:
    return inserts(docs, version, new - old).select(*KEYS, F.lit(0).cast("long").alias("n_docs"), "n_tokens")


@dataclass
class Rollup:
    """Totals kept under ``path``, a folder that all executors share.  One writer at a time."""
    spark: SparkSession
    path: str

    def log(self) -> dict[str, str]:
        """Committed batches that are not in the snapshot yet: id -> folder."""
        newest: dict[str, tuple[int, str]] = {}
        for name, _ in versions.listing(self.spark, f"{self.path}/_log"):
            batch, number, folder = name.rsplit(".", 2)
            newest[unquote(batch)] = max(newest.get(unquote(batch), (-1, "")), (int(number), folder))
        folded = self._folded()
        return {b: f"{self.path}/deltas/{folder}" for b, (_, folder) in newest.items() if b not in folded}

    def _folded(self) -> set[str]:
        if versions.current(self.spark, f"{self.path}/snapshot") is None:
            return set()
        return {r.batch for r in versions.read(self.spark, f"{self.path}/snapshot", "folded").collect()}  # a short text a batch

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Add a batch of signed changes (SCHEMA columns; nulls in keys are groups of their own, null counts zero)."""
        if batch in self._folded():
            return
        count = [F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in ("n_docs", "n_tokens")]
        folder = uuid.uuid4().hex
        # a hot source shrinks to one row per task before the shuffle
        changes.groupBy(*KEYS).agg(*count).write.parquet(f"{self.path}/deltas/{folder}")
        done = [int(n.rsplit(".", 2)[1]) for n, _ in versions.listing(self.spark, f"{self.path}/_log")]
        marker, fs = versions.handle(self.spark, f"{self.path}/_log/{quote(batch, safe='')}.{max(done, default=-1) + 1}.{folder}")
        fs.create(marker, False).close()

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens of all committed batches; groups that came to nothing go."""
        parts = sorted(self.log().values())
        rows = self.spark.read.schema(SCHEMA).parquet(*parts) if parts else self.spark.createDataFrame([], SCHEMA)
        if versions.current(self.spark, f"{self.path}/snapshot") is not None:
            rows = rows.unionByName(versions.read(self.spark, f"{self.path}/snapshot", "totals"))
        return (rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .filter("n_docs != 0 OR n_tokens != 0"))

    def compact(self) -> None:
        """Fold the log into the snapshot; both become visible at once."""
        ids = sorted(self._folded() | set(self.log()))
        folded = self.spark.createDataFrame([(b,) for b in ids], "batch string")
        versions.publish(self.spark, f"{self.path}/snapshot", {"totals": self.totals(), "folded": folded})


def with_token_counts(docs: DataFrame, vocabularies: dict[str, str], pattern: str, text: str = "text") -> DataFrame:
    """``docs`` and an array ``counts`` of (version, n): the tokens of every text by each vocabulary file (lines of base64 token and rank).

    A null text has none.  The files are small and present on every machine; each worker reads them once.
    """
    rows = docs.withColumn("__text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    kind = pa.list_(pa.struct([("version", pa.string()), ("n", pa.int64())]))
    schema = T.StructType([*docs.schema.fields]).add("counts", T.ArrayType(T.StructType().add("version", "string").add("n", "long")))

    def run(batches):
        import tiktoken

        encoders = []
        for name, path in vocabularies.items():
            with open(path, "rb") as f:
                ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
            encoders.append((name, tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})))
        for b in batches:
            counts = [[{"version": name, "n": len(e.encode_ordinary(t))} for name, e in encoders] for t in b.column("__text").to_pylist()]
            rest = b.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(counts, kind)], names=[*rest.schema.names, "counts"])

    return rows.mapInArrow(run, schema)


def corpus_rollup(docs: DataFrame, path: str, vocabularies: dict[str, str], pattern: str) -> Rollup:
    """Three batches over all of ``docs``: insert every document in all versions with tokens estimated from its bytes, revise them to
    the tokens counted, delete the exact copies of a text but one.

    Of equal texts (null: empty) the row of smallest doc_id stays, one with an id before one without; of rows that share
    it one stays.  The revision is committed twice, as after a lost acknowledgement, and the log is folded before the copies
    go, as by a restarted writer; both count once.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.unhex(F.sha2(body, 256)).alias("sha"),
                       F.ceil(F.octet_length(body) / BYTES_PER_TOKEN).alias("guess"),
                       F.monotonically_increasing_id().alias("row"), body.alias("text"))
    counted = materialize(with_token_counts(rows, vocabularies, pattern).drop("text"), "counts")
    each = counted.select("source", "lang", "guess", F.explode("counts").alias("v"))
    rollup = Rollup(docs.sparkSession, path)
    rollup.commit("load", inserts(each, F.col("v.version"), F.col("guess")))
    for _ in range(2):
        rollup.commit("recount", revisions(each, F.col("v.version"), F.col("guess"), F.col("v.n")))
    rollup.compact()
    rollup = Rollup(docs.sparkSession, path)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    # stored, so that the join has an exchange on either side and the rows of a very common text can be split
    kept = materialize(counted.groupBy("sha").agg(first, F.count("*").alias("n")).filter("n > 1").select(
        "sha", F.col("first.row").alias("stays")), "counts-kept")
    gone = counted.join(kept, "sha").filter("row != stays").select("source", "lang", F.explode("counts").alias("v"))
    rollup.commit("copies", deletes(gone, F.col("v.version"), F.col("v.n")))
    return rollup

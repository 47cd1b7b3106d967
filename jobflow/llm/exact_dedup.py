"""Exact dedup by progressive refinement: length, then prefix hash, then full hash (DataFrame functions only).

1. One scan writes a slim table (byte length, hash of the first ``PREFIX`` characters) to the shared folder; the
   prefix comes from the page that the length was read from.
2. Lengths that occur once are out.  Of the others, (length, prefix hash) pairs that occur once are out.
3. The surviving pairs become a bitmap of 2^``BITS`` bits (8 MB at most, whatever the input), so it can be broadcast
   and the second scan knows by row, without moving any text, whether a full hash is owed.  Two pairs that
   share a bit only cost a hash; they are told apart by it.
4. The full SHA-256 is taken of survivors alone.  Rows travel as (id, hash), never with their text.  A hash
   is grouped with partial aggregates, and its group joins back as one row, so a text that a third of all rows share
   is summed before the shuffle and its rows are split by the skew join.

Texts are equal when identical after lower-casing A-Z (other letters are left alone; byte lengths stay).  Null
counts as the empty text; empty texts are equal like any others.  The row with the largest id stays; a null id is
smaller than any other.  Of rows that share text and largest id exactly one stays.  A text of one row is its own
group of size 1.  No row is dropped from the result; an empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobflow.llm.common import materialize

PREFIX = 64
BITS = 26


def normalised(text: str | Column) -> Column:
    """Null as empty, A-Z lower-cased, nothing else changed."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    # lower() also folds other letters, so texts of ASCII alone take it and the rest are translated
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def _pair(norm: Column) -> tuple[Column, Column]:
    return F.octet_length(norm).alias("size"), F.xxhash64(F.substring(norm, 1, PREFIX)).alias("prefix")


def _bit(size: Column | str, prefix: Column | str, bits: int) -> Column:
    return F.pmod(F.xxhash64(size, prefix), F.lit(1 << bits)) + 1


def survivors(slim: DataFrame, bits: int = BITS) -> DataFrame:
    """Bitmap rows (bucket, bitmap) of the (length, prefix) pairs that more than one row has."""
    lengths = slim.groupBy("size").agg(F.count("*").alias("n")).filter("n > 1").select("size")
    # summed before they meet the lengths: a pair that very many rows have is one row there
    pairs = slim.groupBy("size", "prefix").agg(F.count("*").alias("n")).join(lengths, "size", "left_semi").filter("n > 1")
    bit = _bit("size", "prefix", bits)
    return pairs.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("at")).groupBy(
        "bucket").agg(F.bitmap_construct_agg("at").alias("bitmap"))


def refine(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           also: Mapping[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """One row per document: ``id_col``, keep_id, group_size, kept, and the columns of ``also``.

    ``also`` names expressions over the columns of ``docs`` that are taken in the scan that reads the texts.
    """
    also = dict(also or {})
    slim = materialize(docs.select(*_pair(normalised(text_col))), "dedup-prefix")
    owed = F.broadcast(survivors(slim, bits))  # at most 2^bits / 8 bytes
    norm = normalised(text_col)
    own = _bit(*_pair(norm), bits)
    at = F.bitmap_bit_position(own)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), norm.alias("norm"),
                       F.bitmap_bucket_number(own).alias("bucket"), at.alias("at"),
                       *[c.alias(f"also{k}") for k, c in enumerate(also.values())])
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (F.col("at") % 8).cast("int")) == 1, F.lit(False))
    extra = [f"also{k}" for k in range(len(also))]
    marked = rows.join(owed, "bucket", "left").select(
        "row", "id", F.when(hit, F.unhex(F.sha2("norm", 256))).alias("hash"), *extra)
    marked = materialize(marked, "dedup-hash")
    # stored, so that the join has an exchange on either side and a hot group's rows can be split
    groups = materialize(marked.filter("hash IS NOT NULL").groupBy("hash").agg(
        F.count("*").alias("n"), F.max(F.struct("id", "row")).alias("top")).filter("n > 1"), "dedup-groups")
    back = [F.col(e).alias(name) for e, name in zip(extra, also, strict=True)]
    alone = marked.filter("hash IS NULL").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), *back)
    hashed = marked.filter("hash IS NOT NULL").join(groups, "hash", "left").select(
        F.col("id").alias(id_col), F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("top.row"), F.lit(True)).alias("kept"), *back)
    return alone.unionByName(hashed)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """The query's digest: ``refine`` with the SHA-256 (lowercase hex) of every normalised text."""
    return refine(docs, also={"text_sha256": F.sha2(normalised("text"), 256)})


ORACLE = f"""SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
 row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents)"""

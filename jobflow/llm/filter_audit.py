"""Filter interaction audit: recursive CTE over filter prefixes, joined with mask cells.

1. Every document gets a mask of the filters it fails (one bit each) and its labels; rows are counted into mask cells,
   (part, mask) with at most 2^filters cells a part, by partial aggregates before the shuffle.
2. ``E`` (an equal text of smaller id exists, table-wide) joins the smallest id of each text hash back.  A hash with a
   third of all rows is summed before the shuffle; its rows are split by the skew join.
3. A recursive CTE starts from the empty prefix of each part and appends every letter not yet used.  Each level joins the
   part's cells and carries the bits applied so far, so a level emits the metrics of its step: 325 prefixes
   for five filters.  A complete order is its five prefixes.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``.  A null text counts as empty (it fails A alone, or A and E); a null
source is the part ''.  A null id has no smaller one and is not smaller than any, so it never makes or fails E.
Rows that share an id and a text are not copies of each other (none is smaller).  A document is good or toxic if any
label row of its id says so; ids without labels are neither.  Every part has all its rows, zeros included; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobflow.llm.common import materialize
from jobflow.session import scratch_path

LETTERS = "ABCDE"
SIGNS = "#$%&*|"


def words(text: Column) -> Column:
    """Array of the words of ``text``."""
    for sign in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(sign), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def own_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails by itself."""
    w = words(text)
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    signs = F.lit(False)
    for sign in SIGNS:
        signs = signs | F.contains(text, F.lit(sign))
    n = F.size(w)
    # short texts fail A; their words are few, so B is cheap for them
    fails = [n < 200, 100 * F.size(F.array_distinct(w)).cast("long") < 50 * n.cast("long"),
             100 * capitals.cast("long") > 2 * F.char_length(text).cast("long"), signs]
    mask = F.lit(0)
    for k, f in enumerate(fails):
        mask = mask + F.when(f, 1 << k).otherwise(0)
    return mask


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part by the filters they fail."""
    text = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                                   own_mask(text).alias("own"), F.unhex(F.sha2(text, 256)).alias("hash")), "audit-rows")
    # stored, so that the joins have an exchange on either side and a hot key's rows can be split
    first = materialize(rows.groupBy("hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).filter(
        "copies > 1 AND first IS NOT NULL").select("hash", "first"), "audit-first")
    rows = rows.join(first, "hash", "left").select("doc_id", "part", (F.col("own") + F.when(
        F.col("doc_id") > F.col("first"), 16).otherwise(0)).alias("mask"))
    marks = labels.groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
                                         F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marks = materialize(marks.filter("good OR toxic"), "audit-labels")
    return rows.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def _sum(field: str, condition: str) -> str:
    """SQL: ``field`` summed over the part's cells ``c`` that meet ``condition``."""
    return f"aggregate(filter(cells, c -> {condition}), 0L, (s, c) -> s + c.{field})"


def enumerate_prefixes(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, prefix, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost), one row per prefix.

    Runs in a session of its own, whose recursion limit is lifted since the rows grow with the parts.
    """
    spark = cells.sparkSession
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    source, out = scratch_path(spark, "audit-cells"), scratch_path(spark, "audit-prefixes")
    packed.write.parquet(source)  # at most 2^letters cells a part
    side = spark.newSession()
    side.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    side.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    side.read.schema(packed.schema).parquet(source).createOrReplaceTempView("cells")
    hit, free = "c.mask & bit <> 0", "c.mask & before = 0"
    side.sql(f"""
        WITH RECURSIVE prefixes(part, prefix, step, before, bit, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
            SELECT part, '', 0, 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM cells
            UNION ALL
            SELECT part, prefix, step, before, bit, {_sum('n', f'c.mask & (before | bit) = 0')}, {_sum('n', f'{hit} AND {free}')},
                   {_sum('n', f'{hit} AND NOT {free}')}, {_sum('n', 'c.mask = bit')}, {_sum('good', f'{hit} AND {free}')},
                   {_sum('toxic', f'{hit} AND {free}')}
            FROM (SELECT p.part, concat(p.prefix, l.letter) AS prefix, p.step + 1 AS step, p.before | p.bit AS before,
                         l.bit AS bit, cells.cells AS cells
                  FROM prefixes p JOIN cells ON cells.part = p.part
                  LATERAL VIEW inline(array({', '.join(f"struct('{x}', {1 << k})" for k, x in enumerate(letters))})) l AS letter, bit
                  WHERE p.step < {len(letters)} AND (p.before | p.bit) & l.bit = 0))
        SELECT part, prefix, step, right(prefix, 1) AS letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost
        FROM prefixes WHERE step > 0""").write.parquet(out)
    return spark.read.parquet(out)


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order and step: the metrics of the order's prefix, and its filter's Shapley sum.

    A prefix of k letters begins (len - k)! orders, so a filter's removals over all orders are its prefixes'
    removals times that number.
    """
    size = len(letters)
    steps = enumerate_prefixes(cells, letters)
    shapley = steps.groupBy("part", "letter").agg(
        F.sum(F.col("removed") * F.factorial(F.lit(size) - F.col("step"))).cast("long").alias("shapley"))
    orders = steps.filter(F.col("step") == size).select(
        "part", F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))
    orders = orders.withColumn("prefix", F.col("filter_order").substr(F.lit(1), F.col("step")))
    return orders.join(steps, ["part", "step", "prefix"]).join(shapley, ["part", "letter"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley")


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(mask_cells(docs, labels))


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
ORACLE = rf"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS t FROM documents),
lab AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT doc_id, part, len({_WORDS}) < 200 AS a, 100 * len(list_distinct({_WORDS})) < 50 * len({_WORDS}) AS b,
  100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d),
m AS (SELECT part, doc_id, CAST(a AS INTEGER) + 2 * CAST(b AS INTEGER) + 4 * CAST(c AS INTEGER) + 8 * CAST(d AS INTEGER)
  + 16 * CAST(e AS INTEGER) AS mask FROM f),
cells AS (SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM m LEFT JOIN lab USING (doc_id) GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) l(letter, bit)),
pre AS (SELECT '' AS prefix, 0 AS step, 0 AS before, 0 AS bit UNION ALL
 SELECT prefix || l.letter, step + 1, before | pre.bit, l.bit FROM pre JOIN letters l ON ((before | pre.bit) & l.bit) = 0 WHERE step < 5),
s AS (SELECT part, prefix, step, right(prefix, 1) AS letter,
  CAST(sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
 FROM pre, cells WHERE step > 0 GROUP BY ALL),
o AS (SELECT a.part, a.prefix AS filter_order, b.step, b.letter, b.kept, b.removed, b.redundant, b.unique_fails, b.good_lost, b.toxic_lost
 FROM s a JOIN s b ON a.part = b.part AND a.step = 5 AND starts_with(a.prefix, b.prefix))
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
 CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM o"""

"""Merkle dataset manifest with nested-interval labels (DataFrame functions only).

Every group (source) is a tree: its leaves are ranked 0..n-1, and a node carries the interval [lo, hi) of leaf ranks that
it covers.  At level k node i covers [i * 3^k, min((i + 1) * 3^k, n)).  The groups' roots are the leaves of one top tree.

* **Ranks** (``rank_leaves``): range partitioning on (group, order, digest, row) from a sample, so one group or one id with a third of
  all rows is still spread; positions within a task and one small row per (group, task) give the ranks.  No task
  holds a group.
* **Build** (``grow``): nodes of a level meet under (group, lo div width of the parent); at most ``ARITY`` rows a key.
  Each level is a written table, so a lost executor re-reads files.
* **Proofs** (``proofs``): from the root down, each level's nodes find the parent whose interval contains theirs (an equi-join
  on the level's bucket, then containment).  The siblings are the parent's children less the node's own interval:
  those that end at or before its lo go left, those that begin at or after its hi go right.  A path is the
  list of (left, right) digests from leaf to root, of logarithmic length.
* **Fold** (``fold``): hashes a leaf up its path.

A digest is the SHA-256 of the concatenated inputs, child digests as lowercase hex text.  Null fields are written ``-``, empty
texts ``0:``.  Leaves ascend by id, a null id first; rows that share an id ascend by digest, and identical rows have
identical digests, so their order is without effect on any column (their proofs differ by place).  A null source is a group of its own,
before all others.  A table of one row has an empty proof; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobflow.llm.common import fold as crc_fold
from jobflow.llm.common import materialize

ARITY = 3
STORED = 4  # levels on the way down between two written tables: keeps the plans short
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: binary, right: binary>>"


def hex_text(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def node_hash(*digests: Column) -> Column:
    """Binary digest of a node: SHA-256 of its children's digests as hex text."""
    return F.unhex(F.sha2(hex_text(F.concat(*digests)), 256))


def field(value: Column) -> Column:
    """A value as its UTF-8 length, ':' and its text; null is '-'."""
    t = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def group_key(source: Column) -> Column:
    """Text that sorts as the source does, null first: '0' for null, else '1' and the source."""
    return F.coalesce(F.concat(F.lit("1"), source.cast("string")), F.lit("0"))


def rank_leaves(leaves: DataFrame) -> DataFrame:
    """Add ``lo`` (rank within ``grp`` by ``at``, ``h``, from 0) and ``n`` (leaves of the group); written once."""
    order = ["grp", "at", "h", "row"]
    placed = materialize(
        leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id()),
        "manifest-order")
    placed = placed.withColumn("task", F.shiftright("pos", 33))
    runs = placed.groupBy("grp", "task").agg(F.min("pos").alias("first"), F.count("*").alias("rows"))
    # at most one row per task and group
    whole, before = Window.partitionBy("grp"), Window.partitionBy("grp").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("grp", "task", "first", F.sum("rows").over(whole).alias("n"),
                       F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return placed.join(runs, ["grp", "task"]).withColumn("lo", F.col("pos") - F.col("first") + F.col("start")).drop(
        "task", "first", "start", "pos", "row", "at")


@dataclass
class Tree:
    """Levels of written node tables (grp, n, lo, hi, h, kids); level 0 holds the leaves, without kids."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """The root of every group: grp, n, h."""
        found = [nodes.filter((F.col("lo") == 0) & (F.col("hi") == F.col("n"))).select("grp", "n", "h") for nodes in self.levels]
        top = reduce(DataFrame.unionAll, [f.withColumn("level", F.lit(k)) for k, f in enumerate(found)])
        # a lone leaf is a root at level 0; no group has a level above its root
        return top.drop("level")


def grow(ranked: DataFrame, name: str) -> Tree:
    """All levels over the ranked leaves (grp, n, lo, h); a group stops at its root."""
    nodes = materialize(ranked.select("grp", "n", "lo", (F.col("lo") + 1).alias("hi"), "h"), f"{name}-0")
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels, width = [nodes], 1
    while width < largest:
        width *= ARITY
        kid = F.struct("lo", "hi", "h")
        below = levels[-1].filter(F.col("hi") - F.col("lo") < F.col("n"))  # a root has no parent
        kids = below.groupBy("grp", "n", F.floor(F.col("lo") / width).alias("i")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        up = kids.select("grp", "n", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                         node_hash(F.aggregate("kids", F.lit(b""), lambda s, c: F.concat(s, c["h"]))).alias("h"), "kids")
        levels.append(materialize(up, f"{name}-{len(levels)}"))
    return Tree(levels)


def _side(kids: str, condition) -> Column:
    return F.aggregate(F.filter(kids, condition), F.lit(b""), lambda s, c: F.concat(s, c["h"]))


def attach(nodes: DataFrame, parents: DataFrame, width: int, columns: Sequence[str]) -> DataFrame:
    """Containment join of a level with its parents (intervals of ``width``): ``columns`` of the nodes, their path,
    and the group's ``top``."""
    p = parents.select(F.col("grp").alias("p_grp"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), F.col("kids").alias("p_kids"),
                       F.col("path").alias("p_path"), "top", F.floor(F.col("lo") / width).alias("bucket"))
    inside = ((F.col("grp") == F.col("p_grp")) & (F.floor(F.col("lo") / width) == F.col("bucket"))
              & (F.col("lo") >= F.col("p_lo")) & (F.col("hi") <= F.col("p_hi")))
    step = F.struct(_side("p_kids", lambda c: c["hi"] <= F.col("lo")).alias("left"),
                    _side("p_kids", lambda c: c["lo"] >= F.col("hi")).alias("right"))
    return nodes.join(p, inside).select(*columns, "top", F.concat(F.array(step), F.col("p_path")).alias("path"))


def proofs(tree: Tree, tops: DataFrame, leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, lo, hi and others) with the ``path`` of each: its way to the group's root, then the ``path`` of ``tops``
    (grp, h, path); ``top`` is the group's root digest."""
    roots = tops.select(F.col("grp").alias("t_grp"), F.col("h").alias("top"), F.col("path").alias("t_path"))
    own = ["grp", "lo", "hi", "kids"]

    def at_root(nodes: DataFrame, columns: Sequence[str]) -> DataFrame:
        whole = nodes.filter((F.col("lo") == 0) & (F.col("hi") == F.col("n")))
        return whole.join(roots, F.col("grp") == F.col("t_grp")).select(*columns, "top", F.col("t_path").alias("path"))

    top = len(tree.levels) - 1
    if not top:
        return at_root(leaves, leaves.columns)
    above = at_root(tree.levels[top], own)
    for k in range(top - 1, 0, -1):
        nodes = tree.levels[k]
        above = at_root(nodes, own).unionByName(attach(nodes, above, ARITY ** (k + 1), own))
        if (top - k) % STORED == 0:
            above = materialize(above, "manifest-paths")
    return at_root(leaves, leaves.columns).unionByName(attach(leaves, above, ARITY, leaves.columns))


def fold(leaf: Column | str, path: Column | str) -> Column:
    """Binary root digest that a leaf gives along its path."""
    return F.aggregate(path, F.col(leaf) if isinstance(leaf, str) else leaf,
                       lambda h, s: node_hash(s["left"], h, s["right"]))


@dataclass
class Manifest:
    """The source trees, the tree over their roots, and per leaf: the rows' columns, grp, n, lo, hi, h, top, path."""

    sources: Tree
    top: Tree
    root: bytes | None
    leaves: DataFrame

    def nodes(self) -> DataFrame:
        """The manifest as a table: tree, level, group, interval and digest of every node."""
        return reduce(DataFrame.unionAll, [
            nodes.select(F.lit(tree).alias("tree"), F.lit(k).alias("level"), "grp", "lo", "hi", hex_text("h").alias("digest"))
            for tree, t in (("source", self.sources), ("top", self.top)) for k, nodes in enumerate(t.levels)])


def build(rows: DataFrame, *, group: Column, order: Column, leaf: Column, keep: dict[str, Column] | None = None) -> Manifest:
    """Manifest of ``rows``: ``leaf`` digests ranked by ``order`` within ``group``; ``keep`` columns stay with the leaves."""
    kept = [c.alias(f"keep_{name}") for name, c in (keep or {}).items()]
    leaves = materialize(rows.select(group_key(group).alias("grp"), order.alias("at"), leaf.alias("h"),
                                     F.monotonically_increasing_id().alias("row"), *kept), "manifest-leaves")
    ranked = materialize(rank_leaves(leaves).withColumn("hi", F.col("lo") + 1), "manifest-ranks")
    sources = grow(ranked, "manifest-source")
    tops = sources.tops()
    top_leaves = rank_leaves(tops.select(F.lit("").alias("grp"), F.col("grp").alias("at"), "h", F.lit(0).alias("row"),
                                         F.col("grp").alias("of")))
    top_leaves = materialize(top_leaves.withColumn("hi", F.col("lo") + 1), "manifest-tops")
    top = grow(top_leaves, "manifest-top")
    root = top.tops().first()  # one row
    whole = top.tops().select("grp", "h", F.expr(f"cast(array() as {PATH})").alias("path"))
    with_path = proofs(top, whole, top_leaves)
    with_path = materialize(with_path.select(F.col("of").alias("grp"), "h", "path"), "manifest-top-paths")
    return Manifest(sources, top, bytes(root["h"]) if root else None, proofs(sources, with_path, ranked))


def document_proofs(docs: DataFrame) -> DataFrame:
    """Proof and check of every document against a tampering: ids whose CRC-32 is even lose the line feeds of their text."""
    hit = crc_fold(F.col("doc_id"), 2) == 0
    values = [F.col(c) for c in FIELDS]
    tampered = [*values[:-1], F.replace(values[-1], F.lit("\n"), F.lit(""))]
    changed = hit & F.coalesce(F.contains("text", F.lit("\n")), F.lit(False))
    made = build(docs, group=F.col("source"), order=F.col("doc_id"), leaf=leaf_hash(values),
                 keep={"doc_id": F.col("doc_id"), "tampered": F.when(changed, leaf_hash(tampered))})
    root = F.lit(made.root.hex() if made.root else None).cast("string")
    siblings = F.aggregate("path", F.lit(b""), lambda s, x: F.concat(s, x["left"], x["right"]))
    out = made.leaves.select(
        F.col("keep_doc_id").alias("doc_id"), hex_text("h").alias("leaf"), hex_text("top").alias("subroot"), root.alias("root"),
        F.sha2(hex_text(siblings), 256).alias("proof_sha256"),
        hex_text(fold(F.coalesce("keep_tampered", "h"), "path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _enc(value: str) -> str:
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_enc(f"CAST({c} AS VARCHAR)") for c in (*FIELDS[:-1], text)) + ")"


def _sql_tree(name: str, leaves: str) -> str:
    """DuckDB CTE of a forest: grp, level, i, h, m (nodes of the level in the group) from leaves (grp, i, h, m)."""
    return f"""{name}(grp, level, i, h, m) AS (SELECT grp, 0, i, h, m FROM {leaves} UNION ALL
 SELECT grp, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (max(m) + 2) // 3 FROM {name} WHERE m > 1 GROUP BY grp, level, i // 3)"""


def _sql_way(name: str, start: str, tree: str) -> str:
    """DuckDB CTE (k, level, l, r): the siblings left and right of leaf k's node at each level below its group's root."""
    side = "coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i {} t.i), '')"
    return f"""{name}(k, level, l, r) AS (SELECT s.k, t.level, {side.format('<')}, {side.format('>')} FROM {start} s
 JOIN {tree} t ON t.grp = s.grp AND t.m > 1 AND t.i = s.i // CAST(pow(3, t.level) AS BIGINT)
 JOIN {tree} x ON x.grp = t.grp AND x.level = t.level AND x.i // 3 = t.i // 3 GROUP BY s.k, t.level)"""


# CRC-32 (reflected polynomial 0xEDB88320) of the decimal id, by a table of 256 entries
_CRC = """crc AS (SELECT list(list_reduce([k] || list_transform(range(8), lambda x: CAST(0 AS BIGINT)),
  lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY k) AS tab FROM range(256) r(k))"""

ORACLE = f"""WITH RECURSIVE {_CRC},
d AS (SELECT documents.*, xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda a, b: xor(a >> 8, tab[CAST(xor(a, b) & 255 AS BIGINT) + 1])), 4294967295) % 2 = 0 AS hit FROM documents, crc),
leaf AS (SELECT doc_id, coalesce('1' || source, '0') AS grp, {_sql_leaf('text')} AS h,
  CASE WHEN hit THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf('text')} END AS tampered FROM d),
ranked AS (SELECT row_number() OVER () AS k, doc_id, grp, h, tampered,
  row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY grp) AS m FROM leaf),
{_sql_tree('tree', 'ranked')},
sub AS (SELECT grp AS k, '' AS grp, h, row_number() OVER (ORDER BY grp) - 1 AS i, count(*) OVER () AS m FROM tree WHERE m = 1),
{_sql_tree('high', 'sub')},
{_sql_way('lower_way', 'ranked', 'tree')},
{_sql_way('upper_way', 'sub', 'high')},
way AS (SELECT k, level, l, r FROM lower_way UNION ALL
 SELECT ranked.k, 1000 + level, l, r FROM ranked JOIN upper_way ON upper_way.k = ranked.grp),
ways AS (SELECT k, list({{'l': l, 'r': r}} ORDER BY level) AS p FROM way GROUP BY k),
r AS (SELECT doc_id, ranked.h AS leaf, sub.h AS subroot, (SELECT h FROM high WHERE m = 1) AS root, tampered, coalesce(p, []) AS p
 FROM ranked JOIN sub ON sub.k = ranked.grp LEFT JOIN ways ON ways.k = ranked.k),
f AS (SELECT *, list_reduce([{{'l': tampered, 'r': ''}}] || p, lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded FROM r)
SELECT doc_id, leaf, subroot, root, sha256(list_reduce([''] || list_transform(p, lambda s: s.l || s.r), lambda a, b: a || b)) AS proof_sha256,
 folded AS folded_root, folded = root AS verified FROM f"""

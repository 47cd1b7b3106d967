"""Operator 4: nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a bounded sample of distinct vectors and holds centroids only; every row is
then assigned to a leaf by descending it.  Largest inner product is reduced to least distance by one
more coordinate, sqrt(M^2 - |x|^2), that makes all indexed norms M.  A query walks the tree
through a priority queue of centroid distances; how many leaves it visits is calibrated on sample
queries against brute force, widening until the target recall is reached.

Leaves are stored in cells of neighbouring leaves, cells in chunks of bounded size.  A
query travels once to each chunk it needs, with its leaves there, and brings back its best k.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from jobflow.llm.common import materialize

SAMPLE = 20_000
LEAF_ROWS = 32
BRANCH = 16
CELL_ROWS = 4096
CHECKED = 300


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Group number of each row (Lloyd's rounds from k distinct seeded rows; empty groups vanish)."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    group = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        group = ((c * c).sum(1) - 2 * (x @ c.T)).argmin(1)
        used, group = np.unique(group, return_inverse=True)
        total = np.zeros((len(used), x.shape[1]))
        np.add.at(total, group, x)
        c = total / np.bincount(group)[:, None]
    return group


class Tree:
    """Centroids of all nodes; ``children`` lists a node's children, ``leaf`` numbers the leaves in tree order."""

    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        centroids: list[np.ndarray] = []
        self.leaves = 0
        self.rows: list[np.ndarray] = []

        def grow(own: np.ndarray) -> int:
            node = len(centroids)
            centroids.append(x[own].mean(0) if len(own) else np.zeros(x.shape[1]))
            self.children.append([])
            self.leaf.append(-1)
            groups = kmeans(x[own], min(BRANCH, -(-len(own) // leaf_rows))) if len(own) > leaf_rows else np.zeros(0)
            if len(groups) and groups.max() > 0:
                self.children[node] = [grow(own[groups == g]) for g in range(groups.max() + 1)]
            else:
                self.leaf[node] = self.leaves
                self.leaves += 1
                self.rows.append(own)
            return node

        grow(np.arange(len(x)))
        self.centroids = np.array(centroids)
        self.norms = (self.centroids ** 2).sum(1)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row, descending to the nearest child."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            kids = self.children[node]
            if not kids:
                out[own] = self.leaf[node]
                continue
            near = (self.norms[kids] - 2 * (x[own] @ self.centroids[kids].T)).argmin(1)
            todo += [(kid, own[near == i]) for i, kid in enumerate(kids) if (near == i).any()]
        return out

    def visit(self, q: np.ndarray, enough) -> list[int]:
        """Leaves in best-bin-first order until ``enough(leaves so far)``."""
        heap, got = [(0.0, 0)], []
        while heap:
            _, node = heapq.heappop(heap)
            kids = self.children[node]
            if kids:
                far = self.norms[kids] - 2 * (self.centroids[kids] @ q)
                for d, kid in zip(far.tolist(), kids, strict=True):
                    heapq.heappush(heap, (d, kid))
            else:
                got.append(self.leaf[node])
                if enough(got):
                    break
        return got


def lifted(x: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(1), 0))
    return np.concatenate([x, rest[:, None]], 1)


def calibrate(tree: Tree, x: np.ndarray, dim: int, k: int, recall: float) -> int:
    """Fewest leaves whose sample rows hold ``recall`` of the exact k nearest, over spread sample queries."""
    pick = np.unique(np.linspace(0, len(x) - 1, min(CHECKED, len(x))).astype(int))
    leaf_of = np.zeros(len(x), np.int64)
    for leaf, own in enumerate(tree.rows):
        leaf_of[own] = leaf
    ranks = []
    for i in pick:
        q = np.append(x[i, :dim], 0)
        near = x[:, :dim] @ x[i, :dim]
        near[i] = -np.inf
        best = np.argpartition(-near, min(k, len(x) - 1) - 1)[:k] if len(x) > 1 else np.zeros(0, int)
        order = tree.visit(q, lambda got: False)
        at = np.empty(tree.leaves, np.int64)
        at[order] = np.arange(len(order))
        ranks.append(at[leaf_of[best]])
    ranks = np.sort(np.concatenate(ranks)) if ranks else np.zeros(0, int)
    return int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1 if len(ranks) else 1


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
            recall: float = 0.97, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` found of largest inner product for each query, ties to the smaller id.

    ``queries`` has the same two columns.  Rows whose id or vector is null, whose vector is empty, zero,
    holds a null or a non-finite component, or is not as long as the most frequent length, take no part.  A query never
    finds its own id.  Rows that repeat an id and its vector count once; a query id with several vectors asks with the
    smallest, compared component by component.  Of equal vectors only
    the ``k + 1`` smallest ids are scored, as no other can be among a query's best ``k``.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        return (df.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter(
            F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
            & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
            & F.exists("v", lambda e: e != 0)))

    rows = usable(vectors)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = lengths.d
    rows = rows.filter(F.size("v") == dim).distinct()
    alike = Window.partitionBy("v").orderBy("id")
    rows = rows.withColumn("__n", F.row_number().over(alike)).filter(F.col("__n") <= k + 1)
    rows = materialize(rows, "vectors")
    norm = rows.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)))).first()[0]
    picked = rows.filter("__n = 1").orderBy(F.xxhash64("id")).limit(sample).select("v").toPandas()
    x = lifted(np.stack(picked.v.to_numpy()).astype(float), norm)
    tree = Tree(x)
    visits = calibrate(tree, x, dim, k, recall)
    tree.rows = []
    shared = spark.sparkContext.broadcast(tree)

    def assign(batches):
        for pdf in batches:
            if len(pdf):
                v = np.stack(pdf.v.to_numpy()).astype(float)
                yield pd.DataFrame({"id": pdf.id, "v": [r.tobytes() for r in v],
                                    "leaf": shared.value.assign(lifted(v, norm))})

    placed = materialize(rows.select("id", "v").mapInPandas(assign, "id long, v binary, leaf int"), "leaves")
    counts = {r.leaf: r["count"] for r in placed.groupBy("leaf").count().collect()}  # one number per leaf of the sample's tree
    cell, cells, held, chunks = {}, 0, 0, {}
    for leaf in range(tree.leaves):  # neighbouring leaves share a cell
        n = counts.get(leaf, 0)
        if held and held + n > CELL_ROWS:
            cells, held = cells + 1, 0
        cell[leaf] = cells
        held += n
        chunks[cells] = -(-held // CELL_ROWS) or 1
    lay = spark.sparkContext.broadcast((cell, chunks, counts))

    def chunk_rows(batches):
        cell, chunks, _ = lay.value
        for pdf in batches:
            c = pdf.leaf.map(cell)
            part = (pdf.id.to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            yield pdf.assign(cell=c, chunk=(part % c.map(chunks).to_numpy().astype(np.uint64)).astype(np.int32))

    def ask(batches):
        tree, (cell, chunks, counts) = shared.value, lay.value
        for pdf in batches:
            out = []
            for q, v in zip(pdf.id, pdf.v, strict=True):
                v = np.asarray(v, float)
                seen = [0]

                def enough(got, seen=seen):
                    seen[0] += counts.get(got[-1], 0)
                    return len(got) >= visits and seen[0] > k + 1

                per: dict[int, list[int]] = {}
                for leaf in tree.visit(np.append(v, 0), enough):
                    if counts.get(leaf):
                        per.setdefault(cell[leaf], []).append(leaf)
                raw = v.tobytes()
                out += [(q, raw, np.array(leaves, np.int32).tobytes(), c, part)
                        for c, leaves in per.items() for part in range(chunks[c])]
            yield pd.DataFrame(out, columns=["id", "v", "leaves", "cell", "chunk"])

    def best(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        held = held.sort_values(["leaf", "id"])
        leaf, ids = held.leaf.to_numpy(), held.id.to_numpy()
        v = np.frombuffer(b"".join(held.v), float).reshape(-1, dim)
        names = np.unique(leaf)
        lo, hi = np.searchsorted(leaf, names), np.searchsorted(leaf, names, side="right")
        q_ids = asked.id.to_numpy()
        qs = np.frombuffer(b"".join(asked.v), float).reshape(-1, dim)
        n = np.array([len(x) // 4 for x in asked.leaves])
        of, wanted = np.repeat(np.arange(len(n)), n), np.frombuffer(b"".join(asked.leaves), np.int32)
        found_q, found_v, found_s = [], [], []
        for name, a, b in zip(names, lo, hi, strict=True):
            own = of[wanted == name]
            for at in range(0, len(own), 1024):
                part = own[at:at + 1024]
                for c in range(a, b, 4096):
                    s = qs[part] @ v[c:min(b, c + 4096)].T
                    s[q_ids[part][:, None] == ids[c:min(b, c + 4096)][None, :]] = -np.inf
                    take = min(k, s.shape[1])
                    if take < s.shape[1]:  # everything as good as the k-th stays, so ties are settled by id later
                        kth = -np.partition(-s, take - 1, axis=1)[:, take - 1]
                        r, col = np.nonzero((s >= kth[:, None]) & (s > -np.inf))
                    else:
                        r, col = np.nonzero(s > -np.inf)
                    found_q.append(part[r])
                    found_v.append(ids[c + col])
                    found_s.append(s[r, col])
        if not found_q:
            return best(key, asked[:0], held)
        q, vec, s = np.concatenate(found_q), np.concatenate(found_v), np.concatenate(found_s)
        order = np.lexsort([vec, -s, q])
        q, vec, s = q[order], vec[order], s[order]
        start = np.searchsorted(q, q)
        top = np.arange(len(q)) - start < k
        return pd.DataFrame({"query_id": q_ids[q[top]], "vec_id": vec[top], "score": s[top]})

    held = placed.mapInPandas(chunk_rows, "id long, v binary, leaf int, cell int, chunk int")
    # queries are small but their walks are not, so they are dealt out evenly instead of by bytes
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = usable(queries).filter(F.size("v") == dim).repartition(parts, "id").groupBy("id").agg(F.min("v").alias("v")).mapInPandas(
        ask, "id long, v binary, leaves binary, cell int, chunk int")
    some = asked.groupBy("cell", "chunk").cogroup(held.groupBy("cell", "chunk")).applyInPandas(
        best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score").to(T.StructType.fromDDL(schema)))

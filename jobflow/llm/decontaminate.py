"""Operator 9: benchmark decontamination by q-gram lemma filtering.

An occurrence of an item of m characters within k edits shares at least m - q + 1 - k q of the
item's q-grams with the text, all on diagonals at most 2k apart.  Every text is scanned once: rolling
q-gram names are looked up among the items' q-grams, hits are counted in overlapping
diagonal bands, bands that reach the bound are kept, and each kept region is verified by a
banded alignment.

Equal items are one item, under their smallest id.  Items are dealt into groups of about ``GROUP_BYTES`` by the hash of their text;
the driver and the tasks hold one group at a time, since a group's results are stored before the next is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobflow.llm.common import WindowNames, materialize, slices, table_of, utf8_view

Q = 10
RATE = 0.08
GROUP_BYTES = 4 << 20
FILTER_BITS = 22
HITS_AT_ONCE = 1 << 20

_byte = np.arange(256)
_lower = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
_word = (_byte >= 128) | ((_byte >= 48) & (_byte <= 57)) | ((_lower >= 97) & (_lower <= 122))


def normalize(data: np.ndarray, off: np.ndarray):
    """Lower-cased bytes with every run of other ASCII characters as one blank; offsets; byte positions."""
    gap = ~_word[data]
    first = np.zeros(len(data), bool)
    first[off[:-1][off[:-1] < len(data)]] = True
    keep = ~gap
    keep[1:] |= gap[1:] & (~gap[:-1])
    keep &= ~(first & gap)
    at = np.flatnonzero(keep)
    return np.where(gap, 32, _lower[data]).astype(np.uint8)[at], np.searchsorted(at, off), at


def budget(m: int, q: int = Q, rate: float = RATE) -> int:
    """Edits allowed in an item of m bytes: ``rate`` of it, as far as the lemma still asks for a shared q-gram; -1 if too short."""
    return min(int(m * rate), (m - q) // q) if m >= q else -1


class Items:
    """Normalised items, their budgets, bounds and sorted q-grams."""

    def __init__(self, rows: list[tuple[int, str]], q: int = Q, rate: float = RATE):
        self.q = q
        self.ids, self.texts, self.k = [], [], []
        for item, text in rows:
            raw = np.frombuffer(text.encode(), np.uint8)
            norm = normalize(raw, np.array([0, len(raw)]))[0].tobytes().strip()
            k = budget(len(norm), q, rate)
            if k >= 0:
                self.ids.append(item)
                self.texts.append(norm)
                self.k.append(k)
        m = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.m, self.k = m, np.array(self.k, np.int64)
        self.bound = m - q + 1 - self.k * q
        data = np.frombuffer(b"".join(self.texts), np.uint8)
        start = np.cumsum(m) - m
        which = np.repeat(np.arange(len(m)), np.maximum(m - q + 1, 0))
        place = np.arange(len(which)) - np.repeat(np.cumsum(m - q + 1) - (m - q + 1), m - q + 1)
        names = WindowNames(data).at(start[which] + place, q) if len(which) else np.zeros(0, np.uint64)
        order = np.argsort(names, kind="stable")
        self.names, self.which, self.place = names[order], which[order], place[order]
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[(self.names >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True


def aligned(item: bytes, region: bytes, k: int, low: int, high: int) -> tuple[int, int, int] | None:
    """Best (edits, first, end) of ``item`` within ``region``, at most k edits, on diagonals low to high; fewest edits, then leftmost end."""
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    n, far = len(region), k + 1
    width = high - low + 2 * k + 1
    base = low - k
    text = np.full(width + len(item) + 2, 256, np.int16)
    raw = np.frombuffer(region, np.uint8)
    # text[j - base] for j in base .. base + len(item) + width
    lo, hi = max(0, base), min(n, base + len(text))
    if hi > lo:
        text[lo - base: hi - base] = raw[lo:hi]
    d = base + np.arange(width)  # column j of row i is i + d
    cost = np.where((d >= 0) & (d <= n), 0, far)
    begin = d.copy()
    step = np.arange(width)
    edge = np.full(1, far + 1)
    for i, c in enumerate(item):
        diag = cost + (text[i: i + width] != c)
        up = np.concatenate([cost[1:] + 1, edge])
        take_up = up < diag
        new = np.minimum(diag, up)
        src = np.where(take_up, np.concatenate([begin[1:], begin[-1:]]), begin)
        if d[0] + i + 1 < 0 or d[-1] + i + 1 > n:  # cells beside the region
            inside = (d + i + 1 >= 0) & (d + i + 1 <= n)
            new = np.where(inside, np.minimum(new, far), far)
        # insertions run along the row: cost at x from cost at y < x plus x - y
        best = np.minimum.accumulate((new - step) * width + step) % width  # smallest first, ties to the left
        cost = np.minimum(new[best] + step - best, far)
        begin = src[best]
        if i % 8 == 7 and cost.min() > k:
            return None
    x = int(cost.argmin())
    if cost[x] > k:
        return None
    return int(cost[x]), int(begin[x]), int(d[x] + len(item))


def matches(items: Items, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
    """(text, item id, first byte, end byte, edits) of every verified region, the best of overlapping ones."""
    if not len(items.names):
        return []
    q = items.q
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    norm, off, back = normalize(raw, np.concatenate([[0], np.cumsum(size)]))
    if len(norm) < q:
        return []
    names = WindowNames(norm).at(np.arange(len(norm) - q + 1), q)
    hit = np.flatnonzero(items.seen[(names >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    lo = np.searchsorted(items.names, names[hit])
    hi = np.searchsorted(items.names, names[hit], side="right")
    hit, lo, hi = hit[hi > lo], lo[hi > lo], hi[hi > lo]
    row = np.searchsorted(off, hit, side="right") - 1
    inside = hit + q <= off[row + 1]
    hit, lo, hi, row = hit[inside], lo[inside], hi[inside], row[inside]
    keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(hi - lo)
    low = int(items.m.max()) + 1  # bands from before a text's start on count from here
    wide = int(size.max()) + 2 * low
    at = 0
    while at < len(hit):  # hits expand to their items' positions a bounded number at a time
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HITS_AT_ONCE)))
        n = hi[at:to] - lo[at:to]
        each = np.repeat(np.arange(at, to), n)
        gram = np.repeat(lo[at:to], n) + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        item = items.which[gram]
        # band b of width 2w holds diagonals [b w, b w + 2 w) with w = 2 k + 1: any 2k + 1 neighbours share one
        band = (hit[each] - off[row[each]] - items.place[gram]) // (2 * items.k[item] + 1)
        key = (row[each] * len(items.ids) + item) * wide + band + low
        found, n = np.unique(key, return_counts=True)
        keys, of = np.unique(np.concatenate([keys, found]), return_inverse=True)
        times = np.bincount(of, np.concatenate([times, n]), len(keys)).astype(np.int64)
        at = to
    # a band also counts the hits of the next one
    both, of = np.unique(np.concatenate([keys, keys - 1]), return_inverse=True)
    times = np.bincount(of, np.concatenate([times, times]), len(both)).astype(np.int64)
    enough = times >= items.bound[both // wide % len(items.ids)]
    best: dict[tuple[int, int], list] = {}
    for key in both[enough].tolist():
        r, i, b = key // wide // len(items.ids), key // wide % len(items.ids), key % wide - low
        k, m, w = int(items.k[i]), int(items.m[i]), 2 * int(items.k[i]) + 1
        first = max(0, b * w - k)
        body = norm[off[r]: off[r + 1]][first: b * w + 2 * w + m + k].tobytes()
        got = aligned(items.texts[i], body, k, b * w - first, (b + 2) * w - 1 - first)
        if got:
            e, s, t = got
            known = best.setdefault((r, i), [])
            if known and known[-1][1] < first + t and known[-1][2] > first + s:  # the same region from two bands
                known[-1] = min(known[-1], (e, first + s, first + t))
            else:
                known.append((e, first + s, first + t))
    out = []
    for (r, i), found in best.items():
        for e, s, t in found:
            if t > s:
                start = size[:r].sum()
                out.append((r, items.ids[i], int(back[off[r] + s] - start), int(back[off[r] + t - 1] + 1 - start), e))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", q: int = Q, rate: float = RATE) -> DataFrame:
    """``key``, item_id, first, end (byte offsets), edits: every region of a text that holds a benchmark item.

    Compared are texts with ASCII letters lowered and runs of other ASCII characters as one blank.
    An item may differ by ``rate`` of its length in edits, or by as many as still leave
    a shared q-gram by the lemma.  Null or empty texts hold nothing; items under ``q`` normalised
    bytes say too little to prove a leak and are left out.  A repeated row reports each time.
    """
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    schema = rows.select(F.col("__key").alias(key)).schema.add("item_id", "long").add(
        "first", "long").add("end", "long").add("edits", "integer")

    def scan(batches, shared):
        items = Items(shared.value, q, rate)
        for b, got in _scanned(batches, items, "__text"):
            if got:
                r, i, s, e, d = zip(*got, strict=True)
                yield table_of(**{key: b.column("__key").take(pa.array(r, pa.int64())),
                                  "item_id": pa.array(i, pa.int64()), "first": pa.array(s, pa.int64()),
                                  "end": pa.array(e, pa.int64()), "edits": pa.array(d, pa.int32())})

    found = None
    for shared, last in _groups(benchmark, item, item_text):
        one = rows.mapInArrow(lambda batches, shared=shared: scan(batches, shared), schema)
        if not (found is None and last):  # more than one group: each is done before the next is read
            one = materialize(one, "leaks")
            shared.destroy()
        found = one if found is None else found.unionByName(one)
    return found


def _groups(benchmark: DataFrame, item: str, item_text: str):
    """(broadcast of a group's (item id, text), whether it is the last) for every group of distinct item texts."""
    spark = benchmark.sparkSession
    bench = benchmark.select(F.col(item).cast("long").alias("item"), F.col(item_text).cast("string").alias("item_text")).dropna(
        subset=["item_text"]).groupBy("item_text").agg(F.min("item").alias("item"))
    size = bench.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0))).first()[0]
    groups = max(1, -(-size // GROUP_BYTES))
    if groups > 1:
        bench = materialize(bench, "items")
    for g in range(groups):
        part = bench.filter(F.pmod(F.xxhash64("item_text"), F.lit(groups)) == g).collect()
        yield spark.sparkContext.broadcast([(r.item, r.item_text) for r in part]), g == groups - 1


def _scanned(batches, items: Items, column: str):
    """Slices of the batches with the matches of their texts."""
    for b in slices(batches, column, 2 << 20):
        data, off = utf8_view(b.column(column))
        raw = data.tobytes()
        yield b, matches(items, [raw[i:j] for i, j in zip(off[:-1], off[1:], strict=True)])


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
          q: int = Q, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark item is found (``contaminated``), with all their columns.

    Each row is judged by its own text, whatever its id: rows that share an id or have none are told apart.  The
    texts are read once for every group of items; nothing is shuffled.
    """
    def keep(batches, shared):
        items = Items(shared.value, q, rate)
        for b, got in _scanned(batches, items, text):
            stay = np.ones(b.num_rows, bool)
            stay[[r for r, *_ in got]] = False
            yield b.filter(pa.array(stay))

    for shared, last in _groups(benchmark, item, item_text):
        docs = docs.mapInArrow(lambda batches, shared=shared: keep(batches, shared), docs.schema)
        if not last:
            docs = materialize(docs, "clean")
            shared.destroy()
    return docs



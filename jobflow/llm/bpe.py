"""Operator 2: byte-level BPE by padded numpy matrices.

A text is split by the tokenizer's pattern.  Distinct pieces of a batch that the
worker has not met yet are grouped by length into padded matrices; each round
merges every row's leftmost minimum-rank pair, found by a hashed lookup of token
pairs, and compacts the row.  Pieces beyond ``LONG`` bytes would pad and scan quadratically, so
they take the same merges from a heap over a linked list.  Decoding gathers token bytes by offset.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobflow.llm.common import table_of

LONG = 256
CACHE_PIECES = 400_000
NONE = np.int32(2**31 - 1)


class ByteBpe:
    """Ranks of one vocabulary file (lines of base64 token and rank) with encode and decode."""

    def __init__(self, ranks_path: str, pattern: str):
        self.split = regex.compile(pattern).findall
        self.ranks = {}
        with open(ranks_path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        top = max(self.ranks.values()) + 1
        self.top = top
        tokens = [b""] * top
        for t, r in self.ranks.items():
            tokens[r] = t
        self.bytes = Pieces(tokens)
        self.digits = Pieces([b"%d," % r for r in range(top)])
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self._pairs()
        self.cache: dict[str, int] = {}
        self.pieces = Pieces([])

    def _pairs(self) -> None:
        """Open-addressed table (left, right) -> merged id for every split of every token into two tokens."""
        keys, values = [], []
        for t, r in self.ranks.items():
            for cut in range(1, len(t)):
                a, b = self.ranks.get(t[:cut]), self.ranks.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.top + b)
                    values.append(r)
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        bits = max(4, int(np.ceil(np.log2(len(keys) * 3 + 1))))
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.slots = np.full(size, -1, np.int64)
        self.merged = np.full(size, NONE, np.int32)
        left = np.arange(len(keys))
        at = self._slot(keys)
        self.probes = 0
        while len(left):
            free = self.slots[at[left]] < 0
            own = left[free]
            self.slots[at[own]] = keys[own]  # of several the last stays
            won = own[self.slots[at[own]] == keys[own]]
            self.merged[at[won]] = values[won]
            left = left[self.slots[at[left]] != keys[left]]
            at[left] = (at[left] + 1) % size
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, NONE where the vocabulary has no such token."""
        keys = left.astype(np.int64) * self.top + right
        at = self._slot(keys)
        out = np.full(keys.shape, NONE, np.int32)
        open_ = np.ones(keys.shape, bool)
        for _ in range(self.probes):
            found = open_ & (self.slots[at] == keys)
            out[found] = self.merged[at[found]]
            open_ &= ~found & (self.slots[at] >= 0)
            if not open_.any():
                break
            at = np.where(open_, (at + 1) % len(self.slots), at)
        return out

    def merge_rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge equal-length rows of ids to the end; returns the padded ids and each row's length."""
        n, width = rows.shape
        ids, length = rows.copy(), np.full(n, width)
        live = np.arange(n)
        work = ids.copy()
        pair = self.rank_of(work[:, :-1], work[:, 1:]) if width > 1 else np.full((n, 0), NONE, np.int32)
        while pair.shape[1] and len(live):
            best = pair.argmin(1)
            each = np.arange(len(live))
            rank = pair[each, best]
            go = rank != NONE
            if not go.all():
                done = live[~go]
                ids[done, : work.shape[1]] = work[~go]
                live, work, pair, best, rank = live[go], work[go], pair[go], best[go], rank[go]
                each = np.arange(len(live))
            if not len(live):
                break
            # compaction: column j takes j, or j + 1 right of the merged pair
            cols = np.arange(work.shape[1] - 1)
            take = cols[None, :] + (cols[None, :] > best[:, None])
            work = np.take_along_axis(work, take, 1)
            work[each, best] = rank
            length[live] -= 1
            pair = np.take_along_axis(pair, np.minimum(take[:, :-1], pair.shape[1] - 1), 1) \
                if work.shape[1] > 1 else np.full((len(live), 0), NONE, np.int32)
            if pair.shape[1]:
                right = best < work.shape[1] - 1
                r = each[right]
                pair[r, best[right]] = self.rank_of(work[r, best[right]], work[r, best[right] + 1])
                left = best > 0
                r = each[left]
                pair[r, best[left] - 1] = self.rank_of(work[r, best[left] - 1], work[r, best[left]])
        if len(live):
            ids[live, : work.shape[1]] = work
        return ids, length

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges (smallest rank, then leftmost) from a heap over linked tokens."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, token = list(range(1, n + 1)), list(range(-1, n - 1)), [bytes([b]) for b in piece]
        alive = [True] * n
        get = self.ranks.get
        heap = [(r, i, 2) for i in range(n - 1) if (r := get(token[i] + token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, size = heapq.heappop(heap)
            if not alive[i] or (j := after[i]) >= n or len(token[i]) + len(token[j]) != size \
                    or get(token[i] + token[j]) != r:
                continue
            token[i], ids[i], alive[j] = token[i] + token[j], r, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and (b := after[a]) < n and (r := get(token[a] + token[b])) is not None:
                    heapq.heappush(heap, (r, a, len(token[a]) + len(token[b])))
        return np.array([t for t, a in zip(ids, alive, strict=True) if a], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, by length-bucketed matrices."""
        out: list = [None] * len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for n in np.unique(size):
            which = np.flatnonzero(size == n)
            if n > LONG:
                for k in which:
                    out[k] = self.merge_long(pieces[k])
                continue
            step = max(1, (1 << 20) // int(n))
            for at in range(0, len(which), step):
                part = which[at:at + step]
                rows = self.single[np.frombuffer(b"".join([pieces[k] for k in part]), np.uint8)].reshape(-1, n)
                ids, length = self.merge_rows(rows)
                for k, row, m in zip(part, ids, length, strict=True):
                    out[k] = row[:m]
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the n+1 offsets of the texts in them."""
        words = [self.split(t) for t in texts]
        if len(self.cache) > CACHE_PIECES:
            self.cache, self.pieces = {}, Pieces([])
        cache = self.cache
        new = {w for ws in words for w in ws if w not in cache}
        if new:
            fresh = list(new)
            base = len(cache)
            self.pieces.extend(self.encode_pieces([w.encode("utf-8", "surrogatepass") for w in fresh]))
            cache.update(zip(fresh, range(base, base + len(fresh)), strict=True))
        counts = np.fromiter(map(len, words), np.int64, len(words))
        index = np.fromiter((cache[w] for ws in words for w in ws), np.int64, int(counts.sum()))
        ids = self.pieces.gather(index)
        per_word = np.zeros(len(index) + 1, np.int64)
        np.cumsum(self.pieces.size[index], out=per_word[1:])
        return ids, per_word[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes.gather(ids.astype(np.int64)).tobytes()

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return self.digits.gather(ids.astype(np.int64))[:-1].tobytes()


class Pieces:
    """Byte strings or id arrays laid end to end, gathered by index."""

    def __init__(self, items: list):
        raw = bool(items) and isinstance(items[0], bytes)
        self.flat = np.zeros(0, np.uint8 if raw else np.int32)
        self.size = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        if items:
            self.extend([np.frombuffer(x, np.uint8) for x in items] if raw else items)

    def extend(self, items: list[np.ndarray]) -> None:
        size = np.fromiter(map(len, items), np.int64, len(items))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, *items])

    def gather(self, index: np.ndarray) -> np.ndarray:
        size = self.size[index]
        ends = np.cumsum(size)
        if not len(ends):
            return self.flat[:0]
        return self.flat[np.repeat(self.start[index] - ends + size, size) + np.arange(ends[-1])]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
                     keep: tuple[str, ...] = ("doc_id",), digests: bool = False) -> DataFrame:
    """``keep`` columns and, for every row, its token ids and the decoded bytes.

    A null or empty text has no ids and decodes to no bytes.  With ``digests`` the
    columns are n_tokens, ids_sha256 and decoded_sha256 instead of ``ids`` (array)
    and ``decoded`` (binary).  ``ranks_path`` is a small vocabulary file
    present on every machine; each worker reads it once.
    """
    import hashlib

    rows = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    schema = rows.drop("__text").schema
    schema = (schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string") if digests
              else schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "binary"))

    def run(batches):
        bpe = ByteBpe(ranks_path, pattern)
        for b in batches:
            texts = b.column("__text").to_pylist()
            first, parts = 0, []
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and size < 1 << 20:
                    size += len(texts[last])
                    last += 1
                ids, off = bpe.encode(texts[first:last])
                each = [ids[i:j] for i, j in zip(off, off[1:], strict=False)]
                if digests:
                    parts += [(len(x), hashlib.sha256(bpe.decimal(x)).hexdigest(),
                               hashlib.sha256(bpe.decode(x)).hexdigest()) for x in each]
                else:
                    parts += [(x, bpe.decode(x)) for x in each]
                first = last
            rest = b.drop_columns(["__text"])
            cols = [pa.array(list(c), t) for c, t in zip(
                zip(*parts, strict=True), (pa.int64(), pa.string(), pa.string()) if digests
                else (pa.list_(pa.int32()), pa.binary()), strict=True)] if parts else []
            if parts:
                yield table_of(**dict(zip(schema.names, [*rest.columns, *cols], strict=True)))

    return rows.mapInArrow(run, schema)

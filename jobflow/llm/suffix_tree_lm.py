"""Operator 8: language-model scores from a probabilistic suffix tree over words.

A context is kept if it is frequent enough, its own suffix is kept, and a divergence test says that its next-word
counts tell more than its suffix does: the log-likelihood gain of its leave-one-out distribution is above
``least_gain``.  Contexts grow word by word until the test keeps none of a length.  A next word has probability (N(s, x) + lam P(x | suffix of s)) / (N(s) + lam) in state s, the longest kept
suffix of what stands before it; the root has add-one counts.

The tree never is in one place.  Texts become token units (a few MB of text).  For each context length a unit
sends its distinct (context, next word) pairs with counts to buckets by context; a bucket sums them over all
units, tests its contexts and answers every unit with exactly the sums it asked for.
The units are stored bucketed, so that only the answers are shuffled to them.  The buckets of up to ``STORED`` words are asked in ``PASSES``
rounds, one after the other, so that only a part of all pairs is on disk at a time.  There words travel as their numbers among all
distinct words, and a next word's probability only where the gain can depend on it.  From ``STORED`` words on a unit keeps a state: the tokens
that are asked about next, and per text the score of the others; it is written together with what the unit asks next, and what
it has replaced is removed.  Once few texts of a unit are left to ask about, its state holds their tokens too, and when all units' states do,
the units are not read any more.  Contexts with more than 1/4096 of all tokens are split by next word; there can be at most 4096 of them,
so their partial gains are summed on the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobflow.llm.common import BUCKET_BYTES, WindowNames, bucket_bits, even_keys, fold, mix, stored, table_of, utf8_view
from jobflow.session import remove, scratch_path

UNIT_BYTES = 4 << 20
LEADS = 64  # words that a later piece of a text beyond a unit sees before its own; a kept context of that length is an error there
HOT_SHARE = 4096
PASSES = 2
STORED = 2
HOT_LEAST = 50_000
END = np.uint64(0x5DEECE66D)
K = np.uint64(0x9E3779B97F4A7C15)
BLOCK = "unit long, rows binary, ids binary, held binary, sizes binary, leads binary, ends binary, words binary, low binary, high binary"
ANSWER = "unit long, level int, bucket int, sums binary, kept binary"
PART = "sizes binary, leads binary, words binary, low binary, high binary"  # of a state: the unit's texts that are left, if they are few
STATES = f"{ANSWER}, places binary, p binary, done binary, rows binary, ids binary, held binary, {PART}"
STATE = -1  # a unit's state travels like an answer of level -1
FEW = 4  # a state holds the tokens that are left if they are less than one in so many
FEWER_BITS = 2  # of the bucket numbers beyond STORED words, as fewer pairs are asked about
NAME_BYTES = 6  # of a next word's name beyond STORED words: 48 bits tell the next words of one context apart
PAIRS = "contexts binary, lives binary, fan binary, n binary, next binary, counts binary, told binary, parent binary"
ASKED, ASK = f"unit long, bucket int, deal int, {PAIRS}", -2  # level of the rows that ask, where they stand among states
_b = np.arange(256)
_space = (_b == 32) | ((_b >= 9) & (_b <= 13))
_lower = np.where((_b >= 65) & (_b <= 90), _b + 32, _b).astype(np.uint8)


def packed(x: np.ndarray) -> bytes:
    """Counts as one byte each; those of 255 and more follow in two bytes, and of them those of 65535 and more in eight."""
    big = x[x >= 255]
    huge = big[big >= 65535]
    return b"".join([np.int64([len(big), len(huge)]).tobytes(), huge.astype(np.int64).tobytes(), np.minimum(big, 65535).astype(np.uint16).tobytes(),
                     np.minimum(x, 255).astype(np.uint8).tobytes()])


def unpacked(blobs) -> np.ndarray:
    """The counts of several ``packed`` blobs, one after the other."""
    out = [np.zeros(0, np.int64)]
    for b in blobs:
        n, m = np.frombuffer(b, np.int64, 2).tolist()
        big = np.frombuffer(b, np.uint16, n, 16 + 8 * m).astype(np.int64)
        big[big == 65535] = np.frombuffer(b, np.int64, m, 16)
        x = np.frombuffer(b, np.uint8, offset=16 + 8 * m + 2 * n).astype(np.int64)
        x[x == 255] = big
        out.append(x)
    return np.concatenate(out)


def spaced(x: np.ndarray) -> bytes:
    """Ascending values as their distances, all first bytes before all second ones: the high bytes are mostly zero and compress to nothing."""
    return np.diff(x, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unspaced(data: bytes) -> np.ndarray:
    """The values of ``spaced`` bytes."""
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def trimmed(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` lowest bytes of each value, a row each."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k])


def untrimmed(data: bytes, k: int) -> np.ndarray:
    """The values of ``trimmed`` bytes."""
    out = np.zeros((len(data) // k, 8), np.uint8)
    out[:, :k] = np.frombuffer(data, np.uint8).reshape(-1, k)
    return out.view("<u8").ravel()


def bits_of(blobs, sizes) -> np.ndarray:
    """The flags of several ``np.packbits`` blobs of these numbers of flags, one after the other."""
    return np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
                                                for b, n in zip(blobs, sizes, strict=True))])


def ordered(x: np.ndarray) -> np.ndarray:
    """An order in which ``x`` ascends, by sorting its leading bits with the places in the last ones: several times faster than argsort."""
    low = len(x).bit_length()
    key = (x >> np.uint64(low) << np.uint64(low)) | np.arange(len(x), dtype=np.uint64)
    key.sort()
    order = (key & np.uint64((1 << low) - 1)).astype(np.int64)
    got = x[order]
    return np.argsort(x) if (got[1:] < got[:-1]).any() else order  # different values may share their leading bits


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct values, the number of each entry's value, the order of the entries and where a value begins in it."""
    order = ordered(x)
    got = x[order]
    new = np.ones(len(x), bool)
    new[1:] = got[1:] != got[:-1]
    of = np.empty(len(x), np.int64)
    of[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return got[first], of, order, first


def word_names(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words (runs without ASCII white space, ASCII letters lowered) and the words per row."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off) - 1, np.int64)
    data = _lower[data]
    inside = ~_space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = np.flatnonzero(inside & ~(np.append(False, inside[:-1]) & ~edge[:-1]))
    end = np.flatnonzero(inside & ~(np.append(inside[1:], False) & ~edge[1:])) + 1
    w = WindowNames(data)
    names = mix((w.sums[end] - w.sums[first]) * w.inverses[first] + (end - first).astype(np.uint64) * K)
    return names, np.diff(np.searchsorted(first, off))


def _pieces(data: bytes, most: int):
    """Cuts of a text at white space, each of about ``most`` bytes."""
    at = 0
    while len(data) - at > most:
        to = at + most
        while to < len(data) and not _space[data[to]]:
            to += 1
        if to >= len(data):
            break
        yield data[at:to]
        at = to
    yield data[at:]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _bucketed(df: DataFrame, name: str, by: str, n: int) -> DataFrame:
    """``df`` stored in ``n`` buckets of ``by``: what is joined to it on ``by`` is shuffled, not the frame itself."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    entry = f"{name}_{path.rsplit('-', 1)[1]}"
    df.write.bucketBy(n, by).option("compression", "zstd").option("path", path).saveAsTable(entry)  # a file for each task and bucket
    got = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")  # only its name: the files stand where the frame reads them
    return got


def _blocks(docs: DataFrame, key: str, text: str, held: str, unit_bytes: int, buckets: int) -> DataFrame:
    """Token units: rows, their words as numbers into the unit's distinct words, and the words that lead a later piece."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"),
                       F.col(held).alias("held"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def pack(batches):
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def flush():
            nonlocal number
            raw = [p for *_, p in held]
            off = np.concatenate([[0], np.cumsum([len(p) for p in raw])])
            names, sizes = word_names(np.frombuffer(b"".join(raw), np.uint8), off)
            lead = np.array([len(x) for *_, x, _, _ in held], np.int64)
            end = np.array([e for *_, e, _ in held], bool)
            out, at = [], 0
            for k, (*_, x, e, _) in enumerate(held):  # lead words, own words, end of text
                out += [x, names[at: at + sizes[k]], np.array([END] if e else [], np.uint64)]
                at += sizes[k]
            words, index, *_ = distinct(np.concatenate(out))
            index = index.astype(np.uint32)
            one = {"rows": np.array([h[0] for h in held], np.int64), "held": np.array([h[2] for h in held], bool),
                   "sizes": sizes + lead + end, "leads": lead, "ends": end, "words": words,
                   "low": (index & np.uint32(0xFFFF)).astype(np.uint16), "high": (index >> np.uint32(16)).astype(np.uint16)}
            cells = {c: pa.array([spaced(one[c]) if c == "words" else one[c].tobytes()], pa.binary()) for c in one}
            ids = ",".join("" if h[1] is None else str(h[1]) for h in held).encode()
            cells |= {"unit": pa.array([number], pa.int64()), "ids": pa.array([ids], pa.binary())}
            number += 1
            return table_of(**{c: cells[c] for c in _names(BLOCK)})

        for b in batches:
            data, off = utf8_view(b.column("text"))
            for k, (row, i, h) in enumerate(zip(*(b.column(c).to_pylist() for c in ("row", "id", "held")), strict=True)):
                whole, lead = data[off[k]: off[k + 1]].tobytes(), np.zeros(0, np.uint64)
                parts = list(_pieces(whole, unit_bytes))
                for j, part in enumerate(parts):
                    held.append((row, i, h, lead, j == len(parts) - 1, part))
                    size += len(part)
                    if j < len(parts) - 1:
                        tail = word_names(np.frombuffer(part, np.uint8), np.array([0, len(part)]))[0]
                        lead = np.concatenate([lead, tail])[-LEADS:]
                    if size >= unit_bytes:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return _bucketed(rows.mapInArrow(pack, BLOCK), "tokens", "unit", buckets)


class Unit:
    """The tokens of one unit and, level by level, what the buckets answered about them."""

    def __init__(self, block, bits: int, totals: tuple[int, int] | None, least: int, lam: float, hot: int):
        self.names = {c: bytes(block[c]) for c in ("rows", "ids", "held")}  # of all texts, those without tokens here included
        self.held = np.frombuffer(block["held"], bool)
        size = np.frombuffer(block["sizes"], np.int64)
        self.words = unspaced(block["words"])
        self.index = (np.frombuffer(block["low"], np.uint16).astype(np.int64)
                      + (np.frombuffer(block["high"], np.uint16).astype(np.int64) << 16))
        self.piece = np.repeat(np.arange(len(size)), size)
        self.place = np.arange(len(self.index)) - np.repeat(np.cumsum(size) - size, size)
        self.leads = np.frombuffer(block["leads"], np.int64)
        self.own = self.place >= self.leads[self.piece]
        self.train = self.own & ~self.held[self.piece]
        self.all_bits, self.totals, self.least, self.lam, self.hot = bits, totals, least, lam, hot
        self.level = 0
        self.numbers = self.at = self.done = None
        self.partial = False

    @property
    def bits(self) -> int:
        """log2 of the number of buckets that the next level asks."""
        return self.all_bits if self.level < STORED else self.all_bits - FEWER_BITS

    def _cut(self, spread: np.ndarray):
        """Where the ascending ``spread`` changes bucket: (bucket numbers, bounds)."""
        cut = np.searchsorted(spread >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        got = np.flatnonzero(np.diff(cut))
        return got, np.append(cut[got], len(spread))

    def ask_words(self):
        """Level 0: (bucket, words, counts) of the unit's distinct words, which are in ascending order."""
        count = np.bincount(self.index[self.train], minlength=len(self.words))
        got, cut = self._cut(self.words)
        return [(int(g), self.words[a:b], count[a:b]) for g, a, b in zip(got, cut, cut[1:], strict=False)]

    def take_words(self, sums: np.ndarray, numbers: np.ndarray) -> None:
        n, v, _ = self.totals
        self.count = sums  # of each distinct word, over all training tokens
        self.numbers = numbers  # and its number among all distinct words
        self.base = (sums + 1) / (n + v + 1)
        self.p = self.base[self.index]
        self.times = sums[self.index]  # how often the last `level` words and this one occur; here this word alone
        self.context = np.zeros(len(self.index), np.uint64)
        self.alive = self.known = np.ones(len(self.index), bool)

    def wanted(self) -> np.ndarray:
        """Tokens whose suffix is kept, and those before one: the next level needs the sums there (lead words too)."""
        return self.alive | np.append(self.alive[1:] & (self.place[1:] > 0), False)

    def asked(self) -> np.ndarray:
        """Tokens that the next level asks about: the wanted ones whose context is frequent enough."""
        if self.at is not None:
            return self.at
        # where not counted, as no context of that length mattered: what a longer one can have at most is known here
        often = self.times >= self.least
        most = np.where(self.known[:-1], often[:-1], often[1:])
        # before a token whose suffix is kept, the sum is asked as the count of that token's next context
        return np.flatnonzero((self.place[1:] > self.level) & self.wanted()[1:] & most & (self.alive[1:] | often[1:])) + 1

    def _longer(self, context: np.ndarray, at: np.ndarray, d: int) -> np.ndarray:
        """The names of the contexts of ``d`` words, from those of one word less."""
        return mix(context * K + self.words[self.index[at - d]] + np.uint64(d))

    def _hashed(self, at: np.ndarray, d: int) -> np.ndarray:
        context = np.zeros(len(at), np.uint64)
        for k in range(1, d + 1):
            context = self._longer(context, at, k)
        return context

    def next_names(self) -> tuple[np.ndarray, int]:
        """The names of the unit's words as next words of the next level, and their bytes."""
        if self.level < STORED:
            return self.numbers, name_bytes(self.totals[2])
        return self.words & np.uint64((1 << 8 * NAME_BYTES) - 1), NAME_BYTES

    def layout(self, turn: int = 0, passes: int = 1):
        """The tokens that the next level asks about in this turn, ordered by bucket, context and pair, and where a distinct
        (context, next word) pair begins: (tokens, whether a pair begins, and per pair context, N of it, and what deals it out), and all tokens' contexts."""
        d = self.level + 1
        at = self.asked()
        n = self.times[at - 1]  # occurrences of the context that ends just before
        if self.level < STORED and context_bytes(d, self.totals[2]) < 8:
            far = np.uint64(8 * (d - 1) * name_bytes(self.totals[2]))
            context = self.context[at] | self.numbers[self.index[at - d]] << far
        else:
            context = self._hashed(at, d) if d <= STORED + 1 else self._longer(self.context[at], at, d)
        pair = mix(context * K + self.next_names()[0][self.index[at]])
        hot = self.hot
        spread = mix(context)
        split = np.flatnonzero(n > hot)
        part = pair[split] % (1 + n[split] // hot).astype(np.uint64) + np.uint64(1)
        spread[split] = mix(context[split] + part * K)
        # one sort by the leading bits of both, the places in the last ones (sorting values is several times faster than argsort);
        # contexts and pairs that share theirs may alternate, which their bucket puts right
        low = len(at).bit_length()
        top = np.uint64(64 - max(self.bits, (64 - low) // 2))
        key = (spread >> top << top) | (pair >> (np.uint64(64) - top) >> np.uint64(low) << np.uint64(low))
        key |= np.arange(len(at), dtype=np.uint64)
        if passes > 1:
            key = key[(spread >> np.uint64(64 - self.bits)) & np.uint64(passes - 1) == turn]  # PASSES is a power of two
        key.sort()
        order = (key & np.uint64((1 << low) - 1)).astype(np.int64)
        ordered = pair[order]
        new = np.ones(len(order), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first = order[new]
        return at[order], new, context[first], n[first], spread[first], context

    def ask(self, turn: int, passes: int):
        """Rows of the buckets of this turn, as in ``PAIRS``: contexts, whether their suffix is kept, pairs per context, places and N of the
        split contexts, next words, counts, whether the parent's p is told, and it."""
        tokens, new, context, n, spread, _ = self.layout(turn, passes)
        begins = np.flatnonzero(new)
        one = tokens[begins]
        count = np.add.reduceat(self.train[tokens], begins, dtype=np.int64) if len(one) else begins
        told = (count > 0) & (self.times[one] > 1)  # a pair that occurs once gains the same whatever the p
        parent = self.p[one].astype(np.float32)  # coarser steps would look like a gain of frequent contexts
        wide = trimmed(context, context_bytes(self.level + 1, self.totals[2]))
        names, k = self.next_names()
        names = trimmed(names[self.index[one]], k)
        got, cut = self._cut(spread)
        for g, a, b in zip(got, cut, cut[1:], strict=False):
            c, s = context[a:b], spread[a:b]
            own = np.flatnonzero(np.append(True, (c[1:] != c[:-1]) | (s[1:] != s[:-1])))
            total = n[a:b][own]
            split = np.flatnonzero(total > self.hot)
            yield (int(g), wide[a:b][own].tobytes(), np.packbits(self.alive[one[a:b][own]]).tobytes(), packed(np.diff(np.append(own, b - a))),
                   np.concatenate([split, total[split]]).astype(np.int64).tobytes(), names[a:b].tobytes(), packed(count[a:b]),
                   np.packbits(told[a:b]).tobytes(), parent[a:b][told[a:b]].tobytes())

    def take(self, sums: np.ndarray, kept: np.ndarray, hot_kept: frozenset) -> None:
        """Step one level down with the answers, in the order of ``layout``; kept is 0, 1, or 2 for a split context."""
        tokens, new, c, _, s, context = self.layout()
        known = (self.place > self.level) & self.wanted()
        own = np.cumsum(np.append(True, (c[1:] != c[:-1]) | (s[1:] != s[:-1]))) - 1 if len(c) else np.zeros(0, int)
        keep = kept[own] == 1
        for k in np.flatnonzero(kept[own] == 2):
            keep[k] = int(c[k]) in hot_kept
        of = np.cumsum(new) - 1  # the pair of each token
        times = np.zeros(len(self.index), np.int64)
        times[tokens] = sums[of]
        deeper = np.zeros(len(self.index), np.uint64)
        deeper[self.asked()] = context
        alive = np.zeros(len(self.index), bool)
        alive[tokens] = keep[of]
        alive &= self.alive
        go = np.flatnonzero(alive)
        before = self.times[go - 1]
        self.p[go] = (times[go] + self.lam * self.p[go]) / (before + self.lam)
        self.times, self.context, self.alive, self.known, self.level, self.at = times, deeper, alive, known, self.level + 1, None

    def settle(self) -> None:
        """Fix the tokens that are asked about next, and the score of the others."""
        at = self.asked()
        alive = np.zeros(len(self.index), bool)
        alive[at] = self.alive[at]
        if self.done is None:
            tokens = np.bincount(self.piece[self.own], minlength=len(self.held))
            self.done = [tokens, *(np.bincount(self.piece[self.own], v[self.index[self.own]], len(self.held))
                                   for v in (self.count > 0, np.log10(self.base))), np.zeros(len(self.held)), None]
            self.open = np.ones(len(self.index), bool)
        self.done[3] = self.done[3] + self._logs(self.open & ~alive)
        self.done[4] = self.done[3] + self._logs(alive)  # if no longer context is kept
        self.alive = self.open = alive
        self.at = at[self.wanted()[at]]

    def _logs(self, some: np.ndarray) -> np.ndarray:
        """The score of these tokens in each piece."""
        at = np.flatnonzero(self.own & some)
        return np.bincount(self.piece[at], np.log10(self.p[at]), len(self.held))

    def state(self) -> dict:
        """What the longer contexts need, after ``settle``: see ``load``."""
        size = np.zeros(len(self.held), np.int64)
        size[self.piece[self.at]] = self.place[self.at] + 1  # up to the last token that is asked about
        part = dict.fromkeys(_names(PART))
        some = np.zeros(len(self.index), bool)
        some[self.at] = some[self.at - 1] = True  # with the token before each, for its times
        q = np.flatnonzero(some)
        places = q
        if self.partial or FEW * size.sum() < len(self.index):
            left = self.place < size[self.piece]
            used, index = np.unique(self.index[left], return_inverse=True)
            part = {"sizes": size, "leads": self.leads,
                    "low": (index & 0xFFFF).astype(np.uint16), "high": (index >> 16).astype(np.uint16)}
            part = {c: x.tobytes() for c, x in part.items()} | {"words": spaced(self.words[used])}
            places = np.cumsum(left)[q] - 1
        flags = np.zeros((2, len(self.index)), bool)
        flags[0], flags[1, self.at] = self.alive, True
        return {"bucket": self.level, "sums": packed(self.times[q]), "kept": np.packbits(flags[:, q]).tobytes(),
                "places": packed(np.diff(places, prepend=0)), "p": self.p[np.flatnonzero(self.alive)].tobytes(),
                "done": np.concatenate(self.done).astype(float).tobytes(), **self.names, **part}

    def load(self, state) -> None:
        n = len(self.index)
        at = np.cumsum(unpacked([state["places"]]))
        self.level, self.partial = int(state["bucket"]), state["words"] is not None
        self.times, self.alive, self.p = np.zeros(n, np.int64), np.zeros(n, bool), np.ones(n)
        self.context = np.zeros(n, np.uint64)
        self.times[at] = unpacked([state["sums"]])
        flags = np.unpackbits(np.frombuffer(state["kept"], np.uint8), count=2 * len(at)).astype(bool).reshape(2, -1)
        self.alive[at] = flags[0]
        self.at = at = at[flags[1]]
        self.p[np.flatnonzero(self.alive)] = np.frombuffer(state["p"], float)
        self.open = self.alive.copy()
        self.done = list(np.frombuffer(state["done"], float).reshape(5, -1))
        self.context[at] = self._hashed(at, self.level)  # all that are asked about have as many words before them


def name_bytes(n: int) -> int:
    """Bytes of a number below ``n``."""
    return max(1, (n.bit_length() + 7) // 8)


def context_bytes(d: int, n_words: int) -> int:
    """Bytes of a context's name: the numbers of its words, or 8 of a hash where these are not fewer."""
    return min(8, d * name_bytes(n_words)) if d <= STORED else 8


def score_rows(state) -> pd.DataFrame:
    """The scores of all texts of a unit, from its state."""
    tokens, known, base, _, score = np.frombuffer(state["done"], float).reshape(5, -1)
    ids = [int(x) if x else None for x in bytes(state["ids"]).decode().split(",")]
    return pd.DataFrame({
        "row": np.frombuffer(state["rows"], np.int64), "id": pd.array(ids, "Int64"), "held": np.frombuffer(state["held"], bool),
        "n_tokens": np.round(tokens).astype(np.int64), "n_known": np.round(known).astype(np.int64), "base_score": base, "score": score})


def _sum_words(pdf: pd.DataFrame) -> pd.DataFrame:
    n = np.array([len(x) // 8 for x in pdf.words])
    words, of, *_ = distinct(np.frombuffer(b"".join(pdf.words), np.uint64))
    sums = np.zeros(len(words), np.int64)
    np.add.at(sums, of, unpacked(pdf.counts))
    cut = np.cumsum(n)
    out = pd.DataFrame({"unit": pdf.unit, "level": 0, "bucket": pdf.bucket,
                        "sums": [packed(sums[of[b - k:b]]) for b, k in zip(cut, n, strict=True)],
                        "kept": [packed(np.diff(of[b - k:b], prepend=0)) for b, k in zip(cut, n, strict=True)]})  # places among the bucket's words
    return pd.concat([out, pd.DataFrame({"unit": [-1], "level": [0], "bucket": [pdf.bucket.iloc[0]], "sums": [
        np.array([sums.sum(), (sums > 0).sum(), len(words)], np.int64).tobytes()], "kept": [b""]})])


def _sum_pairs(level: int, lam: float, least_gain: float, wide: int, k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        def flat(c, kind):
            return np.frombuffer(b"".join(pdf[c]), kind)

        contexts, fan = untrimmed(b"".join(pdf.contexts), wide), unpacked(pdf.fan)
        last, ends = np.cumsum([len(x) // wide for x in pdf.contexts]), np.cumsum([len(x) // k for x in pdf.next])
        begin, first = np.append(0, last[:-1]), np.append(0, ends[:-1])
        live, told = bits_of(pdf.lives, last - begin), bits_of(pdf.told, ends - first)
        n = np.zeros(len(contexts), np.int64)  # of split contexts
        for x, at in zip(pdf.n, begin, strict=True):
            if len(x):
                place, total = np.frombuffer(x, np.int64).reshape(2, -1)
                n[at + place] = total
        of_entry = np.repeat(np.arange(len(contexts)), fan)
        counts, parent = unpacked(pdf.counts), np.zeros(len(of_entry), np.float32)
        parent[told] = flat("parent", np.float32)
        pairs = mix(contexts[of_entry] * K + untrimmed(b"".join(pdf.next), k))
        _, rank, order, begins = distinct(pairs)
        sums = np.add.reduceat(counts[order], begins)
        names, of_context, *_ = distinct(contexts)
        seen = sums > 0
        s = sums[seen]
        of_pair = of_context[of_entry[order[begins]]][seen]
        p = np.where(s > 1, np.maximum.reduceat(parent[order], begins)[seen], 1).astype(float)  # told by all that count it; any p if once
        total = np.bincount(of_pair, s, len(names))
        total[of_context[n > 0]] = n[n > 0]
        gain = np.bincount(of_pair, s * np.log((s - 1 + lam * p) / (total[of_pair] - 1 + lam) / p), len(names))
        split, kin = np.zeros(len(names), bool), np.zeros(len(names), bool)
        split[of_context] = live & (n > 0)  # the same in all entries of a context
        kin[of_context] = live
        verdict = np.where(split, 2, kin & (gain > least_gain)).astype(np.uint8)
        by_entry, by_context = sums[rank], verdict[of_context]
        out = pd.DataFrame({"unit": pdf.unit, "level": level, "bucket": pdf.bucket,
                            "sums": [packed(by_entry[a:b]) for a, b in zip(first, ends, strict=True)],
                            "kept": [by_context[a:b].tobytes() for a, b in zip(begin, last, strict=True)]})
        part = pd.DataFrame({"unit": -1, "level": level, "bucket": pdf.bucket.iloc[0],
                             "sums": [names[split].tobytes()], "kept": [gain[split].tobytes()]})
        some = pd.DataFrame({"unit": -2, "level": level, "bucket": pdf.bucket.iloc[0],
                             "sums": [np.int64([(verdict == 1).sum()]).tobytes()], "kept": [b""]})
        return pd.concat([out, part, some])
    return run


def suffix_tree_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", held: str = "held_out", depth: int | None = None,
                       least: int = 8, lam: float = 300.0, least_gain: float = 10.0,
                       unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """``key``, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Learned from the rows whose ``held`` is false.  A null text counts as empty: its only token is the end.
    Repeated rows count each time.  Without training rows every probability is one and the scores are 0.
    ``depth`` bounds the words of a context; by default the divergence test alone does.

    The prior mass ``lam`` was chosen on training rows alone: learned from the other folds of sf0.01, the texts of one training fold
    have -3.81, -3.76 and -3.72 log10 per token at 30, 100 and 300.  ``least`` and ``least_gain`` (ten nats, a chance of a gain by luck
    well under one in ten thousand) are levels of evidence, not fitted.
    """
    spark = docs.sparkSession
    length = F.octet_length(F.col(text).cast("string"))
    size, longest = docs.agg(F.coalesce(F.sum(length), F.lit(0)), F.coalesce(F.max(length), F.lit(0))).first()
    bits = bucket_bits(spark, 2 * size // PASSES, 7)  # a token's pair takes about 10 bytes, a token 5 and more
    keys = even_keys(spark, bits)
    few_keys = even_keys(spark, bits - FEWER_BITS)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(docs, key, text, held, unit_bytes, max(parts, size // BUCKET_BYTES + 1))
    hot_kept: list[frozenset] = []

    def ask_words(batches):
        for pdf in batches:
            for _, block in pdf.iterrows():
                got = Unit(block, bits, None, least, lam, 0).ask_words()
                yield pd.DataFrame({"unit": block["unit"], "bucket": [g for g, _, _ in got], "deal": keys[np.array([g for g, _, _ in got], int)],
                                    "words": [w.tobytes() for _, w, _ in got],
                                    "counts": [packed(c) for _, _, c in got]})

    answers, path = stored(blocks.mapInPandas(ask_words, "unit long, bucket int, deal int, words binary, counts binary")
                            .groupBy("deal").applyInPandas(_sum_words, ANSWER), "words")
    # three numbers per bucket, and there are 2**bits buckets
    found = {r.bucket: np.frombuffer(bytes(r.sums), np.int64) for r in answers.filter("unit = -1").collect()}
    n_words = np.zeros(len(keys) + 1, np.int64)
    n_words[[b + 1 for b in found]] = [x[2] for x in found.values()]
    before = np.cumsum(n_words)  # the number of a bucket's first word
    totals = (int(sum(x[0] for x in found.values())), int(sum(x[1] for x in found.values())), int(before[-1]))
    hot = max(HOT_LEAST, totals[0] // HOT_SHARE)
    every, old = [answers.filter("unit >= 0")], [path]  # the answers that rebuild a unit, and where they stand

    def rebuilt(block, got: pd.DataFrame, kept_hot: list[frozenset]) -> Unit:
        """The unit after the answers in ``got``, from its state if there is one; the state may hold what is left of the unit, too."""
        has = got[got.level == STATE]
        whole = not len(has) or has.words.iloc[0] is None
        unit = Unit(block.iloc[0] if whole else has.iloc[0], bits, totals, least, lam, hot)
        if len(has):
            unit.load(has.iloc[0])
        else:
            own = got[got.level == 0].sort_values("bucket")
            unit.take_words(unpacked(own.sums), np.concatenate([before[b] + np.cumsum(unpacked([x])) for b, x in zip(own.bucket, own.kept, strict=True)])
                            .astype(np.uint64))
        for level in range(unit.level + 1, len(kept_hot) + 1):
            own = got[got.level == level].sort_values("bucket")
            unit.take(unpacked(own.sums), np.frombuffer(b"".join(own.kept), np.uint8), kept_hot[level - 1])
        return unit

    def joined(step, schema: str) -> DataFrame:
        got = every[0]
        for more in every[1:]:
            got = got.unionByName(more, allowMissingColumns=True)
        if partial:
            return got.groupBy("unit").applyInPandas(lambda got: step(None, got), schema)
        return blocks.groupBy("unit").cogroup(got.groupBy("unit")).applyInPandas(step, schema)

    def asks(unit: Unit, number: int, turn: int = 0, passes: int = 1) -> pd.DataFrame:
        out = pd.DataFrame(list(unit.ask(turn, passes)), columns=["bucket", *_names(PAIRS)])
        return out.assign(unit=number, deal=(keys if unit.level < STORED else few_keys)[out.bucket.astype(int)])

    def asking(turn: int, passes: int):
        def ask(block: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
            return asks(rebuilt(block, got, hot_kept), got.unit.iloc[0], turn, passes)
        return ask

    def stepping(last: bool):
        def step(block: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
            """A row with the unit's state, and the rows that ask for the next length."""
            number, unit = got.unit.iloc[0], rebuilt(block, got, hot_kept)
            unit.settle()
            state = pd.DataFrame([unit.state()]).assign(unit=number, level=STATE, deal=0, **dict.fromkeys(_names(PAIRS)))
            if last:
                return state
            rows = asks(unit, number).assign(level=ASK, **dict.fromkeys(c for c in _names(STATES) if c not in _names(ASKED) and c != "level"))
            return pd.concat([state, rows[state.columns]]) if len(rows) else state
        return step

    level = 0
    waiting: DataFrame | None = None  # what the units ask next, if their last step wrote it
    partial = False  # whether the states hold what is left of all units
    while depth is None or level < depth:
        level += 1
        gains: dict[int, float] = {}
        n_kept, passes = 0, PASSES if waiting is None else 1
        k = name_bytes(totals[2]) if level <= STORED else NAME_BYTES
        told, paths = [], []
        for turn in range(passes):
            asked = waiting if waiting is not None else joined(asking(turn, passes), ASKED)
            some, path = stored(asked.groupBy("deal").applyInPandas(_sum_pairs(level, lam, least_gain, context_bytes(level, totals[2]), k), ANSWER), "pairs")
            told.append(some.filter("unit >= 0"))
            paths.append(path)
            for r in some.filter("unit < 0 AND length(sums) > 0").collect():  # per bucket a number, and HOT_SHARE contexts in parts
                if r.unit == -2:
                    n_kept += int(np.frombuffer(bytes(r.sums), np.int64)[0])
                    continue
                for c, g in zip(np.frombuffer(bytes(r.sums), np.uint64).tolist(), np.frombuffer(bytes(r.kept), float).tolist(), strict=True):
                    gains[c] = gains.get(c, 0.0) + g
        split = frozenset(c for c, g in gains.items() if g > least_gain)
        if not n_kept and not split:
            break
        if level >= LEADS and longest > unit_bytes:
            raise ValueError(f"contexts of {level} words are kept; pieces of long texts see {LEADS}")
        every, old = [*every, *told], [*old, *paths]
        hot_kept.append(split)
        if level >= STORED:
            both, path = stored(joined(stepping(level == depth), f"{STATES}, deal int, {PAIRS}"), "states")
            for p in old:  # the state replaces them
                remove(spark, p)
            states = both.filter(F.col("level") == STATE).select(*_names(STATES))
            every, old = [states], [path]
            waiting = both.filter(F.col("level") == ASK).select(*_names(ASKED))
            partial = partial or states.filter(F.col("words").isNull()).isEmpty()

    def finish(block: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        unit = rebuilt(block, got, hot_kept)
        unit.settle()
        return score_rows(unit.state())

    def ended(batches):
        for pdf in batches:
            for _, state in pdf.iterrows():
                yield score_rows(state)

    schema = "row long, id long, held boolean, n_tokens long, n_known long, base_score double, score double"
    each = joined(finish, schema) if waiting is None else every[0].select("rows", "ids", "held", "done").mapInPandas(ended, schema)
    return each.groupBy("row", "id", "held").agg(
        *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score"))).select(
        F.col("id").alias(key), F.col("held").alias("held_out"), "n_tokens", "n_known",
        F.lit(totals[0]).cast("long").alias("train_tokens"), "base_score", "score")


def document_scores(docs: DataFrame) -> DataFrame:
    """The contract's columns: rows whose id fold is 2 are held out."""
    return suffix_tree_scores(docs.select("doc_id", "text", (fold(F.col("doc_id"), 7) == 2).alias("held_out")))

"""Periodic runs of words, by longest common extensions on a difference cover.

A run is a stretch of consecutive words that repeats with a smallest period and that
no neighbouring word extends. Two positions ``i`` and ``j`` agree for as many words as
their longest common extension (LCE) says. Only the suffixes that start at a position
of a difference cover are sorted: for any ``i`` and ``j`` some ``k`` below the cover's
modulus puts both ``i + k`` and ``j + k`` on it, so an LCE compares fewer than that
many words and then asks a sparse table of minima over the common prefixes of
neighbours in suffix order.

Runs are found on a harmonic grid: for a period ``q`` only the positions 0, q, 2q, ...
of a text are compared with the one ``q`` further on, n log n pairs in all. A run of
four periods holds a grid point from which it goes on for more than two periods; the
first such point of a run gives its start (by bisection) and its end.

Texts are worked through in groups of about ``GROUP_WORDS`` words, each text's words
numbered apart, so that no extension crosses into another text. Every text stays in
the task that read it: nothing is shuffled. Memory is linear in the words of a group,
or of one longer text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.llm.common import sliced, texts

#: Any distance modulo 13 is a difference of two of these.
COVER, MODULUS = (0, 1, 3, 9), 13
#: A run has at least so many periods, and so many words.
LEAST_PERIODS, LEAST_WORDS = 4, 6
GROUP_WORDS = 1 << 18
#: Pairs compared at once.
PAIRS = 1 << 20

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _meeting() -> np.ndarray:
    """For residues a and b, the least k with a + k and b + k both on the cover."""
    on = np.zeros(MODULUS, bool)
    on[list(COVER)] = True
    k = np.arange(MODULUS)
    both = on[(k[:, None, None] + k[None, :, None]) % MODULUS] & on[(k[:, None, None] + k[None, None, :]) % MODULUS]
    return both.argmax(axis=0)


MEETING = _meeting()


class Extensions:
    """Longest common extensions of positions of ``ids`` (numbers of at least 0)."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        # Behind the end stands a number that is nowhere else.
        self.ids = np.concatenate([ids, np.full(2 * MODULUS, -1, ids.dtype)])
        every = np.arange(0, self.n + 1, MODULUS)
        at = np.sort(np.concatenate([every + c for c in COVER]))
        self.at = at[at < self.n]
        self.place = np.full(self.n + 2 * MODULUS, -1, np.int64)
        self.place[self.at] = np.arange(len(self.at))
        levels = self._sorted()
        self._prefixes(levels)

    def _packed(self) -> list[np.ndarray]:
        """The first MODULUS words of each sampled suffix, several to a number."""
        bits = max(1, int(self.ids.max(initial=0) + 1).bit_length())
        each = max(1, 63 // bits)
        keys = []
        for first in range(0, MODULUS, each):
            key = np.zeros(len(self.at), np.int64)
            for k in range(first, min(first + each, MODULUS)):
                key = (key << bits) | (self.ids[self.at + k].astype(np.int64) + 1)
            keys.append(key)
        return keys

    def _sorted(self) -> list[np.ndarray]:
        """Orders the sampled suffixes by doubling; the rank of each by 13, 26, 52 ... words.

        Only suffixes whose beginnings are still equal are sorted again.
        """
        keys = self._packed()
        self.order = np.lexsort(keys[::-1])
        new = np.ones(len(self.order), bool)
        new[1:] = np.any([k[self.order][1:] != k[self.order][:-1] for k in keys], axis=0)
        levels, width = [], MODULUS
        while True:
            # Rank: place of the first suffix with the same beginning.
            heads = np.flatnonzero(new)
            rank = np.empty(len(self.order), np.int64)
            rank[self.order] = np.repeat(heads, np.diff(np.append(heads, len(self.order))))
            levels.append(rank)
            tied = ~new
            tied[:-1] |= ~new[1:]
            if not tied.any():
                self.rank = rank
                return levels
            slots = np.flatnonzero(tied)
            own = self.order[slots]
            further = self.at[own] + width
            inside = further < self.n
            then = np.full(len(own), -1, np.int64)
            then[inside] = rank[self.place[further[inside]]]
            mixed = np.lexsort((then, rank[own]))
            own, then = own[mixed], then[mixed]
            self.order[slots] = own
            differs = np.ones(len(own), bool)
            differs[1:] = (rank[own][1:] != rank[own][:-1]) | (then[1:] != then[:-1])
            new = new.copy()
            new[slots] |= differs
            width *= 2

    def _prefixes(self, levels: list[np.ndarray]) -> None:
        """Common prefixes of neighbours in suffix order, and minima over 2^k of them."""
        a, b = self.at[self.order[:-1]].copy(), self.at[self.order[1:]].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            rank, width = levels[level], MODULUS << level
            open_ = np.flatnonzero((a < self.n) & (b < self.n))
            equal = open_[rank[self.place[a[open_]]] == rank[self.place[b[open_]]]]
            common[equal] += width
            a[equal] += width
            b[equal] += width
        open_ = np.flatnonzero((a < self.n) & (b < self.n))
        for _ in range(MODULUS - 1):
            open_ = open_[self.ids[a[open_]] == self.ids[b[open_]]]
            open_ = open_[self.ids[a[open_]] >= 0]
            if not len(open_):
                break
            common[open_] += 1
            a[open_] += 1
            b[open_] += 1
        self.minima = [common.astype(np.int32 if self.n < 1 << 31 else np.int64)]
        while 2 * (half := 1 << (len(self.minima) - 1)) <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def _least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of sampled suffixes by their different ranks."""
        low, high = np.minimum(a, b), np.maximum(a, b)
        out = np.empty(len(a), np.int64)
        power = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(power).tolist():
            of = np.flatnonzero(power == k)
            row = self.minima[k]
            out[of] = np.minimum(row[low[of]], row[high[of] - (1 << k)])
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and from ``j`` (different positions) are equal."""
        i, j = np.asarray(i, np.int64), np.asarray(j, np.int64)
        out = np.zeros(len(i), np.int64)
        wait = MEETING[i % MODULUS, j % MODULUS]
        open_ = np.arange(len(i))
        for step in range(MODULUS):
            on = wait[open_] == step
            met = open_[on & (j[open_] + step < self.n) & (i[open_] + step < self.n)]
            if len(met):
                out[met] = step + self._least(self.rank[self.place[i[met] + step]], self.rank[self.place[j[met] + step]])
            open_ = open_[~on]
            same = self.ids[i[open_] + step] == self.ids[j[open_] + step]
            open_ = open_[same & (np.maximum(i[open_], j[open_]) + step < self.n)]
            out[open_] = step + 1
            if not len(open_):
                break
        return out


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text's first position, grid point, period) of all pairs to compare, in bounded pieces."""
    firsts = np.cumsum(sizes) - sizes
    longest = int(sizes.max(initial=0))
    held, room = [], 0
    for q in range(1, longest // LEAST_PERIODS + 1):
        of = np.flatnonzero(sizes >= max(LEAST_WORDS, LEAST_PERIODS * q))
        points = (sizes[of] - 1) // q  # grid points with a position one period further on
        first = np.repeat(firsts[of], points)
        step = np.arange(points.sum()) - np.repeat(np.cumsum(points) - points, points)
        held.append((first, first + step * q, np.full(len(first), q)))
        room += len(first)
        if room >= PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, room = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run, by start and period.

    ``ids`` holds the texts' words one after the other, ``sizes`` the words of each text;
    no two texts share a number.
    """
    found, structure = [], None
    for first, at, q in _grid(sizes):
        # Most pairs differ in one of their first two words; a run needs more than two periods.
        likely = np.flatnonzero(ids[at] == ids[at + q])
        first, at, q = first[likely], at[likely], q[likely]
        likely = np.flatnonzero(ids[at + 1] == ids[np.minimum(at + q + 1, len(ids) - 1)])
        first, at, q = first[likely], at[likely], q[likely]
        if not len(at):
            continue
        structure = structure or Extensions(ids)
        ahead = structure.lce(at, at + q)
        long_ = np.flatnonzero(ahead > (LEAST_PERIODS - 2) * q)
        first, at, q, ahead = first[long_], at[long_], q[long_], ahead[long_]
        # The run's first grid point: the one before it is not in the run.
        earlier = np.flatnonzero(at - q >= first)
        head = np.ones(len(at), bool)
        head[earlier] = structure.lce(at[earlier] - q[earlier], at[earlier]) < q[earlier]
        first, at, q, ahead = first[head], at[head], q[head], ahead[head]
        # Largest step back from which the two sides still agree.
        low, high = np.zeros(len(at), np.int64), np.minimum(q - 1, at - first)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_] + 1) // 2
            agree = structure.lce(at[open_] - middle, at[open_] + q[open_] - middle) >= middle
            low[open_[agree]] = middle[agree]
            high[open_[~agree]] = middle[~agree] - 1
        length = low + q + ahead
        enough = np.flatnonzero(length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q))
        found.append((at[enough] - low[enough], length[enough], q[enough]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, q = (np.concatenate(x) for x in zip(*found))
    # A stretch also repeats with multiples of its smallest period.
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[least], length[least], q[least]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


def without_repeats(size: int, start: np.ndarray, length: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which of ``size`` words stay when each run keeps its first period only."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start + q, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) == 0


def _report(keys: list, words: list[list[bytes]]) -> pa.RecordBatch:
    sizes = np.array([len(w) for w in words], np.int64)
    numbers = count()
    ids = np.empty(int(sizes.sum()), np.int64)
    firsts = np.cumsum(sizes) - sizes
    for first, own in zip(firsts.tolist(), words):
        number = defaultdict(numbers.__next__)
        ids[first:first + len(own)] = np.fromiter(map(number.__getitem__, own), np.int64, len(own))
    start, length, q = find_runs(ids, sizes)
    ends = np.append(np.searchsorted(start, firsts), len(start))
    collapsed = []
    for k, own in enumerate(words):
        a, b = ends[k], ends[k + 1]
        if a < b:
            kept = without_repeats(len(own), start[a:b] - firsts[k], length[a:b], q[a:b])
            own = compress(own, kept.tolist())
        collapsed.append(b" ".join(own))
    runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(start - np.repeat(firsts, np.diff(ends))), pa.array(length), pa.array(q)], ["start", "length", "period"]))
    return pa.record_batch([pa.array(keys, pa.int64()), pa.array(sizes), runs,
                            pa.array(collapsed, pa.binary()).view(pa.string())],
                           names=["doc_id", "n_words", "runs", "collapsed"])


def _groups(batches) -> Iterator[pa.RecordBatch]:
    keys, words, size = [], [], 0
    for batch in sliced(batches):
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            # Bytes are split at the six blanks of ASCII only.
            own = text.split()
            if words and size + len(own) > GROUP_WORDS:
                yield _report(keys, words)
                keys, words, size = [], [], 0
            keys.append(key)
            words.append(own)
            size += len(own)
    if words:
        yield _report(keys, words)


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``runs`` lists start (word number from 0), length and
    smallest period, in words, of every run of at least LEAST_PERIODS periods and
    LEAST_WORDS words, by start, then period. ``collapsed`` has the words joined by one
    blank, without those that a run holds behind its first period. Null and empty texts
    have no words and no runs; repeated rows and rows without id are each reported; an
    empty table gives no rows.
    """
    return texts(df, id_col, text_col).mapInArrow(_groups, SCHEMA)


def folded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts into which periodic runs are put, for one id in ten, as a test of the search.

    With ``h`` the crc32 of the id's decimal text and ``g = h // 10``: where ``h`` is a multiple of
    ten, each of the n words from number ``a = g % n`` on is replaced by the word at
    ``a + (i - a) % p``, for ``p = 1 + (n - a) // (3 + g % 8)``. Other texts, those without
    words and rows without id stay as they are.
    """
    def words(of: str) -> Column:
        return F.regexp_extract_all(F.col(of), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))

    h = F.crc32(F.col("_id").cast("string"))
    rows = texts(df, id_col, text_col).select(
        "_id", "_t", F.when(h % 10 == 0, words("_t")).alias("_w"), F.floor(h / 10).cast("long").alias("_g"))
    rows = rows.withColumn("_n", F.size("_w")).withColumn(
        "_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    left = F.col("_n") - F.col("_a")
    rows = rows.withColumn("_p", (F.lit(1) + F.floor(left / (F.lit(3) + F.col("_g") % 8))).cast("int"))
    whole = F.array_repeat(F.slice("_w", F.col("_a") + 1, F.col("_p")), F.ceil(left / F.col("_p")).cast("int"))
    text = F.concat_ws(" ", F.slice("_w", F.lit(1), F.col("_a")), F.slice(F.flatten(whole), F.lit(1), left))
    return rows.select(F.col("_id").alias(id_col),
                       F.when(F.col("_n") > 0, text).otherwise(F.col("_t")).alias(text_col))

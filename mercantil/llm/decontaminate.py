"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Benchmark items are cut into segments of about 256 words. Seeds are three words in a row
and three words with a gap (the first, second and fourth of four), so some survive where
every third word is edited. They are counted over all documents; a document that holds many of
a segment's seeds is a copy and doesn't make them common. Of the seeds that occur at all,
a segment uses the rare ones, and of each quarter the rarest ones however common, so a
common phrase starts no alignment while a leaked item, however often it is copied and
whichever half of it is left, keeps its seeds. A document that holds a seed is aligned with
the segment around the place the seed points to, word by word, which finds edited and
shortened copies too. The score is the alignment's share of the best possible one.

The benchmark is the stated query set: it goes to the tasks in blocks of at most
``BLOCK_WORDS`` words, one pass over the documents for each block. Documents are never
shuffled; of each block's seeds only counts come back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercantil.llm.common import texts

#: Offsets of a seed's words.
SEEDS = ((0, 1, 2), (0, 1, 3))
SEGMENT_WORDS, BLOCK_WORDS = 256, 200_000
#: A seed is rare in up to this share of the documents, or this many of them.
RARE_SHARE, RARE_DOCUMENTS = 0.0005, 20
#: Share of a segment's seeds in a document that make it a copy.
COPY_SHARE = 0.2
#: Rarest seeds that each quarter of a segment uses in any case.
LEAST_SEEDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
#: Shorter items occur in other words too: they count as exact copies only. Those of one
#: or two words count only as a whole document.
LEAST_WORDS = 8

_FIND = re.compile(r"\w+").findall


def words(text: str) -> list[str]:
    return _FIND(text.lower())


def cut(found: list[str]) -> list[list[str]]:
    """Segments of an item; a short tail stays with the words before it."""
    ends = list(range(SEGMENT_WORDS, len(found) - LEAST_WORDS + 1, SEGMENT_WORDS))
    return [found[a:b] for a, b in zip([0, *ends], [*ends, len(found)])]


class Index:
    """Segments of a block of items, as word numbers, with their seeds."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.items, self.segments = [], []
        self.whole: dict[tuple[str, ...], list] = {}
        vocabulary: dict[str, int] = {}
        for item, text in items:
            found = words(text)
            if 0 < len(found) < 3:
                self.whole.setdefault(tuple(found), []).append(item)
            elif found:
                for part in cut(found):
                    self.items.append(item)
                    self.segments.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in part]))
        self.needed = [1.0 if len(s) < LEAST_WORDS else THRESHOLD for s in self.segments]
        self.vocabulary, self.base = vocabulary, len(vocabulary) + 1
        self.grams_of = [self.grams(s) for s in self.segments]
        self.keys = np.unique(np.concatenate([g for own in self.grams_of for g in own])) if self.segments else np.zeros(0, np.int64)
        pairs = {(int(p), k) for k, own in enumerate(self.grams_of) for g in own for p in np.searchsorted(self.keys, g)}
        self.places, self.segment_of = (np.array(x, np.int64) for x in zip(*sorted(pairs))) if pairs else (np.zeros(0, np.int64),) * 2
        self.seeds = np.bincount(self.segment_of, minlength=len(self.segments))
        self.use()

    def common(self, places: np.ndarray) -> np.ndarray:
        """Of the seeds in a document, those of no segment of which it is a copy."""
        low, high = np.searchsorted(self.places, places), np.searchsorted(self.places, places, "right")
        of = np.repeat(np.arange(len(places)), high - low)
        at = np.arange(len(of)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[of]
        segments = self.segment_of[at]
        copied = np.bincount(segments, minlength=len(self.segments)) >= COPY_SHARE * self.seeds
        return places[np.bincount(of, copied[segments], len(places)) == 0]

    def grams(self, numbers: np.ndarray) -> list[np.ndarray]:
        """Seeds of each kind by their first word, for numbers of known words."""
        out = []
        for kind, offsets in enumerate(SEEDS):
            n = max(0, len(numbers) - offsets[-1])
            a, b, c = (numbers[k:k + n] for k in offsets)
            out.append(((kind * self.base + a) * self.base + b) * self.base + c)
        return out

    def numbers(self, found: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.int64, len(found))

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known seeds and their places in ``keys``; number 0 is a word of no item."""
        none = np.zeros(0, np.int64)
        positions, places = [none], [none]
        known = numbers > 0
        for kind, offsets in enumerate(SEEDS):
            n = len(numbers) - offsets[-1]
            if n <= 0 or not len(self.keys):
                continue
            i, j, k = offsets
            at = np.flatnonzero(known[i:i + n] & known[j:j + n] & known[k:k + n])
            grams = ((kind * self.base + numbers[at]) * self.base + numbers[at + j]) * self.base + numbers[at + k]
            place = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
            met = self.keys[place] == grams
            positions.append(at[met])
            places.append(place[met])
        return np.concatenate(positions), np.concatenate(places)

    def use(self, found: np.ndarray | None = None, counts: np.ndarray | None = None, documents: int = 0) -> None:
        """Where each seed starts an alignment: (segment, offset).

        ``found`` tells which seeds occur at all, ``counts`` in how many documents that are no
        copy. Used are the rare ones, and the rarest of each quarter of a segment.
        """
        self.where: dict[int, list[tuple[int, int]]] = {}
        rare = max(RARE_DOCUMENTS, RARE_SHARE * documents)
        for k, segment in enumerate(self.segments):
            for grams in self.grams_of[k]:
                place = np.searchsorted(self.keys, grams)
                used = np.ones(len(place), bool)
                if counts is not None and len(place):
                    seen, occurs = counts[place], found[place]
                    used = occurs & (seen <= rare)
                    quarter = np.arange(len(place)) * 4 // len(place)
                    ranked = np.lexsort((seen, quarter))
                    ranked = ranked[occurs[ranked]]
                    begin = np.searchsorted(quarter[ranked], quarter[ranked])
                    used[ranked[np.arange(len(ranked)) - begin < LEAST_SEEDS]] = True
                for offset in np.flatnonzero(used).tolist():
                    self.where.setdefault(int(place[offset]), []).append((k, offset))

    def matches(self, text: str) -> list[tuple[int | None, float, int, int]]:
        """(item, score, first word, last word + 1) of the best alignment with each item."""
        found = words(text)
        numbers = self.numbers(found)
        best = {item: (1.0, 0, len(found)) for item in self.whole.get(tuple(found), ())} if len(found) < 3 else {}
        at, place = self.hits(numbers)
        windows: dict[int, list[tuple[int, int]]] = {}
        for position, key in zip(at.tolist(), place.tolist()):
            for k, offset in self.where.get(key, ()):
                size = len(self.segments[k])
                begin = position - offset
                windows.setdefault(k, []).append((max(0, begin - size // 2), begin + size + size // 2))
        for k, spans in windows.items():
            segment, needed = self.segments[k], self.needed[k]
            for begin, end in merged(sorted(spans)):
                own = numbers[begin:end]
                # No alignment can score more than the words in common allow.
                if np.isin(own, segment).sum() < needed * len(segment):
                    continue
                score, first, last = align(segment, own)
                share = score / (MATCH * len(segment))
                if share >= needed and share > best.get(self.items[k], (0,))[0]:
                    best[self.items[k]] = (share, begin + first, begin + last)
        return [(item, *match) for item, match in best.items()]


def merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    begin, end = spans[0]
    for a, b in spans[1:]:
        if a > end:
            yield begin, end
            begin, end = a, b
        end = max(end, b)
    yield begin, end


def align(query: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman with linear gaps: (score, start, end) of the best local alignment in ``text``.

    One numpy pass for each query word: gaps in the text are a running maximum.
    """
    n = len(text)
    steps = -GAP * np.arange(n + 1)
    row, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in query:
        diagonal = row[:-1] + np.where(text == word, MATCH, MISMATCH)
        up = row[1:] + GAP
        cell = np.zeros(n + 1, np.int64)
        cell[1:] = np.maximum(diagonal, up)
        origin = np.arange(n + 1)
        origin[1:] = np.where(diagonal >= up, start[:-1], start[1:])
        empty = cell <= 0
        cell[empty] = 0
        origin[empty] = np.flatnonzero(empty)
        lifted = cell + steps
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        row, start = top - steps, origin[source]
        peak = int(row.argmax())
        if row[peak] > best[0]:
            best = (int(row[peak]), int(start[peak]), peak)
    return best


def blocks(benchmark: DataFrame, item_col: str, text_col: str, named: bool = True) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of at most BLOCK_WORDS words; a longer item is a block of its own.

    With ``named`` only those with an id.
    """
    held, size = [], 0
    rows = benchmark.select(F.col(f"`{item_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).filter("t IS NOT NULL")
    rows = rows.filter("i IS NOT NULL") if named else rows
    for row in rows.toLocalIterator():
        n = len(words(row["t"]))
        if held and size + n > BLOCK_WORDS:
            yield held
            held, size = [], 0
        held.append((row["i"], row["t"]))
        size += n
    if held:
        yield held


def seeded(rows: DataFrame, items: list[tuple[int | None, str]]) -> Index:
    """Index of a block whose seeds are rare over all of ``rows`` (_id, _t)."""
    index = Index(items)

    def run(batches):
        total, seen, documents = np.zeros(len(index.keys), np.int64), np.zeros(len(index.keys), bool), 0
        for batch in batches:
            documents += batch.num_rows
            for text in batch.column(0).to_pylist():
                places = np.unique(index.hits(index.numbers(words(text)))[1])
                if len(places):
                    seen[places] = True
                    total[index.common(places)] += 1
        used = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(total[used], documents), pa.int64())],
                              names=["k", "n"])

    found = rows.select("_t").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    at = found.k.to_numpy(dtype=int)
    counts, occurs = np.zeros(len(index.keys) + 1, np.int64), np.zeros(len(index.keys) + 1, bool)  # the last: all documents
    counts[at], occurs[at] = found.n.to_numpy(dtype=int), True
    index.use(occurs[:-1], counts[:-1], int(counts[-1]))
    return index


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` for each document and item that align.

    Only scores of THRESHOLD or more are returned, one row for each such pair of a row
    and an item, so repeated rows are each reported. Null texts hold nothing; items without
    text or id are not looked for. Items of fewer than LEAST_WORDS words match as exact copies,
    those of one or two words a whole document. Empty tables give no rows.
    """
    rows, out = texts(df, id_col, text_col), None
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    for items in blocks(benchmark, item_col, item_text):
        index = seeded(rows, items)

        def run(batches, index=index):
            for batch in batches:
                found = [(key, *m) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                         for m in index.matches(text)]
                cols = list(zip(*found)) or [[]] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "item_id", "score", "first_word", "last_word"])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else df.sparkSession.createDataFrame([], schema)


def drop_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """The rows of ``df`` that align with no item, with all their columns.

    Items without id count here. Rows with a null text stay, repeated rows stay or go together,
    and an empty benchmark keeps all.
    """
    rows, out = texts(df.select(F.lit(0).alias("_id"), F.col(f"`{text_col}`").alias("_t")), "_id", "_t"), df
    for items in blocks(benchmark, item_col, item_text, named=False):
        clean = _clean(seeded(rows, items))
        out = out.filter(clean(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
    return out


def _clean(index: Index):
    @F.pandas_udf("boolean")
    def clean(column: pd.Series) -> pd.Series:
        return column.map(lambda t: not index.matches(t)).astype(bool)

    return clean

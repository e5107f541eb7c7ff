"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first (case, look-alike letters, digits that stand for letters,
invisible characters), cut to words and matched as one string. The lexicon holds
words and word beginnings with a log-odds weight learned from labelled rows; phrases
in which a word is harmless take its weight back. What harmless texts of the same
length match on average is subtracted, the rest is divided by the spread that goes
with that length and turned into a probability.

Learning reads at most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` other labelled rows, taken
in the order of a hash of their id. A word counts once for each pair of neighbours,
so a text that is copied many times does not make its words look toxic.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.llm.common import sliced, texts

#: Largest number of labelled rows of each kind a lexicon is learned from.
MAX_TOXIC, MAX_CLEAN = 3000, 9000
#: Lengths of word beginnings tried besides whole words.
PREFIXES = (4, 5, 6, 7, 8, 9)
#: Least number of uses in toxic texts, least ratio of rates, least evidence in nats.
LEAST_USES, LEAST_RATIO, LEAST_EVIDENCE = 4, 6.0, 12.0
#: Score from which a document counts as toxic.
THRESHOLD = 0.3

# Letters that look like Latin ones, and digits used in their place.
LOOK_ALIKE = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v",
    "ԝ": "w", "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ʟ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"
# Phrases in which a word of the lexicon is harmless.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "dumb bell", "dummy variable")

_FOLD = str.maketrans({**LOOK_ALIKE, **DIGITS, **dict.fromkeys(INVISIBLE, "")})
_WORDS = re.compile(r"\w+").findall


def fold(text: str) -> str:
    """Folded words of a text, with a blank before, between and after them."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return f" {' '.join(_WORDS(text.lower().translate(_FOLD)))} "


def _forms(word: str) -> list[str]:
    return [f" {word} "] + [f" {word[:n]}" for n in PREFIXES if n <= len(word)]


def _automaton(weights: dict[str, float]):
    found = ahocorasick.Automaton()
    for form, weight in weights.items():
        found.add_word(form, (form, weight))
    found.make_automaton()
    return found


class Lexicon:
    """Weights of forms and exception phrases, and the curve from sum to probability.

    ``base`` is what a word of a harmless text adds on average.
    """

    def __init__(self, weights: dict[str, float], phrases: dict[str, float], base: float = 0.0,
                 slope: float = 1.0, offset: float = -4.0):
        self.weights, self.phrases, self.base = weights, phrases, base
        self.slope, self.offset = slope, offset
        self.found = _automaton(weights | phrases) if weights else None

    def dumps(self) -> str:
        return json.dumps([self.weights, self.phrases, self.base, self.slope, self.offset])

    @classmethod
    def loads(cls, data: str) -> "Lexicon":
        return cls(*json.loads(data))

    def total(self, text: str) -> tuple[float, int]:
        """Sum of matched weights, and the number of words. A word counts once, by its longest form."""
        if not self.found:
            return 0.0, 0
        folded, taken, forms = fold(text), 0.0, {}
        for end, (form, weight) in self.found.iter(folded):
            if form in self.phrases:
                taken += weight
            else:  # of forms with one start, the longest ends last
                forms[end - len(form)] = weight
        return taken + sum(forms.values()), folded.count(" ") - 1

    def excess(self, text: str) -> float:
        total, words = self.total(text)
        usual = self.base * words
        return (total - usual) / math.sqrt(1.0 + usual)

    def score(self, text: str) -> float:
        if not self.weights:
            return 0.0
        x = self.offset + self.slope * self.excess(text)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x))))


def sampled(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int]) -> DataFrame:
    """``_t, _y`` for at most ``most[value]`` labelled rows of each value, in hash order.

    The ids picked are bounded by ``most``, which is what makes their broadcast safe.
    """
    picks = None
    for value, limit in most.items():
        part = (labels.filter(F.col(label) == value).select(F.col("doc_id").cast("long").alias("_i"))
                .filter("_i IS NOT NULL").distinct().orderBy(F.xxhash64("_i"), "_i").limit(limit)
                .withColumn("_y", F.lit(value)))
        picks = part if picks is None else picks.unionByName(part)
    return docs.join(F.broadcast(picks), F.col("_id") == F.col("_i")).select("_t", "_y")


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """Lexicon from ``labels`` (doc_id, toxic), which must hold training rows only.

    Without toxic rows the lexicon is empty and every score 0. Null labels are ignored.
    """
    rows = sampled(texts(df, id_col, text_col), labels, "toxic", {1: MAX_TOXIC, 0: MAX_CLEAN}).persist()
    try:
        counts = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not counts.get(1):
            return Lexicon({}, {})
        return _fit(rows, counts.get(1), counts.get(0, 0))
    finally:
        rows.unpersist()


def _fit(rows: DataFrame, toxic: int, clean: int) -> Lexicon:
    def count_forms(batches):
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[y].update(f for w in fold(text).split() for f in _forms(w))
        forms = list(seen[1].keys() | seen[0].keys())
        yield pa.record_batch([pa.array(forms), pa.array([seen[1][f] for f in forms], pa.int64()),
                               pa.array([seen[0][f] for f in forms], pa.int64())], names=["form", "bad", "good"])

    # Forms that are frequent enough in at most MAX_TOXIC texts: a bounded list.
    candidates = [r["form"] for r in (
        rows.mapInArrow(count_forms, "form string, bad long, good long")
        .groupBy("form").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .filter((F.col("bad") >= LEAST_USES)
                & ((F.col("bad") + 0.5) / (toxic + 1) >= 3 * (F.col("good") + 0.5) / (clean + 1)))
        .select("form").collect())]
    wanted = dict.fromkeys(candidates, 0.0)

    def contexts(batches):
        found = _automaton(wanted)
        for batch in batches:
            out = set()
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded = fold(text)
                for end, (form, _) in found.iter(folded):
                    start = end - len(form) + 1
                    stop = folded.index(" ", start + 1)
                    before, after = folded[:start].rsplit(" ", 1)[-1][-40:], folded[stop + 1:stop + 200].split(" ", 1)[0]
                    out.add((form, folded[start + 1:stop], before, after[:40], y))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.record_batch([pa.array(c, pa.string()) for c in cols[:4]] + [pa.array(cols[4], pa.int64())],
                                  names=["form", "word", "before", "after", "y"])

    if not candidates:
        return Lexicon({}, {})
    uses = (rows.mapInArrow(contexts, "form string, word string, before string, after string, y long")
            .distinct().persist())
    try:
        # Phrases: a harmless neighbour, seen in two texts or more and never in a toxic one.
        pairs = (uses.select("form", "y", F.explode(F.array(
            F.concat(F.lit(" "), "before", F.lit(" "), "word", F.lit(" ")),
            F.concat(F.lit(" "), "word", F.lit(" "), "after", F.lit(" ")))).alias("phrase"))
            .groupBy("form", "phrase").agg(F.sum(1 - F.col("y")).alias("good"), F.sum("y").alias("bad"))
            .filter("bad = 0 AND good >= 2"))
        counts = uses.groupBy("form").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good")).collect()
        spared = pairs.groupBy("form").agg(F.sum("good").alias("good")).collect()
        excused = {r["form"]: r["good"] for r in spared}
        share, judged = toxic / (toxic + clean) if clean else 0.5, []
        for r in counts:
            bad, good = r["bad"], max(0, r["good"] - excused.get(r["form"], 0))
            ratio = ((bad + 0.5) / (toxic + 1)) / ((good + 0.5) / (clean + 1))
            rate = bad / (bad + good)
            evidence = bad * math.log(rate / share) + (good * math.log((1 - rate) / (1 - share)) if good else 0.0) if bad else 0.0
            if ratio >= LEAST_RATIO and evidence >= LEAST_EVIDENCE:
                judged.append((-evidence, r["form"], round(min(8.0, math.log(ratio)), 4)))
        # A form goes if a kept beginning matches all its uses.
        weights: dict[str, float] = {}
        for _, form, weight in sorted(judged):
            if not any(form[:n] in weights for n in range(2, len(form))):
                weights[form] = weight
        kept = pairs.filter(F.col("form").isin(list(weights))).collect() if weights else []
    finally:
        uses.unpersist()
    # What a word's longest form has added is taken back.
    phrases = {r["phrase"]: -weights[r["form"]] for r in sorted(kept, key=lambda r: len(r["form"]))}
    plain = Lexicon(weights, {})
    for phrase in EXCEPTIONS:
        if hit := plain.total(phrase)[0]:
            phrases[fold(phrase)] = -hit
    return _calibrated(rows, Lexicon(weights, phrases))


def _calibrated(rows: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Logistic curve over the totals of the sampled rows, by Newton steps."""
    def totals(batches):
        for batch in batches:
            found = [lexicon.total(t) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([t for t, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64()),
                                   batch.column(1).cast(pa.int64())], names=["t", "n", "y"])

    table = rows.mapInArrow(totals, "t double, n long, y long").toPandas()
    clean = table[table.y == 0]
    base = max(0.0, float(clean.t.sum() / max(1, clean.n.sum())))
    usual = base * table.n.to_numpy()
    x = np.minimum((table.t.to_numpy() - usual) / np.sqrt(1 + usual), 20.0)
    y = table.y.to_numpy(dtype=float)
    design, theta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    # Firm pull towards a slope of one keeps separable samples finite.
    prior, strength = np.array([1.0, -3.0]), np.array([1.0, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        grad = design.T @ (p - y) + strength * (theta - prior)
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag(strength)
        theta -= np.clip(np.linalg.solve(hess, grad), -2, 2)
    return Lexicon(lexicon.weights, lexicon.phrases, base, float(max(theta[0], 0.05)), float(theta[1]))


def toxicity_scores(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row; null and empty texts have no match and a low score."""
    shared = lexicon.dumps()

    def run(batches):
        own = Lexicon.loads(shared)
        for batch in sliced(batches):
            yield pa.record_batch([batch.column(0), pa.array([own.score(t) for t in batch.column(1).to_pylist()],
                                                             pa.float64())], names=["doc_id", "score"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def drop_toxic(df: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose score is below ``threshold``, with all their columns."""
    shared = lexicon.dumps()

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        own = Lexicon.loads(shared)
        return column.map(own.score)

    return df.filter(score(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))) < threshold)


def fold_number(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds

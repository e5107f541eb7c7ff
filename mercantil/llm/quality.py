"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled good; the unlabelled set is drawn from all
documents, good and bad. A small network on style features minimises the
non-negative unbiased risk: pi * R_p+ plus max(0, R_u- - pi * R_p-), stepping back
on batches where the second part is negative. The class prior pi is estimated from
the training labels. Features describe style only (repeats, symbols, case, lines,
word shapes), no ids, sources or languages.

Training takes at most ``MAX_ROWS`` positives and as many unlabelled documents, in the
order of a hash of their id; every document is scored, and the border between good and
bad is placed on the scores of all documents.
"""

from __future__ import annotations

import json
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercantil.llm.common import sliced, stored, texts
from mercantil.llm.toxicity import sampled

#: Largest number of positives and of unlabelled rows a model is fitted on.
MAX_ROWS = 12_000
HIDDEN = 24
STEPS = 1500
BATCH = 512
THRESHOLD = 0.3
#: How far the share of good rows may be from the prior.
SLACK = 0.03
#: Width of the bins that logits are counted in, and the largest logit told apart.
BIN = 1 / 64
REACH = 64
SYMBOLS = "!|*#%$&<>{}=+_~^@/\\[]"
NAMES = (
    "log_words", "log_chars", "mean_word", "long_words", "distinct_words", "pair_repeats",
    "top_word", "distinct_lines", "log_lines", "words_per_line", "upper_words", "upper_chars",
    "digits", "symbols", "bangs", "pipes", "symbol_ends", "stops", "commas", "spaces", "entropy",
    "compress", "adjacent_same", "sentence_words",
)


def features(text: str) -> list[float]:
    """Style of one text; zeros for an empty one."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(NAMES)
    distinct = set(words)
    pairs = set(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    symbols = [text.count(c) for c in SYMBOLS]
    upper = sum(map(str.isupper, words))
    # A fixed-size look at word frequencies: counts in 256 hashed cells over all words.
    cells = np.bincount(np.fromiter((hash_word(w) for w in distinct), np.int64, len(distinct)) & 255,
                        minlength=256)
    share = cells[cells > 0] / cells.sum()
    repeats = n - 1 - len(pairs)
    ends = sum(not w[-1].isalnum() and w[-1] not in ".,;:?!'\")" for w in distinct)
    raw = text.encode()
    return [
        math.log1p(n), math.log1p(size), (size - n) / n, sum(len(w) > 14 for w in distinct) / len(distinct),
        len(distinct) / n, repeats / max(1, n - 1), max(Counter(words).values()) / n,
        len(set(lines)) / max(1, len(lines)), math.log1p(len(lines)), math.log1p(n / max(1, len(lines))), upper / n,
        sum(map(str.isupper, text)) / size,
        sum(text.count(d) for d in "0123456789") / size, sum(symbols) / n, symbols[0] / n, symbols[1] / n,
        ends / len(distinct), text.count(".") / n, text.count(",") / n, text.count(" ") / size,
        float(-(share * np.log(share)).sum()), len(zlib.compress(raw, 1)) / len(raw),
        sum(map(str.__eq__, words, words[1:])) / n, math.log1p(n / (1 + text.count("."))),
    ]


def hash_word(word: str) -> int:
    """The same in every worker, unlike ``hash``."""
    return zlib.crc32(word.encode())


class Network:
    """One hidden layer over standardised features; ``dumps`` and ``loads`` move it as text."""

    def __init__(self, mean, scale, w1, b1, w2, b2, prior):
        self.mean, self.scale, self.w1, self.b1, self.w2 = map(np.asarray, (mean, scale, w1, b1, w2))
        self.b2, self.prior = b2, prior

    def dumps(self) -> str:
        return json.dumps([x.tolist() for x in (self.mean, self.scale, self.w1, self.b1, self.w2)]
                          + [float(self.b2), self.prior])

    @classmethod
    def loads(cls, data: str) -> "Network":
        return cls(*json.loads(data))

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2


def non_negative_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk for logits, with the logistic loss."""
    loss = lambda z: np.logaddexp(0.0, -z)
    return (prior * loss(positive).mean(),
            loss(-unlabelled).mean() - prior * loss(-positive).mean())


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> Network:
    """Minimise the non-negative risk by Adam on mini-batches."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    net = Network(mean, scale, rng.normal(0, 0.3, (both.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 0.3, HIDDEN), 0.0, prior)
    zp, zu = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, STEPS + 1):
        x = np.concatenate([zp[rng.integers(0, len(zp), BATCH)], zu[rng.integers(0, len(zu), BATCH)]])
        hidden = np.tanh(x @ params[0] + params[1])
        out = hidden @ params[2] + params[3][0]
        p, u = out[:BATCH], out[BATCH:]
        _, negative = non_negative_risk(p, u, prior)
        grad = np.empty_like(out)
        if negative >= 0:
            grad[:BATCH] = prior * (-sigmoid(-p) - sigmoid(p)) / BATCH
            grad[BATCH:] = sigmoid(u) / BATCH
        else:  # step back on the part that has become negative
            grad[:BATCH] = prior * sigmoid(p) / BATCH
            grad[BATCH:] = -sigmoid(u) / BATCH
        back = np.outer(grad, params[2]) * (1 - hidden ** 2)
        grads = [x.T @ back, back.sum(0), hidden.T @ grad, np.array([grad.sum()])]
        rate = 0.01 * (1 - step / (STEPS + 1)) + 1e-4
        for k, (param, g) in enumerate(zip(params, grads)):
            g = g + 1e-4 * param
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            param -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    net.b2 = float(params[3][0])
    return net


def border(counts: dict[int, int], prior: float) -> float:
    """Where to cut a histogram (rows by number of ``BIN``) so that about ``prior`` of the rows are above.

    Of the bins whose shares of rows below and above are within ``SLACK`` of that, the
    emptiest is cut, in the middle of the longest run of such bins; if there is no such
    bin, the one in which the share is reached.
    """
    first, last = min(counts), max(counts)
    found = np.array([counts.get(k, 0) for k in range(first, last + 1)])
    below = np.cumsum(found) / found.sum()
    above = 1 - below + found / found.sum()
    near = np.flatnonzero((below <= 1 - prior + SLACK) & (above <= prior + SLACK))
    if not len(near):
        near = np.array([min(int(np.searchsorted(below, 1 - prior)), len(found) - 1)])
    least = near[found[near] == found[near].min()]
    runs = np.split(least, np.flatnonzero(np.diff(least) > 1) + 1)
    longest = max(runs, key=len)
    return (first + (longest[0] + longest[-1] + 1) / 2) * BIN


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    """Model from ``labels``, its border placed on all rows of ``df``; see ``rated``."""
    return rated(df, labels, id_col, text_col)[0]


def rated(df: DataFrame, labels: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[Network | None, DataFrame]:
    """A model learned from ``labels`` (doc_id, quality), training rows only, and its ``doc_id, score``.

    Every text is read once; the logits of all rows are stored, and their histogram
    (one row a bin, at most ``2 * REACH / BIN + 1``) places the border. Null and empty
    texts are scored on zero features. Without a positive or a document there is no
    model, and every score is 0.
    """
    net = fitted(df, labels, id_col, text_col)
    if net is None:
        return None, quality_scores(df, None, id_col, text_col)
    found = stored(logits(df, net, id_col, text_col), "logits")
    bins = F.floor(F.greatest(F.least("logit", F.lit(REACH)), F.lit(-REACH)) / BIN)
    counts = {r.b: r.n for r in found.groupBy(bins.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    move = math.log(THRESHOLD / (1 - THRESHOLD)) - border(counts, net.prior)
    net.b2 += move
    return net, _scores(found, move)


def fitted(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    """The network before its border is placed; None if there is no positive or no document.

    The prior is the share of good rows among the training labels, kept within 0.05 and 0.95.
    """
    rows = texts(df, id_col, text_col)
    prior = labels.agg(F.avg("quality")).first()[0]
    if not prior:
        return None
    everyone = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.lit(0).alias("quality"))

    def vectors(batches):
        for batch in sliced(batches):
            x = [features(t) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(x, pa.list_(pa.float64()))], names=["x"])

    def matrix(frame: DataFrame) -> np.ndarray:
        found = frame.select("_t").mapInArrow(vectors, "x array<double>").toPandas().x
        return np.stack(found.to_list()) if len(found) else np.zeros((0, len(NAMES)))

    positive = matrix(sampled(rows, labels, "quality", {1: MAX_ROWS}))
    unlabelled = matrix(sampled(rows, everyone, "quality", {0: MAX_ROWS}))
    if not len(positive) or not len(unlabelled):
        return None
    return fit(positive, unlabelled, float(min(0.95, max(0.05, prior))))


def logits(df: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, logit`` for every row."""
    packed = net.dumps()

    def run(batches):
        own = Network.loads(packed)
        for batch in sliced(batches):
            x = np.array([features(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(NAMES))
            yield pa.record_batch([batch.column(0), pa.array(own.logits(x), pa.float64())], names=["doc_id", "logit"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, logit double")


def _scores(found: DataFrame, move: float = 0.0) -> DataFrame:
    z = F.greatest(F.least(F.col("logit") + F.lit(move), F.lit(30.0)), F.lit(-30.0))
    return found.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def quality_scores(df: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row.

    Null and empty texts are scored on zero features. Without a model every score is 0.
    """
    if net is None:
        return texts(df, id_col, text_col).select(F.col("_id").alias("doc_id"), F.lit(0.0).alias("score"))
    return _scores(logits(df, net, id_col, text_col))

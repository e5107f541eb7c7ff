"""Quality rules: counts of a text, then perplexity bands under an n-gram model.

The model is a modified Kneser-Ney model of the characters of words, counted by Spark
over all documents. A word is read from its start to its end, so its score is its own
and a document's is the sum over its words; perplexity is taken per word. Tasks count
the grams of their texts; grams of the full length, and those at a word's start, keep
these counts, shorter ones count the different characters seen before them. Discounts
come from the numbers of grams seen once to four times.

The model is a table of hash, ``alpha`` (a gram's discounted share of its context) and
``gamma`` (what a context leaves to shorter ones), sorted by hash. A probability starts
from the uniform one and takes ``alpha + gamma * p`` for each longer context seen. Up to
``BROADCAST_LIMIT`` bytes the sorted arrays go to the tasks, which look grams up by
binary search, each different word once. A larger model stays a table: the different
words are scored by a join with it, and the documents by a join with these. Both ways
give the same scores.

Languages share the model, so that a text with a passage in another language is not
odd, but each has bands of its own. They lie around the median of the perplexities of
its documents, at a multiple of the median distance below and above it; these are read
from a histogram of all documents. Texts are never shuffled on the usual way, only gram
counts and one narrow row a document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.llm import common
from mercantil.llm.common import sliced, stored

ORDER = 5
#: Blanks never stand in a word: they mark its start and its end.
BEGIN, END = " ", "\n"
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Least words of a text, and the largest percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Distance of the bands from the median, in median distances of the documents on that side,
#: which count as LEAST_SPREAD (of the natural logarithm) at least.
BELOW, ABOVE = 7.0, 10.0
LEAST_SPREAD = 0.15
#: Histogram of the natural logarithm of perplexity.
BIN = 1 / 1024
#: Different words held by a task.
HELD = 300_000
#: Letters of a text's words looked up at once.
LETTERS = 1 << 20
#: Of a gram in the arrays: hash, alpha, gamma.
ROW_BYTES = 24

_METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def split_rows(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``_id, _t, _l``; a null language is the empty one."""
    common.ship(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_t"),
                     F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("_l"))


def _different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different key, and for every key which of them it is."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


class Grams:
    """For each character of some words, and each end, the longest gram that ends there.

    Equal grams are found once: ``first`` has a place of each, ``of`` the gram of each place
    that is not a word's start, ``sizes`` the grams of each word.
    """

    def __init__(self, words: list[bytes]):
        self.text = (BEGIN.encode() + (END + BEGIN).encode().join(words) + END.encode()).decode(errors="replace")
        points = np.frombuffer(self.text.encode("utf-32-le"), "<u4")
        starts = np.flatnonzero(points == ord(BEGIN))
        lengths = np.diff(starts, append=len(points))
        self.sizes = lengths - 1
        depth = np.arange(len(points)) - np.repeat(starts, lengths)
        self.points, self.depth = points, np.minimum(depth + 1, ORDER)  # characters of the gram
        # Characters by number, 0 for none: a gram is a number in that base.
        number = np.zeros(int(points.max()) + 1, np.int64)
        number[points] = 1
        base = int(number.sum()) + 1
        number[number > 0] = np.arange(1, base)
        letters = number[points]
        key = np.zeros(len(points), np.int64)
        for back in range(ORDER - 1, -1, -1):
            if base ** (ORDER - back) > 1 << 62:
                # Too many characters for one number: what is packed so far gets a number of its own.
                key = _different(key)[1]
            own = np.zeros(len(points), np.int64)
            own[back:] = letters[:max(0, len(points) - back)]
            key = key * base + np.where(back < self.depth, own, 0)
        places = np.flatnonzero(depth > 0)
        first, self.of = _different(key[places])
        self.first = places[first]

    def strings(self) -> list[str]:
        return [self.text[at + 1 - n:at + 1] for at, n in zip(self.first.tolist(), self.depth[self.first].tolist())]


def _counted(batches) -> Iterator[pa.RecordBatch]:
    """Grams of the texts of a task with their numbers."""
    words: Counter = Counter()

    def handed_on():
        for own, numbers in _pieces(list(words), list(words.values())):
            grams = Grams(own)
            found = np.bincount(grams.of, np.repeat(np.array(numbers, float), grams.sizes))
            yield pa.record_batch([pa.array(grams.strings(), pa.string()), pa.array(found.astype(np.int64))], names=["gram", "n"])
        words.clear()

    for batch in sliced(batches, 200):
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            # Bytes are split at the six blanks of ASCII only.
            words.update(text.split())
        if len(words) >= HELD:
            yield from handed_on()
    yield from handed_on()


def _pieces(words: list[bytes], *others: list) -> Iterator[tuple]:
    """Parallel lists in pieces of about LETTERS letters of words."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    cuts = np.flatnonzero(np.diff((ends - 1) // LETTERS)) + 1
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(words)]):
        if begin < end:
            yield tuple(x[begin:end] for x in (words, *others))


def model(rows: DataFrame) -> DataFrame:
    """``gram, alpha, gamma`` of every gram and context of ``rows`` (_t).

    ``alpha`` is null for a context that is no gram, ``gamma`` for a gram that is no context.
    """
    top = (rows.select("_t").mapInArrow(_counted, "gram string, n long")
           .groupBy("gram").agg(F.sum("n").alias("n")))
    top = stored(top, "grams")
    tails = F.transform(F.sequence(F.lit(1), F.char_length("gram")), lambda k: F.col("gram").substr(k, F.lit(ORDER)))
    every = top.select(F.explode(tails).alias("gram")).distinct()
    shorter = (every.filter(F.char_length("gram") > 1).select(F.expr("substring(gram, 2)").alias("gram"))
               .groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    grams = stored(top.unionByName(shorter).withColumn("k", F.char_length("gram")), "adjusted")

    def seen(n):
        return F.sum(F.when(F.col("n") == n, 1).otherwise(0))

    counts = grams.groupBy("k").agg(*[seen(n).alias(f"n{n}") for n in range(1, 5)])
    share = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(n):
        # Where too few grams are seen so often, half a count.
        raw = F.lit(float(n)) - (n + 1) * share * F.col(f"n{n + 1}") / F.col(f"n{n}")
        usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col(f"n{n}") > 0)
        return F.when(usable & (raw > 0), raw).otherwise(0.5).alias(f"d{n}")

    discounts = counts.select("k", discount(1), discount(2), discount(3))  # ORDER rows
    own = (F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
    grams = grams.join(F.broadcast(discounts), "k").select(
        "gram", "n", own.alias("d"), F.expr("substring(gram, 1, k - 1)").alias("context"))
    contexts = grams.groupBy("context").agg(F.sum("n").alias("all"), F.sum("d").alias("left"))
    none = F.lit(None).cast("double")
    alphas = grams.join(contexts, "context").select(
        "gram", ((F.col("n") - F.col("d")) / F.col("all")).alias("alpha"), none.alias("gamma"))
    gammas = contexts.select(F.col("context").alias("gram"), none.alias("alpha"), (F.col("left") / F.col("all")).alias("gamma"))
    return alphas.unionByName(gammas).groupBy("gram").agg(F.max("alpha").alias("alpha"), F.max("gamma").alias("gamma"))


def _mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves every bit of the output."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return values ^ (values >> np.uint64(33))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)


def _extended(hashes: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hash of each gram with one character put in front."""
    return _mixed(hashes + points * np.uint64(0x9E3779B97F4A7C15))


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = batch.column(0).to_pylist()
        hashes = np.zeros(len(grams), np.uint64)
        for k in range(1, ORDER + 1):
            of = [i for i, g in enumerate(grams) if len(g) >= k]
            if of:
                hashes[of] = _extended(hashes[of], _points("".join(grams[i][-k] for i in of)))
        yield pa.record_batch([pa.array(hashes.view(np.int64)), batch.column(1), batch.column(2)],
                              names=["hash", "alpha", "gamma"])


class Arrays:
    """The model as arrays sorted by hash."""

    def __init__(self, hashes: np.ndarray, alpha: np.ndarray, gamma: np.ndarray):
        self.hashes, self.alpha, self.gamma = hashes, alpha, gamma

    @staticmethod
    def of(table: DataFrame) -> Arrays:
        """Pulls a table, whose size the caller has checked; a null is not a number."""
        hashes, alpha, gamma = (c.to_numpy() for c in table.toArrow().columns)
        hashes = hashes.view(np.uint64)
        order = np.argsort(hashes)
        hashes = hashes[order]
        if (hashes[1:] == hashes[:-1]).any():
            raise ValueError("two grams of the model have one hash")
        return Arrays(hashes, alpha[order], gamma[order])

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash stands; behind the end if nowhere."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.hashes, hashes)
        found = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes
        return np.where(found, at, len(self.hashes))

    def scores(self, words: list[bytes], uniform: float) -> np.ndarray:
        """Sum over each word's characters, and its end, of the natural logarithm of their probability."""
        return np.concatenate([np.zeros(0)] + [self._scores(own, uniform) for own, in _pieces(words)])

    def _scores(self, words: list[bytes], uniform: float) -> np.ndarray:
        grams = Grams(words)
        last, depth, points = grams.first, grams.depth[grams.first], grams.points.astype(np.uint64) + np.uint64(1)
        alpha, gamma = np.append(self.alpha, np.nan), np.append(self.gamma, np.nan)
        own, context = np.zeros(len(last), np.uint64), np.zeros(len(last), np.uint64)
        p = np.full(len(last), uniform)
        for k in range(1, ORDER + 1):
            inside = np.flatnonzero(depth >= k)
            # The context goes one character less far; its gram ends one place earlier.
            share = gamma[self.places(context[inside])]
            letter = points[last[inside] - (k - 1)]
            own[inside] = _extended(own[inside], letter)
            if k < ORDER:
                longer = inside[depth[inside] > k]
                context[longer] = _extended(context[longer], points[last[longer] - k])
            known = ~np.isnan(share)
            inside, share = inside[known], share[known]
            p[inside] = np.nan_to_num(alpha[self.places(own[inside])]) + share * p[inside]
        return np.add.reduceat(np.log(p)[grams.of], np.cumsum(grams.sizes) - grams.sizes)


def repeated_words(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each text, words inside a window of three that stands twice or more in it.

    ``ids`` holds the numbers of the words of all texts, one text after the other.
    """
    text = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero(text[:-2] == text[2:])
    # Few windows stand twice: equal hashes first, then the words themselves.
    hashes = np.zeros(len(at), np.uint64)
    for column in (text[at], ids[at], ids[at + 1], ids[at + 2]):
        hashes = _mixed(hashes + (column.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(hashes)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    inside = np.zeros(len(ids), bool)
    if equal.any():
        at = at[order[np.append(equal, False) | np.append(False, equal)]]
        order = np.lexsort((ids[at + 2], ids[at + 1], ids[at], text[at]))
        at = at[order]
        same = text[at[1:]] == text[at[:-1]]
        for k in range(3):
            same &= ids[at[1:] + k] == ids[at[:-1] + k]
        for k in range(3):
            inside[at[1:][same] + k] = inside[at[:-1][same] + k] = True
    return np.bincount(text, inside, len(sizes)).astype(np.int64)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


class Numbers(dict):
    """Numbers words as they come; ``new`` lists those not yet looked up."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        number = self[word] = len(self)
        return number


def metrics(texts: list[bytes], numbers: Numbers) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Numbers of the words of all texts, words of each, and the five counts of each text."""
    split = [t.split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
    letters, symbols = [_chosen(t, _LETTER) for t in texts], [_chosen(t, _SYMBOL) for t in texts]
    return ids, sizes, [sizes, np.array(letters), np.array(symbols), np.array([repeated_lines(t) for t in texts]),
                        repeated_words(ids, sizes)]


#: Bytes that begin a character of a word, and those of symbols.
_LETTER = np.array([b & 0xC0 != 0x80 and not bytes([b]).isspace() for b in range(256)])
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))


def _chosen(text: bytes, which: np.ndarray) -> int:
    return int(np.count_nonzero(which[np.frombuffer(text, np.uint8)]))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _uniform(table: DataFrame) -> float:
    """One over the different characters of all words, an end and one unknown."""
    return 1.0 / (table.filter((F.char_length("gram") == 1) & F.col("alpha").isNotNull()).count() + 1)


def _by_arrays(rows: DataFrame, arrays: Arrays, uniform: float) -> DataFrame:
    """Counts and log probability of every row, each different word of a task looked up once."""
    shared = rows.sparkSession.sparkContext.broadcast((arrays.hashes, arrays.alpha, arrays.gamma))

    def run(batches):
        held, numbers, known = Arrays(*shared.value), Numbers(), np.zeros(0)
        for batch in sliced(batches):
            if len(numbers) > HELD:
                numbers, known = Numbers(), np.zeros(0)
            ids, sizes, counts = metrics(batch.column(1).cast(pa.binary()).to_pylist(), numbers)
            known = np.append(known, held.scores(numbers.new, uniform))
            numbers.new.clear()
            logs = np.bincount(np.repeat(np.arange(len(sizes)), sizes), known[ids], len(sizes))
            yield pa.record_batch([batch.column(0), batch.column(2), *[pa.array(c, pa.int64()) for c in counts],
                                   pa.array(logs, pa.float64())],
                                  names=["_id", "_l", *[m.split()[0] for m in _METRICS.split(", ")], "logs"])

    return rows.mapInArrow(run, f"_id long, _l string, {_METRICS}, logs double")


def _word_rows(batches) -> Iterator[pa.RecordBatch]:
    """Different words of each text: row, word, how often."""
    for batch in sliced(batches, 200):
        out = [(row, word, n) for row, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
               for word, n in Counter(text.split()).items()]
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()).view(pa.string()),
                               pa.array(columns[2], pa.int64())], names=["_row", "word", "n"])


def _letter_rows(batches) -> Iterator[pa.RecordBatch]:
    """Each word's characters with the grams that end there: word, place, length, gram, context."""
    for batch in sliced(batches, 200):
        for word in batch.column(0).to_pylist():
            marked = BEGIN + word + END
            for first in range(1, len(marked), 1000):
                out = [(k, n, marked[k - n + 1:k + 1], marked[k - n + 1:k])
                       for k in range(first, min(first + 1000, len(marked))) for n in range(1, min(ORDER, k + 1) + 1)]
                at, n, gram, context = zip(*out)
                yield pa.record_batch([pa.array([word] * len(out), pa.string()), pa.array(at, pa.int64()),
                                       pa.array(n, pa.int32()), pa.array(gram, pa.string()), pa.array(context, pa.string())],
                                      names=["word", "place", "k", "gram", "context"])


def _counts_only(batches) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        counts = metrics(batch.column(1).cast(pa.binary()).to_pylist(), Numbers())[2]
        yield pa.record_batch([batch.column(3), batch.column(0), batch.column(2), *[pa.array(c, pa.int64()) for c in counts]],
                              names=["_row", "_id", "_l", *[m.split()[0] for m in _METRICS.split(", ")]])


def _by_joins(rows: DataFrame, table: DataFrame, uniform: float) -> DataFrame:
    """The same as ``_by_arrays`` for a model of any size.

    The different words meet the model's grams in a join; hot grams and words are on a
    side that Spark splits when it is skewed. A word goes by its hash, so that a long one
    is not copied to each of its characters.
    """
    numbered = stored(rows.select("_id", "_t", "_l", F.monotonically_increasing_id().alias("_row")), "numbered")
    words = numbered.select("_row", "_t").mapInArrow(_word_rows, "_row long, word string, n long")
    parts = stored(words.withColumn("key", F.unhex(F.sha2("word", 256))), "words")
    different = stored(parts.groupBy("key").agg(F.first("word").alias("word")), "different")
    letters = different.select("word").mapInArrow(
        _letter_rows, "word string, place long, k int, gram string, context string").select(
        F.unhex(F.sha2("word", 256)).alias("key"), "place", "k", "gram", "context")
    own = table.filter("alpha IS NOT NULL").select("gram", "alpha")
    left = table.filter("gamma IS NOT NULL").select(F.col("gram").alias("context"), "gamma")
    met = letters.join(left, "context").join(own, "gram", "left").select(
        "key", "place", F.struct("k", F.coalesce("alpha", F.lit(0.0)).alias("alpha"), "gamma").alias("step"))
    steps = met.groupBy("key", "place").agg(F.array_sort(F.collect_list("step")).alias("steps"))  # ORDER at most
    chance = F.aggregate("steps", F.lit(uniform), lambda p, s: s.alpha + s.gamma * p)
    scores = steps.groupBy("key").agg(F.sum(F.log(chance)).alias("score"))
    logs = (parts.select("_row", "key", "n").join(scores, "key")
            .groupBy("_row").agg(F.sum(F.col("n") * F.col("score")).alias("logs")))
    counts = numbered.select("_id", "_t", "_l", "_row").mapInArrow(_counts_only, f"_row long, _id long, _l string, {_METRICS}")
    return counts.join(logs, "_row", "left").drop("_row").withColumn("logs", F.coalesce("logs", F.lit(0.0)))


def _median(bins: DataFrame, value: str) -> DataFrame:
    """Median of binned values for each language, from counts of bins only."""
    from pyspark.sql import Window

    below = Window.partitionBy("lang").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (bins.withColumn("_up", F.sum("n").over(below)).withColumn("_all", F.sum("n").over(Window.partitionBy("lang")))
            .filter(2 * F.col("_up") >= F.col("_all")).groupBy("lang").agg(F.min(value).alias("median")))


def bands(scored: DataFrame) -> DataFrame:
    """``lang, low, high``: bounds of the logarithm of perplexity, from all documents that pass the base rules.

    The distances below and above the median are medians over the documents on that side,
    without those in the median's own bin, so that a group of copies there doesn't narrow the bands.
    """
    bins = (scored.filter(~base_failed())
            .groupBy(F.col("_l").alias("lang"), F.round(F.col("log_perplexity") / BIN).cast("long").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))
    bins = stored(bins, "bins")
    middle = stored(_median(bins, "bin"), "medians")
    away = bins.join(middle, "lang").select("lang", (F.col("bin") - F.col("median")).alias("off"), "n")
    low = _median(away.filter("off < 0").withColumn("off", -F.col("off")), "off").withColumnRenamed("median", "below")
    high = _median(away.filter("off > 0"), "off").withColumnRenamed("median", "above")
    spread = middle.join(low, "lang", "left").join(high, "lang", "left")

    def distance(side, times):
        return times * F.greatest(F.coalesce(F.col(side) * BIN, F.lit(0.0)), F.lit(LEAST_SPREAD))

    return spread.select("lang", (F.col("median") * BIN - distance("below", BELOW)).alias("low"),
                         (F.col("median") * BIN + distance("above", ABOVE)).alias("high"))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts, perplexity and verdict of every row.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, perplexity,
    low, high, base_failed, kept``. Null and empty texts have no words, no perplexity and fail;
    a null language is a language of its own. Repeated rows count as often as they occur and
    are each judged; an empty table gives no rows.
    """
    rows = split_rows(df, id_col, text_col, lang_col)
    table = stored(model(rows), "model")
    uniform = _uniform(table)
    if ROW_BYTES * table.count() <= common.BROADCAST_LIMIT:
        arrays = Arrays.of(table.mapInArrow(_hashed, "hash long, alpha double, gamma double"))
        scored = _by_arrays(rows, arrays, uniform)
    else:
        scored = _by_joins(rows, table, uniform)
    scored = stored(scored.withColumn("log_perplexity", F.when(F.col("n_words") > 0, -F.col("logs") / F.col("n_words"))),
                    "scored")
    judged = scored.join(stored(bands(scored), "bands"), F.col("_l") == F.col("lang"), "left")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    return judged.select(
        F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.exp("log_perplexity").alias("perplexity"), F.exp("low").alias("low"), F.exp("high").alias("high"),
        base_failed().alias("base_failed"), (~base_failed() & inside).alias("kept"))

"""The n-gram model, the counts and the bands against definitions written out."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from mercantil.llm import common, perplexity_rules, queries

SCHEMA = "doc_id long, text string, lang string, gram string, n long, low string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_counts(text):
    text, words = text or "", words_of(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(i, i + 3)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if words_of(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(inside)


def brute_model(words, order):
    """Modified Kneser-Ney with interpolation, straight from the counts of all words."""
    raw = Counter()
    for word in words:
        marked = " " + word + "\n"
        for k in range(1, len(marked)):
            for n in range(1, min(order, k + 1) + 1):
                raw[marked[k - n + 1:k + 1]] += 1
    before = defaultdict(set)
    for gram in raw:
        if len(gram) > 1:
            before[gram[1:]].add(gram[0])
    count = {g: n if len(g) == order or g[0] == " " else len(before[g]) for g, n in raw.items()}
    discounts = {}
    for k in range(1, order + 1):
        n = [0] + [sum(1 for g, c in count.items() if len(g) == k and c == m) for m in range(1, 5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        for m in (1, 2, 3):
            d = m - (m + 1) * y * n[m + 1] / n[m] if n[1] and n[2] and n[m] else 0
            discounts[k, m] = d if d > 0 else 0.5
    followed = defaultdict(list)
    for gram, c in count.items():
        followed[gram[:-1]].append((c, discounts[len(gram), min(c, 3)]))
    base = 1 / (sum(len(g) == 1 for g in count) + 1)

    def chance(context, letter):
        rest = chance(context[1:], letter) if context else base
        if context not in followed:
            return rest
        total = sum(c for c, _ in followed[context])
        c = count.get(context + letter, 0)
        own = c - discounts[len(context) + 1, min(c, 3)] if c else 0
        return own / total + sum(d for _, d in followed[context]) / total * rest

    def score(word):
        marked = " " + word + "\n"
        return sum(math.log(chance(marked[max(0, k - order + 1):k], marked[k])) for k in range(1, len(marked)))

    return score


def odd_rows():
    rng = random.Random(4)
    pool = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(90)] + ["日本", "x\x85y", "😀"]
    rows = []
    for k in range(120):
        words = rng.choices(pool, k=rng.randint(40, 120))
        rows.append((k, "".join(w + rng.choice([" ", " ", " ", "\n", "\t "]) for w in words), rng.choice(["en", "de"])))
    rows += [(200, None, "en"), (201, "", None), (202, " \n\n ", "de"), (203, "one two three " * 40, "en"),
             (204, "a b c\n" * 3 + "a b c \n" + "\n\n" + "a|b <#> $%&*", "en"), (None, rows[0][1], "en"),
             (5, rows[5][1], "en"), (5, rows[5][1], "en"), (205, "q" * 5000 + " " + rows[1][1], None),
             (206, " ".join("".join(rng.choices("#%&$", k=9)) for _ in range(70)), "en")]
    return rows


@pytest.fixture(scope="module")
def model():
    rows = odd_rows()
    return rows, brute_model([w for _, t, _ in rows for w in words_of(t)], perplexity_rules.ORDER)


def brute_bands(rows):
    logs = defaultdict(list)
    for _, lang, counts, value in rows:
        if counts[0] >= 50 and 100 * counts[4] <= 50 * counts[0]:
            logs[lang].append(round(value / perplexity_rules.BIN))
    middle = lambda v: sorted(v)[(len(v) + 1) // 2 - 1] if v else 0
    out = {}
    for lang, own in logs.items():
        center = middle(own)
        low, high = middle([center - x for x in own if x < center]), middle([x - center for x in own if x > center])
        out[lang] = ((center * perplexity_rules.BIN - perplexity_rules.BELOW * max(low * perplexity_rules.BIN, perplexity_rules.LEAST_SPREAD)),
                     (center * perplexity_rules.BIN + perplexity_rules.ABOVE * max(high * perplexity_rules.BIN, perplexity_rules.LEAST_SPREAD)))
    return out


@pytest.mark.parametrize("limit", [common.BROADCAST_LIMIT, 0])
def test_rules(spark, monkeypatch, model, limit):
    """Both ways to score, sorted arrays and joins, give the model's values."""
    monkeypatch.setattr(common, "BROADCAST_LIMIT", limit)
    rows, score = model
    scored = []
    for key, text, lang in rows:
        words = words_of(text)
        scored.append((key, lang or "", brute_counts(text), -sum(map(score, words)) / len(words) if words else None))
    bounds = brute_bands(scored)
    expected = []
    for key, lang, counts, value in scored:
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        kept = not failed and bounds[lang][0] <= value <= bounds[lang][1]
        expected.append((str(key), counts, value, failed, kept))
    found = perplexity_rules.quality_rules(frame(spark, rows))
    own = [(str(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words),
            None if r.perplexity is None else math.log(r.perplexity), r.base_failed, r.kept) for r in found.collect()]
    order = lambda r: (r[0], r[1], r[2] or 0)
    for a, b in zip(sorted(own, key=order), sorted(expected, key=order), strict=True):
        assert a[:2] == b[:2] and a[3:] == b[3:] and (a[2] == b[2] or a[2] == pytest.approx(b[2], rel=1e-9))
    kept = {r[0]: r[4] for r in own}
    assert not kept["206"] and not kept["203"] and sum(kept.values()) > 80


def test_small_tables(spark):
    assert perplexity_rules.quality_rules(frame(spark, [])).count() == 0
    found = perplexity_rules.quality_rules(frame(spark, [(1, None, None), (2, "", "en")])).collect()
    assert sorted((r.doc_id, r.n_words, r.perplexity, r.base_failed, r.kept) for r in found) == [
        (1, 0, None, True, False), (2, 0, None, True, False)]


def test_lines_and_windows():
    rng = random.Random(8)
    for _ in range(500):
        text = "".join(rng.choices("ab \n", k=rng.randint(0, 60)))
        others = [rng.choice(["", "a b a b a", text]).encode() for _ in range(3)]
        counts = perplexity_rules.metrics([*others, text.encode(), *others], perplexity_rules.Numbers())[2]
        assert tuple(int(c[3]) for c in counts) == brute_counts(text)


@pytest.mark.parametrize("letters", ["abc", "".join(map(chr, range(0x4E00, 0x4E00 + 9000)))])
def test_grams(letters):
    """Also with more characters than five of them fit into one number."""
    rng = random.Random(5)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(3000)] + [letters]
    grams = perplexity_rules.Grams([w.encode() for w in words])
    strings, at = grams.strings(), 0
    assert len(set(strings)) == len(strings)
    for word, size in zip(words, grams.sizes.tolist()):
        marked = " " + word + "\n"
        assert [strings[k] for k in grams.of[at:at + size]] == [marked[max(0, k - 5):k] for k in range(2, len(marked) + 1)]
        at += size


def test_pieces_of_words(monkeypatch):
    """Words are scored alike, however many are looked up at once."""
    rng = random.Random(2)
    grams = ["", "a", "b", "\n", " a", "ab", "b\n"]
    points = [perplexity_rules._points(g) for g in grams]  # of each character
    hashes = []
    for own in points:
        h = np.zeros(1, np.uint64)
        for p in own[::-1]:
            h = perplexity_rules._extended(h, np.array([p]))
        hashes.append(h[0])
    order = np.argsort(hashes)
    arrays = perplexity_rules.Arrays(np.array(hashes)[order], np.array([np.nan, .3, .2, .1, .4, .5, .6])[order],
                                     np.array([.2, .3, .4, np.nan, .5, np.nan, np.nan])[order])
    words = ["".join(rng.choices("abc", k=rng.randint(1, 9))).encode() for _ in range(50)]
    whole = arrays.scores(words, 0.25).tolist()
    monkeypatch.setattr(perplexity_rules, "LETTERS", 5)
    assert arrays.scores(words, 0.25).tolist() == whole


def test_query(spark, data):
    found = queries.op11_perplexity_rules(spark, data)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.kept and r.base_failed)

"""Periodic runs against a search by definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from mercantil.llm import periodic_runs, queries

SCHEMA = "doc_id long, text string, _id string, _t int, runs string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1, None) for k, t in rows], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words):
    found, seen, n = [], set(), len(words)
    for q in range(1, n // 4 + 1):
        begin = 0
        for i in range(n - q + 1):
            if i < n - q and words[i] == words[i + q]:
                continue
            # words[begin : i + q] has period q and goes no further
            if i + q - begin >= max(6, 4 * q) and (begin, i + q) not in seen:
                seen.add((begin, i + q))
                found.append((begin, i + q - begin, q))
            begin = i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_folded(key, text):
    words = words_of(text)
    n, h = len(words), zlib.crc32(str(key).encode())
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_kept(words, runs):
    gone = set()
    for start, length, q in runs:
        gone.update(range(start + q, start + length))
    return [w for i, w in enumerate(words) if i not in gone]


def some_words(rng):
    kind = rng.random()
    if kind < 0.3:
        return rng.choices("ab", k=rng.randint(0, 90))
    if kind < 0.5:
        return rng.choices("abc", k=rng.randint(1, 9)) * rng.randint(1, 12) + rng.choices("ab", k=rng.randint(0, 9))
    if kind < 0.6:
        return ["a"] * rng.randint(0, 60)
    if kind < 0.8:
        block = rng.choices("abcdefgh", k=rng.randint(1, 40))
        return rng.choices("abcd", k=5) + (block * 7)[:rng.randint(1, 7 * len(block))] + rng.choices("abcd", k=9)
    inner = rng.choices("ab", k=2) * 5
    return (inner + ["c"]) * rng.randint(1, 6)


@pytest.mark.parametrize("pairs", [periodic_runs.PAIRS, 7])
def test_runs_equal_brute_force(monkeypatch, pairs):
    monkeypatch.setattr(periodic_runs, "PAIRS", pairs)
    rng = random.Random(3)
    many = [some_words(rng) for _ in range(400 if pairs > 7 else 60)]
    numbers, ids = {}, []
    for k, words in enumerate(many):
        ids += [numbers.setdefault((k, w), len(numbers)) for w in words]
    sizes = np.array([len(w) for w in many])
    found = list(zip(*(x.tolist() for x in periodic_runs.find_runs(np.array(ids, np.int64), sizes))))
    expected, first = [], 0
    for words in many:
        expected += [(s + first, n, q) for s, n, q in brute_runs(words)]
        first += len(words)
    assert found == expected and len(found) > 50


def test_extensions():
    rng = random.Random(4)
    for _ in range(80):
        n = rng.randint(1, 120)
        words = (rng.choices(range(3), k=rng.randint(1, 8)) * n)[:n] if rng.random() < 0.5 else rng.choices(range(2), k=n)
        found = periodic_runs.Extensions(np.array(words))
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
        if not pairs:
            continue
        lce = found.lce(*map(np.array, zip(*pairs))).tolist()
        for (i, j), own in zip(pairs, lce):
            same = 0
            while max(i, j) + same < n and words[i + same] == words[j + same]:
                same += 1
            assert own == same


def odd_rows():
    rng = random.Random(7)
    rows = [(k, " ".join(some_words(rng))) for k in range(250)]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "a"), (304, "  b\x1cb c\x85 " * 9), (None, "x y " * 9),
             (None, None), (5, rows[5][1]), (5, rows[5][1]), (6, "tie " * 6 + "end " * 6), (305, "long words here " * 4000)]
    return rows


def test_rows(spark, monkeypatch):
    rows = odd_rows()
    # Small groups put texts before and behind a group's border.
    for size in (periodic_runs.GROUP_WORDS, 50):
        monkeypatch.setattr(periodic_runs, "GROUP_WORDS", size)
        found = periodic_runs.periodic_runs(frame(spark, rows)).collect()
        own = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found)
        expected = []
        for key, text in rows:
            words = words_of(text)
            runs = brute_runs(words) if key != 305 else [(0, 12000, 3)]
            expected.append((str(key), len(words), runs, " ".join(brute_kept(words, runs))))
        assert own == sorted(expected)
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def test_query(spark, tmp_path):
    rows = [r for r in odd_rows() if r[0] != 305]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for key, text in rows:
        words = brute_folded(key, text)
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        expected.append((key, len(runs), *best, milli, sha("".join("%d,%d,%d\n" % r for r in runs)),
                         sha(" ".join(brute_kept(words, runs)))))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))

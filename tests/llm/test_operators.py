"""Each text operator against a brute-force version, on small made-up and given tables."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer, models

from mercantil.llm import (
    byte_bpe, components, decontaminate, exact_dedup, jaccard_join, licenses, quality, suffix_dedup, token_files,
    toxicity, unigram_count,
)

SCHEMA = "doc_id long, text string, _id string, _t int, label string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def frame(spark, rows):
    """Rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(k, t, "x", 1, None) for k, t in rows], SCHEMA)


def odd_rows():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta!", "theta", "日本", "x" * 30]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(30)]
    texts += [t + " tail" for t in texts[:10]] + texts[:10]
    texts += ["", None, " \n\t", "a", "ha" * 4000, " ".join(texts[:8])]
    rows = list(enumerate(texts)) + [(None, texts[3]), (7, texts[7]), (7, texts[7]), (8, "other text of a known id")]
    rng.shuffle(rows)
    return rows


EMPTY: list = []


def test_exact_groups(spark):
    rows = odd_rows()
    found = exact_dedup.exact_groups(frame(spark, rows)).collect()
    groups = {}
    for key, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((key, len(text or "")))
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r.text_sha256, []).append(r)
    for norm, members in groups.items():
        own = by[hashlib.sha256(norm.encode()).hexdigest()]
        longest = max(n for _, n in members)
        keep = min((k for k, n in members if n == longest), key=lambda k: (k is None, k))
        assert {(r.keep_id, r.group_size) for r in own} == {(keep, len(members))}
        assert [r.doc_id for r in own if r.kept] == [keep]
    kept = exact_dedup.drop_exact_copies(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "_id", "_t", "label"] and kept.count() == len(groups)
    assert exact_dedup.exact_groups(frame(spark, EMPTY)).count() == 0


@pytest.mark.parametrize("block", [4096, 5, 1])
def test_byte_bpe_equals_library(block):
    ranks = byte_bpe.read_ranks(open(RANKS, "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN, block=block, cache=500)
    rng = random.Random(1)
    parts = ["a", "'", "re", "'ll", " ", "  ", "\n", "12", "!", "é", "日", "\x1c", "\x85", "😀", "the"]
    for text in ["", "a" * 700, " " * 99] + ["".join(rng.choices(parts, k=rng.randint(1, 50))) for _ in range(300)]:
        ids = memoryview(own.encode(text)).cast("I").tolist()
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_byte_bpe_rows(spark):
    rows = odd_rows()
    tokens = byte_bpe.bpe_tokens(frame(spark, rows), RANKS, public_tokenizers.PATTERN)
    found = byte_bpe.bpe_texts(tokens, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in found) == sorted((str(k), (t or "").encode()) for k, t in rows)
    assert byte_bpe.bpe_tokens(frame(spark, EMPTY), RANKS, public_tokenizers.PATTERN).count() == 0


def test_unigram_counts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = unigram_count.zipf_vocabulary(open(path, "rb").read())
    library = Tokenizer(models.Unigram([("<unk>", min(s for _, s in vocabulary))] + vocabulary, 0, False))
    rows = odd_rows()
    for r in unigram_count.token_counts(frame(spark, rows), path).collect():
        own = {len(library.encode("▁" + t.replace(" ", "▁")).ids) if t else 0 for t in
               ((t or "") for k, t in rows if k == r.doc_id)}
        assert r.n_tokens in own


def test_suffix_array_and_prefixes():
    rng = random.Random(2)
    for _ in range(60):
        data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 150))) if rng.random() < 0.6 else b"abab" * 30
        text = np.frombuffer(data, np.uint8)
        found = suffix_dedup.suffix_array(text, 256)
        assert [data[i:] for i in found] == sorted(data[i:] for i in range(len(data)))
        lcp = suffix_dedup.common_prefixes(suffix_dedup._words(text), found, 40)
        for k in range(1, len(data)):
            a, b = data[found[k]:], data[found[k - 1]:]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[k] == min(40, same)


def brute_removed(rows):
    seen = {}
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            w = data[i:i + 50]
            seen[w] = min(seen.get(w, 1 << 62), key if key is not None else 1 << 62)
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 49):
            if seen[data[i:i + 50]] < (key if key is not None else 1 << 62):
                gone[i:i + 50] = True
        yield str(key), len(data), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), \
            np.frombuffer(data, np.uint8)[~gone].tobytes()


def test_suffix_dedup(spark):
    rows = odd_rows()
    found = suffix_dedup.without_repeats(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == sorted(brute_removed(rows))
    assert suffix_dedup.without_repeats(frame(spark, EMPTY)).count() == 0


def test_suffix_dedup_rows_without_id(spark):
    """Thousands of rows that share a null or repeated id take about as long as with ids, and give whole results."""
    rng = random.Random(31)
    some = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    shared = [some(90) for _ in range(40)]
    texts = [some(40) + rng.choice(shared) + some(40) if k % 3 else rng.choice(shared) for k in range(4000)]
    seconds = {}
    for name, key in (("ids", lambda k: k), ("null", lambda k: None if k > 20 else k), ("same", lambda k: 7 if k > 20 else k % 9)):
        rows = [(key(k), t) for k, t in enumerate(texts)]
        begin = time.monotonic()
        found = suffix_dedup.without_repeats(frame(spark, rows)).collect()
        seconds[name] = time.monotonic() - begin
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == sorted(brute_removed(rows))
    assert max(seconds.values()) < 4 * seconds["ids"] + 5, seconds


def test_suffix_dedup_passage_edges(spark, monkeypatch):
    """A passage in many documents: anchors at its edges would collect a run of each of them."""
    rng = random.Random(12)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage = some(200)
    rows = [(k, some(80) + passage + some(80)) for k in range(150)]
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", 40)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    hot = suffix_dedup.hot_anchors(suffix_dedup.texts(frame(spark, rows), "doc_id", "text"), 0)
    assert 0 < len(hot) < 10
    for listed, bounded in ((hot[:0], False), (hot, True)):
        meet = {}
        for _, text in rows:
            data = text.encode()
            anchors = np.unique(suffix_dedup.anchor_runs(data)[0] & suffix_dedup.MASK)
            for run, key, _, _ in suffix_dedup.split_runs(data, anchors, listed):
                meet.setdefault(key, set()).add(run)
        assert (max(map(len, meet.values())) < 40) == bounded
    found = suffix_dedup.without_repeats(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == sorted(brute_removed(rows))


def test_suffix_dedup_sorts_runs_that_may_share_a_window(monkeypatch):
    """Different runs of one bucket that share no window are not sorted."""
    rng = random.Random(44)
    some = lambda n: bytes(rng.choices(b"abcdefgh ", k=n))
    passage = some(60)
    runs = [some(70) for _ in range(300)] + [passage + some(9), some(12) + passage, some(49) + b"x", b"ab" * 40]
    owners = np.array([rng.randint(0, 400) for _ in runs])
    sorted_bytes = []
    real = suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text, *rest: sorted_bytes.append(len(text)) or real(text, *rest))
    found = suffix_dedup.covered_windows(runs, owners)
    least: dict = {}
    for run, owner in zip(runs, owners.tolist()):
        for i in range(len(run) - 49):
            least[run[i:i + 50]] = min(least.get(run[i:i + 50], owner), owner)
    for run, owner, hit in zip(runs, owners.tolist(), found):
        assert hit.tolist() == [least[run[i:i + 50]] < owner for i in range(len(run) - 49)]
    assert any(hit.any() for hit in found) and sum(sorted_bytes) < 300


def test_suffix_dedup_buckets_sent_together(spark, monkeypatch):
    """Many more buckets than messages of a batch: the result is the same."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 512)
    monkeypatch.setattr(suffix_dedup, "GROUPS", 1)
    sent = []
    real = suffix_dedup._covered
    monkeypatch.setattr(suffix_dedup, "_covered", lambda *a: sent.append(a[-2:]) or real(*a))
    rows = odd_rows()
    found = suffix_dedup.without_repeats(frame(spark, rows)).collect()
    assert sent[0][0] > 8 * sent[0][1] > 8
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == sorted(brute_removed(rows))


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    parent = list(range(500))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.label) for r in found} == {(x, root(x)) for a, b in edges if a != b for x in (a, b)}


def test_jaccard_classes(spark, monkeypatch):
    rng = random.Random(9)
    base = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=120)) for _ in range(6)]
    texts = list(base)
    for t in base:
        for _ in range(12):
            w = t.split()
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    rows = list(enumerate(texts)) + [(200, ""), (201, None), (202, "one two"), (203, "one two"), (None, texts[0]), (5, texts[5])]
    sets = [set(jaccard_join.shingles(t or "").tolist()) for _, t in rows]
    n = len(rows)
    linked = [[a != b and bool(sets[a] and sets[b]) and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
               for b in range(n)] for a in range(n)]
    expected = sorted((str(k), sum(linked[i])) for i, (k, _) in enumerate(rows))
    # Small limits send the made-up groups through splits, chunks and blocks as well.
    for largest, block in ((4096, 2048), (16, 8)):
        monkeypatch.setattr(jaccard_join, "LARGEST", largest)
        monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", block)
        found = jaccard_join.near_classes(frame(spark, rows)).collect()
        assert sorted((str(r.doc_id), r.n_links) for r in found) == expected
    classes = {}
    for r in found:
        classes.setdefault(r.class_id, set()).add(r.doc_id)
    for i, (k, _) in enumerate(rows):
        for j in range(n):
            if linked[i][j]:
                assert any({k, rows[j][0]} <= c for c in classes.values())
    kept = jaccard_join.drop_near_copies(frame(spark, rows))
    assert kept.count() == len(classes)
    assert jaccard_join.near_classes(frame(spark, EMPTY)).count() == 0


def test_jaccard_large_nodes(spark, monkeypatch):
    """Any two sets that share the token of a run meet, also in a node beyond the limit."""
    rng = random.Random(21)
    words = rng.choices("abcdefghijklmnopqrstuvwxyz", k=120)
    rows = []
    for k in range(40):  # a chain: neighbours are linked, the ends have little in common
        words[3 * k % 120] = f"new{k}"
        rows.append((k, " ".join(words)))
    monkeypatch.setattr(jaccard_join, "LARGEST", 4)
    reps = jaccard_join._embedded(frame(spark, rows), "doc_id", "text").withColumnRenamed("_row", "_rep")
    units = {}
    for *unit, rep in jaccard_join._leaves(reps).collect():
        units.setdefault(tuple(unit), set()).add(rep)
    together = {(a, b) for members in units.values() for a in members for b in members if a != b}
    nodes = {}
    for r in jaccard_join._first_nodes(reps).collect():
        nodes.setdefault(r["_node"], set()).add(r["_rep"])
    assert max(map(len, nodes.values())) > 8
    assert {(a, b) for members in nodes.values() for a in members for b in members if a != b} <= together
    sets = [set(jaccard_join.shingles(t).tolist()) for _, t in rows]
    linked = [sum(a != b and len(a & b) / len(a | b) >= 0.8 for b in sets) for a in sets]
    assert sorted((r.doc_id, r.n_links) for r in jaccard_join.near_classes(frame(spark, rows)).collect()) == list(enumerate(linked))


def test_near_copies_by_row(spark):
    """Rows without id and rows that share one are judged by their own text."""
    rng = random.Random(11)
    a, b, c, d, e, f = (" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=120)) for _ in range(6))
    rows = [(None, a), (None, b), (1, c), (None, c + " tail"), (None, ""), (None, " "),
            (2, d), (7, d + " tail"), (7, e), (9, f), (9, "other " + a[::-1]), (9, f), (9, f + " tail"),
            (10, ""), (10, ""), (None, b + " tail")]
    kept = [(r.doc_id, r.text) for r in jaccard_join.drop_near_copies(frame(spark, rows)).collect()]
    one_b = [x for x in kept if x[0] is None and x[1].startswith(b)]
    one_f = [x for x in kept if x[0] == 9 and x[1].startswith(f)]
    assert len(one_b) == len(one_f) == 1
    assert sorted(map(str, kept)) == sorted(map(str, one_b + one_f + [
        (None, a), (1, c), (None, ""), (None, " "), (2, d), (7, e), (9, "other " + a[::-1]), (10, ""), (10, "")]))
    found = jaccard_join.near_classes(frame(spark, rows)).collect()
    classes = {}
    for r in found:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(map(str, classes.values())) == sorted(map(str, [
        [None], [None, None], [1, None] if [1, None] in classes.values() else [None, 1], [None], [None],
        [2, 7] if [2, 7] in classes.values() else [7, 2], [7], [9, 9, 9], [9], [10], [10]]))
    assert {r.class_id for r in found if r.doc_id == 1} == {1} and {r.class_id for r in found if r.doc_id == 2} == {2}


def test_token_blocks():
    rng = np.random.default_rng(3)
    for size in (1, 255, 256, 257, 70_000):
        ids = rng.zipf(1.5, size) % 1000
        table = token_files.Table.from_counts(np.bincount(ids, minlength=1000))
        data = token_files.encode_block(ids, [(4, size), (None, 0)], 2, True, table)
        docs, first, resumed, out = token_files.decode_block(data, token_files.Table.loads(table.dumps()))
        assert (docs, first, resumed) == ([(4, size), (None, 0)], 2, True) and (out == ids).all()
        skipped = token_files.CHECK_STEPS * token_files.LANES
        if size > skipped:
            assert (token_files.decode_block(data, table, 1)[3] == ids[skipped:]).all()
        with pytest.raises(ValueError):
            token_files.decode_block(data[:-1] + bytes([data[-1] ^ 1]), table)
    a, b = b"some bytes", b"and many more" * 50
    assert token_files.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_token_files(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = odd_rows() + [(900, "one " * 140_000)]  # goes on in a second block
    token_files.write_ids(frame(spark, rows), str(tmp_path / "ids"), path, end_id=1)
    found = sorted(token_files.file_report(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((k for k, _ in rows), key=lambda k: (k is None, k))
    start = 0
    for r in found:
        ids = [np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for k, t in rows if k == r.doc_id]
        assert r.start == start and (r.n_tokens, r.ids_crc32) in {(len(x), zlib.crc32(x.tobytes())) for x in ids}
        start += r.n_tokens


def brute_align(query, text):
    best = 0
    row = [0] * (len(text) + 1)
    for q in query:
        new = [0]
        for j, t in enumerate(text):
            new.append(max(0, row[j] + (2 if q == t else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, max(new))
    return best


def test_alignment_and_leaks(spark):
    rng = np.random.default_rng(8)
    for _ in range(50):
        query, text = rng.integers(0, 6, rng.integers(1, 30)), rng.integers(0, 6, rng.integers(1, 60))
        assert decontaminate.align(query, text)[0] == brute_align(query.tolist(), text.tolist())
    words = random.Random(6)
    item = [" ".join(words.choices("abcdefghijklmnop", k=40)) for _ in range(4)]
    edited = item[2].split()
    for k in range(3, 40, 7):
        edited[k] = "other"
    rows = [(1, "x y z " * 30), (2, f"some text {item[0]} more"), (3, None), (4, ""), (5, " ".join(edited)),
            (6, item[1].upper()), (6, item[1]), (None, item[3]), (7, " ".join(item[3].split()[:10]))]
    bench = spark.createDataFrame(list(enumerate(item)) + [(9, None), (10, "too short")], "item_id long, text string")
    found = decontaminate.leaks(frame(spark, rows), bench).collect()
    # The first ten words of an item are no copy of it; "too short" is only found as a whole document.
    assert sorted((str(r.doc_id), r.item_id) for r in found) == sorted(
        [("2", 0), ("5", 2), ("6", 1), ("6", 1), ("None", 3)])
    kept = decontaminate.drop_leaks(frame(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 7]
    assert decontaminate.leaks(frame(spark, rows), bench.filter("item_id > 100")).count() == 0


def test_toxicity(spark):
    rng = random.Random(3)
    plain = [f"w{i}" for i in range(200)]

    def text(bad):
        w = rng.choices(plain, k=60)
        if bad:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(["scoundrel", "Rascal"])
        return " ".join(w)

    rows = [(i, text(i % 4 == 0)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn(frame(spark, rows), labels)
    more = rows + [(300, "a r4scаl and a sc0undrel, RASCAL!"), (301, None), (302, "")]
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(frame(spark, more), lexicon).collect()}
    assert all((scores[k] >= 0.3) == (k % 4 == 0) for k in range(200))
    assert scores[300] >= 0.3 > max(scores[301], scores[302])
    assert toxicity.drop_toxic(frame(spark, more), lexicon).count() == 152
    assert toxicity.learn(frame(spark, rows), labels.filter("toxic = 0")).weights == {}


def test_toxicity_longer_words(spark):
    """A kept whole word leaves room for longer ones, and a word that two forms match counts once."""
    rng = random.Random(13)
    plain = ["".join(rng.choices("bcdfghlmnprst", k=7)) for _ in range(400)]
    some = lambda: rng.sample(plain, 20)
    bad = [" ".join([*some(), word, *some()]) for word, n in (("vok", 90), ("vokx", 25), ("vokaz", 25)) for _ in range(n)]
    good = [" ".join(some() + some()) for _ in range(420)]
    rows = list(enumerate(bad + good))
    labels = spark.createDataFrame([(k, int(k < len(bad))) for k, _ in rows], "doc_id long, toxic int")
    lexicon = toxicity.learn(frame(spark, rows), labels)
    assert " vok " in lexicon.weights
    for word in ("vok", "vokx", "vokaz"):
        assert lexicon.score(" ".join([*some(), word, *some()])) >= toxicity.THRESHOLD
    twice = toxicity.Lexicon({" vokx": 2.0, " vokx ": 3.0}, {})
    assert [twice.total(t)[0] for t in ("a vokx b", "a vokxy b", "vokx vokx")] == [3.0, 2.0, 6.0]


def test_quality(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    net = quality.learn(docs, labels)
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, net).collect()}
    own = [(scores[r.doc_id], r.quality) for r in labels.collect()]
    good, bad = [s for s, q in own if q], [s for s, q in own if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(0 <= s <= 1 for s in scores.values())
    assert [r.score for r in quality.quality_scores(frame(spark, [(1, None)]), None).collect()] == [0.0]
    assert quality.non_negative_risk(np.array([50.0]), np.array([50.0]), 0.9)[0] == pytest.approx(0)
    net, rated = quality.rated(docs, labels)
    assert {r.doc_id: r.score for r in rated.collect()} == pytest.approx(scores)
    assert abs(np.mean([s >= quality.THRESHOLD for s in scores.values()]) - net.prior) < 2 * quality.SLACK
    none, empty = quality.rated(frame(spark, []), labels)
    assert none is None and empty.count() == 0


def test_quality_border():
    # The emptiest place near the share, in the middle of the longest one.
    assert quality.border({0: 50, 1: 0, 10: 50}, 0.5) == pytest.approx(5.5 * quality.BIN)
    assert quality.border({0: 490, 1: 10, 2: 3, 3: 10, 4: 487}, 0.5) == pytest.approx(2.5 * quality.BIN)
    # No bin is near enough: the one in which the share is reached.
    assert quality.border({7: 100}, 0.5) == pytest.approx(7.5 * quality.BIN)
    assert quality.border({0: 100, 1: 100, 2: 100}, 0.5) == pytest.approx(1.5 * quality.BIN)


def test_licenses(spark):
    from pyspark.sql import functions as F

    rows = [(1, "LICENSE", "Released under the MIT License."), (2, "src/a.py", "code"), (3, "src/LICENSE.txt", "Licensed under the Apache License, Version 2.0."),
            (4, "src/deep/er/b.py", ""), (5, "src/c.py", "x\nThis work is licensed under the GNU General Public License, version 3.\ny"),
            (6, None, None), (7, "other/d.py", "a driving license is needed")]
    df = spark.createDataFrame([(k, f"h/{p}" if p else None, t) for k, p, t in rows], "id long, path string, own string")
    found = {r.id: (r.license, r.origin, r.from_directory) for r in
             licenses.license_scan(df, "id", "own", F.col("path")).collect()}
    assert found == {1: ("MIT", "own", None), 2: ("Apache-2.0", "inherited", "h/src"), 3: ("Apache-2.0", "own", None),
                     4: ("Apache-2.0", "inherited", "h/src"), 5: ("GPL-3.0", "own", None), 6: (None, "none", None),
                     7: ("MIT", "inherited", "h")}


def test_pipeline(spark, data):
    import corpus_pipeline

    docs, names = spark.read.parquet(f"{data}/documents.parquet"), None
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        names, docs = docs.columns, stage(spark, docs, data)
        after = docs.count()
        assert 0 < after <= before
        before = after
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == names
    assert docs.columns == ["doc_id", "n_tokens", "ids"]


def brute_leaks(rows, items):
    """Every row against every segment of every item."""
    out = set()
    for key, text in rows:
        found = decontaminate.words(text or "")
        for item, own in items:
            own = decontaminate.words(own or "")
            if 0 < len(own) < 3:
                hit = own == found
            else:
                hit = any(brute_align(part, found) >= (2 if len(part) < 8 else 1) * len(part) for part in decontaminate.cut(own) if part)
            if hit:
                out.add((key, item))
    return out


def test_leaks_equal_aligning_everything(spark):
    """Edited at every third to sixth word, halves, short items, tails, common phrases and many copies."""
    rng = random.Random(21)
    pool = [f"w{i}" for i in range(400)]
    some = lambda n: rng.choices(pool, k=n)
    items = [(k, some(rng.randint(16, 60))) for k in range(12)]
    items += [(20, some(7)), (21, some(3)), (22, some(1)), (23, some(262)), (24, "one of the many".split() * 4), (None, some(30))]
    rows = [some(80) for _ in range(20)]
    for _, own in items:
        for step in (3, 4, 5, 6, 1000):
            edited = [w if k % step else "edited" for k, w in enumerate(own, 1)]
            rows.append(some(30) + edited + some(30))
        half = len(own) * 11 // 20
        rows += [some(20) + own[:half] + some(9), some(20) + own[-half:], own, own[:-1], own[256:] + some(5)]
    rows += [some(5) + items[0][1] + some(5) for _ in range(60)] + ["one of the many people".split() + some(40) for _ in range(60)]
    rows = [(k, " ".join(r)) for k, r in enumerate(rows)]
    texts = [(k, " ".join(w)) for k, w in items]
    bench = spark.createDataFrame(texts, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, rows), bench).collect()}
    wanted = brute_leaks(rows, texts)
    assert found == {x for x in wanted if x[1] is not None} and len(found) > 150
    kept = {r.doc_id for r in decontaminate.drop_leaks(frame(spark, rows), bench).collect()}
    assert kept == {k for k, _ in rows} - {k for k, _ in wanted}
    assert decontaminate.leaks(frame(spark, []), bench).count() == 0

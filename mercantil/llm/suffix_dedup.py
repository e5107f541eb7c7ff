"""Removal of byte strings that repeat across documents, by suffix arrays.

A suffix array over the whole corpus would have to move every suffix. Here each 50-byte
window names the smallest hash of the 16-byte strings inside it (its anchor), which
depends on the window's bytes alone, so equal windows have equal anchors. Only runs of
windows whose anchor occurs in two documents are moved, to the bucket of the anchor.
A bucket concatenates them and sorts their suffixes in two stages: suffixes smaller than
their successor directly, all others induced by scans over the buckets of first bytes.
Adjacent common prefixes of 50 bytes or more form groups; a window is covered when its
group holds a document with a smaller id. Most different runs of a bucket share no window:
a hash of each window tells which may, and only these are sorted.

A batch sends each anchor, and later each different run, once, with its smallest id;
for the other copies it already knows the answer. So a run inside a string that a third
of all documents share costs a bucket one row per batch. A run that straddles the edge of
such a string carries the document's own bytes, so it differs in each of them. Anchors
with very many different runs are found first, and their runs are split into windows that
go to the bucket of their own hash: equal windows still meet, and no anchor fills a bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercantil.llm.common import LAST_ID, texts
from mercantil.llm.jaccard_join import _groups

LENGTH = 50
ANCHOR = 16
#: Bytes of text meant for one bucket.
BUCKET_BYTES = 2 << 20
#: A batch sends one message to each group of up to PER_GROUP buckets; fewer than GROUPS groups
#: are not made. Messages would else grow with the square of the input, as do batches times buckets.
PER_GROUP, GROUPS = 8, 512
MASK = np.uint64((1 << 48) - 1)
#: Bits of a text's hash that join rows, beside their id.
LOW = (1 << 32) - 1
#: Different runs (of about 70 bytes) from which an anchor is split into windows. They are
#: counted on one text in SAMPLE; what is split changes where windows meet, not the result.
HOT_RUNS, SAMPLE = 16384, 16
#: Least numbers of 2 to 8 bytes.
_BYTES = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


# Suffix sorting of one bucket.

def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor. The last one is not."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    smaller = np.zeros(n, bool)
    if len(change):
        # Inside a run of one byte the type is that of the run's end.
        smaller[:change[-1] + 1] = np.repeat(text[change] < text[change + 1], np.diff(change, prepend=-1))
    return smaller


def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one number that sorts like them; zeros follow the end."""
    out = np.concatenate([text, np.zeros(7, text.dtype)]).astype(np.uint64)
    for size in (1, 2, 4):
        out = (out[:-size] << np.uint64(8 * size)) | out[size:]
    return out


def _direct(words: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """``positions`` sorted by their first ``depth`` bytes; only ties go on to the next eight."""
    n = len(words)
    key = words[positions]
    place = np.argsort(key)
    order, key = positions[place], key[place]
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(order) else order
    open_at = np.arange(len(order))
    for at in range(8, depth, 8):
        same = np.zeros(len(open_at), bool)
        if len(open_at) > 1:
            next_to = (group[open_at[1:]] == group[open_at[:-1]])
            same[1:] |= next_to
            same[:-1] |= next_to
        open_at = open_at[same]
        if not len(open_at):
            break
        own, old = order[open_at], group[open_at]
        where = own + at
        key = np.where(where < n, words[np.minimum(where, n - 1)], np.uint64(0))
        new = np.concatenate([[True], old[1:] != old[:-1]])
        # Groups that are in order already, such as copies that go on alike, stay as they are.
        number = np.cumsum(new) - 1
        wrong = np.zeros(number[-1] + 1, bool)
        wrong[number[1:][~new[1:] & (key[1:] < key[:-1])]] = True
        mixed = np.flatnonzero(wrong[number])
        place = mixed[np.lexsort((key[mixed], number[mixed]))]
        own[mixed], key[mixed] = own[place], key[place]
        order[open_at] = own
        fresh = new | np.concatenate([[True], key[1:] != key[:-1]])
        # New group names that keep their order: position of the first member.
        group[open_at] = np.maximum.accumulate(np.where(fresh, open_at, 0))
    return order


def suffix_array(text: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of ``text`` (bytes as uint8) in order of their first ``depth`` bytes, in two stages.

    ``words`` is ``_words(text)``, if it is known.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    smaller = _types(text)
    sorted_b = _direct(_words(text) if words is None else words, np.flatnonzero(smaller), depth)
    cuts = np.searchsorted(text[sorted_b], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def hand_on(suffixes: np.ndarray) -> None:
        before = suffixes[suffixes > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            first = text[before]
            place = np.argsort(first, kind="stable")
            first, before = first[place], before[place]
            bounds = np.concatenate([[0], np.flatnonzero(first[1:] != first[:-1]) + 1, [len(first)]])
            for a, b in zip(bounds[:-1], bounds[1:]):
                waiting[first[a]].append(before[a:b])

    # The last suffix has no successor to be induced from.
    waiting[text[-1]].append(np.array([n - 1]))
    for c in np.unique(text).tolist():
        # Larger than their successors first: those put here so far, then what they put here.
        while waiting[c]:
            part = np.concatenate(waiting[c])
            waiting[c] = []
            out.append(part)
            hand_on(part)
        part = sorted_b[cuts[c]:cuts[c + 1]]
        if len(part):
            out.append(part)
            hand_on(part)
    return np.concatenate(out)


def common_prefixes(words: np.ndarray, suffixes: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it, counted up to ``most`` bytes."""
    n = len(words)
    lcp = np.zeros(len(suffixes), np.int64)
    pairs = np.arange(1, len(suffixes))
    a, b = suffixes[1:], suffixes[:-1]
    for at in range(0, most, 8):
        if at:
            a, b = a + 8, b + 8
            inside = (a < n) & (b < n)
            if not inside.all():
                pairs, a, b = pairs[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        same = differ == 0
        end = ~same
        # Leading equal bytes of the words that differ.
        lcp[pairs[end]] = at + 7 - np.searchsorted(_BYTES, differ[end], side="right")
        pairs, a, b = pairs[same], a[same], b[same]
        lcp[pairs] = at + 8
    return np.minimum(lcp, most)


def hashes(text: np.ndarray, length: int) -> np.ndarray:
    """A number for each string of ``length`` bytes in ``text`` (uint8), made of its bytes alone."""
    x = text.astype(np.uint64) * _ODD[0]
    h, power, size = (x ^ (x >> np.uint64(29))) * _ODD[1], _ODD[2], 1
    out, done = None, 0
    with np.errstate(over="ignore"):
        while True:
            if length & size:  # the next part of the string; its parts have sizes 1, 2, 4, ...
                part = h[done:]
                out = part if out is None else out[:len(part)] * power + part
                done += size
            if done == length:
                return (out ^ (out >> np.uint64(32))) * _ODD[0]
            h = h[:max(0, len(h) - size)] * power + h[size:]  # twice the length from two halves
            power, size = power * power, 2 * size


def may_share(text: np.ndarray, starts: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each run, whether one of its windows may occur elsewhere; never False for one that does.

    Run ``k`` has ``windows[k]`` windows from ``starts[k]`` on. Equal windows have equal hashes.
    """
    number = np.repeat(np.arange(len(starts)), windows)
    at = np.arange(len(number)) + np.repeat(starts - np.cumsum(windows) + windows, windows)
    bits = np.uint64(len(starts).bit_length())
    # One sort for both: the hash above, the number of the run below.
    key = np.sort((hashes(text, length)[at] >> bits << bits) | number.astype(np.uint64))
    same = key[1:] >> bits == key[:-1] >> bits
    found = np.zeros(len(starts), bool)
    for side in (key[1:], key[:-1]):
        found[(side[same] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] = True
    return found


def covered_windows(runs: list[bytes], owners: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each run of windows, which of them also start in a run of a smaller owner.

    A run of ``n`` bytes holds ``n - length + 1`` windows. Only runs that may share a window
    are sorted.
    """
    sizes = np.array([len(r) for r in runs], np.int64)
    met = may_share(np.frombuffer(b"".join(runs), np.uint8), np.cumsum(sizes) - sizes, sizes - length + 1, length)
    found = iter(_sorted_windows([r for r, m in zip(runs, met.tolist()) if m], owners[met], length) if met.any() else ())
    return [next(found) if m else np.zeros(n - length + 1, bool) for n, m in zip(sizes.tolist(), met.tolist())]


def _sorted_windows(runs: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """``covered_windows`` by sorting all suffixes.

    Bytes are separated by a terminator below all of them, so nothing matches across runs.
    """
    sizes = np.array([len(r) for r in runs], np.int64)
    windows = sizes - length + 1
    # Bytes 254 and 255 do not occur in UTF-8, so adding one leaves room for the terminator.
    text = np.frombuffer(b"".join(r + b"\xff" for r in runs), np.uint8) + np.uint8(1)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    run = np.repeat(np.arange(len(runs)), sizes + 1)
    valid = np.arange(len(text)) - starts[run] < windows[run]
    words = _words(text)
    suffixes = suffix_array(text, length + 8, words)
    lcp = common_prefixes(words, suffixes, length + 6)
    owner = np.where(valid, owners[run], np.iinfo(np.int64).max)[suffixes]
    first = np.flatnonzero(lcp < length)
    least = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.append(first, len(suffixes))))
    hit = np.zeros(len(text), bool)
    hit[suffixes[valid[suffixes] & (owner > least)]] = True
    return [hit[s:s + w] for s, w in zip(starts, windows)]


# Anchors of one document.

def anchor_runs(data: bytes, length: int = LENGTH, anchor: int = ANCHOR):
    """(hashes, starts, ends): windows ``start..end-1`` have the same anchor. None if too short."""
    n = len(data)
    if n < length:
        return None
    h = hashes(np.frombuffer(data, np.uint8), anchor)
    width, size = length - anchor + 1, 1
    while 2 * size <= width:
        h = np.minimum(h[:len(h) - size], h[size:])
        size *= 2
    if width > size:
        h = np.minimum(h[:len(h) - width + size], h[width - size:])
    starts = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
    return h[starts], starts, np.append(starts[1:], len(h))


def run_places(data: bytes, wanted: np.ndarray, hot: np.ndarray):
    """``(keys, starts, ends)`` for the runs of the ``wanted`` anchors; those of ``hot`` ones window by window.

    A key is the anchor, or the hash of the window. Both arrays are sorted. None if too short.
    """
    found = anchor_runs(data)
    if found is None:
        return None
    own = found[0] & MASK
    at = np.flatnonzero(_among(own, wanted))
    own, starts, ends = own[at], found[1][at], found[2][at]
    cut = _among(own, hot)
    if not cut.any():
        return own, starts, ends
    sizes = (ends - starts)[cut]
    each = np.arange(sizes.sum()) + np.repeat(starts[cut] - np.cumsum(sizes) + sizes, sizes)
    names = np.array([xxhash.xxh64_intdigest(data[i:i + LENGTH]) for i in each.tolist()], np.uint64) & MASK
    return (np.concatenate([own[~cut], names]), np.concatenate([starts[~cut], each]), np.concatenate([ends[~cut], each + 1]))


def split_runs(data: bytes, wanted: np.ndarray, hot: np.ndarray):
    """``(run, key, start, end)`` for each of ``run_places``."""
    for key, s, e in zip(*(x.tolist() for x in run_places(data, wanted, hot) or ())):
        yield data[s:e + LENGTH - 1], key, s, e


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(values), bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def hot_anchors(rows: DataFrame, size: int) -> np.ndarray:
    """Sorted anchors with about HOT_RUNS different runs or more; at most one for so many runs of the input.

    Beyond a terabyte (``size`` in bytes) the limit grows with the input, so the list stays small.
    """
    def run(batches):
        for batch in batches:
            hs, runs = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for text in batch.column(0).to_pylist():
                data = text.encode()
                if found := anchor_runs(data):
                    h, starts, ends = found
                    # A run by its first and last window and its size.
                    window = hashes(np.frombuffer(data, np.uint8), LENGTH)
                    hs.append(h & MASK)
                    runs.append((window[starts] * _ODD[1] + window[ends - 1]) * _ODD[2] + (ends - starts).astype(np.uint64))
            h = np.concatenate(hs)
            run_, first = np.unique(np.concatenate(runs), return_index=True)
            yield pa.record_batch([pa.array(h[first].astype(np.int64)), pa.array(run_.view(np.int64))], names=["_h", "_run"])

    limit = max(HOT_RUNS, size >> 26) / SAMPLE
    found = (rows.filter(F.pmod(F.xxhash64("_t"), F.lit(SAMPLE)) == 0).select("_t").mapInArrow(run, "_h long, _run long")
             .distinct().groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= limit).select("_h").toPandas())
    return np.sort(found["_h"].to_numpy(dtype=np.int64).astype(np.uint64))


def _pack(*columns: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(data: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(data), [], 0
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _slices(values: np.ndarray):
    """(value, start, end) of each run of equal values."""
    cuts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
    return zip(values[cuts[:-1]].tolist(), cuts[:-1].tolist(), cuts[1:].tolist()) if len(values) else []


def _repeated_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """``_id, _s, _h``: the anchors of each row that a row of another id also has.

    ``_s`` is part of the hash of the row's text, so that rows without id, or with a
    repeated one, aren't one key. Where they share an anchor inside a batch, it may be
    listed without need; whether it is shared with another id is settled later.
    """
    def send(batches):
        for batch in batches:
            hs, owners, parts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode()
                if found := anchor_runs(data):
                    own = np.unique(found[0] & MASK)
                    hs.append(own)
                    owners.append(np.full(len(own), key, np.int64))
                    parts.append(np.full(len(own), xxhash.xxh64_intdigest(data) & LOW, np.uint32))
            h, owner, part = np.concatenate(hs), np.concatenate(owners), np.concatenate(parts)
            order = np.lexsort((owner, h))
            h, owner, part = h[order], owner[order], part[order]
            first = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
            # Copies inside the batch: the smallest id stands for all, the others are known now.
            least = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
            many = np.zeros(len(h), np.uint8)
            many[least[owner != owner[least]]] = 1
            yield from _known(owner[~first], part[~first], h[~first])
            h, owner, part, many = h[first], owner[first], part[first], many[first]
            bucket = _bucket(h, buckets)
            order = np.lexsort((owner, bucket))
            h, owner, part, many, bucket = h[order], owner[order], part[order], many[order], bucket[order]
            out = [(b, e - s, _pack((h[s:e] >> np.uint64(32)).astype("<u2"), (h[s:e] & np.uint64(LOW)).astype("<u4"),
                                    many[s:e], np.diff(owner[s:e], prepend=0), part[s:e].astype("<u4")))
                   for b, s, e in _slices(bucket)]
            cols = list(zip(*out)) or [[], [], []]
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
                                  names=["_at", "_n", "_data"])

    def _known(owner, part, h):
        # Bucket -1 - k: answers that need no bucket, spread by the document.
        if len(owner):
            place = (owner + part) % 64
            order = np.argsort(place, kind="stable")
            owner, part, h, place = owner[order], part[order], h[order], place[order]
            out = [(-1 - p, e - s, _pack(h[s:e], owner[s:e], part[s:e].astype("<u4"))) for p, s, e in _slices(place)]
            cols = list(zip(*out))
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
                                  names=["_at", "_n", "_data"])

    def found(owner, part, h):
        return pa.record_batch([pa.array(owner, pa.int64()), pa.array(part.astype(np.int64), pa.int64()),
                                pa.array(h.astype(np.int64), pa.int64())], names=["_id", "_s", "_h"])

    def answer(batches):
        for group in _groups(batches, 1):
            at, sizes, blobs = group.column(0)[0].as_py(), group.column(1).to_pylist(), group.column(2).to_pylist()
            if at < 0:
                for n, x in zip(sizes, blobs):
                    h, owner, part = _unpack(x, n, "<u8", "<i8", "<u4")
                    yield found(owner, part, h)
                continue
            parts = [_unpack(x, n, "<u2", "<u4", "u1", "<i8", "<u4") for n, x in zip(sizes, blobs)]
            h = np.concatenate([(a.astype(np.uint64) << np.uint64(32)) | b for a, b, _, _, _ in parts])
            many = np.concatenate([m for _, _, m, _, _ in parts]).astype(bool)
            owner = np.concatenate([np.cumsum(d) for _, _, _, d, _ in parts])
            part = np.concatenate([p for *_, p in parts])
            order = np.lexsort((owner, h))
            h, owner, part, many = h[order], owner[order], part[order], many[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            last = np.append(first[1:], len(h)) - 1
            shared = (owner[first] != owner[last]) | np.logical_or.reduceat(many, first)
            keep = np.repeat(shared, last - first + 1)
            yield found(owner[keep], part[keep], h[keep])

    return (rows.select("_id", "_t").mapInArrow(send, "_at long, _n long, _data binary")
            .repartition("_at").sortWithinPartitions("_at").mapInArrow(answer, "_id long, _s long, _h long"))


def _packed(rows: DataFrame) -> DataFrame:
    """``_id, _s, _th, _z``: texts compressed before they are shuffled, with a hash to tell rows of one id apart."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data = [t.encode() for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([xxhash.xxh64_intdigest(d) - (1 << 63) for d in data], pa.int64()),
                                   pa.array([pack.compress(d) for d in data], pa.binary()), batch.column(2)],
                                  names=["_id", "_th", "_z", "_null"])

    # The filter is what an inner join adds anyway; with it, both joins share one shuffle.
    return (rows.mapInArrow(run, "_id long, _th long, _z binary, _null boolean")
            .withColumn("_s", F.col("_th").bitwiseAND(F.lit(LOW))).filter("_id IS NOT NULL AND _s IS NOT NULL"))


def _covered(texts_: DataFrame, anchors: DataFrame, hot: np.ndarray, buckets: int, per: int) -> DataFrame:
    """``_id, _th, _spans``: covered windows as pairs of 32-bit start and end; several rows a document.

    ``per`` buckets are sent together, and sorted one by one.
    """
    wanted = anchors.groupBy("_id", "_s").agg(F.collect_set("_h").alias("_hs"))
    # All columns stay, so that this shuffle of the texts also serves the last join.
    rows = texts_.join(wanted, ["_id", "_s"]).select("_id", "_th", "_z", "_hs", "_null")
    schema = "_at long, _n long, _data binary, _id long, _th long, _spans binary"

    def known(key, th, spans):
        return pa.record_batch([pa.array([-1] * len(key), pa.int64()), pa.array([0] * len(key), pa.int64()),
                                pa.array([b""] * len(key), pa.binary()), pa.array(key, pa.int64()), pa.array(th, pa.int64()),
                                pa.array(spans, pa.binary())], names=["_at", "_n", "_data", "_id", "_th", "_spans"])

    def send(batches):
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            runs: dict = {}
            homes, number, row, starts, ends = [], [], [], [], []
            put = runs.setdefault
            keys, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            seen = set()
            for k in range(batch.num_rows):
                if (keys[k], ths[k]) in seen:  # the same row again has the same spans
                    continue
                seen.add((keys[k], ths[k]))
                data = unpack.decompress(batch.column(2)[k].as_py())
                hs = np.sort(batch.column(3)[k].values.to_numpy().astype(np.uint64))
                if (found := run_places(data, hs, hot)) is None:
                    continue
                own, s, e = found
                number.append(np.array([put(data[a:b], len(runs)) for a, b in zip(s.tolist(), (e + (LENGTH - 1)).tolist())], np.int64))
                homes.append(own)
                row.append(np.full(len(own), k))
                starts.append(s)
                ends.append(e)
            if not runs:
                continue
            homes, number, row, starts, ends = (np.concatenate(x) for x in (homes, number, row, starts, ends))
            owner = keys[row]
            least = np.full(len(runs), LAST_ID)
            np.minimum.at(least, number, owner)
            # Runs equal inside the batch: the smallest id stands for all others.
            other = owner > least[number]
            if other.any():
                spans = np.stack([starts[other], ends[other]], 1).astype("<u4")
                parts = list(_slices(row[other]))
                where = [k for k, _, _ in parts]
                yield known(keys[where], ths[where], [spans[s:e].tobytes() for _, s, e in parts])
            # The rows that hold the smallest id; several, if rows share an id.
            names, home = list(runs), np.empty(len(runs), np.uint64)
            home[number] = homes  # equal runs have one anchor
            bucket = _bucket(home, buckets)
            order = np.lexsort((home, bucket))
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            place = rank[number[~other]]
            by_run = np.argsort(place, kind="stable")
            place = place[by_run]
            table = [x[~other][by_run].astype("<i8") for x in (owner, ths[row], starts)]
            out = []
            bucket = bucket[order]
            for b, s, e in _slices(bucket // per):
                part = [names[i] for i in order[s:e].tolist()]
                lo, hi = np.searchsorted(place, (s, e))
                lengths = np.array([len(r) for r in part], "<i8")
                raw = np.array([len(part), hi - lo], "<i8").tobytes() + lengths.tobytes() + (place[lo:hi] - s).astype("<i8").tobytes() \
                    + b"".join(t[lo:hi].tobytes() for t in table) + (bucket[s:e] % per).astype("u1").tobytes() + b"".join(part)
                out.append((b, len(part), pack.compress(raw)))
            cols = list(zip(*out))
            m = len(out)
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                                   pa.array([0] * m, pa.int64()), pa.array([0] * m, pa.int64()), pa.array([b""] * m, pa.binary())],
                                  names=["_at", "_n", "_data", "_id", "_th", "_spans"])

    def settle(batches):
        unpack = zstandard.ZstdDecompressor()
        for group in _groups(batches, 1):
            if group.column(0)[0].as_py() < 0:
                for b in group.select([3, 4, 5]).to_batches():
                    yield pa.record_batch(b.columns, names=["_id", "_th", "_spans"])
                continue
            runs, where, subs = {}, [], []
            for data in group.column(2).to_pylist():
                raw = unpack.decompress(data)
                n, m = np.frombuffer(raw, "<i8", 2)
                lengths = np.frombuffer(raw, "<i8", n, 16)
                j, key, th, s = (np.frombuffer(raw, "<i8", m, 16 + 8 * (n + i * m)) for i in range(4))
                sub = np.frombuffer(raw, "u1", n, 16 + 8 * (n + 4 * m))
                ends = 16 + 8 * (n + 4 * m) + n + np.cumsum(lengths)
                number = np.array([runs.setdefault(raw[e - l:e], len(runs)) for e, l in zip(ends.tolist(), lengths.tolist())], np.int64)
                where.append(np.stack([number[j], key, th, s]))
                subs.append((number, sub))
            numbers, sub = (np.concatenate(x) for x in zip(*subs))
            bucket = np.zeros(len(runs), np.uint8)
            bucket[numbers] = sub
            number, key, th, s = np.concatenate(where, 1)
            names = list(runs)
            owners = np.full(len(names), np.iinfo(np.int64).max)
            np.minimum.at(owners, number, key)
            hit = [np.zeros(0, bool)] * len(names)
            for b in np.unique(bucket):
                own = np.flatnonzero(bucket == b)
                for i, x in zip(own.tolist(), covered_windows([names[i] for i in own.tolist()], owners[own])):
                    hit[i] = x
            windows = np.array([len(x) for x in hit])
            whole = key > owners[number]  # a smaller id has the whole run
            some = np.logical_or.reduceat(np.concatenate(hit), np.concatenate([[0], np.cumsum(windows)[:-1]]))
            found = [(key[whole], th[whole], s[whole], s[whole] + windows[number[whole]])]
            for j, k, t, at in zip(*(x[~whole & some[number]].tolist() for x in (number, key, th, s))):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[j].view(np.int8), [0]]))) + at
                found.append((np.full(len(edge) // 2, k), np.full(len(edge) // 2, t), edge[::2], edge[1::2]))
            key, th, s, e = (np.concatenate(x) for x in zip(*found))
            if len(key):
                order = np.lexsort((th, key))
                key, th = key[order], th[order]
                spans = np.stack([s[order], e[order]], 1).astype("<u4")
                first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (th[1:] != th[:-1])]))
                yield pa.record_batch([pa.array(key[first], pa.int64()), pa.array(th[first], pa.int64()),
                                       pa.array([x.tobytes() for x in np.split(spans, first[1:])], pa.binary())],
                                      names=["_id", "_th", "_spans"])

    sent = rows.mapInArrow(send, schema)
    # What is known already needs no company: spread it over all tasks.
    place = F.when(F.col("_at") < 0, F.xxhash64("_id")).otherwise(F.col("_at"))
    return (sent.repartition(place).sortWithinPartitions("_at")
            .mapInArrow(settle, "_id long, _th long, _spans binary"))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes) for every row.

    Each byte covered by a 50-byte string that also starts in a document with a smaller
    id is removed; strings are judged on the input. ``n_spans`` counts maximal removed
    runs. A null text counts as empty; texts below 50 bytes stay whole. A null id is
    larger than all others, and rows with equal ids do not remove each other's bytes.
    """
    rows = texts(df, id_col, text_col).select(
        F.coalesce("_id", F.lit(LAST_ID)).alias("_id"), "_t", F.col("_id").isNull().alias("_null"))
    size = rows.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    per = min(PER_GROUP, max(1, buckets // max(GROUPS, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    packed = _packed(rows)
    spans = (_covered(packed, _repeated_anchors(rows, -(-buckets // per)), hot_anchors(rows, size), buckets, per)
             .withColumn("_s", F.col("_th").bitwiseAND(F.lit(LOW)))
             .groupBy("_id", "_s").agg(F.collect_list(F.struct("_th", "_spans")).alias("_spans")))

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            n_bytes, removed, n_spans, kept = [], [], [], []
            listed = batch.column(3)
            sizes = listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            ths, parts = listed.flatten().flatten()
            # Rows may share an id, so a part is taken by the hash of its text.
            own = ths.to_numpy() == np.repeat(batch.column(1).to_numpy(), sizes)
            parts, own = parts.to_pylist(), own.tolist()
            for z, a, b in zip(batch.column(2).to_pylist(), cuts[:-1], cuts[1:]):
                data = unpack.decompress(z)
                n_bytes.append(len(data))
                raw = b"".join(x for x, mine in zip(parts[a:b], own[a:b]) if mine)
                if not raw:
                    removed.append(0)
                    n_spans.append(0)
                    kept.append(data)
                    continue
                found = np.frombuffer(raw, "<u4").astype(np.int64).reshape(-1, 2)
                found = found[np.argsort(found[:, 0])]
                # Bytes covered from each start on; a span goes on while the next one starts inside or at its end.
                ends = np.maximum.accumulate(found[:, 1] + (LENGTH - 1))
                new = np.concatenate([[True], found[1:, 0] > ends[:-1]])
                starts, ends = found[new, 0], ends[np.append(new[1:], True)]
                removed.append(int((ends - starts).sum()))
                n_spans.append(len(starts))
                kept.append(b"".join(data[x:y] for x, y in zip([0, *ends.tolist()], [*starts.tolist(), len(data)])))
            yield pa.record_batch([batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, removed, n_spans)),
                                   pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return (packed.join(spans, ["_id", "_s"], "left")
            .select(F.when(~F.col("_null"), F.col("_id")).alias("doc_id"), "_th", "_z", "_spans")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))

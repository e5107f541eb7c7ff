"""Byte-level BPE encoding and decoding as a tree reduction.

A text is cut into blocks. Blocks are split by the pattern, neighbours are joined by
splitting a window around the border anew, and the window grows until the pieces
outside provably stand. Each piece is encoded the same way on bytes, down to leaves of
a few bytes: halves first, then the border is encoded anew until both outer pairs of
tokens are stable. A token sequence is the encoding if and only if each adjacent pair
is the encoding of its own bytes, so the join may stop there. Decoding concatenates
byte strings up the tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from mercantil.llm.common import Memo, file_bytes, sliced, texts

#: Characters in a leaf of the tree over a text.
BLOCK = 4096
#: Bytes in a leaf of the tree over a piece.
LEAF = 8
#: Longest window that is encoded by passes over all its pairs.
SHORT = 24
#: Entries of a worker's cache of encoded pieces.
CACHE = 400_000
#: Characters the pattern may look at from a piece's start to decide on it ('re, 've, 'll).
REACH = 3


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class ByteBpe:
    """Encoder and decoder for one rank table and one split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, block: int = BLOCK, cache: int = CACHE):
        self.ranks, self.block = ranks, block
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.find = regex.compile(pattern).findall
        self.pairs = Memo(lambda p: self.merged(p[0] + p[1]) == [p[0], p[1]], cache // 8)
        self.windows = Memo(self.merged, cache // 8)
        self.leaves = Memo(self.merged, cache // 8)
        self.pieces = Memo(self._piece, cache)

    # Bytes of one piece.

    def merged(self, data: bytes) -> list[bytes]:
        """Encode a window directly: lowest rank first, then leftmost."""
        ranks, n = self.ranks, len(data)
        if n <= SHORT:
            rank, none = ranks.get, len(self.tokens)
            parts = [data[i:i + 1] for i in range(n)]
            found = [rank(data[i:i + 2], none) for i in range(n - 1)]
            while found and (least := min(found)) < none:
                i = found.index(least)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                del found[i]
                if i:
                    found[i - 1] = rank(parts[i - 1] + parts[i], none)
                if i < len(found):
                    found[i] = rank(parts[i] + parts[i + 1], none)
            return parts
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[data[i:i + 2]], i, i + 2) for i in range(n - 1) if data[i:i + 2] in ranks]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or after[after[i]] != end:
                continue
            alive[after[i]] = False
            after[i] = end
            if end < n:
                before[end] = i
            for start, stop in ((before[i], end), (i, after[end] if end < n else n + 1)):
                if start >= 0 and stop <= n and (rank := ranks.get(data[start:stop])) is not None:
                    heapq.heappush(heap, (rank, start, stop))
        return [data[i:after[i]] for i in range(n) if alive[i]]

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """Tokens of two neighbouring spans as tokens of the whole."""
        i, j = 1, 1
        while True:
            window = b"".join(left[-i:] + right[:j])
            middle = self.windows[window] if len(window) < 64 else self.merged(window)
            left_ok = i == len(left) or self.pairs[left[-i - 1], middle[0]]
            right_ok = j == len(right) or self.pairs[middle[-1], right[j]]
            if left_ok and right_ok:
                return left[:-i] + middle + right[j:]
            if not left_ok:
                i = min(len(left), 2 * i)
            if not right_ok:
                j = min(len(right), 2 * j)

    def span(self, data: bytes) -> list[bytes]:
        if len(data) <= LEAF:
            return self.leaves[data]
        half = len(data) // 2
        return self.join(self.span(data[:half]), self.span(data[half:]))

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        if (rank := self.ranks.get(data)) is not None:
            return rank.to_bytes(4, "little")
        return b"".join(self.ranks[t].to_bytes(4, "little") for t in self.span(data))

    # Pieces of one text.

    @staticmethod
    def _fixed(pieces: list[str], size: int) -> int:
        """How many leading pieces of a span of ``size`` characters no later text can change."""
        at = size
        for k in range(len(pieces), 0, -1):
            start = at - len(pieces[k - 1])
            if at < size and start + REACH <= size:
                return k
            at = start
        return 0

    def join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        """Pieces of two neighbouring blocks as pieces of the whole."""
        if not left or not right:
            return left or right
        keep = 0
        # Only the last pieces can be open: look back as far as needed.
        back = 4
        while True:
            tail = left[-back:]
            fixed = self._fixed(tail, sum(map(len, tail)))
            if fixed or back >= len(left):
                keep = max(0, len(left) - back) + fixed
                break
            back *= 2
        open_text = "".join(left[keep:])
        j = 4
        while True:
            window = open_text + "".join(right[:j])
            found = self.find(window)
            if j >= len(right):
                return left[:keep] + found
            borders, at = {}, len(open_text)
            for k, piece in enumerate(right[:j]):
                borders[at] = k
                at += len(piece)
            fixed, at = self._fixed(found, len(window)), 0
            for k, piece in enumerate(found[:fixed]):
                at += len(piece)
                if at in borders:
                    return left[:keep] + found[:k + 1] + right[borders[at]:]
            j *= 2

    def split(self, text: str) -> list[str]:
        if len(text) <= self.block:
            return self.find(text)
        half = len(text) // 2
        return self.join_pieces(self.split(text[:half]), self.split(text[half:]))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_BUILT: dict = {}


def _encoder(data: bytes, pattern: str) -> ByteBpe:
    """One encoder per worker process and vocabulary."""
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = ByteBpe(read_ranks(data), pattern)
    return _BUILT[key]


def bpe_tokens(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row; ``ids`` are little-endian unsigned 32-bit.

    Null and empty texts have no tokens. Rows keep their count and any repeats.
    The rank file's size is checked before it is sent to the executors.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(file_bytes(ranks_path))

    def run(batches):
        bpe = _encoder(shared.value, pattern)
        for batch in sliced(batches):
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                   pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def bpe_texts(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` (bytes) from the rows of :func:`bpe_tokens`.

    Null ids decode to no bytes.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(file_bytes(ranks_path))

    def run(batches):
        bpe = _encoder(shared.value, pattern)
        for batch in sliced(batches):
            decoded = [bpe.decode(memoryview(x or b"").cast("I")) for x in batch.column(2).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(decoded, pa.binary())],
                                  names=["doc_id", "n_tokens", "ids", "decoded"])

    return (tokens.select("doc_id", "n_tokens", "ids")
            .mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary"))

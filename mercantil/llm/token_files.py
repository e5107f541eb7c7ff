"""Token-ID files: a static range asymmetric numeral system over independent blocks.

One frequency table, counted over the whole corpus, serves all blocks. Inside a block
the ids are dealt to interleaved lanes whose states are numpy vectors, so a step codes
one id of every lane. A block holds its documents' ids and lengths, the lane states at
checkpoints (decoding may start at any of them) and checksums of the block and of its
ids. Blocks are rows of a Parquet folder, so Spark's writer commits them and a lost
task is simply run again; each block decodes without any other.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercantil.llm.common import LAST_ID, Memo, file_bytes, sliced, stored, texts

MAGIC = b"RANS0001"
BLOCK_IDS = 1 << 17
LANES = 1024
#: Steps between two checkpoints; a step codes one id in each lane.
CHECK_STEPS = 64
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
HEADER = struct.Struct("<8s16sIIIIIIIII")


# Tokens.

class Recent:
    """Cache of two generations: when the newer is full, the older one goes."""

    def __init__(self, limit: int):
        self.limit, self.newer, self.older = limit, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.newer.get(key)
        if found is None and (found := self.older.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.newer) >= self.limit:
            self.newer, self.older = {}, self.newer
        self.newer[key] = value


#: The splitter and normalizers under which a text's ids are those of its words.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Marks that may follow a word's letters.
MARKS = ".,;:!?|*#%$&()"
#: Letters that the normalizers only lower, and the marks after them.
LATIN = rf"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[{MARKS}]*)$"


class WordTokenizer:
    """The library's tokenizer behind a cache of words without case and marks.

    Its splitter never crosses a blank, so a text's ids are those of its words. Words of
    a batch are told apart, cut into letters and marks and put together again as Arrow
    columns; only letters that the cache lacks go to the library, many in one call. These
    are one piece each, whose last token is marked as a word end, which is where the ids
    of a joined call are cut. Lowered Latin letters are what the normalizers and the
    splitter would give, so they go to the library's model without those two steps. A
    tokenizer of other steps encodes whole texts.
    """

    def __init__(self, data: bytes, cache: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_buffer(data)
        self.by_word = self._splits_words(json.loads(data))
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.type = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.last = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.last[i] = token.endswith("</w>")
        self.known = Recent(cache)
        self.tails = Memo(self._direct, 10_000)

    @staticmethod
    def _splits_words(config: dict) -> bool:
        steps = ((config.get("normalizer") or {}).get("normalizers", []),
                 (config.get("pre_tokenizer") or {}).get("pretokenizers", []))
        kinds = [[x["type"] for x in found] for found in steps]
        return (kinds == [NORMALIZERS, ["Split", "ByteLevel"]]
                and steps[1][0]["pattern"].get("Regex") == WORD_SPLIT
                and config["model"].get("end_of_word_suffix") == "</w>")

    def _direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def _joined(self, tokenizer, names: list[str]) -> list[bytes]:
        """Ids of each of ``names``, all letters, by calls for a thousand at once."""
        found = []
        for at in range(0, len(names), 1000):
            part = names[at:at + 1000]
            coded = tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(coded.ids, np.int64)
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
            if len(ends) == len(part):
                joined, width = ids.astype(self.type).tobytes(), self.type.itemsize
                found += [joined[b * width:e * width] for b, e in zip([0, *ends], ends)]
            else:
                found += map(self._direct, part)
        return found

    def _cached(self, names: list[str], learn) -> list[bytes]:
        """Ids of each of ``names``, all different; ``learn`` gives those of the unknown ones."""
        found = list(map(self.known.get, names))
        places = [i for i, own in enumerate(found) if own is None]
        for i, own in zip(places, learn([names[i] for i in places])):
            found[i] = own
            self.known.put(names[i], own)
        return found

    def _others(self, names: list[str]) -> list[bytes]:
        """Ids of words that are not Latin letters and marks."""
        cores = [name.rstrip(MARKS) for name in names]
        alpha = list({core for core in cores if core.isalpha()})
        ids = dict(zip(alpha, self._joined(self.tokenizer, alpha)))
        return [ids[core] + self.tails[name[len(core):]] if core in ids else self._direct(name)
                for name, core in zip(names, cores)]

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of each of ``words``, all different."""
        parts = pc.extract_regex(words, LATIN)
        latin = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        cores, tails = (pc.struct_field(parts.filter(latin), i).dictionary_encode() for i in (0, 1))
        lowered = pc.utf8_lower(cores.dictionary).dictionary_encode()
        ids = _binary(self._cached(lowered.dictionary.to_pylist(), lambda x: self._joined(self.letters, x)))
        marks = _binary(map(self.tails.__getitem__, tails.dictionary.to_pylist()))
        simple = pc.binary_join_element_wise(ids.take(lowered.indices.take(cores.indices)), marks.take(tails.indices),
                                             pa.scalar(b"", pa.large_binary()))
        others = _binary(self._cached(words.filter(~latin).to_pylist(), self._others))
        place = np.empty(len(words), np.int64)
        place[latin] = np.arange(len(simple))
        place[~latin] = len(simple) + np.arange(len(others))
        return pa.concat_arrays([simple, others]).take(pa.array(place))

    def encode(self, found: pa.Array) -> pa.Array:
        """Ids of each text (never null) as little-endian integers of ``type``."""
        if not self.by_word:
            return _binary(map(self._direct, found.to_pylist()))
        split = pc.split_pattern(pc.replace_substring(found, "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        ids = self._words(words.dictionary).take(words.indices)
        _, ends, joined = ids.buffers()
        # A text's ids are neighbours: its bytes go from its first word's to its last one's.
        ends = np.frombuffer(ends, np.int64)[ids.offset:ids.offset + len(ids) + 1]
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        return pa.Array.from_buffers(pa.large_binary(), len(found), [None, pa.py_buffer(ends[offsets]), joined])


def _binary(found) -> pa.Array:
    return pa.array(list(found), pa.large_binary())


_BUILT: dict = {}


def _tokenizer(data: bytes) -> WordTokenizer:
    key = hashlib.sha256(data).digest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = WordTokenizer(data)
    return _BUILT[key]


def token_ids(df: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``_id, _ids`` for every row, with the end id; a null or empty text has only that one."""
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(tokenizer_path))

    def run(batches):
        tokenizer = _tokenizer(shared.value)
        end = pa.scalar(np.array([end_id], tokenizer.type).tobytes(), pa.large_binary())
        empty = pa.scalar(b"", pa.large_binary())
        for batch in sliced(batches):
            ids = pc.binary_join_element_wise(tokenizer.encode(batch.column(1)), end, empty)
            yield pa.record_batch([batch.column(0), ids.cast(pa.binary())], names=["_id", "_ids"])

    return texts(df, id_col, text_col).mapInArrow(run, "_id long, _ids binary")


# The coder.

class Table:
    """Frequencies that sum to a power of two; symbols that never occur have none."""

    def __init__(self, freq: np.ndarray, bits: int):
        self.freq, self.bits = freq.astype(np.uint64), bits
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        self.name = hashlib.md5(self.dumps()).digest()

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> "Table":
        used = int((counts > 0).sum())
        bits = max(20, used.bit_length() + 2)
        room, total = 1 << bits, max(1, int(counts.sum()))
        freq = np.where(counts > 0, np.maximum(1, counts.astype(np.float64) * room / total), 0).astype(np.int64)
        spare = room - int(freq.sum())
        order = np.argsort(-freq, kind="stable")
        if spare > 0 and used:
            freq[order[0]] += spare
        for i in order:
            if spare >= 0:
                break
            taken = min(-spare, int(freq[i]) // 2)
            freq[i] -= taken
            spare += taken
        return cls(freq, bits)

    def dumps(self) -> bytes:
        return struct.pack("<I", self.bits) + self.freq.astype("<u4").tobytes()

    @classmethod
    def loads(cls, data: bytes) -> "Table":
        return cls(np.frombuffer(data, "<u4", offset=4).astype(np.int64), struct.unpack_from("<I", data)[0])


def encode_block(ids: np.ndarray, docs: list[tuple[int | None, int]], first: int, resumed: bool,
                 table: Table) -> bytes:
    """One block: ``docs`` are (id, number of ids here); ``first`` numbers the first of them."""
    steps = -(-len(ids) // LANES)
    state = np.full(LANES, LOW, np.uint64)
    bits = np.uint64(table.bits)
    chunks, checks, words = [], [], 0
    for step in range(steps - 1, -1, -1):
        own = ids[step * LANES:(step + 1) * LANES]
        x, f = state[:len(own)], table.freq[own]
        full = x >= f << np.uint64(63 - table.bits)
        out = (x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
        x[full] >>= WORD
        q, r = np.divmod(x, f)
        state[:len(own)] = (q << bits) + r + table.start[own]
        chunks.append(out)
        words += len(out)
        if step % CHECK_STEPS == 0:
            checks.append((words, state.copy()))
    stream = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")
    body = [
        np.array([i if i is not None else LAST_ID for i, _ in docs], "<i8").tobytes(),
        np.array([i is None for i, _ in docs], "u1").tobytes(),
        np.array([n for _, n in docs], "<u4").tobytes(),
        np.array([words - w for w, _ in checks[::-1]], "<u4").tobytes(),
        b"".join(s.astype("<u8").tobytes() for _, s in checks[::-1]),
        stream.tobytes(),
    ]
    content = b"".join(body)
    return HEADER.pack(MAGIC, table.name, len(ids), len(docs), first, resumed, LANES, CHECK_STEPS, len(stream),
                       zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(content)) + content


def decode_block(data: bytes, table: Table, check: int = 0):
    """(docs, first, resumed, ids) of a block; ids from checkpoint ``check`` on.

    Raises ValueError on another table, a damaged block or ids that differ from those written.
    """
    magic, name, n, n_docs, first, resumed, lanes, every, n_words, ids_crc, crc = HEADER.unpack_from(data)
    content = memoryview(data)[HEADER.size:]
    if magic != MAGIC or name != table.name or zlib.crc32(content) != crc:
        raise ValueError("not a block of this table, or damaged")
    steps = -(-n // lanes)
    n_checks = -(-steps // every)
    at = 0

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(content, kind, count, at)
        at += found.nbytes
        return found

    keys, nulls, sizes = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
    places, states = take("<u4", n_checks), take("<u8", n_checks * lanes)
    stream = take("<u4", n_words).astype(np.uint64)
    docs = [(None if z else int(k), int(s)) for k, z, s in zip(keys, nulls, sizes)]
    if not n:
        return docs, first, bool(resumed), np.zeros(0, np.uint32)
    state, place = states[check * lanes:(check + 1) * lanes].copy(), int(places[check])
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    out = np.empty(n - check * every * lanes, np.uint32)
    for step in range(check * every, steps):
        begin = step * lanes
        width = min(lanes, n - begin)
        x = state[:width]
        slot = x & mask
        symbol = table.slots[slot]
        x = table.freq[symbol] * (x >> bits) + slot - table.start[symbol]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << WORD) | stream[place:place + len(low)]
        place += len(low)
        state[:width] = x
        out[begin - check * every * lanes:][:width] = symbol
    if check == 0 and zlib.crc32(out.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("the ids differ from those written")
    return docs, first, bool(resumed), out


def crc32_joined(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings in a row, from theirs and the second one's length.

    Appending zero bytes is a linear map on the 32 bits; its powers are squared up.
    """
    def times(matrix, vector):
        total, i = 0, 0
        while vector:
            if vector & 1:
                total ^= matrix[i]
            vector >>= 1
            i += 1
        return total

    matrix = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):
        matrix = [times(matrix, column) for column in matrix]  # one zero byte
    while size:
        if size & 1:
            first = times(matrix, first)
        matrix = [times(matrix, column) for column in matrix]
        size >>= 1
    return first ^ second


# Files.

def _count(ids: DataFrame, size: int, width: str) -> np.ndarray:
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in sliced(batches):
            joined = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(joined, width), minlength=size)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["s", "n"])

    # At most one row for each entry of the vocabulary comes back.
    found = ids.select("_ids").mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[found.s.to_numpy()] = found.n.to_numpy()
    return counts


def write_ids(df: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text") -> None:
    """Write the ids of every row to ``path``/blocks and the table to ``path``/table.

    Documents come in ascending id (null last), ranges of ids in parts; equal ids are
    neighbours. A document longer than a block goes on in the next. Empty tables give
    an empty folder of blocks.
    """
    spark = df.sparkSession
    tokenizer = _tokenizer(file_bytes(tokenizer_path))
    size, width = tokenizer.size, tokenizer.type.str
    ids = stored(token_ids(df, tokenizer_path, end_id, id_col, text_col), "ids")
    table = Table.from_counts(_count(ids, size, width))
    packed = table.dumps()
    spark.createDataFrame([(bytearray(packed),)], "data binary").write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(packed)

    def run(batches):
        table, part = Table.loads(shared.value), TaskContext.get().partitionId()
        held, docs, count, block, first, number, resumed = [], [], 0, 0, 0, 0, False

        def flush():
            ids = np.concatenate(held) if held else np.zeros(0, width)
            return pa.record_batch([pa.array([part], pa.int64()), pa.array([block], pa.int64()),
                                    pa.array([len(ids)], pa.int64()),
                                    pa.array([encode_block(ids, docs, first, resumed, table)], pa.binary())],
                                   names=["part", "block", "n_ids", "data"])

        for batch in batches:
            for key, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own, at = np.frombuffer(x, width), 0
                while at < len(own):
                    if count == BLOCK_IDS:
                        yield flush()
                        block, held, docs, count, first, resumed = block + 1, [], [], 0, number, at > 0
                    piece = own[at:at + BLOCK_IDS - count]
                    held.append(piece)
                    docs.append((key, len(piece)))
                    count += len(piece)
                    at += len(piece)
                number += 1
        if docs:
            yield flush()

    order = F.coalesce("_id", F.lit(LAST_ID))
    (ids.repartitionByRange(order).sortWithinPartitions(order, "_ids")
     .mapInArrow(run, "part long, block long, n_ids long, data binary")
     .write.parquet(f"{path}/blocks"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of documents, decoded block by block: ``part, doc, doc_id, at, ids``.

    ``part, doc`` name a document, ``at`` counts the ids of its part before the piece.
    """
    packed = bytes(spark.read.schema("data binary").parquet(f"{path}/table").first()[0])
    shared = spark.sparkContext.broadcast(packed)
    blocks = spark.read.schema("part long, block long, n_ids long, data binary").parquet(f"{path}/blocks")

    def run(batches):
        table = Table.loads(shared.value)
        for batch in batches:
            for part, block, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                docs, first, _, ids = decode_block(data, table)
                ends = np.cumsum([n for _, n in docs])
                yield pa.record_batch([
                    pa.array([part] * len(docs), pa.int64()), pa.array(range(first, first + len(docs)), pa.int64()),
                    pa.array([k for k, _ in docs], pa.int64()),
                    pa.array([block * BLOCK_IDS + int(e) - n for e, (_, n) in zip(ends, docs)], pa.int64()),
                    pa.array([x.astype("<u4").tobytes() for x in np.split(ids, ends[:-1])], pa.binary()),
                ], names=["part", "doc", "doc_id", "at", "ids"])

    return blocks.select("part", "block", "data").mapInArrow(
        run, "part long, doc long, doc_id long, at long, ids binary")


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part. One row a part, so the window over all of them is small."""
    blocks = spark.read.schema("part long, block long, n_ids long, data binary").parquet(f"{path}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
            .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""
    pieces = read_ids(spark, path).select("part", "doc", "doc_id", "at", (F.length("ids") / 4).cast("long").alias("n"),
                                          F.crc32("ids").alias("crc"))

    def join(batches):
        for batch in batches:
            crcs = []
            for found in batch.column(4).to_pylist():
                first, *rest = sorted(found, key=lambda x: x["at"])
                total = first["crc"]
                for x in rest:
                    total = crc32_joined(total, x["crc"], 4 * x["n"])
                crcs.append(total)
            yield pa.record_batch([*(batch.column(i) for i in range(4)), pa.array(crcs, pa.int64())],
                                  names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    # A document has as many pieces as blocks it reaches into.
    docs = (pieces.groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
        F.collect_list(F.struct("at", "n", "crc")).alias("pieces"))
        .select("part", "doc_id", "at", "n_tokens", "pieces")
        .mapInArrow(join, "part long, doc_id long, at long, n_tokens long, ids_crc32 long"))
    return docs.join(part_starts(spark, path), "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")

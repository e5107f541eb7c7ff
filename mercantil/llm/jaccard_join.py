"""Similarity join on word shingles by chosen paths.

Every text becomes a set of shingles; rows with equal sets are one representative with
a weight. Sets are embedded as 128 min-hash values, which act as tokens. A run starts
with one sampled token and splits all representatives by its value into nodes, which are
compared by brute force on the embedding; large nodes are cut into blocks, and every two
blocks are compared, so no pair of a node is left out. Runs are repeated: a pair at the
threshold shares a token with probability 0.8, so sixteen runs leave 7 in a million million.
Comparing never lists all pairs: members are joined to a pivot, and only members
outside the largest cluster become pivots. What comes out is a forest of likely links.

Its components hold every link, so the exact Jaccard values are computed inside them:
each set goes to its component once, large components are cut into blocks and each
pair of blocks is a unit of its own. Units return counts of links and a spanning
forest, not pairs. Components of that forest are the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercantil.llm.common import LAST_ID, Memo, sliced, stored, texts
from mercantil.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
#: Values of the embedding, and runs.
VALUES, RUNS = 128, 16
#: Largest node compared at once; larger ones are cut into blocks of this size, compared two by two.
LARGEST = 4096
#: Five standard deviations of the estimate below the threshold.
LEAST_EQUAL = int(VALUES * (THRESHOLD - 5 * (THRESHOLD * (1 - THRESHOLD) / VALUES) ** 0.5))
#: Rows and shingles in a block of a component.
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 2_000_000

_RNG = np.random.default_rng(20240501)
_MULTIPLY = _RNG.integers(1, 1 << 63, VALUES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) | 1 for k in range(SHINGLE)], dtype=np.uint64)
#: One worker's cache of word hashes.
_WORDS = Memo(lambda w: xxhash.xxh64_intdigest(w.encode()), 150_000)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of five lower-case words.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(h))):
        total += h[k:k + n] * _POWERS[k]
    total ^= total >> np.uint64(31)
    return np.unique(total * np.uint64(0xD6E8FEB86659FD93))


def embedding(found: np.ndarray) -> np.ndarray:
    """Min-hash values (32 bits) of a set, in bounded slices."""
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(found), 2048):
        h = found[None, at:at + 2048] * _MULTIPLY[:, None] + _ADD[:, None]
        least = np.minimum(least, (h >> np.uint64(32)).astype(np.uint32).min(1))
    return least


def set_key(found: np.ndarray) -> tuple[int, int]:
    data = found.tobytes()
    return (xxhash.xxh64_intdigest(data) - (1 << 63), xxhash.xxh64_intdigest(data, 1) - (1 << 63))


def _hashed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id, _t, _h1, _h2``: an id may be null or repeated, so id and both hashes of the text name a row."""
    return texts(df, id_col, text_col).select("_id", "_t", *_hashes(F.col("_t")))


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]


def _embedded(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_row, _id, _h1, _h2, _k1, _k2, _size, _tokens, _low`` for every row, stored.

    Of the embedding, ``_tokens`` has the values that runs split on, ``_low`` the lowest byte of each.
    """
    def run(batches):
        for batch in sliced(batches):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            keys = [set_key(s) for s in sets]
            mins = np.stack([embedding(s) for s in sets]) if sets else np.zeros((0, VALUES), np.uint32)
            yield pa.record_batch([
                *(batch.column(k) for k in (0, 2, 3)),
                pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([m.tobytes() for m in mins[:, ::VALUES // RUNS]], pa.binary()),
                pa.array([m.tobytes() for m in (mins & 0xFF).astype(np.uint8)], pa.binary())],
                names=["_id", "_h1", "_h2", "_k1", "_k2", "_size", "_tokens", "_low"])

    rows = _hashed(df, id_col, text_col).mapInArrow(
        run, "_id long, _h1 long, _h2 long, _k1 long, _k2 long, _size long, _tokens binary, _low binary")
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()), "embedded")


def _first_nodes(reps: DataFrame) -> DataFrame:
    """``_node, _rep``: run ``r`` splits on its token."""
    nodes = F.array(*[F.xxhash64(F.lit(r), F.substring("_tokens", r * 4 + 1, 4)) for r in range(RUNS)])
    return reps.select(F.explode(nodes).alias("_node"), "_rep")


def _sized(nodes: DataFrame) -> DataFrame:
    sizes = nodes.groupBy("_node").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return nodes.join(sizes, "_node")


def _leaves(reps: DataFrame) -> DataFrame:
    """``_node, _i, _j, _rep``: units to compare by brute force, all with two members or more.

    A node of more than LARGEST members is cut into blocks, and every two blocks are a
    unit of their own: any two members of a node meet, however large it is.
    """
    nodes = _sized(_first_nodes(reps)).withColumn("_blocks", F.ceil(F.col("_n") / LARGEST))
    placed = nodes.select("_node", "_rep", "_blocks", F.pmod(F.xxhash64("_rep", "_node"), F.col("_blocks")).alias("_block"))
    # Members of one block meet in each of its units, so a block is paired with others only.
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1),
                      lambda other: (other != F.col("_block")) | (F.col("_blocks") == 1))
    return placed.select("_node", "_block", "_rep", F.explode(others).alias("_other")).select(
        "_node", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"), "_rep")


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        p = self.parent
        while not np.array_equal(q := p[p], p):
            p = q
        self.parent = p
        return p

    def unite(self, members: np.ndarray) -> None:
        r = self.roots()
        own = np.unique(r[members])
        self.parent = np.where(np.isin(r, own), own[0], r)


def likely_clusters(values: np.ndarray) -> np.ndarray:
    """Root of each row such that rows with LEAST_EQUAL equal values have equal roots.

    Each pivot is compared with all rows. Rows of the largest cluster need not be
    pivots: pairs across clusters are seen from the other side.
    """
    n = len(values)
    forest, done = Forest(n), np.zeros(n, bool)
    pivot = 0
    while True:
        done[pivot] = True
        near = np.flatnonzero((values == values[pivot]).sum(1) >= LEAST_EQUAL)
        if len(near) > 1:
            forest.unite(near)
        roots = forest.roots()
        counts = np.bincount(roots, minlength=n)
        open_rows = np.flatnonzero((roots != counts.argmax()) & ~done)
        if not len(open_rows):
            return roots
        pivot = int(open_rows[0])


def _groups(batches, width: int):
    """Runs of rows with equal leading ``width`` columns, over sorted batches."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        if not held.num_rows:
            continue
        keys = [held.column(k).to_numpy() for k in range(width)]
        change = np.zeros(len(keys[0]) - 1, bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1])
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield held.slice(a, b - a)
        held = held.slice(cuts[-1]).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def likely_links(reps: DataFrame) -> DataFrame:
    """A forest ``a, b`` whose components hold every pair the runs have found: links to a cluster's head."""
    def run(batches):
        for group in _groups(batches, 3):
            ids = group.column(3).to_numpy()
            values = np.frombuffer(b"".join(group.column(4).to_pylist()), np.uint8).reshape(len(ids), VALUES)
            roots = likely_clusters(values)
            kept = roots != np.arange(len(ids))
            yield pa.record_batch([pa.array(ids[kept], pa.int64()), pa.array(ids[roots[kept]], pa.int64())], names=["a", "b"])

    rows = _leaves(reps).join(reps.select("_rep", "_low"), "_rep").select("_node", "_i", "_j", "_rep", "_low")
    return stored(rows.repartition("_node", "_i", "_j").sortWithinPartitions("_node", "_i", "_j", "_rep")
                  .mapInArrow(run, "a long, b long"), "likely")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: frequent shingles by matrix products, rare ones by their pairs."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(n), sizes)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, rows = flat[order], rows[order]
    starts = np.concatenate([[0], np.flatnonzero(flat[1:] != flat[:-1]) + 1, [len(flat)]]) if len(flat) else np.zeros(1, int)
    counts = np.diff(starts)
    common = np.zeros((n, n), np.float32)
    dense = counts >= max(2, n // 32)
    picked = np.flatnonzero(dense)
    for at in range(0, len(picked), 4096):
        part = picked[at:at + 4096]
        cols = np.repeat(np.arange(len(part)), counts[part])
        where = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in part])
        block = np.zeros((n, len(part)), np.float32)
        block[rows[where], cols] = 1
        common += block @ block.T
    rare = np.flatnonzero(~dense & (counts > 1))
    for count in np.unique(counts[rare]):
        own = rare[counts[rare] == count]
        # All shingles of one frequency at once, in slices of bounded size.
        per = max(1, 4_000_000 // int(count) ** 2)
        for at in range(0, len(own), per):
            members = rows[starts[own[at:at + per]][:, None] + np.arange(count)]
            left = np.broadcast_to(members[:, :, None], (*members.shape, count)).ravel()
            right = np.broadcast_to(members[:, None, :], (len(members), count, count)).ravel()
            common += np.bincount(left * n + right, minlength=n * n).reshape(n, n)
    return common


def unit_links(sets: list[np.ndarray], weights: np.ndarray, side: np.ndarray):
    """(links, linked rows, root) for each set of a unit.

    ``side`` is all zeros inside one block; else only pairs across sides count.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets])
    common = common_counts(sets)
    linked = common >= THRESHOLD * (sizes[:, None] + sizes[None, :] - common) - 1e-4
    linked &= (sizes > 0)[:, None] & (sizes > 0)[None, :]
    np.fill_diagonal(linked, False)
    if side.any():
        linked &= side[:, None] != side[None, :]
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        front = np.zeros(n, bool)
        front[start] = True
        while front.any():
            root[front] = start
            front = linked[front].any(0) & (root < 0)
    return linked.sum(1), linked @ weights, root


def _exact(df: DataFrame, reps: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_rep, _texts, _rows, _root``: partial counts of links and forest, by unit; stored."""
    members = reps.select("_rep", "_id", "_h1", "_h2", "_size", "_m").join(labels, F.col("_rep") == F.col("node"))
    totals = members.groupBy("label").agg(F.count(F.lit(1)).alias("_c"), F.sum("_size").alias("_s"))
    blocks = F.greatest(F.ceil(F.col("_c") / BLOCK_ROWS), F.ceil(F.col("_s") / BLOCK_SHINGLES))
    placed = (members.join(totals, "label")
              .select("_id", "_h1", "_h2", "_rep", "_m", "label", blocks.alias("_blocks"),
                      F.pmod(F.xxhash64("_rep"), blocks).alias("_block")))

    def sets(batches):
        seen = set()  # rows equal in id and text meet in one task: one of them is enough
        for batch in sliced(batches):
            found, keep = [], []
            for i, (text, rep) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if rep not in seen:
                    seen.add(rep)
                    found.append(shingles(text).tobytes())
                    keep.append(i)
            rest = batch.take(pa.array(keep, pa.int64()))
            yield pa.record_batch([*(rest.column(k) for k in range(1, 6)), pa.array(found, pa.binary())],
                                  names=["_rep", "_m", "label", "_blocks", "_block", "_set"])

    rows, wanted = _hashed(df, id_col, text_col), placed.withColumnsRenamed({"_id": "_i", "_h1": "_x1", "_h2": "_x2"})
    with_sets = (rows.join(wanted, _same_row())
                 .select("_t", "_rep", "_m", "label", "_blocks", "_block")
                 .mapInArrow(sets, "_rep long, _m long, label long, _blocks long, _block long, _set binary"))
    units = with_sets.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_other")).select(
        "label", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"),
        "_rep", "_m", "_block", "_set")

    def run(batches):
        for group in _groups(batches, 3):
            ids, weights, side = (group.column(k).to_numpy() for k in (3, 4, 5))
            _, first = np.unique(ids, return_index=True)  # repeated input rows
            found = group.column(6).to_pylist()
            texts_, rows, root = unit_links([np.frombuffer(found[i], np.uint64) for i in first],
                                            weights[first].astype(np.float64),
                                            side[first] - side[first].min() if len(first) else side)
            ids = ids[first]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts_, pa.int64()),
                                   pa.array(rows.astype(np.int64), pa.int64()), pa.array(ids[root], pa.int64())],
                                  names=["_rep", "_texts", "_rows", "_root"])

    return stored(units.repartition("label", "_i", "_j").sortWithinPartitions("label", "_i", "_j", "_rep")
                  .mapInArrow(run, "_rep long, _texts long, _rows long, _root long"), "exact")


def _same_row() -> Column:
    return (F.col("_h1") == F.col("_x1")) & (F.col("_h2") == F.col("_x2")) & F.col("_id").eqNullSafe(F.col("_i"))


def _classes(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, sets and classes; texts without words are among the rows only.

    Rows are those of ``_embedded``. Sets: ``_k1, _k2, _label, _m, _texts, _near``. Classes:
    ``_label, _first``, the latter id (null last) and text hashes of the row that comes first.
    """
    rows = _embedded(df, id_col, text_col)
    first = F.struct(F.col("_id").isNull().alias("_null"), "_id", "_h1", "_h2")
    groups = stored(rows.filter("_size > 0").groupBy("_k1", "_k2").agg(
        F.min("_row").alias("_rep"), F.min(first).alias("_first"), F.count(F.lit(1)).alias("_m")), "groups")
    reps = stored(rows.filter("_size > 0").join(groups.select("_rep", "_m"), F.col("_row") == F.col("_rep"))
                  .select("_rep", "_id", "_h1", "_h2", "_size", "_tokens", "_low", "_m"), "representatives")
    exact = _exact(df, reps, components(likely_links(reps)), id_col, text_col)
    counts = exact.groupBy("_rep").agg(F.sum("_texts").alias("_texts"), F.sum("_rows").alias("_rows"))
    forest = components(exact.filter("_rep <> _root").select(F.col("_rep").alias("a"), F.col("_root").alias("b")))
    sets = stored(groups.join(counts, "_rep", "left").join(forest, F.col("_rep") == F.col("node"), "left")
                  .select("_k1", "_k2", "_first", "_m", F.coalesce("label", "_rep").alias("_label"),
                          F.coalesce("_texts", F.lit(0)).alias("_texts"), F.coalesce("_rows", F.lit(0)).alias("_near")),
                  "sets")
    return rows, sets.drop("_first"), sets.groupBy("_label").agg(F.min("_first").alias("_first"))


def _named(classes: DataFrame) -> DataFrame:
    """``_label, _class`` for classes ``_label, _first``: a number that no other class has.

    It is the smallest id. A class without ids, and all but one of those with the same
    smallest id, take the smallest row number, counted from the least long.
    """
    number = F.col("_label") + F.lit(-LAST_ID - 1)
    with_id = classes.filter("_first._id IS NOT NULL").select("_label", "_first._id", "_first._h1", "_first._h2")
    shared = (with_id.groupBy("_id").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_h1", "_h2", "_label")).alias("_s"))
              .filter("_n > 1").select("_id", F.col("_s._label").alias("_holder")))
    return (with_id.join(shared, "_id", "left")
            .select("_label", F.when(F.col("_holder") != F.col("_label"), number).otherwise(F.col("_id")).alias("_class"))
            .unionByName(classes.filter("_first._id IS NULL").select("_label", number.alias("_class"))))


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, n_links, n_text_links`` for every row.

    A link joins two rows whose shingle sets have a Jaccard similarity of 0.8 or more.
    Classes are connected by links; ``class_id`` is the smallest id in the class. A class
    without ids, or whose smallest id is that of another class too, has a negative number
    of its own (see ``_named``). ``n_links`` counts linked rows, copies included,
    ``n_text_links`` linked sets that differ. Texts without words have no links, each
    is its own class.
    """
    rows, sets, classes = _classes(df, id_col, text_col)
    bare = rows.filter("_size = 0")
    alone = bare.select(F.col("_row").alias("_label"),
                        F.struct(F.col("_id").isNull().alias("_null"), "_id", "_h1", "_h2").alias("_first"))
    names = stored(_named(classes.unionByName(alone)), "names")
    linked = rows.filter("_size > 0").select("_id", "_k1", "_k2").join(sets.join(names, "_label"), ["_k1", "_k2"]).select(
        F.col("_id").alias("doc_id"), F.col("_class").alias("class_id"),
        (F.col("_m") - 1 + F.col("_near")).alias("n_links"), F.col("_texts").alias("n_text_links"))
    none = F.lit(0).cast("long")
    return linked.unionByName(bare.select("_id", "_row").join(names, F.col("_row") == F.col("_label")).select(
        F.col("_id").alias("doc_id"), F.col("_class").alias("class_id"),
        none.alias("n_links"), none.alias("n_text_links")))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay: of each class the one with the smallest id, and texts without words.

    A null id comes after all others. Rows that tie on the smallest id stay once.
    """
    rows, sets, classes = _classes(df, id_col, text_col)
    judged = (rows.filter("_size > 0").select("_id", "_h1", "_h2", "_k1", "_k2")
              .join(sets.join(classes, "_label").select("_k1", "_k2", "_first"), ["_k1", "_k2"]))
    first = (F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_h1") == F.col("_first._h1"))
             & (F.col("_h2") == F.col("_first._h2")))
    # Rows equal in id and text are in one class, so they fare alike: all go, or one stays.
    acted = stored(judged.groupBy(F.col("_id").alias("_i"), F.col("_h1").alias("_x1"), F.col("_h2").alias("_x2"))
                   .agg(F.bool_or(first).alias("_thin"), F.count(F.lit(1)).alias("_n"))
                   .filter("NOT _thin OR _n > 1").drop("_n"), "acted")
    names = df.columns
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_own"),
                    F.col(f"`{id_col}`").cast("long").alias("_id"),
                    *_hashes(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
    single = own.join(acted, _same_row(), "left_anti").select("_own.*")
    one = Window.partitionBy("_id", "_h1", "_h2").orderBy(F.to_json("_own"))
    tied = (own.join(acted.filter("_thin"), _same_row(), "left_semi").withColumn("_rank", F.row_number().over(one))
            .filter("_rank = 1").select("_own.*"))
    return single.unionByName(tied)

"""Ordered computations inside a group of any size, as one lazy plan.

A plain window sorts a whole group in one task, so one key holding a third of the rows
would hold up the job. Here groups are cut into chunks of neighbouring rows: windows
run inside ``keys + chunk``, and one summary row per chunk is carried across chunks, as
in a parallel prefix scan. The result equals the plain window.

Chunks come from the order itself. A row has a position (the microsecond of an instant,
or an id) and a unique number among rows of one position. A group of more than
``CHUNK_ROWS`` rows is cut by the high digits of the position; a piece that is still
larger by the next digits, then by single positions and blocks of numbers. So rows of
one instant are cut too, a chunk has ``CHUNK_ROWS`` rows or one block of numbers, and no
piece has more than 65,536 parts on one level. The counts that decide are aggregates in
the same plan, over keys and digits only: nothing runs while the plan is built, nothing
is collected, and a small group is the case of a single chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a group or piece that one task sorts without trouble.
CHUNK_ROWS = 5_000_000
#: Positions in a piece of the first and second level, as powers of two.
HIGH, LOW = 32, 16
#: Numbers in a block of one position, as a power of two.
BLOCK = 20


def _position(df: DataFrame, column: str) -> Column:
    """The first ordering column as a number."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("bigint")


def _digits(df: DataFrame, order: Sequence[str]) -> DataFrame:
    place = _position(df, order[0])
    return df.withColumn("_high", F.shiftright(place, HIGH)).withColumn("_low", F.shiftright(place, LOW))


def cuts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = CHUNK_ROWS,
) -> list[DataFrame]:
    """Groups and pieces of more than ``rows`` rows, by level.

    Each list has at most one entry for so many rows of the input, so it is broadcast. A
    level counts only what the one before has listed: mostly the rows of no group. Lists
    made from more rows than a computation has serve it as well.
    """
    marked, lists = _digits(df.select(*dict.fromkeys([*keys, order[0]])), order), []
    for flag, names in (("_cut1", [*keys]), ("_cut2", [*keys, "_high"]), ("_cut3", [*keys, "_high", "_low"])):
        if lists:
            marked = marked.join(lists[-1], names[:-1], "left_semi")
        counts = marked.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"))
        lists.append(F.broadcast(counts.filter(F.col("_rows") > rows).drop("_rows").withColumn(flag, F.lit(True))))
    return lists


def with_chunk(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], lists: Sequence[DataFrame],
) -> DataFrame:
    """Add ``_chunk``, a struct that sorts as the rows do; -1 where a level is not cut.

    ``lists`` come from ``cuts``; ``_cut`` tells whether the group is cut at all.
    """
    keys = list(keys)
    place = _position(df, order[0])
    number = F.col(order[1]).cast("bigint") if len(order) > 1 else place
    marked = _digits(df, order)
    for level, found in zip(([], ["_high"], ["_high", "_low"]), lists):
        marked = marked.join(found, [*keys, *level], "left")
    none = F.lit(-1).cast("bigint")
    chunk = F.struct(
        F.when(F.col("_cut1"), F.col("_high")).otherwise(none).alias("a"),
        F.when(F.col("_cut2"), F.col("_low")).otherwise(none).alias("b"),
        F.when(F.col("_cut3"), place).otherwise(none).alias("c"),
        F.when(F.col("_cut3"), F.shiftright(number, BLOCK)).otherwise(none).alias("d"))
    return marked.select(*df.columns, chunk.alias("_chunk"), F.col("_cut1").isNotNull().alias("_cut"))


def with_neighbor(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], name: str,
    following: bool = False, chunk_rows: int = CHUNK_ROWS, lists: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Add struct ``name`` with ``columns`` of the previous (or following) row.

    The struct is null at the start (or end) of a group. ``keys`` and ``order`` columns are
    not null. ``lists`` are those of ``cuts``, made here if not given. Only the first row of a chunk of a cut group looks into another chunk, so one
    row per chunk goes through the second, small window.
    """
    keys, order = list(keys), list(order)
    step, far_end = (F.lead, F.first) if following else (F.lag, F.last)
    row = F.struct(*columns)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    across = Window.partitionBy(*keys).orderBy("_chunk")
    near = (with_chunk(df, keys, order, lists or cuts(df, keys, order, chunk_rows))
            .withColumn("_near", step(row).over(inside)).withColumn("_far", far_end(row).over(whole)))
    border = F.col("_near").isNull() & F.col("_cut")
    settled = near.filter(~border)
    carried = near.filter(border).withColumn("_near", step("_far").over(across))
    return (settled.unionByName(carried)).select(*df.columns, F.col("_near").alias(name))


def with_running_levels(
    df: DataFrame, keys: Sequence[str], order: Sequence[str],
    deltas: dict[str, tuple[str, str | None]], floor_at_zero: bool = True, chunk_rows: int = CHUNK_ROWS,
    lists: Sequence[DataFrame] | None = None, openings: DataFrame | None = None,
) -> DataFrame:
    """Add running levels of signed movements.

    ``deltas`` maps an output name to ``(delta column, opening level column)``.
    With ``floor_at_zero`` each step is clamped, ``level = max(level + delta, 0)``,
    in closed form: with prefix sums S the level is ``S + max(opening, -min(S))``.
    Both S and its running minimum combine across chunks. ``lists`` are those of ``cuts``,
    made here if not given. ``openings`` have the opening levels by ``keys``, one row each,
    where ``df`` does not.
    """
    keys, order = list(keys), list(order)
    marked = with_chunk(df, keys, order, lists or cuts(df, keys, order, chunk_rows))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def prefixes(rows: DataFrame) -> DataFrame:
        """Sums inside chunks and their running minimum."""
        for name, (delta, _) in deltas.items():
            rows = rows.withColumn(f"_s_{name}", F.sum(delta).over(upto))
        for name in deltas:
            rows = rows.withColumn(f"_m_{name}", F.min(f"_s_{name}").over(upto))
        return rows

    def opened(rows: DataFrame) -> DataFrame:
        return rows if openings is None else rows.join(openings, keys, "left")

    def levels(rows: DataFrame, carried: bool) -> DataFrame:
        """Levels from local sums, plus what earlier chunks carry over."""
        made = []
        for name, (_, opening) in deltas.items():
            start = F.coalesce(F.col(opening), F.lit(0)) if opening else F.lit(0)
            base = F.col(f"_b_{name}") if carried else F.lit(0)
            total = base + F.col(f"_s_{name}")
            if not floor_at_zero:
                made.append((total + start).alias(name))
                continue
            lowest = base + F.col(f"_m_{name}")
            if carried:
                # least() skips nulls, so the first chunk needs no special case.
                lowest = F.least(F.col(f"_n_{name}"), lowest)
            made.append((total + F.greatest(start, -lowest)).alias(name))
        return rows.select(*df.columns, *made)

    # Cut groups: one row per chunk with its total and its lowest prefix.
    split = prefixes(marked.filter("_cut"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = split.groupBy(*keys, "_chunk").agg(*[
        F.sum(delta).alias(f"_t_{name}") for name, (delta, _) in deltas.items()
    ], *[F.min(f"_s_{name}").alias(f"_l_{name}") for name in deltas])
    for name in deltas:
        totals = totals.withColumn(f"_b_{name}", F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)))
    for name in deltas:
        lowest = F.min(F.col(f"_b_{name}") + F.col(f"_l_{name}")).over(before)
        totals = totals.withColumn(f"_n_{name}", lowest)
    carried = totals.select(*keys, "_chunk", *[f"_{p}_{name}" for name in deltas for p in ("b", "n")])
    # Told apart before the windows, so that rows of small groups are shuffled and sorted once.
    return levels(prefixes(opened(marked.filter("NOT _cut"))), carried=False).unionByName(
        levels(opened(split.join(carried, [*keys, "_chunk"])), carried=True))

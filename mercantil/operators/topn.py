"""First rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key by ``order`` (ascending, nulls first).

    An aggregate instead of a ranking window: it combines map-side, so a hot
    key sends one row per task through the shuffle.
    """
    return _edge_per_key(df, keys, F.min_by, order)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key by ``order`` (nulls never beat a value)."""
    return _edge_per_key(df, keys, F.max_by, order)


def _edge_per_key(df: DataFrame, keys: Sequence[str], pick, order) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    names = [c for c in order if isinstance(c, str)]
    if len(names) == len(order) and set(rest) <= set(names):
        # The order tells the whole row, so it is sent once.
        edge = (F.min if pick is F.min_by else F.max)(F.struct(*dict.fromkeys(names))).alias("_edge")
        return df.groupBy(*keys).agg(edge).select(*keys, *[F.col("_edge")[c].alias(c) for c in rest]).select(*df.columns)
    edge = pick(F.struct(*rest), F.struct(*order)).alias("_edge")
    return df.groupBy(*keys).agg(edge).select(*keys, "_edge.*").select(*df.columns)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], spread: Sequence[str],
    n: int, salts: int = 256,
) -> DataFrame:
    """The first ``n`` rows of each group, exact for groups of any size.

    Few groups hold all rows, so a first pass ranks inside ``salts`` slices of
    each group (by a hash of ``spread``); at most ``n * salts`` rows per group
    reach the second pass.
    """
    keys = list(keys)
    slice_of = F.pmod(F.xxhash64(*spread), F.lit(salts))
    sliced = Window.partitionBy(*keys, "_slice").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_slice", slice_of)
        .withColumn("_rank", F.row_number().over(sliced)).filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(final)).filter(F.col("_rank") <= n)
        .drop("_slice", "_rank")
    )

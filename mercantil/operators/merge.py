"""Key-based merges as joins: insert only, upsert and update only.

Each returns the new content of the target. All are idempotent: merging the
same rows again changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.operators.topn import first_per_key


def new_rows(
    target: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Incoming rows whose key the target lacks, one per key.

    ``order`` decides which of several incoming rows wins (the first); without
    it the whole row decides, so the result does not depend on the input order.
    """
    keys = list(keys)
    if order is None:
        order = [c for c in incoming.columns if c not in keys]
    rows = first_per_key(incoming, keys, order)
    if target is None:
        return rows
    return rows.join(target.select(*keys), keys, "left_anti")


def merge_insert_only(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str],
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Keep every target row and append the keys it lacks."""
    return target.unionByName(new_rows(target, incoming, keys, order))


def merge_upsert(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str],
    replace: Sequence[str] = (), fill: Sequence[str] = (), fill_if: str | None = None,
) -> DataFrame:
    """Insert new keys; on a known key change only the named columns.

    ``replace`` takes the incoming value as it is, ``fill`` takes it unless it
    is null. Other columns keep the target value. ``incoming`` has one row per
    key.
    """
    keys = list(keys)
    replace, fill = set(replace), set(fill)
    old = target.withColumn("_known", F.lit(True)).alias("o")
    new = incoming.withColumn("_given", F.lit(True)).alias("n")
    joined = old.join(new, keys, "full_outer")
    known, given = F.col("o._known").isNotNull(), F.col("n._given").isNotNull()

    def merged(column: str) -> Column:
        before, after = F.col(f"o.{column}"), F.col(f"n.{column}")
        if column in replace:
            value = F.when(given, after).otherwise(before)
        elif column in fill:
            allowed = F.col(f"n.{fill_if}") | ~known if fill_if else F.lit(True)
            value = F.when(given & allowed, F.coalesce(after, before)).otherwise(before)
        else:
            value = F.when(known, before).otherwise(after)
        return value.alias(column)

    return joined.select(*[F.col(c) if c in keys else merged(c) for c in target.columns])


def merge_update_only(
    target: DataFrame, changes: DataFrame, keys: Sequence[str],
    columns: Sequence[str] | Mapping[str, str],
) -> DataFrame:
    """Set columns of known keys where the change is not null; add no row.

    ``changes`` has one row per key.
    """
    keys = list(keys)
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    changed = changes.select(*keys, *[F.col(src).alias(f"_new_{dst}") for dst, src in names.items()])
    joined = target.join(changed, keys, "left")
    return joined.select(*[
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in names else F.col(c)
        for c in target.columns
    ])

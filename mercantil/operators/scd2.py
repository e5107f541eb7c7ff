"""Type 2 dimensions: merge a snapshot, or build the whole history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.functions.expressions import micros, surrogate_key
from mercantil.operators.ordered import CHUNK_ROWS, cuts, with_neighbor

VALIDITY = ["valido_desde", "valido_hasta", "es_actual"]


def _version_key(key: str) -> Column:
    return surrogate_key(key, micros("valido_desde"))


def changed(tracked: Sequence[str], before: str, after: str) -> Column:
    """True when any tracked column differs; two nulls are equal."""
    test = F.lit(False)
    for column in tracked:
        test = test | ~F.col(f"{before}.{column}").eqNullSafe(F.col(f"{after}.{column}"))
    return test


def new_versions(
    incoming: DataFrame, key: str, sk: str, ts: Column | str,
) -> DataFrame:
    """Incoming snapshot rows as open versions starting at ``ts``."""
    start = F.col(ts) if isinstance(ts, str) else ts
    columns = [c for c in incoming.columns if c not in (*VALIDITY, sk)]
    return (
        incoming.withColumn("valido_desde", start.cast("timestamp"))
        .withColumn("valido_hasta", F.lit(None).cast("timestamp"))
        .withColumn("es_actual", F.lit(True))
        .select(_version_key(key).alias(sk), *columns, *VALIDITY)
    )


def scd2_apply(
    dim: DataFrame, incoming: DataFrame, key: str, sk: str, tracked: Sequence[str],
    ts: Column | str,
) -> DataFrame:
    """New content of ``dim`` after seeing the ``incoming`` snapshot.

    One row per key in ``incoming``. ``ts`` is the change time: a literal, or
    a column of ``incoming``. A current version whose tracked columns are
    unchanged stays as it is (untracked columns included); a changed one is
    closed at ``ts`` and a new one opened. Keys absent from ``incoming`` stay.
    A change that is not later than the current version's start opens a
    microsecond after it, so intervals never overlap and keys stay distinct.
    """
    current = dim.filter("es_actual")
    open_since = current.select(F.col(key).alias("_k"), F.col("valido_desde").alias("_open"))
    start = F.col(ts) if isinstance(ts, str) else ts
    later = F.greatest(start.cast("timestamp"), F.timestamp_micros(micros("_open") + 1))
    timed = incoming.join(open_since, F.col(key) == F.col("_k"), "left").withColumn("_start", later)
    opened = (new_versions(timed.drop("_k", "_open"), key, sk, "_start").drop("_start")
              .withColumn("_in", F.lit(True)))
    closed_before = dim.filter("NOT es_actual")

    joined = current.alias("o").join(
        opened.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    differs = changed(tracked, "o", "n")
    had, seen = F.col(f"o.{key}").isNotNull(), F.col("n._in").isNotNull()
    old, new = (F.struct(*[F.col(f"{side}.{c}").alias(c) for c in dim.columns]) for side in "on")
    closed = F.struct(*[
        F.col("n.valido_desde").alias(c) if c == "valido_hasta"
        else F.lit(False).alias(c) if c == "es_actual"
        else F.col(f"o.{c}").alias(c)
        for c in dim.columns
    ])
    # One pass over the join gives one row (kept, new) or two (closed, new).
    rows = (
        F.when(had & (~seen | ~differs), F.array(old))
        .when(had, F.array(closed, new))
        .otherwise(F.array(new))
    )
    touched = joined.select(F.explode(rows).alias("r")).select("r.*")
    return closed_before.unionByName(touched)


def scd2_close(dim: DataFrame, ids: DataFrame, key: str, ts: Column) -> DataFrame:
    """Close the current version of each key in ``ids`` at ``ts``."""
    hit = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    closing = F.col("_hit").isNotNull() & F.col("es_actual")
    joined = dim.join(hit, key, "left")
    return joined.select(*[
        F.when(closing, ts.cast("timestamp")).otherwise(F.col(c)).alias(c) if c == "valido_hasta"
        else (F.col(c) & ~closing).alias(c) if c == "es_actual"
        else F.col(c)
        for c in dim.columns
    ])


def scd2_history(
    changes: DataFrame, key: str, sk: str, tracked: Sequence[str], ts: str, event_id: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """All versions from a change log, ordered by ``(ts, event_id)``.

    A row that repeats the tracked values of the row before opens no version.
    """
    tracked = list(tracked)
    # Change points are fewer than changes, so the same lists serve both passes.
    lists = cuts(changes, [key], [ts, event_id], chunk_rows)
    seen = with_neighbor(changes, [key], [ts, event_id], tracked, "_prev", lists=lists)
    now = F.struct(*tracked)
    points = seen.filter(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(now)).drop("_prev")
    # Change points of equal time close at once and are empty spans; they stay,
    # as each of them was a version.
    spans = with_neighbor(
        points, [key], [ts, event_id], [ts], "_next", following=True, lists=lists)
    columns = [c for c in changes.columns if c not in (ts, event_id)]
    return spans.select(
        surrogate_key(key, micros(ts), event_id).alias(sk), *columns,
        F.col(ts).alias("valido_desde"), F.col(f"_next.{ts}").alias("valido_hasta"),
        F.col("_next").isNull().alias("es_actual"),
    )

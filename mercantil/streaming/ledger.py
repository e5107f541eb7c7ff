"""Deduplication across batches: a ledger of settled event ids by day.

An event is settled once it is loaded, counted without effect, or a dead letter. A later
delivery of it is dropped before it reaches a loader. The ledger is placed by the day
the event occurred, so a batch reads only the days that it holds, however long the
history; it is append-only, and the last batch of each writer makes a replay harmless.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.sources.snapshots import KeyedTable


def day_of_event() -> Column:
    """The day an event is filed under; events without a time are filed together."""
    return F.coalesce(F.to_date("ocurrido_en"), F.to_date(F.lit("1970-01-01")))


@dataclass(frozen=True)
class EventLedger:
    table: KeyedTable

    def unseen(self, events: DataFrame, among: DataFrame | None = None) -> DataFrame:
        """The events that are not settled yet; ``among`` has all their days and is cheaper to read."""
        if self.table.is_empty():
            return events
        dated = events.withColumn("_dia", day_of_event())
        known = self.table.read_for((events if among is None else among).select(day_of_event().alias("dia")).distinct())
        # Joined by id alone, as events are dealt for their deduplication: they are shuffled once.
        known = known.groupBy(F.col("evento_negocio_id").alias("_visto")).agg(F.collect_set("dia").alias("_dias"))
        same = (F.col("evento_negocio_id") == F.col("_visto")) & F.array_contains("_dias", F.col("_dia"))
        return dated.join(known, same, "left_anti").select(*events.columns)

    def settle(self, events: DataFrame, writer: str, batch_id: int) -> bool:
        """Add the ids of ``events``; False if this batch was added before."""
        rows = events.select("evento_negocio_id", day_of_event().alias("dia"))
        return self.table.insert(rows, writer, batch_id, compact=DataFrame.distinct)

"""Health of the pipeline in one row, and progress of its streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from mercantil.functions.expressions import percent


def pipeline_health(
    pending: DataFrame, dlq: DataFrame, fact_pedidos: DataFrame, fact_envios: DataFrame,
    fact_carritos: DataFrame, watermarks: DataFrame, unmatched: DataFrame | None = None,
) -> DataFrame:
    """Counts of events and facts, cart conversion and order watermark.

    Each count is one row, stacked and folded by a global aggregate, so
    nothing but one row per source meets in a task. ``unmatched`` holds
    handled events whose source row was missing.
    """
    names = ["eventos_pendientes", "dlq_total", "pedidos", "envios", "carritos",
             "convertidos", "sin_origen"]

    def count(df: DataFrame, name: str, converted: bool = False) -> DataFrame:
        counts = {name: F.count("*")}
        if converted:
            counts["convertidos"] = F.count_if(F.col("convertido"))
        row = df.agg(*[v.alias(k) for k, v in counts.items()])
        return row.select(
            *[F.col(n) if n in counts else F.lit(None).cast("bigint").alias(n) for n in names],
            F.lit(None).cast("timestamp").alias("marca"))

    rows = [
        count(pending, "eventos_pendientes"), count(dlq, "dlq_total"),
        count(fact_pedidos, "pedidos"), count(fact_envios, "envios"),
        count(fact_carritos, "carritos", converted=True),
        watermarks.filter("tabla_fuente = 'pedidos'").select(
            *[F.lit(None).cast("bigint").alias(n) for n in names],
            F.col("ultima_carga").alias("marca")),
    ]
    if unmatched is not None:
        rows.append(count(unmatched, "sin_origen"))
    total = reduce(DataFrame.unionByName, rows).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
        F.max("marca").alias("marca_pedidos"))
    return total.withColumn(
        "tasa_conversion_pct",
        F.coalesce(percent(F.col("convertidos"), F.col("carritos"), 1), F.lit(0)))


class ProgressLog(StreamingQueryListener):
    """Keeps the last progress of each stream by name."""

    def __init__(self, keep: int = 100):
        self.keep = keep
        self.progress: list[dict] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.progress.append({
            "name": p.name, "batch": p.batchId, "rows": p.numInputRows,
            "rows_per_second": p.processedRowsPerSecond})
        del self.progress[:-self.keep]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

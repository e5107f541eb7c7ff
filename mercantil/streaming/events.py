"""The event log: reading, deduplication, routing, dead letters, watermarks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercantil import schemas
from mercantil.functions import constants as C
from mercantil.functions.expressions import lookup
from mercantil.functions.payload import CORRUPT
from mercantil.operators.merge import merge_insert_only
from mercantil.operators.topn import first_per_key

LOADER_BY_EVENT = {
    event: loader for loader, events in C.EVENTS_BY_LOADER.items() for event in events
}

# Source table whose watermark a loader moves.
SOURCE_BY_LOADER = {
    "order_created": "pedidos",
    "payment": "pagos",
    "stock": "movimientos_inventario",
    "shipment_delivered": "envios",
    "return": "devoluciones",
}


def read_events(
    spark: SparkSession, path: str, fmt: str = "json", files_per_trigger: int | None = None,
    schema: str = schemas.EVENTS, **options: str,
) -> DataFrame:
    """Stream of new event files under ``path``.

    The checkpoint of the query remembers what was read, so no processed flag
    is kept on the events.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def poll(events: DataFrame, n: int = C.POLL_BATCH) -> DataFrame:
    """The oldest unprocessed events with attempts left, as one poll takes them."""
    pending = events.filter(
        ~F.col("procesado_olap") & (F.col("intentos_olap") < C.MAX_ATTEMPTS))
    return pending.orderBy("ocurrido_en", "evento_negocio_id").limit(n)


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per event id: most attempts, then the earliest, then by content.

    A delivery of an event that waits for its retry does not reset its attempts.
    """
    if "intentos_olap" in events.columns:
        events = events.withColumn("_left", -F.col("intentos_olap"))
        rest = [c for c in events.columns if c not in ("evento_negocio_id", "_left", "ocurrido_en")]
        return first_per_key(events, ["evento_negocio_id"], ["_left", "ocurrido_en", *rest]).drop("_left")
    rest = [c for c in events.columns if c not in ("evento_negocio_id", "ocurrido_en")]
    return first_per_key(events, ["evento_negocio_id"], ["ocurrido_en", *rest])


def dedup_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop repeated ids that arrive within ``delay``, with bounded state.

    Optional: it also drops events later than ``delay``. The loader is safe
    without it, since a batch is deduplicated by id, and across batches by the
    ledger of settled ids, which keeps late events.
    """
    return events.withWatermark("ocurrido_en", delay).dropDuplicatesWithinWatermark(
        ["evento_negocio_id"])


def with_heartbeat(events: DataFrame) -> DataFrame:
    """The stream with a clock beside it that brings batches, but no rows."""
    beat = events.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    empty = beat.filter("value < 0").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields])
    return events.unionByName(empty)


def route_events(events: DataFrame, extra: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``cargador``, the loader in charge; null when there is none."""
    table = {**LOADER_BY_EVENT, **(extra or {})}
    return events.withColumn("cargador", lookup(table, "tipo_evento"))


def _dead(events: DataFrame, reason: str, error: Column, at: Column) -> DataFrame:
    return events.select(
        F.col("evento_negocio_id").alias("evento_id"), "tipo_evento",
        F.coalesce("payload", F.lit("{}")).alias("payload"), F.lit(reason).alias("motivo"),
        error.cast("string").alias("error_detalle"), at.alias("creado_en"))


def dlq_unhandled(routed: DataFrame, at: Column | None = None) -> DataFrame:
    """Dead letters of events that no loader takes."""
    at = F.current_timestamp() if at is None else at
    return _dead(routed.filter("cargador IS NULL"), C.DLQ_NO_HANDLER, F.lit(None), at)


def is_good(events: DataFrame) -> Column:
    """Whether a routed event has a loader and neither a payload nor a row error."""
    good = F.col("cargador").isNotNull() & F.col(CORRUPT).isNull()
    return good & F.col("error_fila").isNull() if "error_fila" in events.columns else good


def failed_events(routed: DataFrame) -> DataFrame:
    """Events of a known type whose payload or source rows cannot be used, with the error.

    ``error_fila`` holds row errors where they were looked for. ``intentos_olap`` counts
    the attempts including this one.
    """
    attempts = F.col("intentos_olap") if "intentos_olap" in routed.columns else F.lit(0)
    error = F.concat(F.lit("payload ilegible: "), F.col(CORRUPT))
    if "error_fila" in routed.columns:
        error = F.coalesce(error, "error_fila")
    return (
        routed.filter(F.col("cargador").isNotNull() & ~is_good(routed))
        .withColumn("intentos_olap", (attempts + 1).cast("int"))
        .withColumn("error_olap", F.substring(error, 1, C.ERROR_LENGTH))
    )


def dlq_failed(failed: DataFrame, at: Column | None = None) -> DataFrame:
    """Dead letters of events that failed for the last time."""
    at = F.current_timestamp() if at is None else at
    spent = failed.filter(F.col("intentos_olap") >= C.MAX_ATTEMPTS)
    return _dead(spent, C.DLQ_RETRIES, F.col("error_olap"), at)


def to_retry(failed: DataFrame) -> DataFrame:
    """Failed events with attempts left."""
    return failed.filter(F.col("intentos_olap") < C.MAX_ATTEMPTS)


def dlq_put(dlq: DataFrame, letters: DataFrame) -> DataFrame:
    """Dead-letter table with new letters; a known event id is left alone."""
    return merge_insert_only(dlq, letters, ["evento_id"])


def watermarks(routed: DataFrame, at: Column | None = None) -> DataFrame:
    """Per source: newest event loaded, and when."""
    at = F.current_timestamp() if at is None else at
    loaded = routed.filter(is_good(routed))
    source = lookup(SOURCE_BY_LOADER, "cargador").alias("tabla_fuente")
    return (
        loaded.select(source, "ocurrido_en").filter("tabla_fuente IS NOT NULL")
        .groupBy("tabla_fuente").agg(F.max("ocurrido_en").alias("ultima_carga"))
        .withColumn("actualizado_en", at)
    )


def update_watermarks(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Watermark table moved forward, never back."""
    both = current.unionByName(seen)
    return both.groupBy("tabla_fuente").agg(
        F.max("ultima_carga").alias("ultima_carga"),
        F.max("actualizado_en").alias("actualizado_en"))

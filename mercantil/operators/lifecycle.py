"""Order life cycle, payments, refunds, returns and carts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.functions import constants as C
from mercantil.functions import expressions as X
from mercantil.operators.ordered import CHUNK_ROWS, with_neighbor
from mercantil.operators.topn import first_per_key, last_per_key, top_n_per_group


def _age_at_least(now: Column, seconds: Column | int) -> Column:
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.unix_micros(now) - F.unix_micros("actualizado_en") >= seconds * 1_000_000


def lifecycle_due(
    orders: DataFrame, now: Column, per_state: int = C.LIFECYCLE_BATCH,
    min_age: int = C.LIFECYCLE_MIN_AGE_SECONDS,
) -> DataFrame:
    """Per state the oldest orders due to move on, with their next state.

    Orders in transit wait at least twice the minimum age (60 s or more).
    Confirmed orders move on by payment, see ``payment_candidates``.
    """
    transit = max(2 * min_age, C.TRANSIT_MIN_AGE_SECONDS)
    state = F.col("estado_actual")
    age = F.when(state == "enviado", transit).otherwise(min_age)
    movable = [s for s in C.ORDER_FLOW[:-1] if s != "confirmado"]
    due = (
        orders.filter(state.isin(movable) & _age_at_least(now, age))
        .select("pedido_id", "estado_actual", "actualizado_en")
    )
    oldest = top_n_per_group(
        due, ["estado_actual"], [F.col("actualizado_en"), F.col("pedido_id")],
        ["pedido_id"], per_state)
    return oldest.withColumn("estado_siguiente", X.next_state("estado_actual"))


def payment_candidates(
    orders: DataFrame, now: Column, n: int | None = C.LIFECYCLE_BATCH,
    min_age: int = C.LIFECYCLE_MIN_AGE_SECONDS,
) -> DataFrame:
    """Oldest unpaid orders in a payable state."""
    due = (
        orders.filter(F.col("estado_actual").isin("pendiente", "confirmado")
                      & (F.col("estado_pago") != "pagado") & _age_at_least(now, min_age))
        .select("pedido_id", "estado_actual", "cliente_id", "total_final", "actualizado_en")
        .orderBy("actualizado_en", "pedido_id")
    )
    return due if n is None else due.limit(n)


def fulfillment_status(orders: DataFrame) -> DataFrame:
    """Fulfillment that follows from each order's state."""
    return orders.select(
        "pedido_id", "estado_actual",
        F.coalesce(X.fulfillment_of("estado_actual"), F.lit("pendiente"))
        .alias("estado_fulfillment"))


def state_history(
    events: DataFrame, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every state an order took, with the state before it.

    ``events`` are parsed; creation sets 'pendiente', cancelling 'cancelado'.
    """
    kind = F.col("tipo_evento")
    state = (
        F.when(kind.isin(C.EVENTS_BY_LOADER["order_created"]), "pendiente")
        .when(kind.isin(C.EVENTS_BY_LOADER["order_cancelled"]), "cancelado")
        .when(kind.isin(C.EVENTS_BY_LOADER["order_updated"]), F.col("estado_nuevo"))
    )
    steps = events.select(
        "pedido_id", "ocurrido_en", "evento_negocio_id", state.alias("estado_nuevo")
    ).filter("pedido_id IS NOT NULL AND estado_nuevo IS NOT NULL")
    linked = with_neighbor(
        steps, ["pedido_id"], ["ocurrido_en", "evento_negocio_id"], ["estado_nuevo"], "_prev",
        chunk_rows=chunk_rows)
    return linked.select(
        "evento_negocio_id", "pedido_id", F.col("_prev.estado_nuevo").alias("estado_anterior"),
        "estado_nuevo", F.col("ocurrido_en").alias("cambiado_en"))


def latest_captured(payments: DataFrame) -> DataFrame:
    """The last captured payment per order."""
    return last_per_key(
        payments.filter("estado = 'capturado'")
        .select("pedido_id", "pago_id", "monto", "creado_en"),
        ["pedido_id"], ["creado_en", "pago_id"])


def cancel_refunds(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Refunds owed for cancelled orders with a captured payment."""
    cancelled = orders.filter("estado_actual = 'cancelado'").select("pedido_id")
    return latest_captured(payments).join(cancelled, "pedido_id", "left_semi").select(
        "pago_id", "pedido_id", "monto", F.lit("cancelacion_cliente").alias("codigo_motivo"),
        F.lit("pendiente").alias("estado"))


def return_candidates(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Delivered orders without an active return; a rejected one does not count."""
    active = returns.filter("estado <> 'rechazada'").select("pedido_id")
    return (
        orders.filter("estado_actual = 'entregado'").select("pedido_id", "cliente_id")
        .join(active, "pedido_id", "left_anti")
    )


def shipments_to_create(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Orders that reached 'enviado' and have no shipment yet."""
    return (
        orders.filter("estado_actual = 'enviado'").select("pedido_id", "cliente_id")
        .join(shipments.select("pedido_id"), "pedido_id", "left_anti")
    )


def shipping_address(addresses: DataFrame) -> DataFrame:
    """Default address of each client, else the oldest one."""
    return first_per_key(
        addresses.select("cliente_id", "direccion_id", "es_predeterminada", "ciudad"),
        ["cliente_id"], [~F.col("es_predeterminada"), "direccion_id"])


def payment_event_log(payments: DataFrame) -> DataFrame:
    """Steps of each settled payment: started, authorized, then captured or failed."""
    def step(n: int, name: Column, status: Column) -> Column:
        return F.struct(F.lit(n).alias("paso"), name.alias("tipo_evento"),
                        status.alias("estado_evento"))
    ok = F.lit("ok")
    last = F.when(F.col("estado") == "capturado", step(3, F.lit("capturado"), ok)).otherwise(
        step(3, F.lit("fallido"), F.lit("error")))
    steps = F.array(step(1, F.lit("iniciado"), ok), step(2, F.lit("autorizado"), ok), last)
    return (
        payments.filter(F.col("estado").isin("capturado", "fallido"))
        .select("pago_id", F.col("monto").alias("monto_evento"), F.explode(steps).alias("s"))
        .select("pago_id", "s.*", "monto_evento")
    )


def payment_attempts(payments: DataFrame) -> DataFrame:
    """Attempts, failures and captured amount per order."""
    captured = F.col("estado") == "capturado"
    return payments.groupBy("pedido_id").agg(
        F.count("*").alias("intentos"),
        F.count_if(F.col("estado") == "fallido").alias("fallidos"),
        F.sum(F.when(captured, F.col("monto")).otherwise(0).cast(X.MONEY))
        .alias("monto_capturado"))


def cart_order_link(events: DataFrame) -> DataFrame:
    """Cart and order pairs named by conversion and creation events."""
    named = events.filter(
        F.col("tipo_evento").isin("carrito_convertido", "pedido_creado")
        & F.col("carrito_id").isNotNull() & F.col("pedido_id").isNotNull())
    return named.select("carrito_id", "pedido_id").distinct()


def cart_funnel(carts: DataFrame, links: DataFrame, orders: DataFrame) -> DataFrame:
    """Carts, orders made from them and orders paid."""
    linked = links.join(
        orders.select("pedido_id", (F.col("estado_pago") == "pagado").alias("_pagado")),
        "pedido_id", "left")
    per_cart = linked.groupBy("carrito_id").agg(
        F.count("*").alias("pedidos"), F.count_if(F.coalesce("_pagado", F.lit(False)))
        .alias("pagados"))
    return carts.select("carrito_id", "estado").join(per_cart, "carrito_id", "left").groupBy(
        "estado").agg(
        F.count("*").alias("carritos"), F.count("pedidos").alias("con_pedido"),
        F.count_if(F.col("pagados") > 0).alias("con_pago"))


def sample_rows(
    df: DataFrame, key: str, fraction: float, seed: int, condition: str | None = None,
) -> DataFrame:
    """Sample of the rows that meet ``condition``: those whose keys hash below ``fraction``.

    The choice depends on the key and the seed only, not on files or partitions.
    """
    rows = df if condition is None else df.filter(condition)
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return rows.filter(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < int(fraction * 2**32))


def backlog_by_state(orders: DataFrame) -> DataFrame:
    """Open orders per state."""
    closed = ["entregado", "cancelado", "reembolsado"]
    return orders.filter(~F.col("estado_actual").isin(closed)).groupBy("estado_actual").agg(
        F.count("*").alias("pedidos"))

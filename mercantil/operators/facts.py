"""Fact loaders: business events in, fact rows out.

Every loader takes parsed events (see ``functions.payload``), re-reads the
source rows they name, and looks dimension keys up with left joins, so a miss
gives a null key and keeps the row. An event whose source row is missing
writes nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.functions import constants as C
from mercantil.functions import expressions as X
from mercantil.operators.dims import CALENDAR, current_keys
from mercantil.operators.merge import merge_upsert
from mercantil.operators.topn import first_per_key
from mercantil.sources.tables import Catalog

EVENT_ORDER = ["ocurrido_en", "evento_negocio_id"]


@dataclass(frozen=True)
class LoadContext:
    """What loaders look values up in."""

    oltp: Catalog
    dims: Catalog
    calendar: tuple[dt.date, dt.date] = CALENDAR
    # Days for a shipment without both times; None keeps them null.
    missing_days: int | None = None
    loaded_at: Column | None = None

    def date_key(self, moment: str) -> Column:
        return X.date_key(X.day_of(moment), *self.calendar)

    def stamp(self) -> Column:
        now = F.current_timestamp() if self.loaded_at is None else self.loaded_at
        return now.alias("cargado_en")

    def customer_keys(self) -> DataFrame:
        return current_keys(self.dims.dim_cliente, "cliente_id", "cliente_sk")

    def warehouse_keys(self) -> DataFrame:
        return current_keys(self.dims.dim_almacen, "almacen_id", "almacen_sk")

    def variant_keys(self) -> DataFrame:
        """Variant and product keys per variant id."""
        variants = current_keys(self.dims.dim_variante, "variante_id", "variante_sk")
        products = current_keys(self.dims.dim_producto, "producto_id", "producto_sk")
        return (
            self.oltp.variantes_producto.select("variante_id", "producto_id")
            .join(variants, "variante_id", "left").join(products, "producto_id", "left")
            .select("variante_id", "variante_sk", "producto_sk")
        )


def events_for(events: DataFrame, loader: str) -> DataFrame:
    return events.filter(F.col("tipo_evento").isin(C.EVENTS_BY_LOADER[loader]))


def touched_ids(events: DataFrame, loader: str, column: str) -> DataFrame:
    """Distinct ids named by a loader's events."""
    return events_for(events, loader).select(column).filter(F.col(column).isNotNull()).distinct()


# --- orders -----------------------------------------------------------------

def load_fact_orders(events: DataFrame, ctx: LoadContext) -> DataFrame:
    """One row per created order; ``num_items`` counts its lines."""
    ids = touched_ids(events, "order_created", "pedido_id")
    lines = (ctx.oltp.rows_for("detalle_pedidos", ids).join(ids, "pedido_id", "left_semi")
             .groupBy("pedido_id").agg(F.count("*").alias("lineas")))
    orders = (
        ctx.oltp.rows_for("pedidos", ids).join(ids, "pedido_id", "left_semi")
        .join(lines, "pedido_id", "left")
        .join(ctx.customer_keys(), "cliente_id", "left")
    )
    return orders.select(
        "pedido_id", "numero_pedido", "cliente_sk",
        ctx.date_key("creado_en").alias("fecha_sk"),
        X.channel_key("canal_venta").alias("canal_sk"),
        X.order_state_key("estado_actual").alias("estado_pedido_sk"),
        # The source never links an order to a promotion.
        F.lit(None).cast("bigint").alias("promocion_sk"),
        "subtotal", "descuento_total", "impuesto_total", "costo_envio", "total_final",
        F.coalesce("lineas", F.lit(0)).cast("int").alias("num_items"),
        "estado_pago", "estado_fulfillment", "creado_en", ctx.stamp(),
    )


def load_fact_order_lines(events: DataFrame, ctx: LoadContext) -> DataFrame:
    """One row per line of each created order, dated by the order."""
    ids = touched_ids(events, "order_created", "pedido_id")
    orders = (
        ctx.oltp.rows_for("pedidos", ids)
        .select("pedido_id", "cliente_id", F.col("creado_en").alias("pedido_en"))
        .join(ids, "pedido_id", "left_semi")
        .join(ctx.customer_keys(), "cliente_id", "left")
    )
    lines = (
        ctx.oltp.rows_for("detalle_pedidos", ids).join(orders, "pedido_id")
        .join(ctx.variant_keys(), "variante_id", "left")
    )
    return lines.select(
        "detalle_pedido_id", "pedido_id", "variante_sk", "producto_sk", "cliente_sk",
        ctx.date_key("pedido_en").alias("fecha_sk"),
        "cantidad", "precio_unitario", "descuento_linea", "impuesto_linea", "total_linea",
        "creado_en", ctx.stamp(),
    )


# --- order fold -------------------------------------------------------------

FOLDED = ["estado_pedido_sk", "estado_fulfillment", "estado_pago"]


def state_contributions(
    events: DataFrame, loaders: tuple[str, ...] = ("order_updated", "order_cancelled"),
) -> DataFrame:
    """What update and cancel events set; null where nothing is set.

    A cancelled order is refunded and pending, whether or not it was paid.
    """
    kinds = [kind for loader in loaders for kind in C.EVENTS_BY_LOADER[loader]]
    cancelled = F.col("tipo_evento").isin(C.EVENTS_BY_LOADER["order_cancelled"])
    state = F.when(cancelled, "cancelado").otherwise(F.col("estado_nuevo"))
    return (
        events.filter(F.col("tipo_evento").isin(kinds) & F.col("pedido_id").isNotNull())
        .select("pedido_id", *EVENT_ORDER, state.alias("estado"), cancelled.alias("cancelado"))
        .filter("estado IS NOT NULL")
        .select("pedido_id", *EVENT_ORDER,
                X.order_state_key("estado").alias("estado_pedido_sk"),
                X.fulfillment_of("estado").alias("estado_fulfillment"),
                F.when(F.col("cancelado"), "reembolsado").alias("estado_pago"))
    )


def payment_contributions(events: DataFrame, pagos: DataFrame) -> DataFrame:
    """A captured payment marks its order as paid."""
    captured = (
        events.filter("tipo_evento = 'pago_capturado' AND pago_id IS NOT NULL")
        .groupBy("pago_id")
        .agg(F.max(F.struct(*EVENT_ORDER)).alias("at"))
    )
    return (
        captured.join(pagos.select("pago_id", "pedido_id"), "pago_id")
        .filter("pedido_id IS NOT NULL")
        .select("pedido_id", "at.*",
                F.lit(None).cast("bigint").alias("estado_pedido_sk"),
                F.lit(None).cast("string").alias("estado_fulfillment"),
                F.lit("pagado").alias("estado_pago"))
    )


def order_contributions(events: DataFrame, pagos: DataFrame) -> DataFrame:
    return state_contributions(events).unionByName(payment_contributions(events, pagos))


def fold(contributions: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Last value per key and column, with the event that set it.

    Ties on time are broken by the event id. The fold is associative: it
    combines map-side, and the rows of several folds merge with ``refold``.
    """
    at = F.struct(*EVENT_ORDER)
    picks = []
    for column in columns:
        mark = F.when(F.col(column).isNotNull(), at)
        picks += [F.max_by(column, mark).alias(column), F.max(mark).alias(f"{column}_en")]
    return contributions.groupBy(key).agg(*picks)


def refold(folds: DataFrame, key: str = "pedido_id", columns: list[str] = FOLDED) -> DataFrame:
    """One fold out of the rows of several, in any order."""
    picks = []
    for column in columns:
        mark = F.col(f"{column}_en")
        picks += [F.max_by(column, mark).alias(column), F.max(mark).alias(f"{column}_en")]
    return folds.groupBy(key).agg(*picks)


def apply_fold(facts: DataFrame, folded: DataFrame, key: str = "pedido_id", columns: list[str] = FOLDED) -> DataFrame:
    """Facts with folded values over the first ones."""
    values = folded.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = facts.join(values, key, "left")
    return joined.select(*[
        F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in facts.columns
    ])


def fold_orders(contributions: DataFrame) -> DataFrame:
    return fold(contributions, "pedido_id", FOLDED)


def merge_folds(left: DataFrame, right: DataFrame) -> DataFrame:
    return refold(left.unionByName(right))


# --- payments and stock -----------------------------------------------------

def load_fact_payments(events: DataFrame, ctx: LoadContext) -> DataFrame:
    """One row per payment; the client comes from the event, else the order."""
    named = first_per_key(
        events_for(events, "payment").filter("pago_id IS NOT NULL").select(
            "pago_id", F.col("cliente_id").alias("cliente_evento"),
            F.col("pedido_id").alias("pedido_evento"), *EVENT_ORDER),
        ["pago_id"], EVENT_ORDER)
    orders = named.select(F.col("pedido_evento").alias("pedido_id"))
    owners = ctx.oltp.rows_for("pedidos", orders).select(
        F.col("pedido_id").alias("pedido_evento"), F.col("cliente_id").alias("cliente_pedido"))
    payments = (
        ctx.oltp.rows_for("pagos", named.select("pago_id"))
        .join(named.select("pago_id", "cliente_evento", "pedido_evento"), "pago_id")
        .join(owners, "pedido_evento", "left")
        .withColumn("cliente_id", F.coalesce("cliente_evento", "cliente_pedido"))
        .join(ctx.customer_keys(), "cliente_id", "left")
    )
    return payments.select(
        "pago_id", "pedido_id", "cliente_sk", ctx.date_key("creado_en").alias("fecha_sk"),
        X.payment_method_key("metodo_pago").alias("metodo_pago_sk"),
        "monto", "estado", "proveedor_pago", "creado_en", ctx.stamp(),
    )


def movement_facts(movements: DataFrame, ctx: LoadContext) -> DataFrame:
    """Stock movements of any type as fact rows, quantities signed as stored."""
    variants = ctx.variant_keys().select("variante_id", "variante_sk")
    return (
        movements.join(ctx.warehouse_keys(), "almacen_id", "left")
        .join(variants, "variante_id", "left")
        .select(
            F.col("movimiento_inventario_id").alias("movimiento_id"), "almacen_sk", "variante_sk",
            ctx.date_key("fecha_movimiento").alias("fecha_sk"),
            "tipo_movimiento", "cantidad", "tipo_referencia", "referencia_id",
            "fecha_movimiento", ctx.stamp())
    )


def load_fact_stock(events: DataFrame, ctx: LoadContext) -> DataFrame:
    """Movements named by stock events."""
    key = "movimiento_inventario_id"
    ids = touched_ids(events, "stock", "movimiento_id").withColumnRenamed("movimiento_id", key)
    movements = ctx.oltp.rows_for("movimientos_inventario", ids).join(ids, key, "left_semi")
    return movement_facts(movements, ctx)


# --- shipments --------------------------------------------------------------

def load_fact_shipments(events: DataFrame, ctx: LoadContext) -> DataFrame:
    """Delivered and returned shipments.

    The last event of a shipment decides: a return forces state 'devuelto', a
    delivery takes the stored state. ``_entregado`` tells whether a delivery
    event is among them (see ``merge_shipments``).
    """
    delivered, returned = C.EVENTS_BY_LOADER["shipment_delivered"], C.EVENTS_BY_LOADER["shipment_returned"]
    named = (
        events.filter(F.col("tipo_evento").isin(delivered + returned) & F.col("envio_id").isNotNull())
        .groupBy("envio_id")
        .agg(F.max_by("tipo_evento", F.struct(*EVENT_ORDER)).alias("ultimo"),
             F.bool_or(F.col("tipo_evento").isin(delivered)).alias("_entregado"))
    )
    shipments = (
        ctx.oltp.rows_for("envios", named.select("envio_id")).join(named, "envio_id")
        .join(ctx.warehouse_keys(), "almacen_id", "left")
    )
    return shipments.select(
        "envio_id", "pedido_id", "almacen_sk",
        ctx.date_key("enviado_en").alias("fecha_envio_sk"),
        ctx.date_key("entregado_en").alias("fecha_entrega_sk"),
        F.when(F.col("ultimo").isin(returned), "devuelto").otherwise(F.col("estado_envio"))
        .alias("estado_envio"),
        "transportista",
        X.delivery_days("enviado_en", "entregado_en", ctx.missing_days).alias("dias_entrega"),
        ctx.stamp(), "_entregado",
    )


SHIPMENT_FOLDED = ["estado_envio", "fecha_entrega_sk", "dias_entrega"]


def shipment_contributions(events: DataFrame, ctx: LoadContext) -> DataFrame:
    """What each shipment event sets: a return the state, a delivery state, date and days.

    Folded by event time, so neither the order nor the batches of the events matter.
    """
    delivered, returned = C.EVENTS_BY_LOADER["shipment_delivered"], C.EVENTS_BY_LOADER["shipment_returned"]
    named = events.filter(F.col("tipo_evento").isin(delivered + returned) & F.col("envio_id").isNotNull()).select(
        "envio_id", *EVENT_ORDER, F.col("tipo_evento").isin(delivered).alias("_entregado"))
    found = ctx.oltp.rows_for("envios", named.select("envio_id")).join(named, "envio_id")
    came = F.col("_entregado")
    return found.select(
        "envio_id", *EVENT_ORDER,
        F.when(came, F.col("estado_envio")).otherwise("devuelto").alias("estado_envio"),
        F.when(came, ctx.date_key("entregado_en")).alias("fecha_entrega_sk"),
        F.when(came, X.delivery_days("enviado_en", "entregado_en", ctx.missing_days)).alias("dias_entrega"))


def merge_shipments(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """State is replaced; a delivery also fills date and days unless null."""
    return merge_upsert(
        fact, rows, ["envio_id"], replace=["estado_envio"],
        fill=["fecha_entrega_sk", "dias_entrega"], fill_if="_entregado")


# --- returns and carts ------------------------------------------------------

def load_fact_returns(events: DataFrame, ctx: LoadContext) -> DataFrame:
    """Returns with variant and quantity of their first detail row."""
    ids = touched_ids(events, "return", "devolucion_id")
    first = first_per_key(
        ctx.oltp.rows_for("detalle_devoluciones", ids).select(
            "devolucion_id", "detalle_devolucion_id", "variante_id", "cantidad_devuelta"),
        ["devolucion_id"], ["detalle_devolucion_id"])
    found = ctx.oltp.rows_for("devoluciones", ids).join(ids, "devolucion_id", "left_semi")
    owners = (
        ctx.oltp.rows_for("pedidos", found.select("pedido_id")).select("pedido_id", "cliente_id")
        .join(ctx.customer_keys(), "cliente_id", "left")
    )
    returns = (
        found
        .join(first, "devolucion_id", "left")
        .join(ctx.variant_keys(), "variante_id", "left")
        .join(owners, "pedido_id", "left")
    )
    return returns.select(
        "devolucion_id", "pedido_id", "variante_sk", "producto_sk", "cliente_sk",
        ctx.date_key("creado_en").alias("fecha_sk"), "motivo", "estado",
        F.coalesce("cantidad_devuelta", F.lit(0)).alias("cantidad_devuelta"), ctx.stamp(),
    )


def load_fact_carts(events: DataFrame, ctx: LoadContext) -> DataFrame:
    """Carts with lines counted and valued; the stored state decides."""
    ids = touched_ids(events, "cart", "carrito_id")
    # Only the carts named: a value that overflows elsewhere is no concern of this batch.
    lines = ctx.oltp.rows_for("detalle_carritos", ids).join(ids, "carrito_id", "left_semi").groupBy("carrito_id").agg(
        F.count("*").alias("lineas"),
        F.sum(F.col("cantidad") * F.col("precio_unitario")).alias("valor"))
    carts = (
        ctx.oltp.rows_for("carritos", ids).join(ids, "carrito_id", "left_semi")
        .join(lines, "carrito_id", "left")
        .join(ctx.customer_keys(), "cliente_id", "left")
    )
    return carts.select(
        "carrito_id", "cliente_sk", ctx.date_key("creado_en").alias("fecha_sk"), "estado",
        F.coalesce("lineas", F.lit(0)).cast("int").alias("num_items"),
        X.money(F.coalesce("valor", F.lit(0))).alias("valor_total"),
        (F.col("estado") == "convertido").alias("convertido"), ctx.stamp(),
    )


CART_FOLDED = ["estado", "convertido"]


def cart_contributions(events: DataFrame, ctx: LoadContext) -> DataFrame:
    """What each cart event sets: the stored state, and whether it is a conversion."""
    named = events_for(events, "cart").filter("carrito_id IS NOT NULL").select("carrito_id", *EVENT_ORDER)
    found = ctx.oltp.rows_for("carritos", named.select("carrito_id")).join(named, "carrito_id")
    return found.select("carrito_id", *EVENT_ORDER, "estado", (F.col("estado") == "convertido").alias("convertido"))


def merge_carts(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """A known cart changes state and conversion only."""
    return merge_upsert(fact, rows, ["carrito_id"], replace=["estado", "convertido"])

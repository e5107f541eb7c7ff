"""Pricing, purchasing and cart values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercantil.functions import constants as C
from mercantil.functions import expressions as X
from mercantil.operators.dims import latest_price
from mercantil.sources.tables import Catalog


def price_order_lines(lines: DataFrame) -> DataFrame:
    """Gross, net, tax and total per line.

    ``lines`` has ``cantidad``, ``precio_unitario`` and ``descuento_linea``.
    The total carries no tax: tax is charged once per order.
    """
    gross = F.col("precio_unitario") * F.col("cantidad")
    net = gross - F.col("descuento_linea")
    return (
        lines.withColumn("bruto_linea", X.money(gross))
        .withColumn("neto_linea", X.money(net))
        .withColumn("impuesto_linea", X.cents_half_even(X.tax(net)))
        .withColumn("total_linea", X.cents_half_even(net))
    )


def price_orders(lines: DataFrame, charges: DataFrame | None = None) -> DataFrame:
    """Order totals from priced or raw lines.

    ``charges`` may give ``descuento_total`` and ``tarifa_envio`` per
    ``pedido_id``; shipping is free strictly above the threshold. Line
    discounts do not lower the order total.
    """
    gross = F.col("precio_unitario") * F.col("cantidad")
    totals = lines.groupBy("pedido_id").agg(F.sum(gross).cast(X.MONEY).alias("subtotal"))
    zero = F.lit(0).cast(X.MONEY)
    if charges is None:
        totals = totals.withColumn("descuento_total", zero).withColumn("tarifa_envio", zero)
    else:
        totals = totals.join(
            charges.select("pedido_id", "descuento_total", "tarifa_envio"), "pedido_id", "left")
    discount = X.money(F.coalesce("descuento_total", zero))
    base = F.col("subtotal") - discount
    shipping = X.money(
        F.when(F.col("subtotal") > C.FREE_SHIPPING_OVER, zero)
        .otherwise(F.coalesce("tarifa_envio", zero)))
    tax = X.cents_half_even(X.tax(base))
    return totals.select(
        "pedido_id", "subtotal", discount.alias("descuento_total"), tax.alias("impuesto_total"),
        shipping.alias("costo_envio"), X.cents_half_even(base + tax + shipping).alias("total_final"))


def product_snapshot(oltp: Catalog, ids: DataFrame) -> DataFrame:
    """Name, sku and list price of the active variants among ``ids``.

    The price is the latest one, so a variant with several prices stays one row.
    """
    wanted = oltp.variantes_producto.filter("activa").join(
        ids.select("variante_id").distinct(), "variante_id", "left_semi")
    names = oltp.productos.select("producto_id", F.col("nombre").alias("_nombre"))
    price = latest_price(oltp.precios_producto).select("variante_id", "precio_lista")
    snapshot = F.concat("_nombre", F.lit(" "), F.coalesce("color", F.lit("")))
    return (
        wanted.join(price, "variante_id").join(names, "producto_id")
        .select("variante_id", "precio_lista", "sku", snapshot.alias("nombre_snap"))
    )


def value_purchase_orders(orders: DataFrame, variants: DataFrame) -> DataFrame:
    """Cost, tax and total of purchase quantities; an unknown cost is 0."""
    cost = F.coalesce("precio_costo", F.lit(0).cast(X.MONEY))
    subtotal = X.cents(cost * F.col("cantidad_recibida"))
    return (
        orders.join(variants.select("variante_id", "precio_costo"), "variante_id", "left")
        .withColumn("subtotal", subtotal)
        .withColumn("impuesto_total", X.cents(X.tax("subtotal")))
        .select("orden_compra_id", "subtotal", "impuesto_total",
                X.cents(F.col("subtotal") + F.col("impuesto_total")).alias("total_oc"))
    )


def cart_value(cart_lines: DataFrame) -> DataFrame:
    """Value of each cart."""
    value = F.col("cantidad") * F.col("precio_unitario")
    return cart_lines.groupBy("carrito_id").agg(F.sum(value).alias("valor_total"))

"""The star schema: from a warehouse folder, or straight from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercantil.functions import expressions as X
from mercantil.operators import dims as D
from mercantil.sources import retail as R
from mercantil.sources.tables import Catalog

CLIENTE_REGION = ["c_custkey AS cliente_sk", "c_custkey AS cliente_id",
                  "c_mktsegment AS segmento", "n_name AS ciudad", "r_name AS region",
                  "true AS es_actual"]
PRODUCTO = ["p_partkey AS producto_sk", "p_partkey AS producto_id", "p_name AS nombre_producto",
            "p_brand AS nombre_marca", "p_type AS nombre_categoria", "true AS es_actual"]
ENVIO_ESTADO = "CASE WHEN l_returnflag = 'R' THEN 'devuelto' ELSE 'entregado' END"


def constant_dims(spark: SparkSession, start: dt.date, end: dt.date) -> dict:
    """Dimensions of fixed size: a calendar and three seed lists."""
    return {
        "dim_fecha": lambda: D.dim_date(spark, start, end),
        "dim_metodo_pago": lambda: D.dim_payment_method(spark),
        "dim_estado_pedido": lambda: D.dim_order_state(spark),
        "dim_canal": lambda: D.dim_channel(spark),
    }


def star_catalog(spark: SparkSession, raw: Catalog, oltp: Catalog | None = None) -> Catalog:
    """Star schema read off the given tables, natural ids serving as keys.

    Facts keep every source row (lines have no unique id here).
    """
    oltp = oltp or R.source_catalog(raw)
    start, end = R.CALENDAR_START, R.CALENDAR_END

    def key(moment: str):
        return X.date_key(X.day_of(moment), start, end)

    def dim_cliente() -> DataFrame:
        return (
            raw.customer
            .join(raw.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(raw.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(*CLIENTE_REGION))

    def fact_pedidos() -> DataFrame:
        lines = raw.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.sum(F.expr(R.LINE_DISCOUNT)).alias("descuento"), F.count("*").alias("lineas"))
        joined = raw.orders.join(lines, "o_orderkey", "left")
        return joined.select(
            F.col("o_orderkey").alias("pedido_id"), F.col("o_custkey").alias("cliente_sk"),
            key("o_orderdate").alias("fecha_sk"),
            X.channel_key(F.expr(R.CHANNEL)).alias("canal_sk"),
            F.expr(R.TOTAL).alias("total_final"),
            F.coalesce(X.money("descuento"), F.lit(0).cast(X.MONEY)).alias("descuento_total"),
            F.coalesce("lineas", F.lit(0)).cast("int").alias("num_items"),
            F.expr(R.PAYMENT_STATE).alias("estado_pago"))

    def fact_detalle() -> DataFrame:
        return raw.lineitem.select(
            F.col("l_orderkey").alias("pedido_id"), F.col("l_partkey").alias("producto_sk"),
            F.expr(R.QUANTITY).alias("cantidad"), F.expr(R.PRICE).alias("precio_unitario"),
            F.expr(R.LINE_TOTAL).alias("total_linea"))

    def fact_pagos() -> DataFrame:
        return raw.orders.select(
            F.col("o_orderkey").alias("pago_id"), F.col("o_orderkey").alias("pedido_id"),
            X.payment_method_key(F.expr(R.METHOD)).alias("metodo_pago_sk"),
            F.expr(R.TOTAL).alias("monto"),
            F.expr("CASE WHEN o_orderstatus = 'F' THEN 'capturado' ELSE 'fallido' END")
            .alias("estado"))

    def fact_movimientos() -> DataFrame:
        return raw.lineitem.select(
            F.col("l_suppkey").alias("almacen_sk"), key("l_shipdate").alias("fecha_sk"),
            F.expr(R.MOVEMENT).alias("tipo_movimiento"),
            F.expr(f"CASE WHEN l_linenumber = 3 THEN -{R.QUANTITY} ELSE {R.QUANTITY} END")
            .alias("cantidad"))

    def fact_envios() -> DataFrame:
        orders = raw.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
        return raw.lineitem.join(orders, "l_orderkey").select(
            F.col("l_orderkey").alias("pedido_id"), F.col("l_suppkey").alias("almacen_sk"),
            F.expr(R.CARRIER).alias("transportista"), F.expr(ENVIO_ESTADO).alias("estado_envio"),
            X.delivery_days("o_orderdate", "l_shipdate").alias("dias_entrega"))

    def fact_devoluciones() -> DataFrame:
        return raw.lineitem.filter("l_returnflag = 'R'").select(
            F.col("l_orderkey").alias("pedido_id"), F.col("l_partkey").alias("producto_sk"),
            F.expr(R.REASON).alias("motivo"), F.expr(R.QUANTITY).alias("cantidad_devuelta"))

    def fact_carritos() -> DataFrame:
        carts = raw.events.groupBy("user_id", F.to_date("ts").alias("dia")).agg(
            F.bool_or(F.col("event_type") == "purchase").alias("convertido"),
            F.count("*").alias("num_items"),
            F.sum(X.money("value")).alias("valor_total"))
        return carts.select(
            F.col("user_id").alias("cliente_sk"), X.date_key("dia", start, end).alias("fecha_sk"),
            "num_items", X.money("valor_total").alias("valor_total"), "convertido")

    return Catalog({
        **constant_dims(spark, start, end),
        "dim_cliente": dim_cliente,
        "dim_producto": lambda: raw.part.selectExpr(*PRODUCTO),
        "dim_almacen": lambda: oltp.almacenes.withColumn("almacen_sk", F.col("almacen_id")),
        "fact_pedidos": fact_pedidos,
        "fact_detalle_pedidos": fact_detalle,
        "fact_pagos": fact_pagos,
        "fact_movimientos_inventario": fact_movimientos,
        "fact_envios": fact_envios,
        "fact_devoluciones": fact_devoluciones,
        "fact_carritos": fact_carritos,
        "niveles_stock": lambda: oltp.niveles_stock,
        "variantes_producto": lambda: oltp.variantes_producto,
    })

"""The ten BI queries over the star schema.

Where a fact shrinks on its own keys (per day, per warehouse, per customer), it
is aggregated before dimension attributes are attached, so the shuffle carries
partial sums and a key that holds a third of the rows costs one row per task.
Where it does not shrink (distinct orders per product), the join comes first
and the aggregate combines map-side after it. ``pedido_id`` is unique in
``fact_pedidos``, so its rows are counted without a distinct.

Only the calendar and the seed lists carry a broadcast hint, as their size is
fixed. For other dimensions Spark compares table statistics with
``spark.sql.autoBroadcastJoinThreshold``, and beyond it sort-merges with AQE
splitting skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercantil.functions.expressions import average, percent
from mercantil.sources.tables import Catalog


def _mean(column: str) -> Column:
    """Mean of a money column, sharing the sum that the query computes anyway.

    It keeps many digits, so that rounding it once more cannot tip a half.
    """
    return average(F.sum(column), F.count(column))


def _calendar(star: Catalog, *columns: str) -> DataFrame:
    return F.broadcast(star.dim_fecha.select("fecha_sk", *columns))


def _current(dim: DataFrame) -> DataFrame:
    return dim.filter("es_actual")


def _versions(star: Catalog, dim: str, sk: str, key: str, columns: list[str], restate: bool):
    """Dimension attributes per surrogate key.

    By default only keys of current versions are present, so facts bound to a
    closed version drop out. With ``restate`` every version maps to the
    attributes of the current one.
    """
    table = getattr(star, dim)
    if not restate:
        return _current(table).select(sk, key, *columns)
    return table.select(sk, key).join(_current(table).select(key, *columns), key)


def daily_sales(star: Catalog) -> DataFrame:
    """Paid orders per day."""
    per_day = (
        star.fact_pedidos.filter("estado_pago = 'pagado'")
        .groupBy("fecha_sk")
        .agg(F.count("pedido_id").alias("total_pedidos"),
             F.sum("total_final").alias("ventas_netas"),
             _mean("total_final").cast("decimal(16,6)").alias("ticket_promedio"),
             F.sum("descuento_total").alias("descuentos_otorgados"))
    )
    return (
        per_day.join(_calendar(star, "fecha", "dia_nombre", "es_fin_semana"), "fecha_sk")
        .select("fecha", "dia_nombre", "es_fin_semana", "total_pedidos", "ventas_netas",
                "ticket_promedio", "descuentos_otorgados")
        .orderBy("fecha")
    )


def top_products(star: Catalog, n: int = 10, restate: bool = False) -> DataFrame:
    """Products with the highest revenue."""
    names = ["nombre_producto", "nombre_marca", "nombre_categoria"]
    products = _versions(star, "dim_producto", "producto_sk", "producto_id", names, restate)
    return (
        star.fact_detalle_pedidos.join(products, "producto_sk")
        .groupBy(*names)
        .agg(F.sum("cantidad").alias("unidades_vendidas"),
             F.sum("total_linea").alias("ingresos_totales"),
             _mean("precio_unitario").cast("decimal(16,6)").alias("precio_promedio"),
             F.countDistinct("pedido_id").alias("pedidos_distintos"))
        .orderBy(F.desc_nulls_first("ingresos_totales"), *names)
        .limit(n)
    )


def cart_conversion(star: Catalog) -> DataFrame:
    """Carts per month and the share converted."""
    per_day = star.fact_carritos.groupBy("fecha_sk").agg(
        F.count("*").alias("n"), F.count_if(F.col("convertido")).alias("si"),
        F.count_if(~F.col("convertido")).alias("no"))
    return (
        per_day.join(_calendar(star, "anio", "mes", "mes_nombre"), "fecha_sk")
        .groupBy("anio", "mes", "mes_nombre")
        .agg(F.sum("n").alias("total_carritos"), F.sum("si").alias("convertidos"),
             F.sum("no").alias("abandonados"),
             percent(F.sum("si"), F.sum("n"), 2).alias("tasa_conversion_pct"))
        .orderBy("anio", "mes")
    )


def carrier_performance(star: Catalog) -> DataFrame:
    """Delivery days and success per carrier and warehouse city."""
    per_warehouse = (
        star.fact_envios.filter("transportista IS NOT NULL")
        .groupBy("transportista", "almacen_sk")
        .agg(F.count("*").alias("n"), F.sum("dias_entrega").alias("dias"),
             F.count("dias_entrega").alias("con_dias"),
             F.min("dias_entrega").alias("minimo"), F.max("dias_entrega").alias("maximo"),
             F.count_if(F.col("estado_envio") == "entregado").alias("ok"),
             F.count_if(F.col("estado_envio") == "devuelto").alias("back"))
    )
    warehouses = star.dim_almacen.select("almacen_sk", F.col("ciudad").alias("ciudad_almacen"))
    return (
        per_warehouse.join(warehouses, "almacen_sk")
        .groupBy("transportista", "ciudad_almacen")
        .agg(F.sum("n").alias("total_envios"),
             F.round(average(F.sum("dias").cast("decimal(20,0)"), F.sum("con_dias")), 1)
             .alias("promedio_dias_entrega"),
             F.min("minimo").alias("minimo_dias"), F.max("maximo").alias("maximo_dias"),
             F.sum("ok").alias("entregas_exitosas"), F.sum("back").alias("devoluciones"),
             percent(F.sum("ok"), F.sum("n"), 1).alias("tasa_exito_pct"))
        .select("transportista", "total_envios", "promedio_dias_entrega", "minimo_dias",
                "maximo_dias", "entregas_exitosas", "devoluciones", "tasa_exito_pct",
                "ciudad_almacen")
        .orderBy(F.asc_nulls_last("promedio_dias_entrega"), "transportista", "ciudad_almacen")
    )


def returns_by_reason(star: Catalog, restate: bool = False) -> DataFrame:
    """Returns per reason and product category."""
    products = _versions(
        star, "dim_producto", "producto_sk", "producto_id", ["nombre_categoria"], restate)
    return (
        star.fact_devoluciones.join(products, "producto_sk")
        .groupBy("motivo", "nombre_categoria")
        .agg(F.count("*").alias("total_devoluciones"),
             F.sum("cantidad_devuelta").alias("unidades_devueltas"),
             F.countDistinct("pedido_id").alias("pedidos_afectados"))
        .orderBy(F.desc("total_devoluciones"), "motivo", "nombre_categoria")
    )


def ticket_by_channel(star: Catalog) -> DataFrame:
    """Paid orders per sales channel."""
    paid = (
        star.fact_pedidos.filter("estado_pago = 'pagado'")
        .groupBy("canal_sk")
        .agg(F.count("pedido_id").alias("total_pedidos"),
             F.sum("total_final").alias("ventas_totales"),
             F.round(_mean("total_final"), 0).alias("ticket_promedio_clp"),
             F.round(F.avg(F.col("num_items").cast("decimal(12,0)")), 1)
             .alias("items_promedio_por_pedido"),
             F.round(_mean("descuento_total"), 0).alias("descuento_promedio_clp"))
    )
    return (
        paid.join(F.broadcast(star.dim_canal), "canal_sk").drop("canal_sk")
        .select("canal", "total_pedidos", "ventas_totales", "ticket_promedio_clp",
                "items_promedio_por_pedido", "descuento_promedio_clp")
        .orderBy(F.desc_nulls_first("ventas_totales"), "canal")
    )


def payment_methods(star: Catalog) -> DataFrame:
    """Captured payments per method and their share."""
    captured = (
        star.fact_pagos.filter("estado = 'capturado'")
        .groupBy("metodo_pago_sk")
        .agg(F.count("*").alias("total_transacciones"), F.sum("monto").alias("monto_total_clp"),
             F.round(_mean("monto"), 0).alias("monto_promedio_clp"))
        .join(F.broadcast(star.dim_metodo_pago), "metodo_pago_sk")
    )
    # At most seven rows reach this window.
    everything = F.sum("total_transacciones").over(Window.partitionBy())
    return (
        captured.select(
            "metodo_pago", "categoria", "total_transacciones", "monto_total_clp",
            "monto_promedio_clp",
            percent(F.col("total_transacciones"), everything, 1).alias("porcentaje_uso"))
        .orderBy(F.desc("total_transacciones"), "metodo_pago")
    )


def customer_segments(star: Catalog, restate: bool = False) -> DataFrame:
    """Customers, paid orders and lifetime value per segment."""
    customers = _versions(star, "dim_cliente", "cliente_sk", "cliente_id", ["segmento"], restate)
    per_version = (
        star.fact_pedidos.filter("estado_pago = 'pagado'")
        .groupBy("cliente_sk")
        .agg(F.count("pedido_id").alias("pedidos"), F.sum("total_final").alias("ventas"),
             F.count("total_final").alias("filas"))
        .join(customers, "cliente_sk")
    )
    per_customer = per_version.groupBy("segmento", "cliente_id").agg(
        F.sum("pedidos").alias("pedidos"), F.sum("ventas").alias("ventas"),
        F.sum("filas").alias("filas")) if restate else per_version
    clients = F.count("cliente_id")
    return (
        per_customer.groupBy("segmento")
        .agg(clients.alias("total_clientes"), F.sum("pedidos").alias("total_pedidos"),
             F.sum("ventas").alias("ventas_totales"),
             F.round(average(F.sum("ventas"), F.sum("filas")), 0).alias("ticket_promedio"),
             F.round(average(F.sum("ventas"), clients), 0).alias("ltv_promedio_clp"))
        .orderBy(F.desc_nulls_first("ventas_totales"), "segmento")
    )


def inventory_rotation(star: Catalog) -> DataFrame:
    """Stock entries, exits and returns per warehouse and month.

    Months sort by name, and reservations count as exits along with sales.
    """
    quantity, kind = F.col("cantidad"), F.col("tipo_movimiento")
    per_month = (
        star.fact_movimientos_inventario
        .join(_calendar(star, "anio", "mes_nombre"), "fecha_sk")
        .groupBy("almacen_sk", "anio", "mes_nombre")
        .agg(F.sum(F.when(kind.isin("ingreso", "reposicion"), quantity).otherwise(0))
             .alias("entradas"),
             F.sum(F.when(kind.isin("venta", "reserva"), F.abs(quantity)).otherwise(0))
             .alias("salidas"),
             F.sum(F.when(kind == "devolucion", quantity).otherwise(0))
             .alias("devoluciones_stock"))
    )
    warehouses = star.dim_almacen.select("almacen_sk", F.col("nombre").alias("almacen"), "ciudad")
    return (
        per_month.join(warehouses, "almacen_sk")
        .groupBy("almacen", "ciudad", "mes_nombre", "anio")
        .agg(*[F.sum(c).alias(c) for c in ("entradas", "salidas", "devoluciones_stock")])
        .orderBy("almacen", "anio", "mes_nombre")
    )


def cohort_retention(star: Catalog, by_customer: bool = False) -> DataFrame:
    """Customers by month of first paid order, with repeat share and value.

    One aggregate per customer version (or per customer with ``by_customer``),
    then one per month.
    """
    paid = star.fact_pedidos.filter("estado_pago = 'pagado'")
    who = "cliente_sk"
    if by_customer:
        paid = paid.join(star.dim_cliente.select("cliente_sk", "cliente_id"), "cliente_sk", "left")
        who = "cliente_id"
    per_customer = (
        paid.filter(F.col("fecha_sk").isNotNull() & F.col(who).isNotNull())
        .groupBy(who)
        .agg(F.min("fecha_sk").alias("fecha_sk"), F.count("pedido_id").alias("pedidos"),
             F.sum("total_final").alias("valor"))
        .join(_calendar(star, "fecha"), "fecha_sk")
    )
    repeat = F.count_if(F.col("pedidos") > 1)
    return (
        per_customer.groupBy(F.date_format("fecha", "yyyy-MM").alias("mes_cohort"))
        .agg(F.count("*").alias("clientes_nuevos"),
             F.round(F.avg(F.col("pedidos").cast("decimal(20,0)")), 1).alias("promedio_pedidos"),
             F.round(_mean("valor"), 0).alias("ltv_promedio_clp"),
             repeat.alias("clientes_recurrentes"),
             percent(repeat, F.count("*"), 1).alias("tasa_recurrencia_pct"))
        .orderBy("mes_cohort")
    )


# --- dashboard headline numbers ---------------------------------------------

def kpi_sales(star: Catalog) -> DataFrame:
    """Net sales, average ticket and orders per day with sales."""
    per_day = daily_sales(star)
    orders, days = F.sum("total_pedidos"), F.count("*")
    sales = F.sum("ventas_netas")
    return per_day.agg(
        sales.alias("ventas_netas"), F.round(average(sales, orders), 0).alias("ticket_promedio"),
        F.round(average(orders.cast("decimal(20,0)"), days), 2).alias("pedidos_por_dia"))


def kpi_carts(star: Catalog) -> DataFrame:
    """Share of carts converted and abandoned."""
    n, yes = F.count("*"), F.count_if(F.col("convertido"))
    return star.fact_carritos.agg(
        n.alias("total_carritos"), percent(yes, n, 2).alias("tasa_conversion_pct"),
        percent(F.count_if(~F.col("convertido")), n, 2).alias("tasa_abandono_pct"))


def kpi_payments(star: Catalog) -> DataFrame:
    """Amount captured, mean per transaction and number of transactions."""
    return star.fact_pagos.filter("estado = 'capturado'").agg(
        F.sum("monto").alias("monto_capturado"), F.round(_mean("monto"), 0).alias("monto_promedio"),
        F.count("*").alias("transacciones"))


def kpi_retention(star: Catalog) -> DataFrame:
    """Share of customers with more than one paid order, and mean lifetime value."""
    per_customer = (
        star.fact_pedidos.filter("estado_pago = 'pagado' AND cliente_sk IS NOT NULL")
        .groupBy("cliente_sk")
        .agg(F.count("pedido_id").alias("pedidos"), F.sum("total_final").alias("valor")))
    repeat = F.count_if(F.col("pedidos") > 1)
    return per_customer.agg(
        percent(repeat, F.count("*"), 2).alias("tasa_recurrencia_pct"),
        F.round(_mean("valor"), 0).alias("ltv_promedio"))

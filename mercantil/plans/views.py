"""Analytical views over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercantil.sources.tables import Catalog


def geo_sales(star: Catalog) -> DataFrame:
    """Sales and orders per day and customer region."""
    regions = star.dim_cliente.select("cliente_sk", "region")
    per_region = star.fact_pedidos.join(regions, "cliente_sk").groupBy("fecha_sk", "region").agg(
        F.sum("total_final").alias("total_ventas"), F.count("*").alias("total_pedidos"))
    return (
        per_region.join(F.broadcast(star.dim_fecha.select("fecha_sk", "fecha")), "fecha_sk")
        .select("fecha", "region", "total_ventas", "total_pedidos")
    )


def current_customers(dim_cliente: DataFrame) -> DataFrame:
    return dim_cliente.filter("es_actual").select(
        "cliente_id", "segmento", F.col("valido_desde").alias("fecha_inicio"),
        F.col("valido_hasta").alias("fecha_fin"))


def customer_history(dim_cliente: DataFrame) -> DataFrame:
    return dim_cliente.select("*")


def carrier_summary(star: Catalog) -> DataFrame:
    return star.fact_envios.groupBy("transportista").agg(
        F.count("*").alias("total_envios"),
        F.avg(F.col("dias_entrega").cast("decimal(12,0)")).alias("promedio_entrega"))


def returns_summary(star: Catalog) -> DataFrame:
    return star.fact_devoluciones.groupBy("motivo").agg(F.count("*").alias("total_devoluciones"))


def critical_stock(niveles_stock: DataFrame, variantes: DataFrame) -> DataFrame:
    """Stock levels below their reorder point."""
    low = niveles_stock.filter("cantidad_disponible < punto_reorden")
    return low.join(variantes.select("variante_id", "producto_id"), "variante_id").select(
        "producto_id", "variante_id", "almacen_id",
        F.col("cantidad_disponible").alias("stock_actual"),
        F.col("punto_reorden").alias("stock_minimo"))


def dlq_monitor(dlq_eventos: DataFrame) -> DataFrame:
    return dlq_eventos.select("*")


def dlq_by_reason(dlq_eventos: DataFrame) -> DataFrame:
    return dlq_eventos.groupBy("tipo_evento", "motivo").agg(F.count("*").alias("eventos"))


def register_views(star: Catalog) -> list[str]:
    """Create one temporary view per warehouse table and per analytical view."""
    made = []
    for name in star.names():
        getattr(star, name).createOrReplaceTempView(name)
        made.append(name)
    views = {
        "vw_ventas_geograficas": lambda: geo_sales(star),
        "vw_clientes_actuales": lambda: current_customers(star.dim_cliente),
        "vw_clientes_historico": lambda: customer_history(star.dim_cliente),
        "vw_performance_transportistas": lambda: carrier_summary(star),
        "vw_resumen_devoluciones": lambda: returns_summary(star),
        "vw_stock_critico": lambda: critical_stock(star.niveles_stock, star.variantes_producto),
        "vw_dlq_monitor": lambda: dlq_monitor(star.dlq_eventos),
    }
    needs = {"vw_stock_critico": "niveles_stock", "vw_dlq_monitor": "dlq_eventos"}
    for name, build in views.items():
        if needs.get(name, "fact_pedidos") in star:
            build().createOrReplaceTempView(name)
            made.append(name)
    return made

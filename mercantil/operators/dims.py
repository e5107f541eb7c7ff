"""Dimension builders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercantil.functions import constants as C
from mercantil.functions import expressions as X
from mercantil.operators.merge import merge_insert_only, merge_upsert
from mercantil.operators.scd2 import new_versions, scd2_apply
from mercantil.operators.topn import first_per_key, last_per_key
from mercantil.sources.tables import Catalog

CALENDAR = (dt.date(2020, 1, 1), dt.date(2030, 12, 31))

CUSTOMER_TRACKED = ["segmento", "estado", "ciudad", "region"]
PRODUCT_TRACKED = ["nombre_producto", "estado_producto"]
VARIANT_TRACKED = ["precio_lista_actual", "activa"]


def dim_date(
    spark: SparkSession, start: dt.date = CALENDAR[0], end: dt.date = CALENDAR[1],
) -> DataFrame:
    """Calendar with one row per day; ``fecha_sk`` counts days from 1."""
    days = (end - start).days + 1
    # One range partition: a calendar has a few thousand rows by nature.
    ids = spark.range(1, days + 1, 1, 1)
    return calendar_columns(
        ids.select(F.col("id").alias("fecha_sk"),
                   F.date_add(F.lit(start), (F.col("id") - 1).cast("int")).alias("fecha")))


def calendar_columns(days: DataFrame) -> DataFrame:
    """Calendar attributes for a table of ``(fecha_sk, fecha)``."""
    weekday = F.dayofweek("fecha") - 1
    return days.select(
        "fecha_sk", "fecha",
        F.year("fecha").cast("smallint").alias("anio"),
        F.quarter("fecha").cast("smallint").alias("trimestre"),
        F.month("fecha").cast("smallint").alias("mes"),
        F.weekofyear("fecha").cast("smallint").alias("semana"),
        F.dayofmonth("fecha").cast("smallint").alias("dia_mes"),
        weekday.cast("smallint").alias("dia_semana"),
        F.date_format("fecha", "EEEE").alias("dia_nombre"),
        F.date_format("fecha", "MMMM").alias("mes_nombre"),
        weekday.isin(0, 6).alias("es_fin_semana"),
        F.lit(False).alias("es_feriado"),
    )


def calendar_for(moments: DataFrame, column: str) -> DataFrame:
    """Calendar from the first to the last day found in ``column``."""
    span = moments.agg(F.min(F.to_date(column)).alias("a"), F.max(F.to_date(column)).alias("b"))
    days = span.select("a", F.explode(F.sequence("a", "b")).alias("fecha"))
    return calendar_columns(
        days.select((F.datediff("fecha", "a") + 1).cast("bigint").alias("fecha_sk"), "fecha"))


# --- constant dimensions ----------------------------------------------------

def dim_payment_method(spark: SparkSession) -> DataFrame:
    rows = [(i, m, c) for i, (m, c) in enumerate(C.PAYMENT_METHODS, start=1)]
    return spark.createDataFrame(rows, "metodo_pago_sk bigint, metodo_pago string, categoria string")


def dim_order_state(spark: SparkSession) -> DataFrame:
    rows = [(i, s, t, p) for i, (s, t, p) in enumerate(C.ORDER_STATES, start=1)]
    return spark.createDataFrame(
        rows, "estado_pedido_sk bigint, estado string, es_terminal boolean, es_positivo boolean")


def dim_channel(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(enumerate(C.CHANNELS, start=1)), "canal_sk bigint, canal string")


# --- snapshots of the source ------------------------------------------------

def default_addresses(addresses: DataFrame) -> DataFrame:
    """One default address per client (the oldest if several are marked)."""
    return first_per_key(
        addresses.filter("es_predeterminada")
        .select("cliente_id", "direccion_id", "codigo_pais", "ciudad", "provincia"),
        ["cliente_id"], ["direccion_id"])


def customer_snapshot(oltp: Catalog) -> DataFrame:
    """Clients with their default address, or the default place without one."""
    joined = oltp.clientes.join(default_addresses(oltp.direcciones_cliente), "cliente_id", "left")
    return joined.select(
        "cliente_id", "correo",
        F.concat("nombre", F.lit(" "), "apellido").alias("nombre_completo"),
        "segmento", "estado",
        F.coalesce("codigo_pais", F.lit(C.DEFAULT_COUNTRY)).alias("codigo_pais"),
        F.coalesce("ciudad", F.lit(C.DEFAULT_CITY)).alias("ciudad"),
        F.coalesce("provincia", F.lit(C.DEFAULT_REGION)).alias("region"),
    )


def product_snapshot(oltp: Catalog) -> DataFrame:
    """Products with brand, category and parent category."""
    brand = oltp.marcas.select("marca_id", F.col("nombre").alias("nombre_marca"))
    category = oltp.categorias.select(
        "categoria_id", "categoria_padre_id", F.col("nombre").alias("nombre_categoria"))
    parent = oltp.categorias.select(
        F.col("categoria_id").alias("categoria_padre_id"), F.col("nombre").alias("nombre_padre"))
    tree = category.join(parent, "categoria_padre_id", "left").select(
        "categoria_id", "nombre_categoria",
        F.coalesce("nombre_padre", "nombre_categoria").alias("categoria_padre"))
    return (
        oltp.productos.join(brand, "marca_id").join(tree, "categoria_id")
        .select("producto_id", F.col("nombre").alias("nombre_producto"), "nombre_marca",
                "nombre_categoria", "categoria_padre", "estado_producto")
    )


def latest_price(prices: DataFrame) -> DataFrame:
    """The price row in force last per variant; the higher id breaks ties."""
    return last_per_key(
        prices.select("variante_id", "precio_id", "precio_lista", "vigente_desde"),
        ["variante_id"], ["vigente_desde", "precio_id"])


def variant_snapshot(oltp: Catalog, dim_producto: DataFrame) -> DataFrame:
    """Variants with list price (0 without one) and current product key."""
    price = latest_price(oltp.precios_producto).select("variante_id", "precio_lista")
    return (
        oltp.variantes_producto.join(price, "variante_id", "left")
        .join(current_keys(dim_producto, "producto_id", "producto_sk"), "producto_id", "left")
        .select("variante_id", "producto_sk", "sku", "color", "talla",
                F.coalesce("precio_lista", F.lit(0).cast(X.MONEY)).alias("precio_lista_actual"),
                "precio_costo", "activa")
    )


# --- loaders ----------------------------------------------------------------

def load_dim(
    incoming: DataFrame, key: str, sk: str, tracked: list[str], ts: Column,
    dim: DataFrame | None = None, touched: DataFrame | None = None,
) -> DataFrame:
    """Type 2 load of a snapshot, optionally of the touched ids only."""
    if touched is not None:
        incoming = incoming.join(touched.select(key).distinct(), key, "left_semi")
    if dim is None:
        return new_versions(incoming, key, sk, ts)
    return scd2_apply(dim, incoming, key, sk, tracked, ts)


def dim_customer_scd2(oltp: Catalog, ts: Column, dim=None, touched=None) -> DataFrame:
    return load_dim(customer_snapshot(oltp), "cliente_id", "cliente_sk",
                    CUSTOMER_TRACKED, ts, dim, touched)


def dim_product_scd2(oltp: Catalog, ts: Column, dim=None, touched=None) -> DataFrame:
    return load_dim(product_snapshot(oltp), "producto_id", "producto_sk",
                    PRODUCT_TRACKED, ts, dim, touched)


def dim_variant_scd2(
    oltp: Catalog, dim_producto: DataFrame, ts: Column, dim=None, touched=None,
) -> DataFrame:
    """A missing price equals 0, so it opens no version over a stored 0."""
    return load_dim(variant_snapshot(oltp, dim_producto), "variante_id", "variante_sk",
                    VARIANT_TRACKED, ts, dim, touched)


def dim_warehouse(almacenes: DataFrame, dim: DataFrame | None = None, overwrite: bool = False):
    """Type 1 warehouses: insert if absent; ``overwrite`` also renames."""
    incoming = almacenes.select(
        X.surrogate_key("almacen_id").alias("almacen_sk"),
        "almacen_id", "codigo", "nombre", "ciudad", "codigo_pais")
    if dim is None:
        return incoming
    if overwrite:
        return merge_upsert(dim, incoming, ["almacen_id"], replace=["nombre", "ciudad"])
    return merge_insert_only(dim, incoming, ["almacen_id"])


def dim_promotion(promociones: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Type 1 promotions: the latest name and type win."""
    incoming = promociones.select(
        X.surrogate_key("promocion_id").alias("promocion_sk"), "promocion_id", "nombre", "tipo")
    if dim is None:
        return incoming
    return merge_upsert(dim, incoming, ["promocion_id"], replace=["nombre", "tipo"])


def current_keys(dim: DataFrame, key: str, sk: str) -> DataFrame:
    """Natural key and surrogate key of the current versions."""
    current = dim.filter("es_actual") if "es_actual" in dim.columns else dim
    return current.select(key, sk)

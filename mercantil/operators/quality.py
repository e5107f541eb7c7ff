"""Data-quality checks taken from the declared constraints.

A row rule is a predicate, a set rule a DataFrame of violating rows or keys;
``dq_report`` counts the violations of both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercantil.functions import constants as C
from mercantil.functions.expressions import order_state_key

# Declared signs (fixed values).
NON_NEGATIVE = {
    "pedidos": ["subtotal", "descuento_total", "impuesto_total", "costo_envio", "total_final"],
    "detalle_pedidos": ["precio_unitario", "descuento_linea", "impuesto_linea", "total_linea"],
    "niveles_stock": ["cantidad_fisica", "cantidad_reservada"],
    "precios_producto": ["precio_lista"],
    "variantes_producto": ["precio_costo"],
    "detalle_carritos": ["precio_unitario"],
    "promociones": ["valor"],
    "ordenes_compra": ["subtotal", "impuesto_total", "total_oc"],
    "envios": ["costo_envio_real"],
}
POSITIVE = {
    "detalle_pedidos": ["cantidad"],
    "detalle_carritos": ["cantidad"],
    "detalle_devoluciones": ["cantidad_devuelta"],
    "pagos": ["monto"],
}
FACT_KEYS = {
    "fact_pedidos": "pedido_id",
    "fact_detalle_pedidos": "detalle_pedido_id",
    "fact_pagos": "pago_id",
    "fact_movimientos_inventario": "movimiento_id",
    "fact_envios": "envio_id",
    "fact_carritos": "carrito_id",
    "fact_devoluciones": "devolucion_id",
}


# --- row rules: one predicate each, true for a violation ----------------------

def total_mismatch(tolerance: int = 2) -> Column:
    """The parts of an order do not add up to its total."""
    parts = (F.col("subtotal") - F.col("descuento_total") + F.col("impuesto_total")
             + F.col("costo_envio"))
    return F.abs(F.col("total_final") - parts) > tolerance


def not_listed(table: str, column: str) -> Column:
    """A value outside the declared list; null passes."""
    return ~F.col(column).isin(C.ENUMERATIONS[table, column])


def bad_sign(table: str, columns: Sequence[str]) -> Column:
    """Negative money or stock, or a quantity that is not positive."""
    tests = [F.col(c) < 0 for c in NON_NEGATIVE.get(table, []) if c in columns]
    tests += [F.col(c) <= 0 for c in POSITIVE.get(table, []) if c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def bad_rating() -> Column:
    return ~F.col("calificacion").between(1, 5)


def incoherent_version() -> Column:
    """Flag and end of a Type 2 version disagree."""
    return F.col("es_actual") != F.col("valido_hasta").isNull()


def violations(df: DataFrame, rule: Column) -> DataFrame:
    """The rows that break a rule."""
    return df.filter(rule)


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations of many row rules in one pass over the table."""
    counts = df.agg(*[F.count_if(rule).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    pairs = F.array(*[
        F.struct(F.lit(name).alias("regla"), F.col(f"r{i}").alias("violaciones"))
        for i, name in enumerate(rules)
    ])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


# --- set rules: DataFrames of violating rows or keys --------------------------

def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("filas")).filter("filas > 1")


def several_active_shipments(envios: DataFrame) -> DataFrame:
    """Orders with more than one shipment that has not failed or come back."""
    active = envios.filter(~F.col("estado_envio").isin("fallido", "devuelto"))
    return duplicate_keys(active, ["pedido_id"])


def several_active_returns(devoluciones: DataFrame) -> DataFrame:
    """Orders with more than one return that was not rejected."""
    return duplicate_keys(devoluciones.filter("estado <> 'rechazada'"), ["pedido_id"])


def several_current_versions(dim: DataFrame, key: str) -> DataFrame:
    return duplicate_keys(dim.filter("es_actual"), [key])


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-null key is missing in the dimension."""
    return fact.filter(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def overlapping_intervals(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Rows that begin before an earlier interval of their key has ended; a null end is open."""
    earlier = (Window.partitionBy(key).orderBy("_start", "_end")
               .rowsBetween(Window.unboundedPreceding, -1))
    open_end = F.lit("9999-12-31 00:00:00").cast("timestamp")
    return (
        df.filter(F.col(start).isNotNull())
        .select(key, F.col(start).cast("timestamp").alias("_start"),
                F.coalesce(F.col(end).cast("timestamp"), open_end).alias("_end"))
        .withColumn("_busy", F.max("_end").over(earlier))
        .filter("_start < _busy").drop("_busy")
    )


def with_version_marks(versions: DataFrame, key: str) -> DataFrame:
    """Type 2 versions with what their rules need, from one window for each key.

    ``_busy`` is the latest end of the earlier versions, ``_current`` the number of
    current versions so far.
    """
    open_end = F.lit("9999-12-31 00:00:00").cast("timestamp")
    end = F.when(F.col("valido_desde").isNotNull(), F.coalesce("valido_hasta", open_end))
    order = Window.partitionBy(key).orderBy("valido_desde", "_end")
    return (
        versions.withColumn("_end", end)
        .withColumn("_busy", F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_current", F.count_if("es_actual").over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )


def overlapping_version() -> Column:
    """A version that begins before an earlier one of its key has ended."""
    return F.col("valido_desde") < F.col("_busy")


def second_current_version() -> Column:
    """True once for each key with more than one current version."""
    return F.col("es_actual") & (F.col("_current") == 2)


def with_dimensions(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Mark per key of ``fact`` whether its dimension holds it, for ``missing_in_dimension``.

    ``dims`` maps a key to a dimension with one row per key. All keys of a fact are
    checked in one pass over it.
    """
    for key, dim in dims.items():
        found = dim.select(F.col(key), F.lit(True).alias(f"_hay_{key}"))
        fact = fact.join(found, key, "left")
    return fact


def missing_in_dimension(key: str) -> Column:
    return F.col(key).isNotNull() & F.col(f"_hay_{key}").isNull()


def repeated_keys(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Keys held by more than one row, counted per rule; all tables share one shuffle."""
    rows = reduce(DataFrame.unionByName, [
        df.filter(F.col(key).isNotNull()).select(
            F.lit(rule).alias("regla"), F.col(key).cast("string").alias("clave"))
        for rule, (df, key) in tables.items()])
    counts = (duplicate_keys(rows, ["regla", "clave"])
              .groupBy("regla").agg(F.count("*").alias("violaciones")))
    # Rules that hold count zero.
    names = rows.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(rule) for rule in tables])).alias("regla"),
        F.lit(0).cast("bigint").alias("violaciones"))
    return counts.unionByName(names).groupBy("regla").agg(F.sum("violaciones").alias("violaciones"))


def stale_order_state(fact_pedidos: DataFrame, pedidos: DataFrame) -> DataFrame:
    """Order facts whose state differs from the source (some changes emit no event)."""
    source = pedidos.select("pedido_id", order_state_key("estado_actual").alias("_fuente"))
    return fact_pedidos.join(source, "pedido_id").filter(
        ~F.col("estado_pedido_sk").eqNullSafe(F.col("_fuente")))


# --- contract checks --------------------------------------------------------

def contract_violations(
    spark: SparkSession, found: Mapping[str, T.StructType], wanted: Mapping[str, T.StructType],
) -> DataFrame:
    """Missing tables, missing columns and columns of another type."""
    rows = []
    for table, schema in wanted.items():
        if table not in found:
            rows.append((table, None, "falta tabla"))
            continue
        types = {f.name: f.dataType for f in found[table].fields}
        for field in schema.fields:
            if field.name not in types:
                rows.append((table, field.name, "falta columna"))
            elif types[field.name] != field.dataType:
                rows.append((table, field.name, "otro tipo"))
    return spark.createDataFrame(rows, "tabla string, columna string, problema string")


def short_calendar(dim_fecha: DataFrame, days: int = 365) -> DataFrame:
    """One row when the calendar has fewer days than needed."""
    return dim_fecha.agg(F.count("*").alias("dias")).filter(F.col("dias") < days)


def missing_watermarks(spark: SparkSession, watermarks: DataFrame) -> DataFrame:
    """Expected sources without a watermark row, ready to append."""
    wanted = spark.createDataFrame([(s,) for s in C.WATERMARK_SOURCES], "tabla_fuente string")
    epoch = F.lit("2020-01-01 00:00:00").cast("timestamp")
    return wanted.join(watermarks.select("tabla_fuente"), "tabla_fuente", "left_anti").select(
        "tabla_fuente", epoch.alias("ultima_carga"),
        F.current_timestamp().alias("actualizado_en"))


def dq_report(
    row_rules: Mapping[str, tuple[DataFrame, Mapping[str, Column]]],
    set_rules: Mapping[str, DataFrame],
) -> DataFrame:
    """Violations per rule, 0 for a rule that holds.

    ``row_rules`` gives per table its rows and predicates, counted in one scan
    of the table. ``set_rules`` gives the violating rows of rules that need a
    shuffle.
    """
    parts = [count_violations(df, rules) for df, rules in row_rules.values()]
    parts += [
        rows.agg(F.count("*").alias("violaciones")).select(F.lit(rule).alias("regla"), "violaciones")
        for rule, rows in set_rules.items()
    ]
    return reduce(DataFrame.unionByName, parts)

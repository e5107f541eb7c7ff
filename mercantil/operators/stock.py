"""Stock rules: allocation, movements, ledger and reordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercantil.operators.ordered import CHUNK_ROWS, with_running_levels
from mercantil.operators.topn import last_per_key


def _best_warehouse(levels: DataFrame, measure: str) -> DataFrame:
    """Per variant the warehouse with the highest ``measure``, lowest id on ties.

    Some warehouse has enough exactly when the best one has, so allocation
    needs this row only and never pairs lines with every warehouse.
    """
    best = last_per_key(
        levels.select("variante_id", "almacen_id", F.col(measure).alias("_nivel")),
        ["variante_id"], ["_nivel", -F.col("almacen_id")])
    return best.select("variante_id", F.col("almacen_id").alias("_almacen"), "_nivel")


def allocate_warehouse(lines: DataFrame, levels: DataFrame) -> DataFrame:
    """Set ``almacen_id`` to the warehouse with most available stock.

    Null when no warehouse has the quantity. Each line is judged on its own,
    see ``mark_oversold`` for lines that compete.
    """
    enough = F.col("_nivel") >= F.col("cantidad")
    joined = lines.drop("almacen_id").join(
        _best_warehouse(levels, "cantidad_disponible"), "variante_id", "left")
    return joined.select(
        *[c for c in lines.columns if c != "almacen_id"],
        F.when(enough, F.col("_almacen")).alias("almacen_id"))


def allocate_competing(
    lines: DataFrame, levels: DataFrame, order: list[str], chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Lines of a variant draw on its stock in ``order``, the fullest warehouse first.

    Running demand and running stock are intervals of one axis; a line gets what it
    overlaps of each warehouse, so it may become several rows. What no warehouse has is
    a row with null ``almacen_id``. A variant's intervals are at most one per warehouse;
    lines are never paired with each other. Lines without quantity give no row.
    """
    wanted = lines.filter("cantidad > 0").withColumn("_demand", F.col("cantidad").cast("bigint"))
    running = with_running_levels(
        wanted.drop("almacen_id"), ["variante_id"], order, {"_to": ("_demand", None)},
        floor_at_zero=False, chunk_rows=chunk_rows).withColumn("_from", F.col("_to") - F.col("_demand"))
    fullest = Window.partitionBy("variante_id").orderBy(F.desc("cantidad_disponible"), "almacen_id")
    upto = fullest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stock = (
        levels.filter("cantidad_disponible > 0")
        .withColumn("_end", F.sum(F.col("cantidad_disponible").cast("bigint")).over(upto))
        .groupBy("variante_id").agg(
            F.collect_list(F.struct(
                F.col("almacen_id"), (F.col("_end") - F.col("cantidad_disponible")).alias("start"),
                F.col("_end").alias("end"))).alias("_parts"),
            F.max("_end").alias("_total")))
    total = F.coalesce("_total", F.lit(0).cast("bigint"))
    joined = running.join(stock, "variante_id", "left")
    met = F.filter(F.coalesce("_parts", F.expr("array()")), lambda p: (p["start"] < F.col("_to")) & (p["end"] > F.col("_from")))
    given = F.transform(met, lambda p: F.struct(
        p["almacen_id"].alias("almacen_id"),
        (F.least(p["end"], "_to") - F.greatest(p["start"], "_from")).alias("cantidad")))
    rest = F.when(F.col("_to") > total, F.array(F.struct(
        F.lit(None).cast(levels.schema["almacen_id"].dataType).alias("almacen_id"),
        (F.col("_to") - F.greatest(total, "_from")).alias("cantidad"))))
    kept = [c for c in lines.columns if c not in ("almacen_id", "cantidad")]
    both = F.concat(given, F.coalesce(rest, F.filter(given, lambda _: F.lit(False))))
    return joined.select(*kept, F.explode(both).alias("_p")).select(*kept, "_p.*")


def mark_oversold(
    lines: DataFrame, levels: DataFrame, order: list[str], chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add demand so far per (warehouse, variant) and whether it passes the stock."""
    allocated = lines.filter("almacen_id IS NOT NULL").withColumn(
        "_demand", F.col("cantidad").cast("bigint"))
    running = with_running_levels(
        allocated, ["almacen_id", "variante_id"], order, {"demanda_acumulada": ("_demand", None)},
        floor_at_zero=False, chunk_rows=chunk_rows).drop("_demand")
    stock = levels.select("almacen_id", "variante_id", "cantidad_disponible")
    return (
        running.join(stock, ["almacen_id", "variante_id"], "left")
        .withColumn("excede_stock", F.col("demanda_acumulada") > F.col("cantidad_disponible"))
    )


def reservation_movements(allocated: DataFrame) -> DataFrame:
    """'reserva' movements of allocated lines."""
    return allocated.filter("almacen_id IS NOT NULL").select(
        "almacen_id", "variante_id", F.lit("reserva").alias("tipo_movimiento"), "cantidad",
        F.lit("pedido").alias("tipo_referencia"), F.col("pedido_id").alias("referencia_id"))


def delivery_movements(orders: DataFrame, lines: DataFrame, levels: DataFrame) -> DataFrame:
    """'venta' movements of delivered orders, with negative quantity.

    A line without warehouse takes the one with most reserved stock if that
    covers the quantity, else warehouse 1.
    """
    delivered = orders.filter("estado_actual = 'entregado'").select("pedido_id")
    best = _best_warehouse(levels, "cantidad_reservada")
    fallback = F.when(F.col("_nivel") >= F.col("cantidad"), F.col("_almacen")).otherwise(F.lit(1))
    return (
        lines.select("pedido_id", "variante_id", "cantidad", "almacen_id")
        .join(delivered, "pedido_id", "left_semi")
        .join(best, "variante_id", "left")
        .select(F.coalesce("almacen_id", fallback).alias("almacen_id"), "variante_id",
                F.lit("venta").alias("tipo_movimiento"), (-F.col("cantidad")).alias("cantidad"),
                F.lit("pedido").alias("tipo_referencia"),
                F.col("pedido_id").alias("referencia_id"))
    )


def cancel_release(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Reserved stock given back by orders that may be cancelled."""
    open_orders = orders.filter(
        F.col("estado_actual").isin("pendiente", "confirmado")).select("pedido_id")
    return (
        lines.filter("almacen_id IS NOT NULL").join(open_orders, "pedido_id", "left_semi")
        .select("almacen_id", "variante_id", F.lit("liberacion").alias("tipo_movimiento"),
                "cantidad", F.lit("pedido").alias("tipo_referencia"),
                F.col("pedido_id").alias("referencia_id"))
    )


def return_movements(
    returns: DataFrame, return_lines: DataFrame, lines: DataFrame, levels: DataFrame,
) -> DataFrame:
    """'devolucion' movements; the quantity must lie between 1 and the ordered one.

    A line without warehouse goes where a delivery of it would have come from.
    """
    best = _best_warehouse(levels, "cantidad_reservada")
    fallback = F.when(F.col("_nivel") >= F.col("_pedida"), F.col("_almacen")).otherwise(F.lit(1))
    ordered = lines.select(
        "detalle_pedido_id", F.col("cantidad").alias("_pedida"), "almacen_id")
    return (
        return_lines.select("devolucion_id", "detalle_pedido_id", "variante_id",
                            "cantidad_devuelta")
        .join(returns.select("devolucion_id"), "devolucion_id", "left_semi")
        .join(ordered, "detalle_pedido_id")
        .filter(F.col("cantidad_devuelta").between(F.lit(1), F.col("_pedida")))
        .join(best, "variante_id", "left")
        .select(F.coalesce("almacen_id", fallback).alias("almacen_id"), "variante_id",
                F.lit("devolucion").alias("tipo_movimiento"),
                F.col("cantidad_devuelta").alias("cantidad"),
                F.lit("devolucion").alias("tipo_referencia"),
                F.col("devolucion_id").alias("referencia_id"))
    )


def replenish_movements(purchases: DataFrame, kind: Column | None = None) -> DataFrame:
    """Stock received from purchase orders, as 'ingreso' or 'reposicion'.

    Without ``kind`` even purchase ids are 'ingreso' and odd ones 'reposicion'.
    """
    if kind is None:
        kind = F.when(F.col("orden_compra_id") % 2 == 0, "ingreso").otherwise("reposicion")
    return purchases.filter("estado = 'recibida_total'").select(
        "almacen_id", "variante_id", kind.alias("tipo_movimiento"),
        F.col("cantidad_recibida").alias("cantidad"),
        F.lit("orden_compra").alias("tipo_referencia"),
        F.col("orden_compra_id").alias("referencia_id"))


def physical_delta(kind: Column, quantity: Column) -> Column:
    """Change of physical stock; sales are stored negative."""
    moves = kind.isin("ingreso", "reposicion", "devolucion", "venta", "ajuste")
    return F.when(moves, quantity).otherwise(0).cast("bigint")


def reserved_delta(kind: Column, quantity: Column) -> Column:
    """Change of reserved stock: sales and releases lower it."""
    return (
        F.when(kind == "reserva", quantity)
        .when(kind == "venta", quantity)
        .when(kind == "liberacion", -quantity)
        .otherwise(0).cast("bigint")
    )


def stock_ledger(
    movements: DataFrame, opening: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Running physical, reserved and available stock after each movement.

    Levels never fall below 0. Order is by time and movement id within each
    (warehouse, variant).
    """
    kind, quantity = F.col("tipo_movimiento"), F.col("cantidad")
    signed = (
        movements.select("movimiento_inventario_id", "almacen_id", "variante_id",
                         "tipo_movimiento", "cantidad", "fecha_movimiento")
        .withColumn("_fisica", physical_delta(kind, quantity))
        .withColumn("_reservada", reserved_delta(kind, quantity))
    )
    keys, order = ["almacen_id", "variante_id"], ["fecha_movimiento", "movimiento_inventario_id"]
    starts: tuple[str | None, str | None] = (None, None)
    if opening is not None:
        opening = opening.select(*keys, F.col("cantidad_fisica").alias("_f0"), F.col("cantidad_reservada").alias("_r0"))
        starts = ("_f0", "_r0")
    levels = with_running_levels(
        signed, keys, order,
        {"cantidad_fisica": ("_fisica", starts[0]), "cantidad_reservada": ("_reservada", starts[1])},
        chunk_rows=chunk_rows, openings=opening)
    return levels.select(
        "movimiento_inventario_id", "almacen_id", "variante_id", "tipo_movimiento", "cantidad",
        "fecha_movimiento", "cantidad_fisica", "cantidad_reservada",
        (F.col("cantidad_fisica") - F.col("cantidad_reservada")).alias("cantidad_disponible"))


def reorder_candidates(levels: DataFrame, variants: DataFrame, n: int | None = None) -> DataFrame:
    """Stock at or below its reorder point that has a supplier, lowest first."""
    low = levels.filter("cantidad_disponible <= punto_reorden")
    found = low.join(
        variants.filter("proveedor_id IS NOT NULL").select("variante_id", "proveedor_id"),
        "variante_id")
    ordered = found.select(
        "almacen_id", "variante_id", "proveedor_id", "cantidad_disponible", "punto_reorden"
    ).orderBy("cantidad_disponible", "almacen_id", "variante_id")
    return ordered if n is None else ordered.limit(n)

"""Row errors: events whose source rows don't fit the fact tables.

A loader copies source rows into facts of declared types. A number out of range, an
unreadable date, a missing required value or a text that is too long must fail the
event that names the row, and nothing else. The checks are columns over the rows that a
batch names (``try_cast``, no exception), so the faulty events go to the retries and the
dead letters while the others load.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercantil import schemas
from mercantil.functions import expressions as X
from mercantil.operators.facts import events_for
from mercantil.sources.tables import Catalog

#: Payload field that names the entity, and the source tables with the column it is found in.
CHECKED = {
    "order_created": ("pedido_id", {"pedidos": "pedido_id", "detalle_pedidos": "pedido_id"}),
    "payment": ("pago_id", {"pagos": "pago_id"}),
    "stock": ("movimiento_id", {"movimientos_inventario": "movimiento_inventario_id"}),
    "shipment_delivered": ("envio_id", {"envios": "envio_id"}),
    "shipment_returned": ("envio_id", {"envios": "envio_id"}),
    "return": ("devolucion_id", {"devoluciones": "devolucion_id", "detalle_devoluciones": "devolucion_id"}),
    "cart": ("carrito_id", {"carritos": "carrito_id", "detalle_carritos": "carrito_id"}),
}
ERROR = "error_fila"
#: Characters of a value that an error shows.
SHOWN = 100


def _faults(table: str, schema: T.StructType) -> list[Column]:
    """One column for each check of a table: the error, or null."""
    wanted = {f.name: f.dataType for f in T.StructType.fromDDL(schemas.SOURCES[table]).fields}
    found = {f.name: f.dataType for f in schema.fields}
    faults = []
    for name, kind in wanted.items():
        if name in found and found[name] != kind:
            bad = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
            shown = F.substring(F.col(name).cast("string"), 1, SHOWN)
            faults.append(F.when(bad, F.concat(F.lit(f"{table}.{name}: valor fuera de rango o ilegible: "), shown)))
    for name in schemas.REQUIRED.get(table, ()):
        faults.append(F.when(F.col(name).isNull(), F.lit(f"{table}.{name}: falta")))
    for name, most in schemas.LENGTHS.get(table, {}).items():
        faults.append(F.when(F.char_length(F.col(name).cast("string")) > most,
                             F.lit(f"{table}.{name}: más de {most} caracteres")))
    return faults


def _cart_totals(rows: DataFrame) -> DataFrame:
    """Carts whose value passes the money type, from lines that fit themselves."""
    money = T.StructType.fromDDL(schemas.SOURCES["detalle_carritos"])["precio_unitario"].dataType
    value = F.sum(F.col("cantidad").try_cast("int") * F.col("precio_unitario").try_cast(money))
    totals = rows.groupBy("evento_negocio_id", "carrito_id").agg(value.alias("v"))
    bad = F.col("v").isNotNull() & F.col("v").try_cast(X.MONEY).isNull()
    return totals.filter(bad).select("evento_negocio_id", F.concat(
        F.lit("carritos.valor_total: valor fuera de rango: "), F.col("v").cast("string")).alias(ERROR))


def row_errors(
    events: DataFrame, oltp: Catalog, loaders: Iterable[str] = tuple(CHECKED), dealt: Mapping[str, DataFrame] | None = None,
) -> DataFrame | None:
    """``evento_negocio_id, error_fila`` for each event that names a row that doesn't fit.

    ``events`` are parsed and routed, ``oltp`` has the source tables as they are. Of several
    errors the first by text is told. Only rows that the events name are looked at, and only
    for ``loaders``; None if nothing can be wrong there. ``dealt`` has the events that fill a
    payload field, where they are at hand by that field.
    """
    found = []
    for loader, (field, tables) in CHECKED.items():
        if loader not in loaders:
            continue
        named = events_for((dealt or {}).get(field, events), loader).filter(F.col(field).isNotNull())
        for table, key in tables.items():
            if table not in oltp:
                continue
            ids = named.select("evento_negocio_id", F.col(field).alias(key))
            rows = oltp.rows_for(table, ids.select(key))
            faults = _faults(table, rows.schema)
            if faults:
                first = F.array_min(F.filter(F.array(*faults), lambda e: e.isNotNull()))
                found.append(ids.join(rows, key).select("evento_negocio_id", first.alias(ERROR)).filter(
                    F.col(ERROR).isNotNull()))
            if table == "detalle_carritos":
                found.append(_cart_totals(ids.join(rows, key)))
    if not found:
        return None
    return reduce(DataFrame.unionByName, found).groupBy("evento_negocio_id").agg(F.min(ERROR).alias(ERROR))


def with_row_errors(routed: DataFrame, oltp: Catalog, loaders: Iterable[str] = tuple(CHECKED)) -> DataFrame:
    """Routed events with ``error_fila``, null for those whose rows fit."""
    return with_errors(routed, row_errors(routed, oltp, loaders))


def with_errors(routed: DataFrame, errors: DataFrame | None) -> DataFrame:
    """Routed events with the errors found by ``row_errors``."""
    if errors is None:
        return routed.withColumn(ERROR, F.lit(None).cast("string"))
    return routed.join(errors, "evento_negocio_id", "left")

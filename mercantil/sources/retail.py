"""Adapter: the given order tables seen as the retail source tables.

Every projection is plain SQL text that Spark and the checking engine both
read, so the two sides rename columns in exactly the same way. Only joins and
aggregates are written per engine.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercantil.sources.tables import Catalog

CALENDAR_START = dt.date(1995, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)

CHANNEL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'call_center' WHEN '2-HIGH' THEN 'mobile'
 WHEN '3-MEDIUM' THEN 'web' WHEN '4-NOT SPECIFIED' THEN 'marketplace' ELSE 'api' END"""
ORDER_STATE = """CASE WHEN o_orderstatus = 'F' THEN 'entregado'
 ELSE CASE WHEN o_orderstatus = 'P' THEN CASE o_orderkey % 3 WHEN 0 THEN 'enviado'
     WHEN 1 THEN 'cancelado' ELSE 'preparando' END
   ELSE CASE o_orderkey % 4 WHEN 0 THEN 'pendiente' WHEN 1 THEN 'confirmado'
     WHEN 2 THEN 'pagado' ELSE 'empaquetado' END END END"""
FULFILLMENT = """CASE WHEN o_orderstatus = 'F' THEN 'entregado'
 WHEN o_orderstatus = 'P' THEN CASE o_orderkey % 3 WHEN 0 THEN 'enviado' WHEN 1 THEN 'pendiente'
   ELSE 'preparando' END
 ELSE CASE o_orderkey % 4 WHEN 3 THEN 'listo' ELSE 'pendiente' END END"""
# Nested so that a filter on one state reaches the Parquet scan as a plain predicate.
PAYMENT_STATE = """CASE WHEN o_orderstatus = 'F' THEN 'pagado'
 ELSE CASE WHEN o_orderstatus = 'O' THEN 'pendiente' ELSE 'parcial' END END"""
METHOD = """CASE o_orderkey % 5 WHEN 0 THEN 'tarjeta_credito' WHEN 1 THEN 'tarjeta_debito'
 WHEN 2 THEN 'transferencia' WHEN 3 THEN 'billetera_virtual' ELSE 'cuotas' END"""
PROVIDER = """CASE o_orderkey % 5 WHEN 0 THEN 'Transbank' WHEN 1 THEN 'MercadoPago'
 WHEN 2 THEN 'Flow' WHEN 3 THEN 'Khipu' ELSE 'Kushki' END"""
CARRIER = """CASE l_suppkey % 5 WHEN 0 THEN 'Chilexpress' WHEN 1 THEN 'Starken'
 WHEN 2 THEN 'BlueExpress' WHEN 3 THEN 'Correos Chile' ELSE 'Urbano' END"""
REASON = """CASE l_linenumber % 4 WHEN 0 THEN 'producto_defectuoso'
 WHEN 1 THEN 'no_cumple_expectativa' WHEN 2 THEN 'talla_incorrecta' ELSE 'cambio_decision' END"""
MOVEMENT = """CASE l_linenumber WHEN 1 THEN 'ingreso' WHEN 2 THEN 'reposicion' WHEN 3 THEN 'venta'
 WHEN 4 THEN 'reserva' WHEN 5 THEN 'devolucion' WHEN 6 THEN 'ajuste' ELSE 'liberacion' END"""

TOTAL = "CAST(o_totalprice AS DECIMAL(12,2))"
ORDER_TAX = f"CAST({TOTAL} * CAST(0.1597 AS DECIMAL(5,4)) AS DECIMAL(12,2))"
ORDER_SHIPPING = (f"CASE WHEN {TOTAL} > 50000 THEN CAST(0 AS DECIMAL(12,2)) "
                  "ELSE CAST(4990 AS DECIMAL(12,2)) END")
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
QUANTITY = "CAST(l_quantity AS INT)"
GROSS = f"CAST({PRICE} * {QUANTITY} AS DECIMAL(12,2))"
LINE_DISCOUNT = f"CAST({GROSS} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2))"
LINE_TOTAL = f"CAST({GROSS} - {LINE_DISCOUNT} AS DECIMAL(12,2))"
LINE_TAX = f"CAST({LINE_TOTAL} * CAST(0.19 AS DECIMAL(3,2)) AS DECIMAL(12,2))"
# Natural key of a line, and an id for every row: lines that share the key are numbered.
LINE_KEY = "l_orderkey * 100 + l_linenumber"
LINE_ID = f"({LINE_KEY}) * 1000 + l_copy"
VARIANT = "l_partkey * 2 + l_linenumber % 2"

CLIENTES = [
    "c_custkey AS cliente_id",
    "c_name AS cliente_externo_id",
    "lower(c_name) || '@example.com' AS correo",
    "substr(c_name, 1, 8) AS nombre",
    "substr(c_name, 10) AS apellido",
    "c_mktsegment AS segmento",
    "CASE WHEN c_acctbal < 0 THEN 'bloqueado' WHEN c_acctbal < 1000 THEN 'inactivo' "
    "ELSE 'activo' END AS estado",
    "c_acctbal >= 1000 AS activo",
]
DIRECCIONES = [
    "c_custkey * 2 + k AS direccion_id",
    "c_custkey AS cliente_id",
    "n_name AS ciudad",
    "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE r_name END AS provincia",
    "'CL' AS codigo_pais",
    "k = 0 AND c_custkey % 4 < 2 AS es_predeterminada",
]
MARCAS = ["CAST(substr(p_brand, 7) AS BIGINT) AS marca_id", "p_brand AS nombre"]
CATEGORIAS = [
    "CAST(ascii(substr(p_type, 2, 1)) AS BIGINT) AS categoria_id",
    "CAST(CASE p_type WHEN 'ECONOMY' THEN 82 WHEN 'SMALL' THEN 84 ELSE NULL END AS BIGINT) "
    "AS categoria_padre_id",
    "p_type AS nombre",
]
PRODUCTOS = [
    "p_partkey AS producto_id",
    "CAST(substr(p_brand, 7) AS BIGINT) AS marca_id",
    "CAST(ascii(substr(p_type, 2, 1)) AS BIGINT) AS categoria_id",
    "p_name AS nombre",
    "CASE WHEN p_size % 10 = 0 THEN 'descontinuado' ELSE 'activo' END AS estado_producto",
]
VARIANTES = [
    "p_partkey * 2 + k AS variante_id",
    "p_partkey AS producto_id",
    "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_partkey % 5 + 1 END AS proveedor_id",
    "'SKU-' || CAST(p_partkey * 2 + k AS STRING) AS sku",
    "CASE WHEN p_size % 3 = 0 THEN NULL ELSE split_part(p_name, ' ', 1) END AS color",
    "CAST(p_size AS STRING) AS talla",
    "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,2)) "
    "AS precio_costo",
    "(p_size + k) % 7 <> 0 AS activa",
]
# Two price rows for most variants, one or none for the rest; some share their start.
PRECIOS = [
    "(p_partkey * 2 + k) * 4 + n AS precio_id",
    "p_partkey * 2 + k AS variante_id",
    "CAST(CAST(p_retailprice AS DECIMAL(12,2)) + 10 * n AS DECIMAL(12,2)) AS precio_lista",
    "CASE WHEN n = 1 AND p_size % 2 = 0 THEN TIMESTAMP '1996-01-01 00:00:00' "
    "ELSE TIMESTAMP '1995-01-01 00:00:00' END AS vigente_desde",
]
PROMOCIONES = [
    "CAST(substr(p_brand, 7) AS BIGINT) AS promocion_id",
    "'Promo ' || p_brand AS nombre",
    "CASE CAST(substr(p_brand, 7) AS BIGINT) % 4 WHEN 0 THEN 'porcentaje' WHEN 1 THEN 'monto_fijo' "
    "WHEN 2 THEN 'envio_gratis' ELSE 'combo' END AS tipo",
]
ALMACENES = [
    "s_suppkey AS almacen_id",
    "'ALM-' || CAST(s_suppkey AS STRING) AS codigo",
    "s_name AS nombre",
    "n_name AS ciudad",
    "'CL' AS codigo_pais",
]
PEDIDOS = [
    "o_orderkey AS pedido_id",
    "'PED-' || CAST(o_orderkey AS STRING) AS numero_pedido",
    "o_custkey AS cliente_id",
    f"{CHANNEL} AS canal_venta",
    f"{ORDER_STATE} AS estado_actual",
    # Orders of status P were keyed without adding the discount back.
    f"CAST({TOTAL} - {ORDER_TAX} - {ORDER_SHIPPING} + CASE WHEN o_orderstatus = 'P' "
    "THEN CAST(0 AS DECIMAL(12,2)) ELSE coalesce(descuento, CAST(0 AS DECIMAL(12,2))) END "
    "AS DECIMAL(12,2)) AS subtotal",
    "CAST(coalesce(descuento, CAST(0 AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS descuento_total",
    f"{ORDER_TAX} AS impuesto_total",
    f"{ORDER_SHIPPING} AS costo_envio",
    f"{TOTAL} AS total_final",
    f"{PAYMENT_STATE} AS estado_pago",
    f"{FULFILLMENT} AS estado_fulfillment",
    "o_orderdate AS creado_en",
    "o_orderdate AS actualizado_en",
]
DETALLE_PEDIDOS = [
    f"{LINE_ID} AS detalle_pedido_id",
    "l_orderkey AS pedido_id",
    f"{VARIANT} AS variante_id",
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey END AS almacen_id",
    f"{QUANTITY} AS cantidad",
    f"{PRICE} AS precio_unitario",
    f"{LINE_DISCOUNT} AS descuento_linea",
    f"{LINE_TAX} AS impuesto_linea",
    f"{LINE_TOTAL} AS total_linea",
    "l_shipdate AS creado_en",
]
PAGOS = [
    "o_orderkey * 4 + k AS pago_id",
    "o_orderkey AS pedido_id",
    f"{PROVIDER} AS proveedor_pago",
    f"{METHOD} AS metodo_pago",
    f"{TOTAL} AS monto",
    "CASE WHEN k = o_orderkey % 3 AND (o_orderstatus = 'F' OR o_orderkey % 12 = 1) "
    "THEN 'capturado' ELSE 'fallido' END AS estado",
    "o_orderdate + k * INTERVAL '1' HOUR AS creado_en",
]
MOVIMIENTOS = [
    f"{LINE_ID} AS movimiento_inventario_id",
    "l_suppkey AS almacen_id",
    f"{VARIANT} AS variante_id",
    f"{MOVEMENT} AS tipo_movimiento",
    f"CASE WHEN l_linenumber = 3 THEN -{QUANTITY} ELSE {QUANTITY} END AS cantidad",
    "'pedido' AS tipo_referencia",
    "l_orderkey AS referencia_id",
    "l_shipdate AS fecha_movimiento",
]
ENVIOS = [
    f"{LINE_ID} AS envio_id",
    "l_orderkey AS pedido_id",
    "l_suppkey AS almacen_id",
    "CASE WHEN l_returnflag = 'R' THEN 'devuelto' WHEN l_returnflag = 'N' AND l_linestatus = 'O' "
    "THEN 'en_camino' ELSE 'entregado' END AS estado_envio",
    f"{CARRIER} AS transportista",
    "o_orderdate AS enviado_en",
    "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE l_shipdate END "
    "AS entregado_en",
]
DEVOLUCIONES = [
    f"{LINE_ID} AS devolucion_id",
    "l_orderkey AS pedido_id",
    f"{REASON} AS motivo",
    "CASE WHEN l_linestatus = 'F' THEN 'aprobada' ELSE 'rechazada' END AS estado",
    "l_shipdate AS creado_en",
]
# Two detail rows per return over 5 units, none for smaller ones.
DETALLE_DEVOLUCIONES = [
    f"({LINE_ID}) * 2 + k AS detalle_devolucion_id",
    f"{LINE_ID} AS devolucion_id",
    f"{LINE_ID} AS detalle_pedido_id",
    f"{VARIANT} AS variante_id",
    f"CASE WHEN k = 0 THEN {QUANTITY} ELSE 1 END AS cantidad_devuelta",
]
NIVELES_STOCK = [
    "variante_id * 1000000 + almacen_id AS nivel_stock_id",
    "almacen_id",
    "variante_id",
    "cantidad_fisica",
    "cantidad_reservada",
    "cantidad_fisica - cantidad_reservada AS cantidad_disponible",
    "CAST(20 AS BIGINT) AS punto_reorden",
]
ORDENES_COMPRA = [
    f"{LINE_ID} AS orden_compra_id",
    "l_suppkey AS proveedor_id",
    "l_suppkey AS almacen_id",
    "CASE WHEN l_linestatus = 'F' THEN 'recibida_total' ELSE 'enviada' END AS estado",
    f"{VARIANT} AS variante_id",
    f"{QUANTITY} AS cantidad_recibida",
    "l_shipdate AS fecha_recepcion",
]

# Stream of business events; {k} is the number in props, {day} the UTC day of ts.
STREAM_TYPE = """CASE event_type
 WHEN 'purchase' THEN CASE WHEN {k} % 4 = 0 THEN 'pago_fallido' ELSE 'pago_capturado' END
 WHEN 'click' THEN CASE WHEN {k} % 2 = 0 THEN 'carrito_convertido' ELSE 'carrito_abandonado' END
 WHEN 'view' THEN 'pedido_actualizado'
 WHEN 'signup' THEN CASE WHEN {k} % 5 = 0 THEN 'pedido_cancelado' ELSE 'pedido_creado' END
 ELSE CASE WHEN {k} % 10 = 0 THEN 'pedido_creado' ELSE 'error' END END"""
STREAM_STATE = """CASE {k} % 11 WHEN 0 THEN 'pendiente' WHEN 1 THEN 'confirmado'
 WHEN 2 THEN 'pagado' WHEN 3 THEN 'preparando' WHEN 4 THEN 'empaquetado' WHEN 5 THEN 'enviado'
 WHEN 6 THEN 'entregado' WHEN 7 THEN 'cancelado' WHEN 8 THEN 'reembolsado' WHEN 9 THEN 'devuelto'
 ELSE 'desconocido' END"""
STREAM_PAYLOAD = f"""CASE event_type
 WHEN 'purchase' THEN '{{{{"pago_id":' || CAST(event_id AS STRING) || ',"pedido_id":'
   || CAST(user_id AS STRING) || '}}}}'
 WHEN 'click' THEN '{{{{"carrito_id":' || CAST(user_id * 100000 + {{day}} AS STRING) || '}}}}'
 WHEN 'view' THEN CASE WHEN {{k}} % 13 = 12 THEN NULL ELSE '{{{{"pedido_id":'
   || CAST(user_id AS STRING) || ',"estado_nuevo":"' || {STREAM_STATE} || '"}}}}' END
 WHEN 'signup' THEN '{{{{"pedido_id":' || CAST(user_id AS STRING) || '}}}}'
 ELSE CASE WHEN {{k}} % 10 = 0 THEN '{{{{bad' ELSE '{{{{"k":' || CAST({{k}} AS STRING) || '}}}}' END END"""
STREAM = [
    "event_id AS evento_negocio_id",
    "event_type AS tipo_entidad",
    "user_id AS entidad_id",
    f"{STREAM_TYPE} AS tipo_evento",
    f"{STREAM_PAYLOAD} AS payload",
    "ts AS ocurrido_en",
]


def stream_columns(k: str, day: str) -> list[str]:
    return [column.format(k=k, day=day) for column in STREAM]


SPARK_K = "CAST(get_json_object(props, '$.k') AS INT)"
SPARK_DAY = "datediff(to_date(ts), DATE '1970-01-01')"

# Order of equal line ids: the first by all other columns is kept.
LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def stream_events(events: DataFrame) -> DataFrame:
    """Business event envelopes from the ``events`` table (batch or stream)."""
    # The number is read once here, as the columns use it many times.
    read = events.selectExpr("*", f"{SPARK_K} AS k", f"{SPARK_DAY} AS day")
    return read.selectExpr(*stream_columns("k", "day"))


def numbered_lines(lineitem: DataFrame) -> DataFrame:
    """Every line, with its number among those of the same order and line number.

    Lines are numbered by order first, so they are dealt as a join with orders needs them.
    """
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", *LINE_ORDER)
    same = (Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*LINE_ORDER)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    number = F.row_number().over(order)
    return lineitem.withColumn("_n", number).select(
        "l_orderkey", "l_linenumber", *LINE_ORDER,
        (F.col("_n") - F.min("_n").over(same)).cast("bigint").alias("l_copy"))


def source_catalog(raw: Catalog, numbered_rows: DataFrame | None = None) -> Catalog:
    """The retail source tables as views over the given tables.

    ``numbered_rows`` are those of ``numbered_lines``, where they were written already.
    """
    lines: dict[str, DataFrame] = {} if numbered_rows is None else {"n": numbered_rows}

    def numbered() -> DataFrame:
        if "n" not in lines:
            lines["n"] = numbered_lines(raw.lineitem)
        return lines["n"]

    def variants() -> DataFrame:
        return raw.part.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))

    def orders_with_discount() -> DataFrame:
        discount = raw.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.sum(F.expr(LINE_DISCOUNT)).alias("descuento"))
        return raw.orders.join(discount, "o_orderkey", "left")

    def lines_with_orders() -> DataFrame:
        orders = raw.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
        return numbered().join(orders, "l_orderkey")

    def stock_levels() -> DataFrame:
        quantity = F.col("l_quantity").cast("bigint")
        return (
            raw.lineitem
            .groupBy(F.col("l_suppkey").alias("almacen_id"), F.expr(VARIANT).alias("variante_id"))
            .agg(F.sum(quantity).alias("cantidad_fisica"),
                 F.sum(F.when(F.col("l_linenumber").isin(3, 4, 6), quantity).otherwise(0))
                 .alias("cantidad_reservada"))
            .selectExpr(*NIVELES_STOCK)
        )

    def carts() -> DataFrame:
        return (
            raw.events
            .groupBy(F.expr(f"user_id * 100000 + {SPARK_DAY}").alias("carrito_id"),
                     F.col("user_id").alias("cliente_id"))
            .agg(F.when(F.bool_or(F.col("event_type") == "purchase"), "convertido")
                 .otherwise("abandonado").alias("estado"),
                 F.min("ts").alias("creado_en"))
        )

    return Catalog({
        "clientes": lambda: raw.customer.selectExpr(*CLIENTES),
        "direcciones_cliente": lambda: (
            raw.customer.filter("c_custkey % 4 <> 3")
            .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
            .filter("k = 0 OR c_custkey % 4 > 0")
            .join(raw.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(raw.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(*DIRECCIONES)),
        "marcas": lambda: raw.part.selectExpr(*MARCAS).distinct(),
        "categorias": lambda: raw.part.selectExpr(*CATEGORIAS).distinct(),
        "productos": lambda: raw.part.selectExpr(*PRODUCTOS),
        "variantes_producto": lambda: variants().selectExpr(*VARIANTES),
        "precios_producto": lambda: (
            variants().withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
            .filter("n < p_size % 4").selectExpr(*PRECIOS)),
        "promociones": lambda: raw.part.selectExpr(*PROMOCIONES).distinct(),
        "almacenes": lambda: (
            raw.supplier.join(raw.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .selectExpr(*ALMACENES)),
        "niveles_stock": stock_levels,
        "pedidos": lambda: orders_with_discount().selectExpr(*PEDIDOS),
        "detalle_pedidos": lambda: numbered().selectExpr(*DETALLE_PEDIDOS),
        "pagos": lambda: (
            raw.orders.withColumn(
                "k", F.explode(F.sequence(F.lit(0), (F.col("o_orderkey") % 3).cast("int"))))
            .selectExpr(*PAGOS)),
        "movimientos_inventario": lambda: numbered().selectExpr(*MOVIMIENTOS),
        "envios": lambda: lines_with_orders().selectExpr(*ENVIOS),
        "devoluciones": lambda: (
            numbered().filter("l_returnflag = 'R'").selectExpr(*DEVOLUCIONES)),
        "detalle_devoluciones": lambda: (
            numbered().filter("l_returnflag = 'R'")
            .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
            .selectExpr(*DETALLE_DEVOLUCIONES)),
        "carritos": carts,
        "detalle_carritos": lambda: raw.events.selectExpr(
            "event_id AS detalle_carrito_id",
            f"user_id * 100000 + {SPARK_DAY} AS carrito_id",
            "1 + event_id % 3 AS cantidad",
            "CAST(value AS DECIMAL(12,2)) AS precio_unitario"),
        "ordenes_compra": lambda: numbered().selectExpr(*ORDENES_COMPRA),
        "eventos_negocio": lambda: stream_events(raw.events),
    })


def _event(kind: str, at: str, number: str, *fields: str) -> list[str]:
    """Envelope columns; ``fields`` are payload members, ``name`` or ``name = expression``."""
    members = []
    for item in fields:
        name, _, value = item.partition(" = ")
        members.append(f"'{name}', {value or name}")
    return [
        f"{number} AS evento_negocio_id",
        f"{kind} AS tipo_evento",
        f"to_json(named_struct({', '.join(members)})) AS payload",
        f"{at} AS ocurrido_en",
    ]


def event_log(oltp: Catalog) -> Catalog:
    """The events that lead to the source tables, one catalog entry per kind.

    Numbers are unique over all entries.
    """
    movement = "tipo_movimiento"
    stock_kind = (f"CASE WHEN {movement} IN ('ingreso', 'reposicion') THEN 'stock_repuesto' "
                  f"WHEN {movement} = 'reserva' THEN 'stock_reservado' ELSE 'stock_vendido' END")
    return Catalog({
        "orders": lambda: oltp.pedidos.selectExpr(
            *_event("'pedido_creado'", "creado_en", "pedido_id * 8", "pedido_id")),
        "payments": lambda: oltp.pagos.selectExpr(
            *_event("CASE estado WHEN 'capturado' THEN 'pago_capturado' ELSE 'pago_fallido' END",
                    "creado_en", "pago_id * 8 + 1", "pago_id", "pedido_id")),
        "stock": lambda: oltp.movimientos_inventario.filter(
            F.col(movement).isin("ingreso", "reposicion", "reserva", "venta")).selectExpr(
            *_event(stock_kind, "fecha_movimiento", "movimiento_inventario_id * 8 + 2",
                    "movimiento_id = movimiento_inventario_id")),
        "shipments": lambda: oltp.envios.filter("estado_envio <> 'en_camino'").selectExpr(
            *_event("CASE estado_envio WHEN 'devuelto' THEN 'envio_devuelto' "
                    "ELSE 'envio_entregado' END", "entregado_en", "envio_id * 8 + 3",
                    "envio_id", "pedido_id")),
        "returns": lambda: oltp.devoluciones.selectExpr(
            *_event("'devolucion_creada'", "creado_en", "devolucion_id * 8 + 4",
                    "devolucion_id", "pedido_id")),
        "carts": lambda: oltp.carritos.selectExpr(
            *_event("'carrito_' || estado", "creado_en", "carrito_id * 8 + 5", "carrito_id")),
    })

"""The queries again, as SQL for an independent engine (DuckDB).

Only the column renames of ``sources.retail`` are shared with the Spark side;
joins, aggregates, windows and merges are written here on their own, in the
plain way: sequential windows, full sorts, correlated rules.
"""

from __future__ import annotations

import re

from mercantil.functions import constants as C
from mercantil.sources import retail as R

LOAD = "TIMESTAMP '1995-01-01 00:00:00'"
NOW = "TIMESTAMP '2001-06-01 00:00:00'"
SEEN = "TIMESTAMP '2024-02-01 00:00:00'"
K = "CAST(json_extract_string(props, '$.k') AS INT)"
DAY = "date_diff('day', DATE '1970-01-01', CAST(ts AS DATE))"
STAMP = "%Y-%m-%d %H:%M:%S.%f"


def cols(items: list[str]) -> str:
    return ", ".join(items)


def text(expr: str, alias: str) -> str:
    return f"strftime({expr}, '{STAMP}') AS {alias}"


def sk(*parts: str) -> str:
    joined = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    u = f"CAST(CAST('0x' || substr(md5({joined}), 1, 16) AS UBIGINT) AS HUGEINT)"
    return (f"CAST(CASE WHEN {u} >= 9223372036854775808 THEN {u} - 18446744073709551616 "
            f"ELSE {u} END AS BIGINT)")


def fecha_sk(expr: str, start: str = "1995-01-01", end: str = "2030-12-31") -> str:
    return (f"CASE WHEN CAST({expr} AS DATE) BETWEEN DATE '{start}' AND DATE '{end}' "
            f"THEN date_diff('day', DATE '{start}', CAST({expr} AS DATE)) + 1 END")


def position(values: list[str], expr: str) -> str:
    whens = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(values, start=1))
    return f"CAST(CASE {expr} {whens} END AS BIGINT)"


STATES = [s for s, _, _ in C.ORDER_STATES]
METHODS = [m for m, _ in C.PAYMENT_METHODS]


def fulfillment(expr: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.FULFILLMENT_BY_STATE.items())
    return f"CASE {expr} {whens} END"


def one_of(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


NUMBERED = ("SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
            f"ORDER BY {cols(R.LINE_ORDER)}) - 1 AS l_copy FROM lineitem")

CTES: dict[str, str] = {
    "dim_fecha": "SELECT date_diff('day', DATE '1995-01-01', CAST(d AS DATE)) + 1 AS fecha_sk, "
        "CAST(d AS DATE) AS fecha, year(d) AS anio, month(d) AS mes, dayname(d) AS dia_nombre, "
        "monthname(d) AS mes_nombre, dayofweek(d) IN (0, 6) AS es_fin_semana "
        "FROM generate_series(DATE '1995-01-01', DATE '2030-12-31', INTERVAL 1 DAY) t(d)",
    "descuentos": f"SELECT l_orderkey, SUM({R.LINE_DISCOUNT}) AS descuento, COUNT(*) AS lineas "
        "FROM lineitem GROUP BY 1",
    # source tables
    "clientes": f"SELECT {cols(R.CLIENTES)} FROM customer",
    "direcciones": f"SELECT {cols(R.DIRECCIONES)} FROM customer "
        "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
        "JOIN (VALUES (0), (1)) v(k) ON c_custkey % 4 <> 3 AND (k = 0 OR c_custkey % 4 > 0)",
    "marcas": f"SELECT DISTINCT {cols(R.MARCAS)} FROM part",
    "categorias": f"SELECT DISTINCT {cols(R.CATEGORIAS)} FROM part",
    "productos": f"SELECT {cols(R.PRODUCTOS)} FROM part",
    "variantes": f"SELECT {cols(R.VARIANTES)} FROM part, (VALUES (0), (1)) v(k)",
    "precios": f"SELECT {cols(R.PRECIOS)} FROM part, (VALUES (0), (1)) v(k), (VALUES (0), (1)) w(n) "
        "WHERE n < p_size % 4",
    "promociones": f"SELECT DISTINCT {cols(R.PROMOCIONES)} FROM part",
    "almacenes": f"SELECT {cols(R.ALMACENES)} FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "niveles": "SELECT " + cols(R.NIVELES_STOCK) + f""" FROM (
        SELECT l_suppkey AS almacen_id, {R.VARIANT} AS variante_id,
          CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS cantidad_fisica,
          CAST(SUM(CASE WHEN l_linenumber IN (3, 4, 6) THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
            AS BIGINT) AS cantidad_reservada
        FROM lineitem GROUP BY 1, 2)""",
    "pedidos": f"SELECT {cols(R.PEDIDOS)} FROM orders LEFT JOIN descuentos ON l_orderkey = o_orderkey",
    "lineas": NUMBERED,
    "detalle": f"SELECT {cols(R.DETALLE_PEDIDOS)} FROM lineas",
    "pagos": f"SELECT {cols(R.PAGOS)} FROM orders JOIN (VALUES (0), (1), (2)) v(k) "
        "ON k <= o_orderkey % 3",
    "movimientos": f"SELECT {cols(R.MOVIMIENTOS)} FROM lineas",
    "envios": f"SELECT {cols(R.ENVIOS)} FROM lineas JOIN orders ON l_orderkey = o_orderkey",
    "devoluciones": f"SELECT {cols(R.DEVOLUCIONES)} FROM lineas WHERE l_returnflag = 'R'",
    "detalle_dev": f"SELECT {cols(R.DETALLE_DEVOLUCIONES)} FROM lineas, (VALUES (0), (1)) v(k) "
        "WHERE l_returnflag = 'R'",
    "carritos": f"SELECT user_id * 100000 + {DAY} AS carrito_id, user_id AS cliente_id, "
        "CASE WHEN bool_or(event_type = 'purchase') THEN 'convertido' ELSE 'abandonado' END AS estado, "
        "MIN(ts) AS creado_en FROM events GROUP BY 1, 2",
    "detalle_car": f"SELECT event_id AS detalle_carrito_id, user_id * 100000 + {DAY} AS carrito_id, "
        "1 + event_id % 3 AS cantidad, CAST(value AS DECIMAL(12,2)) AS precio_unitario FROM events",
    "precios_altos": """SELECT carrito_id, cantidad, CAST(precio_unitario * CASE
          WHEN detalle_carrito_id % 103 = 0 THEN 1000000000 WHEN detalle_carrito_id % 101 = 0 THEN 10000000
          ELSE 1 END AS DECIMAL(30,2)) AS precio FROM detalle_car""",
    "compras": f"SELECT {cols(R.ORDENES_COMPRA)} FROM lineas",
    # events
    "eventos": f"SELECT {cols(R.stream_columns(K, DAY))} FROM events",
    "leidos": """SELECT *, CASE WHEN payload = '{bad' THEN payload END AS documento_malo,
          CASE WHEN payload IS NULL OR payload = '{bad' THEN NULL
               ELSE CAST(json_extract_string(payload, '$.pedido_id') AS BIGINT) END AS pedido_id,
          CASE WHEN payload IS NULL OR payload = '{bad' THEN NULL
               ELSE json_extract_string(payload, '$.estado_nuevo') END AS estado_nuevo,
          CASE WHEN payload IS NULL OR payload = '{bad' THEN NULL
               ELSE CAST(json_extract_string(payload, '$.pago_id') AS BIGINT) END AS pago_id,
          CASE WHEN payload IS NULL OR payload = '{bad' THEN NULL
               ELSE CAST(json_extract_string(payload, '$.carrito_id') AS BIGINT) END AS carrito_id,
          CASE WHEN tipo_evento = 'pedido_creado' THEN 'order_created'
               WHEN tipo_evento = 'pedido_actualizado' THEN 'order_updated'
               WHEN tipo_evento = 'pedido_cancelado' THEN 'order_cancelled'
               WHEN tipo_evento LIKE 'pago_%' THEN 'payment'
               WHEN tipo_evento LIKE 'carrito_%' THEN 'cart' END AS cargador
        FROM eventos""",
    "buenos": "SELECT * FROM leidos WHERE cargador IS NOT NULL AND documento_malo IS NULL",
    "fallos": f"""SELECT *, CASE WHEN evento_negocio_id % 2 = 0 THEN 3 ELSE 1 END AS intentos_olap,
          substr('payload ilegible: ' || documento_malo, 1, {C.ERROR_LENGTH}) AS error_olap
        FROM leidos WHERE cargador IS NOT NULL AND documento_malo IS NOT NULL""",
    "cartas": f"""SELECT evento_negocio_id AS evento_id, tipo_evento,
          coalesce(payload, '{{}}') AS payload, 'sin_handler' AS motivo,
          CAST(NULL AS VARCHAR) AS error_detalle, {text(SEEN, 'creado_en')}
        FROM leidos WHERE cargador IS NULL
        UNION ALL
        SELECT evento_negocio_id, tipo_evento, payload, 'error_max_reintentos', error_olap,
          {text(SEEN, 'creado_en')} FROM fallos WHERE intentos_olap >= 3""",
    # dimensions of the first load
    "sk_cliente": "SELECT cliente_id, " + sk("cliente_id", "788918400000000")
        + " AS cliente_sk FROM clientes",
    "sk_producto": "SELECT producto_id, " + sk("producto_id", "788918400000000")
        + " AS producto_sk FROM productos",
    "sk_variante": "SELECT variante_id, producto_id, " + sk("variante_id", "788918400000000")
        + " AS variante_sk FROM variantes",
    "sk_almacen": "SELECT almacen_id, " + sk("almacen_id") + " AS almacen_sk FROM almacenes",
    "foto_cliente": """SELECT c.cliente_id, correo, nombre || ' ' || apellido AS nombre_completo,
          segmento, estado, coalesce(codigo_pais, 'CL') AS codigo_pais,
          coalesce(ciudad, 'Santiago') AS ciudad, coalesce(provincia, 'Metropolitana') AS region
        FROM clientes c LEFT JOIN (SELECT * FROM direcciones WHERE es_predeterminada) d
          ON d.cliente_id = c.cliente_id""",
    "foto_producto": """SELECT producto_id, marca_id, p.nombre AS nombre_producto,
          m.nombre AS nombre_marca, c.nombre AS nombre_categoria,
          coalesce(cp.nombre, c.nombre) AS categoria_padre, estado_producto
        FROM productos p JOIN marcas m USING (marca_id)
          JOIN categorias c ON c.categoria_id = p.categoria_id
          LEFT JOIN categorias cp ON cp.categoria_id = c.categoria_padre_id""",
    "ultimo_precio": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
          PARTITION BY variante_id ORDER BY vigente_desde DESC NULLS LAST, precio_id DESC) AS rn
        FROM precios) WHERE rn = 1""",
    "foto_variante": """SELECT v.variante_id, producto_sk, sku, color, talla,
          coalesce(precio_lista, CAST(0 AS DECIMAL(12,2))) AS precio_lista_actual, precio_costo, activa
        FROM variantes v LEFT JOIN ultimo_precio USING (variante_id)
          LEFT JOIN sk_producto USING (producto_id)""",
    "versiones": """SELECT *, lead(cambiado_en) OVER w AS hasta FROM (
          SELECT o_custkey AS cliente_id, o_orderpriority AS segmento, o_orderdate AS cambiado_en,
            o_orderkey AS cambio_id, lag(o_orderpriority) OVER (PARTITION BY o_custkey
              ORDER BY o_orderdate, o_orderkey) AS antes
          FROM orders) WHERE antes IS NULL OR antes <> segmento
        WINDOW w AS (PARTITION BY cliente_id ORDER BY cambiado_en, cambio_id)""",
    # star schema over the given tables
    "s_pedidos": f"""SELECT o_orderkey AS pedido_id, o_custkey AS cliente_sk,
          CAST(o_orderdate AS DATE) AS fecha, {R.CHANNEL} AS canal, {R.TOTAL} AS total_final,
          coalesce(CAST(descuento AS DECIMAL(12,2)), 0) AS descuento_total,
          coalesce(lineas, 0) AS num_items, {R.PAYMENT_STATE} AS estado_pago
        FROM orders LEFT JOIN descuentos ON l_orderkey = o_orderkey""",
    "s_pagados": "SELECT * FROM s_pedidos WHERE estado_pago = 'pagado'",
    "s_carritos": """SELECT user_id, CAST(ts AS DATE) AS fecha,
          bool_or(event_type = 'purchase') AS convertido FROM events GROUP BY 1, 2""",
    "s_envios": f"""SELECT {R.CARRIER} AS transportista, l_suppkey AS almacen_id,
          greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)), 0)
            AS dias_entrega,
          CASE WHEN l_returnflag = 'R' THEN 'devuelto' ELSE 'entregado' END AS estado_envio
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "s_devoluciones": f"""SELECT l_orderkey AS pedido_id, l_partkey, {R.REASON} AS motivo,
          {R.QUANTITY} AS cantidad FROM lineitem WHERE l_returnflag = 'R'""",
    "s_pagos": f"""SELECT {R.METHOD} AS metodo_pago, {R.TOTAL} AS monto FROM orders
        WHERE o_orderstatus = 'F'""",
    # facts
    "f_creados": f"""SELECT p.pedido_id, numero_pedido, cliente_sk,
          {fecha_sk('creado_en')} AS fecha_sk, {position(C.CHANNELS, 'canal_venta')} AS canal_sk,
          {position(STATES, 'estado_actual')} AS estado_pedido_sk,
          subtotal, descuento_total, impuesto_total, costo_envio, total_final,
          coalesce(n, 0) AS num_items, estado_pago, estado_fulfillment, creado_en
        FROM pedidos p LEFT JOIN sk_cliente USING (cliente_id)
          LEFT JOIN (SELECT pedido_id, COUNT(*) AS n FROM detalle GROUP BY 1) USING (pedido_id)""",
    "por_flujo": """SELECT * FROM f_creados WHERE pedido_id IN
        (SELECT pedido_id FROM buenos WHERE tipo_evento = 'pedido_creado')""",
    "aportes": f"""SELECT pedido_id, ocurrido_en, evento_negocio_id,
          {position(STATES, 'estado_nuevo')} AS estado_pedido_sk,
          {fulfillment('estado_nuevo')} AS estado_fulfillment,
          CAST(NULL AS VARCHAR) AS estado_pago, 'a' AS clase
        FROM buenos WHERE tipo_evento = 'pedido_actualizado' AND estado_nuevo IS NOT NULL
        UNION ALL
        SELECT pedido_id, ocurrido_en, evento_negocio_id, 8, 'pendiente', 'reembolsado', 'c'
        FROM buenos WHERE tipo_evento = 'pedido_cancelado'
        UNION ALL
        SELECT p.pedido_id, ocurrido_en, evento_negocio_id, NULL, NULL, 'pagado', 'p'
        FROM buenos JOIN pagos p USING (pago_id) WHERE tipo_evento = 'pago_capturado'""",
}


def fold(kinds: str) -> str:
    """Folded orders of the stream, one window per column."""
    def last(column: str) -> str:
        return (f"(SELECT {column} FROM aportes a WHERE a.pedido_id = f.pedido_id AND clase IN "
                f"({kinds}) AND {column} IS NOT NULL "
                "ORDER BY ocurrido_en DESC, evento_negocio_id DESC LIMIT 1)")
    return f"""SELECT pedido_id, numero_pedido, num_items, total_final,
        coalesce({last('estado_pedido_sk')}, estado_pedido_sk) AS estado_pedido_sk,
        coalesce({last('estado_fulfillment')}, estado_fulfillment) AS estado_fulfillment,
        coalesce({last('estado_pago')}, estado_pago) AS estado_pago FROM por_flujo f"""


def folded(kinds: str) -> str:
    return f"""SELECT pedido_id, estado_pedido_sk, estado_fulfillment, estado_pago,
        CAST(total_final AS DOUBLE) AS total_final FROM ({fold(kinds)})"""


def dim_history(snapshot: str, id_: str, key: str, columns: list[str], moved: str,
                now: dict[str, str]) -> str:
    """First load closed where ``moved`` holds, plus the version opened then."""
    start, later = LOAD, NOW
    def row(since, until, current, changes, micros):
        values = [f"{changes.get(c, c)} AS {c}" for c in columns]
        return (f"SELECT {sk(id_, micros)} AS {key}, {id_}, {cols(values)}, "
                f"{text(since, 'valido_desde')}, {until} AS valido_hasta, "
                f"{current} AS es_actual FROM {snapshot}")
    first = row(start, f"CASE WHEN {moved} THEN strftime({later}, '{STAMP}') END",
                f"NOT coalesce({moved}, false)", {}, "788918400000000")
    second = row(later, "CAST(NULL AS VARCHAR)", "true", now, "991353600000000")
    return f"{first} UNION ALL {second} WHERE {moved}"


def money(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def big(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


def counted(source: str) -> str:
    return f"""SELECT almacen_id, variante_id, tipo_movimiento, tipo_referencia, referencia_id,
        CAST(SUM(cantidad) AS BIGINT) AS cantidad, COUNT(*) AS filas FROM ({source})
        GROUP BY 1, 2, 3, 4, 5"""


ASSIGNED = """SELECT d.detalle_pedido_id, d.pedido_id, d.variante_id,
        CAST(d.cantidad * 2 AS BIGINT) AS cantidad,
        (SELECT n.almacen_id FROM niveles n WHERE n.variante_id = d.variante_id
           AND n.cantidad_disponible >= d.cantidad * 2
         ORDER BY n.cantidad_disponible DESC, n.almacen_id LIMIT 1) AS almacen_id FROM detalle d"""

DUE = f"estado_actual <> 'confirmado' AND actualizado_en <= {NOW} - INTERVAL 30 SECONDS"

VARIANT_JOIN = ("LEFT JOIN sk_variante v USING (variante_id) "
                "LEFT JOIN sk_producto sp ON sp.producto_id = v.producto_id")

SQL: dict[str, str] = {
    "daily_sales": """SELECT strftime(d.fecha, '%Y-%m-%d') AS fecha, dia_nombre, es_fin_semana,
          COUNT(DISTINCT pedido_id) AS total_pedidos,
          CAST(SUM(total_final) AS DOUBLE) AS ventas_netas,
          ROUND(AVG(total_final), 6) AS ticket_promedio,
          CAST(SUM(descuento_total) AS DOUBLE) AS descuentos_otorgados
        FROM s_pagados p JOIN dim_fecha d ON d.fecha = p.fecha GROUP BY 1, 2, 3""",
    "top_products": f"""SELECT p_name AS nombre_producto, p_brand AS nombre_marca,
          p_type AS nombre_categoria, CAST(SUM({R.QUANTITY}) AS BIGINT) AS unidades_vendidas,
          CAST(SUM({R.LINE_TOTAL}) AS DOUBLE) AS ingresos_totales,
          ROUND(AVG({R.PRICE}), 6) AS precio_promedio,
          COUNT(DISTINCT l_orderkey) AS pedidos_distintos
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3
        ORDER BY 5 DESC, 1, 2, 3 LIMIT 10""",
    "cart_conversion": """SELECT CAST(anio AS BIGINT) AS anio, CAST(mes AS BIGINT) AS mes, mes_nombre,
          COUNT(*) AS total_carritos, COUNT(*) FILTER (WHERE convertido) AS convertidos,
          COUNT(*) FILTER (WHERE NOT convertido) AS abandonados,
          ROUND(100.0 * COUNT(*) FILTER (WHERE convertido) / COUNT(*), 2) AS tasa_conversion_pct
        FROM s_carritos c JOIN dim_fecha d ON d.fecha = c.fecha GROUP BY 1, 2, 3""",
    "carrier_performance": """SELECT transportista, COUNT(*) AS total_envios,
          ROUND(AVG(dias_entrega), 1) AS promedio_dias_entrega,
          CAST(MIN(dias_entrega) AS BIGINT) AS minimo_dias,
          CAST(MAX(dias_entrega) AS BIGINT) AS maximo_dias,
          COUNT(*) FILTER (WHERE estado_envio = 'entregado') AS entregas_exitosas,
          COUNT(*) FILTER (WHERE estado_envio = 'devuelto') AS devoluciones,
          ROUND(100.0 * COUNT(*) FILTER (WHERE estado_envio = 'entregado') / COUNT(*), 1)
            AS tasa_exito_pct, ciudad AS ciudad_almacen
        FROM s_envios JOIN almacenes USING (almacen_id) GROUP BY transportista, ciudad""",
    "returns_by_reason": """SELECT motivo, p_type AS nombre_categoria, COUNT(*) AS total_devoluciones,
          CAST(SUM(cantidad) AS BIGINT) AS unidades_devueltas,
          COUNT(DISTINCT pedido_id) AS pedidos_afectados
        FROM s_devoluciones JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "ticket_by_channel": """SELECT canal, COUNT(DISTINCT pedido_id) AS total_pedidos,
          CAST(SUM(total_final) AS DOUBLE) AS ventas_totales,
          ROUND(AVG(total_final), 0) AS ticket_promedio_clp,
          ROUND(AVG(num_items), 1) AS items_promedio_por_pedido,
          ROUND(AVG(descuento_total), 0) AS descuento_promedio_clp
        FROM s_pagados GROUP BY 1""",
    "payment_methods": """SELECT metodo_pago,
          CASE WHEN metodo_pago LIKE 'tarjeta%' THEN 'tarjeta'
               WHEN metodo_pago = 'transferencia' THEN 'bancario' ELSE 'digital' END AS categoria,
          COUNT(*) AS total_transacciones, CAST(SUM(monto) AS DOUBLE) AS monto_total_clp,
          ROUND(AVG(monto), 0) AS monto_promedio_clp,
          ROUND(100.0 * COUNT(*) / (SELECT COUNT(*) FROM s_pagos), 1) AS porcentaje_uso
        FROM s_pagos GROUP BY 1, 2""",
    "customer_segments": """SELECT c_mktsegment AS segmento, COUNT(DISTINCT c_custkey) AS total_clientes,
          COUNT(DISTINCT pedido_id) AS total_pedidos,
          CAST(SUM(total_final) AS DOUBLE) AS ventas_totales,
          ROUND(AVG(total_final), 0) AS ticket_promedio,
          ROUND(CAST(SUM(total_final) AS DOUBLE) / COUNT(DISTINCT c_custkey), 0) AS ltv_promedio_clp
        FROM customer JOIN s_pagados ON cliente_sk = c_custkey GROUP BY 1""",
    "inventory_rotation": f"""SELECT nombre AS almacen, ciudad, mes_nombre,
          CAST(anio AS BIGINT) AS anio,
          CAST(coalesce(SUM(n) FILTER (tipo = 'ingreso' OR tipo = 'reposicion'), 0) AS BIGINT)
            AS entradas,
          CAST(coalesce(SUM(abs(n)) FILTER (tipo = 'venta' OR tipo = 'reserva'), 0) AS BIGINT)
            AS salidas,
          CAST(coalesce(SUM(n) FILTER (tipo = 'devolucion'), 0) AS BIGINT) AS devoluciones_stock
        FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS dia, {R.MOVEMENT} AS tipo,
                CASE WHEN l_linenumber = 3 THEN -{R.QUANTITY} ELSE {R.QUANTITY} END AS n
              FROM lineitem)
          JOIN almacenes ON almacen_id = l_suppkey JOIN dim_fecha ON fecha = dia
        GROUP BY ALL""",
    "cohort_retention": """SELECT strftime(primera, '%Y-%m') AS mes_cohort, COUNT(*) AS clientes_nuevos,
          ROUND(AVG(n), 1) AS promedio_pedidos, ROUND(AVG(valor), 0) AS ltv_promedio_clp,
          CAST(SUM(CAST(n > 1 AS INT)) AS BIGINT) AS clientes_recurrentes,
          ROUND(100.0 * SUM(CAST(n > 1 AS INT)) / COUNT(*), 1) AS tasa_recurrencia_pct
        FROM (SELECT MIN(fecha) AS primera, COUNT(DISTINCT pedido_id) AS n,
                SUM(total_final) AS valor FROM s_pagados GROUP BY cliente_sk)
        GROUP BY 1""",
    "view_geo_sales": """SELECT strftime(fecha, '%Y-%m-%d') AS fecha, r_name AS region,
          CAST(SUM(total_final) AS DOUBLE) AS total_ventas, COUNT(*) AS total_pedidos
        FROM s_pedidos JOIN customer ON c_custkey = cliente_sk
          JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2""",
    "view_current_customers": f"""SELECT cliente_id, segmento, {text('cambiado_en', 'fecha_inicio')},
          CAST(NULL AS VARCHAR) AS fecha_fin FROM versiones WHERE hasta IS NULL""",
    "view_carrier_summary": """SELECT transportista, COUNT(*) AS total_envios,
          ROUND(AVG(dias_entrega), 4) AS promedio_entrega FROM s_envios GROUP BY 1""",
    "view_returns_summary": "SELECT motivo, COUNT(*) AS total_devoluciones FROM s_devoluciones GROUP BY 1",
    "view_critical_stock": """SELECT producto_id, variante_id, almacen_id,
          cantidad_disponible AS stock_actual, punto_reorden AS stock_minimo
        FROM niveles JOIN variantes USING (variante_id)
        WHERE cantidad_disponible < punto_reorden""",
    "view_dlq_monitor": "SELECT * FROM cartas",
    "view_dlq_by_reason": "SELECT tipo_evento, motivo, COUNT(*) AS eventos FROM cartas GROUP BY 1, 2",
    "kpi_sales": """SELECT CAST(SUM(total_final) AS DOUBLE) AS ventas_netas,
          ROUND(CAST(SUM(total_final) AS DOUBLE) / COUNT(DISTINCT pedido_id), 0) AS ticket_promedio,
          ROUND(1.0 * COUNT(DISTINCT pedido_id) / COUNT(DISTINCT fecha), 2) AS pedidos_por_dia
        FROM s_pagados""",
    "kpi_carts": """SELECT COUNT(*) AS total_carritos,
          ROUND(100.0 * COUNT(*) FILTER (WHERE convertido) / COUNT(*), 2) AS tasa_conversion_pct,
          ROUND(100.0 * COUNT(*) FILTER (WHERE NOT convertido) / COUNT(*), 2) AS tasa_abandono_pct
        FROM s_carritos""",
    "kpi_payments": """SELECT CAST(SUM(monto) AS DOUBLE) AS monto_capturado,
          ROUND(AVG(monto), 0) AS monto_promedio, COUNT(*) AS transacciones FROM s_pagos""",
    "kpi_retention": """SELECT ROUND(100.0 * COUNT(*) FILTER (WHERE n > 1) / COUNT(*), 2)
            AS tasa_recurrencia_pct, ROUND(AVG(valor), 0) AS ltv_promedio
        FROM (SELECT COUNT(DISTINCT pedido_id) AS n, SUM(total_final) AS valor
              FROM s_pagados GROUP BY cliente_sk)""",
    # dimensions
    "dim_date": """SELECT row_number() OVER (ORDER BY d) AS fecha_sk,
          strftime(d, '%Y-%m-%d') AS fecha, year(d) AS anio, quarter(d) AS trimestre,
          month(d) AS mes, weekofyear(d) AS semana, day(d) AS dia_mes, dayofweek(d) AS dia_semana,
          dayname(d) AS dia_nombre, monthname(d) AS mes_nombre,
          dayofweek(d) IN (0, 6) AS es_fin_semana, false AS es_feriado
        FROM (SELECT unnest(generate_series(CAST(MIN(o_orderdate) AS DATE),
                CAST(MAX(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d FROM orders)""",
    "scd2_close": f"""SELECT {sk('c_custkey', '788918400000000')} AS cliente_sk,
          c_custkey AS cliente_id, {text(LOAD, 'valido_desde')},
          CASE WHEN cerrar THEN strftime({NOW}, '{STAMP}') END AS valido_hasta,
          NOT cerrar AS es_actual
        FROM (SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                AND o_orderstatus = 'P') AS cerrar FROM customer)""",
    "scd2_history": f"""SELECT {sk('cliente_id', 'epoch_us(cambiado_en)', 'cambio_id')} AS cliente_sk,
          cliente_id, segmento, {text('cambiado_en', 'valido_desde')},
          {text('hasta', 'valido_hasta')}, hasta IS NULL AS es_actual FROM versiones""",
    "dim_customer_scd2": dim_history(
        "foto_cliente", "cliente_id", "cliente_sk",
        ["correo", "nombre_completo", "segmento", "estado", "codigo_pais", "ciudad", "region"],
        "estado = 'bloqueado'",
        {"estado": "'inactivo'",
         "correo": "CASE WHEN cliente_id % 2 = 0 THEN 'nuevo@example.com' ELSE correo END"}),
    "dim_product_scd2": dim_history(
        "foto_producto", "producto_id", "producto_sk",
        ["nombre_producto", "nombre_marca", "nombre_categoria", "categoria_padre",
         "estado_producto"], "marca_id = 3", {"nombre_producto": "nombre_producto || ' II'"}),
    "dim_variant_scd2": "SELECT * REPLACE (" + money("precio_lista_actual", "precio_costo")
        + ") FROM (" + dim_history(
        "foto_variante", "variante_id", "variante_sk",
        ["producto_sk", "sku", "color", "talla", "precio_lista_actual", "precio_costo", "activa"],
        "(activa AND variante_id % 2 = 0)", {"activa": "false"}) + ")",
    "latest_price": f"""SELECT variante_id, precio_id, CAST(precio_lista AS DOUBLE) AS precio_lista,
          {text('vigente_desde', 'vigente_desde')} FROM ultimo_precio""",
    "dim_warehouse": f"""SELECT {sk('almacen_id')} AS almacen_sk, almacen_id, codigo,
          CASE WHEN almacen_id % 2 = 0 THEN 'Antiguo ' || nombre ELSE nombre END AS nombre,
          ciudad, codigo_pais FROM almacenes""",
    "dim_seeds": "SELECT dimension, clave, valor, coalesce(usos, 0) AS usos FROM (VALUES "
        + ", ".join(f"('{d}', CAST({i} AS BIGINT), '{v}')"
                    for d, values in (("estado", STATES), ("canal", C.CHANNELS), ("metodo", METHODS))
                    for i, v in enumerate(values, start=1))
        + """) v(dimension, clave, valor) LEFT JOIN (
          SELECT 'estado' AS dimension, estado_actual AS valor, COUNT(*) AS usos FROM pedidos GROUP BY 2
          UNION ALL SELECT 'canal', canal_venta, COUNT(*) FROM pedidos GROUP BY 2
          UNION ALL SELECT 'metodo', metodo_pago, COUNT(*) FROM pagos GROUP BY 2
        ) USING (dimension, valor)""",
    "dim_promotion": f"""SELECT {sk('promocion_id')} AS promocion_sk, promocion_id, nombre, tipo
        FROM promociones""",
    "date_key": f"""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS texto,
          {fecha_sk('ts', '2020-01-01', '2024-01-15')} AS fecha_sk FROM events""",
    # facts
    "load_fact_orders": f"""SELECT pedido_id, numero_pedido, cliente_sk, fecha_sk, canal_sk,
          estado_pedido_sk, CAST(NULL AS BIGINT) AS promocion_sk,
          {money('subtotal', 'descuento_total', 'impuesto_total', 'costo_envio', 'total_final')},
          num_items, estado_pago, estado_fulfillment, {text('creado_en', 'creado_en')}
        FROM f_creados""",
    "load_fact_order_lines": f"""SELECT detalle_pedido_id, d.pedido_id, variante_sk, producto_sk,
          cliente_sk, {fecha_sk('p.creado_en')} AS fecha_sk, {big('cantidad')},
          {money('precio_unitario', 'descuento_linea', 'impuesto_linea', 'total_linea')},
          {text('d.creado_en', 'creado_en')}
        FROM detalle d JOIN pedidos p USING (pedido_id) LEFT JOIN sk_cliente USING (cliente_id)
          {VARIANT_JOIN}""",
    "fold_order_status": folded("'a'"),
    "fold_order_cancel": folded("'c'"),
    "fold_orders": folded("'a', 'c', 'p'"),
    "load_fact_payments": f"""SELECT pago_id, pedido_id, cliente_sk,
          {fecha_sk('g.creado_en')} AS fecha_sk, {position(METHODS, 'metodo_pago')} AS metodo_pago_sk,
          {money('monto')}, estado, proveedor_pago, {text('g.creado_en', 'creado_en')}
        FROM pagos g JOIN pedidos USING (pedido_id) LEFT JOIN sk_cliente USING (cliente_id)""",
    "load_fact_stock": f"""SELECT movimiento_inventario_id AS movimiento_id, almacen_sk, variante_sk,
          {fecha_sk('fecha_movimiento')} AS fecha_sk, tipo_movimiento, {big('cantidad')},
          tipo_referencia, referencia_id, {text('fecha_movimiento', 'fecha_movimiento')}
        FROM movimientos LEFT JOIN sk_almacen USING (almacen_id)
          LEFT JOIN sk_variante USING (variante_id)
        WHERE tipo_movimiento IN ('ingreso', 'reposicion', 'reserva', 'venta')""",
    "load_fact_shipments": f"""SELECT envio_id, pedido_id, almacen_sk,
          {fecha_sk('enviado_en')} AS fecha_envio_sk, {fecha_sk('entregado_en')} AS fecha_entrega_sk,
          estado_envio, transportista, greatest(date_diff('day', CAST(enviado_en AS DATE),
            CAST(entregado_en AS DATE)), 0) AS dias_entrega
        FROM envios LEFT JOIN sk_almacen USING (almacen_id) WHERE estado_envio <> 'en_camino'""",
    "load_shipments_returned": f"""SELECT envio_id, pedido_id, almacen_sk,
          {fecha_sk('enviado_en')} AS fecha_envio_sk, {fecha_sk('entregado_en')} AS fecha_entrega_sk,
          CASE WHEN estado_envio = 'devuelto' THEN 'devuelto' ELSE 'entregado' END AS estado_envio,
          transportista, greatest(date_diff('day', CAST(enviado_en AS DATE),
            CAST(entregado_en AS DATE)), 0) AS dias_entrega
        FROM envios LEFT JOIN sk_almacen USING (almacen_id)
        WHERE entregado_en IS NOT NULL""",
    "load_fact_returns": f"""SELECT v0.devolucion_id, v0.pedido_id, variante_sk, producto_sk,
          cliente_sk, {fecha_sk('v0.creado_en')} AS fecha_sk, motivo, estado,
          CAST(coalesce(cantidad_devuelta, 0) AS BIGINT) AS cantidad_devuelta
        FROM devoluciones v0 LEFT JOIN (SELECT * FROM detalle_dev WHERE detalle_devolucion_id % 2 = 0)
            USING (devolucion_id)
          LEFT JOIN (SELECT pedido_id, cliente_id FROM pedidos) USING (pedido_id)
          LEFT JOIN sk_cliente USING (cliente_id) {VARIANT_JOIN}""",
    "load_fact_carts": f"""SELECT carrito_id, cliente_sk, {fecha_sk('creado_en')} AS fecha_sk, estado,
          COUNT(detalle_carrito_id) AS num_items,
          CAST(SUM(cantidad * precio_unitario) AS DOUBLE) AS valor_total,
          estado = 'convertido' AS convertido
        FROM carritos LEFT JOIN detalle_car USING (carrito_id) LEFT JOIN sk_cliente USING (cliente_id)
        GROUP BY ALL""",
    # pipeline
    "read_events": f"SELECT * REPLACE ({text('ocurrido_en', 'ocurrido_en')}) FROM eventos",
    "parse_payload": """SELECT evento_negocio_id, pedido_id, CAST(NULL AS BIGINT) AS cliente_id,
          CAST(NULL AS VARCHAR) AS estado_anterior, estado_nuevo, pago_id,
          CAST(NULL AS BIGINT) AS movimiento_id, CAST(NULL AS BIGINT) AS envio_id,
          CAST(NULL AS BIGINT) AS devolucion_id, carrito_id, documento_malo FROM leidos""",
    "route_events": f"""SELECT cargador, tipo_evento, COUNT(*) AS eventos,
          {text('MIN(ocurrido_en)', 'primero')}, {text('MAX(ocurrido_en)', 'ultimo')}
        FROM leidos GROUP BY 1, 2""",
    "dlq_unhandled": "SELECT * FROM cartas WHERE motivo = 'sin_handler'",
    "dlq_failed": "SELECT * FROM cartas WHERE motivo = 'error_max_reintentos'",
    "dlq_put": """SELECT * REPLACE (CASE WHEN evento_id % 7 = 0 THEN 'error_max_reintentos'
          ELSE motivo END AS motivo) FROM cartas""",
    "dedup_events": f"""SELECT evento_negocio_id, tipo_evento, payload,
          {text('ocurrido_en', 'ocurrido_en')} FROM eventos""",
    "update_watermarks": "SELECT tabla_fuente, " + text(
        "coalesce(t, TIMESTAMP '2020-01-01 00:00:00')", "ultima_carga") + ", " + text(
        f"CASE WHEN t IS NULL THEN TIMESTAMP '2020-01-01 00:00:00' ELSE {SEEN} END", "actualizado_en")
        + " FROM (VALUES " + ", ".join(f"('{s}')" for s in C.WATERMARK_SOURCES)
        + """) w(tabla_fuente) LEFT JOIN (
          SELECT CASE cargador WHEN 'order_created' THEN 'pedidos' WHEN 'payment' THEN 'pagos' END
            AS tabla_fuente, MAX(ocurrido_en) AS t FROM buenos GROUP BY 1) USING (tabla_fuente)""",
    "backlog_by_state": """SELECT estado_actual, COUNT(*) AS pedidos FROM pedidos
        WHERE estado_actual NOT IN ('entregado', 'cancelado', 'reembolsado') GROUP BY 1""",
    "pipeline_health": f"""SELECT (SELECT COUNT(*) FROM fallos WHERE intentos_olap < 3)
            AS eventos_pendientes,
          (SELECT COUNT(*) FROM cartas) AS dlq_total, (SELECT COUNT(*) FROM por_flujo) AS pedidos,
          (SELECT COUNT(*) FROM envios WHERE estado_envio <> 'en_camino') AS envios,
          n AS carritos, si AS convertidos,
          (SELECT COUNT(*) FROM buenos WHERE cargador = 'payment'
             AND pago_id NOT IN (SELECT pago_id FROM pagos)) AS sin_origen,
          (SELECT {text('MAX(ocurrido_en)', 'm')[:-5]} FROM buenos WHERE cargador = 'order_created')
            AS marca_pedidos,
          ROUND(100.0 * si / n, 1) AS tasa_conversion_pct
        FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE estado = 'convertido') AS si
              FROM carritos WHERE carrito_id IN (SELECT carrito_id FROM buenos))""",
    "stream_orders": "SELECT * REPLACE (" + money("total_final") + ") FROM ("
        + fold("'a', 'c', 'p'") + ")",
    "stream_payments": f"""SELECT pago_id, pedido_id, {fecha_sk('g.creado_en')} AS fecha_sk,
          {position(METHODS, 'metodo_pago')} AS metodo_pago_sk, {money('monto')}, estado, proveedor_pago
        FROM pagos g WHERE pago_id IN (SELECT pago_id FROM buenos WHERE cargador = 'payment')""",
    "stream_shipments": f"""SELECT envio_id, pedido_id, {fecha_sk('enviado_en')} AS fecha_envio_sk,
          {fecha_sk('entregado_en')} AS fecha_entrega_sk,
          CASE WHEN estado_envio = 'devuelto' THEN 'devuelto' ELSE 'entregado' END AS estado_envio,
          transportista, greatest(date_diff('day', CAST(enviado_en AS DATE),
            CAST(entregado_en AS DATE)), 0) AS dias_entrega
        FROM envios WHERE entregado_en IS NOT NULL""",
    "stream_carts": f"""SELECT carrito_id, {fecha_sk('creado_en')} AS fecha_sk, estado,
          COUNT(detalle_carrito_id) AS num_items,
          CAST(SUM(cantidad * precio_unitario) AS DOUBLE) AS valor_total, estado = 'convertido' AS convertido
        FROM carritos LEFT JOIN detalle_car USING (carrito_id)
        WHERE carrito_id IN (SELECT carrito_id FROM buenos WHERE cargador = 'cart') GROUP BY ALL""",
    "stream_stock": f"""SELECT movimiento_inventario_id AS movimiento_id, {fecha_sk('fecha_movimiento')} AS fecha_sk,
          tipo_movimiento, {big('cantidad')}, tipo_referencia, referencia_id
        FROM movimientos WHERE tipo_movimiento IN ('ingreso', 'reposicion', 'reserva', 'venta')""",
    "stream_returns": f"""SELECT v0.devolucion_id, v0.pedido_id, {fecha_sk('v0.creado_en')} AS fecha_sk,
          motivo, estado, CAST(coalesce(cantidad_devuelta, 0) AS BIGINT) AS cantidad_devuelta
        FROM devoluciones v0 LEFT JOIN (SELECT * FROM detalle_dev WHERE detalle_devolucion_id % 2 = 0)
            USING (devolucion_id)""",
    "health_counters": """SELECT (SELECT COUNT(*) FROM buenos) AS procesados,
          (SELECT COUNT(*) FROM leidos WHERE cargador IS NOT NULL AND documento_malo IS NOT NULL) AS errores,
          (SELECT COUNT(*) FROM leidos WHERE cargador IS NULL) AS cartas,
          (SELECT COUNT(*) FROM por_flujo)
            + (SELECT COUNT(*) FROM detalle WHERE pedido_id IN (SELECT pedido_id FROM por_flujo))
            + (SELECT COUNT(*) FROM pagos WHERE pago_id IN (SELECT pago_id FROM buenos WHERE cargador = 'payment'))
            + (SELECT COUNT(*) FROM carritos WHERE carrito_id IN
                (SELECT carrito_id FROM buenos WHERE cargador = 'cart')) AS insertados,
          (SELECT COUNT(*) FROM (SELECT DISTINCT pedido_id FROM aportes))
            + (SELECT COUNT(*) FROM carritos WHERE carrito_id IN
                (SELECT carrito_id FROM buenos WHERE cargador = 'cart')) AS actualizados""",
    "retry_stream": """SELECT evento_negocio_id AS evento_id, tipo_evento,
          CASE WHEN cargador IS NULL THEN 'sin_handler' ELSE 'error_max_reintentos' END AS motivo,
          CASE WHEN cargador IS NOT NULL THEN 'payload ilegible: ' || documento_malo END AS error_detalle
        FROM leidos WHERE cargador IS NULL OR documento_malo IS NOT NULL""",
    "dedup_stream": f"""SELECT evento_negocio_id, tipo_evento, {text('ocurrido_en', 'ocurrido_en')},
          CAST(evento_negocio_id % 5 AS BIGINT) AS lote FROM eventos""",
    "row_errors": """SELECT evento_id, tipo_evento, 'error_max_reintentos' AS motivo, MIN(error) AS error_detalle
        FROM (
          SELECT pedido_id * 8 AS evento_id, 'pedido_creado' AS tipo_evento,
            'pedidos.creado_en: valor fuera de rango o ilegible: sin fecha' AS error
          FROM pedidos WHERE pedido_id % 97 = 0
          UNION ALL SELECT pago_id * 8 + 1,
            CASE estado WHEN 'capturado' THEN 'pago_capturado' ELSE 'pago_fallido' END, 'pagos.pedido_id: falta'
          FROM pagos WHERE pago_id % 89 = 0
          UNION ALL SELECT carrito_id * 8 + 5, 'carrito_' || estado,
            'detalle_carritos.precio_unitario: valor fuera de rango o ilegible: ' || CAST(precio AS VARCHAR)
          FROM precios_altos JOIN carritos USING (carrito_id) WHERE abs(precio) >= 10000000000
          UNION ALL SELECT carrito_id * 8 + 5, 'carrito_' || estado,
            'carritos.valor_total: valor fuera de rango: ' || CAST(total AS VARCHAR)
          FROM (SELECT carrito_id, SUM(cantidad * precio) AS total FROM precios_altos
                WHERE abs(precio) < 10000000000 GROUP BY 1) JOIN carritos USING (carrito_id)
          WHERE abs(total) >= 10000000000)
        GROUP BY 1, 2""",
    # merges
    "merge_insert_only": f"""SELECT {R.LINE_KEY} AS detalle_pedido_id, l_partkey, l_suppkey, l_quantity,
          l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
          {text('l_shipdate', 'l_shipdate')} FROM lineas WHERE l_copy = 0 AND l_orderkey % 2 = 0
        UNION ALL SELECT {R.LINE_KEY}, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM lineas WHERE l_copy = 0 AND l_orderkey % 2 = 1""",
    "merge_upsert": f"""SELECT carrito_id, cliente_sk, fecha_sk,
          CASE WHEN fecha_sk < 10602 THEN 'activo' ELSE estado END AS estado,
          CASE WHEN fecha_sk <= 10607 THEN 0 ELSE n END AS num_items,
          CAST(valor AS DOUBLE) AS valor_total,
          fecha_sk >= 10602 AND estado = 'convertido' AS convertido
        FROM (SELECT carrito_id, cliente_sk, {fecha_sk('creado_en')} AS fecha_sk, estado,
                COUNT(detalle_carrito_id) AS n, SUM(cantidad * precio_unitario) AS valor
              FROM carritos LEFT JOIN detalle_car USING (carrito_id)
                LEFT JOIN sk_cliente USING (cliente_id) GROUP BY ALL)""",
    "merge_update_only": """SELECT pedido_id, cliente_id,
          CASE WHEN pedido_id IN (SELECT pedido_id FROM pagos WHERE estado = 'capturado')
            THEN 'pagado' ELSE estado_pago END AS estado_pago,
          CAST(total_final AS DOUBLE) AS total_final FROM pedidos""",
    # rules
    "price_order_lines": """SELECT detalle_pedido_id,
          CAST(precio_unitario * cantidad AS DOUBLE) AS bruto_linea,
          CAST(precio_unitario * cantidad - descuento_linea AS DOUBLE) AS neto_linea,
          CAST(round_even(CAST(precio_unitario * cantidad - descuento_linea AS DECIMAL(18,2))
            * CAST(0.19 AS DECIMAL(3,2)), 2) AS DOUBLE) AS impuesto_linea,
          CAST(precio_unitario * cantidad - descuento_linea AS DOUBLE) AS total_linea
        FROM detalle""",
    "price_orders": """SELECT pedido_id, CAST(subtotal AS DOUBLE) AS subtotal,
          CAST(descuento AS DOUBLE) AS descuento_total,
          CAST(iva AS DOUBLE) AS impuesto_total, CAST(envio AS DOUBLE) AS costo_envio,
          CAST(subtotal - descuento + iva + envio AS DOUBLE) AS total_final
        FROM (SELECT *, CAST(round_even((subtotal - descuento) * CAST(0.19 AS DECIMAL(3,2)), 2)
                AS DECIMAL(18,2)) AS iva,
                CAST(CASE WHEN subtotal > 50000 THEN 0 ELSE 4990 END AS DECIMAL(12,2)) AS envio
              FROM (SELECT pedido_id,
                      CAST(SUM(precio_unitario * cantidad) AS DECIMAL(18,2)) AS subtotal,
                      CAST(CASE WHEN pedido_id % 5 = 0 THEN 100 ELSE 0 END AS DECIMAL(12,2))
                        AS descuento FROM detalle GROUP BY 1))""",
    "product_snapshot": """SELECT variante_id, CAST(precio_lista AS DOUBLE) AS precio_lista, sku,
          nombre || ' ' || coalesce(color, '') AS nombre_snap
        FROM variantes JOIN ultimo_precio USING (variante_id) JOIN productos USING (producto_id)
        WHERE activa AND variante_id IN (SELECT variante_id FROM detalle)""",
    "allocate_warehouse": ASSIGNED,
    "allocate_competing": """SELECT detalle_pedido_id, d.variante_id, almacen_id,
          CAST(least(b, hasta) - greatest(a, desde) AS BIGINT) AS cantidad
        FROM (SELECT detalle_pedido_id, variante_id, SUM(cantidad) OVER w AS b,
                SUM(cantidad) OVER w - cantidad AS a FROM detalle WHERE cantidad > 0
              WINDOW w AS (PARTITION BY variante_id ORDER BY pedido_id, detalle_pedido_id)) d
        JOIN (SELECT variante_id, almacen_id, SUM(cantidad_disponible) OVER v AS hasta,
                SUM(cantidad_disponible) OVER v - cantidad_disponible AS desde
              FROM niveles WHERE cantidad_disponible > 0
              WINDOW v AS (PARTITION BY variante_id ORDER BY cantidad_disponible DESC, almacen_id)
              UNION ALL
              SELECT variante_id, NULL, 1000000000000000, coalesce(total, 0)
              FROM (SELECT DISTINCT variante_id FROM detalle) LEFT JOIN (
                SELECT variante_id, SUM(cantidad_disponible) AS total FROM niveles
                WHERE cantidad_disponible > 0 GROUP BY 1) USING (variante_id)) s
          ON s.variante_id = d.variante_id AND desde < b AND hasta > a""",
    "mark_oversold": f"""SELECT detalle_pedido_id, a.almacen_id, demanda_acumulada,
          demanda_acumulada > cantidad_disponible AS excede_stock
        FROM (SELECT *, CAST(SUM(cantidad) OVER (PARTITION BY almacen_id, variante_id
                ORDER BY pedido_id, detalle_pedido_id) AS BIGINT) AS demanda_acumulada
              FROM ({ASSIGNED}) WHERE almacen_id IS NOT NULL) a
          JOIN niveles n ON n.almacen_id = a.almacen_id AND n.variante_id = a.variante_id""",
    "reservation_movements": counted(
        f"SELECT almacen_id, variante_id, 'reserva' AS tipo_movimiento, 'pedido' AS tipo_referencia, "
        f"pedido_id AS referencia_id, cantidad FROM ({ASSIGNED}) WHERE almacen_id IS NOT NULL"),
    "delivery_movements": counted(
        """SELECT coalesce(d.almacen_id, (SELECT n.almacen_id FROM niveles n
             WHERE n.variante_id = d.variante_id AND n.cantidad_reservada >= d.cantidad
             ORDER BY n.cantidad_reservada DESC, n.almacen_id LIMIT 1), 1) AS almacen_id,
             d.variante_id, 'venta' AS tipo_movimiento, 'pedido' AS tipo_referencia,
             d.pedido_id AS referencia_id, -d.cantidad AS cantidad
           FROM detalle d JOIN pedidos USING (pedido_id) WHERE estado_actual = 'entregado'"""),
    # Prefix sums and their minimum over whole groups; tests compare with a plain loop.
    "stock_ledger": """SELECT movimiento_inventario_id, almacen_id, variante_id,
          CAST(f AS BIGINT) AS cantidad_fisica, CAST(r AS BIGINT) AS cantidad_reservada,
          CAST(f - r AS BIGINT) AS cantidad_disponible
        FROM (SELECT movimiento_inventario_id, almacen_id, variante_id,
                sf - least(-5, MIN(sf) OVER w) AS f, sr - least(-1, MIN(sr) OVER w) AS r
              FROM (SELECT *,
                      SUM(CASE WHEN tipo_movimiento IN ('ingreso', 'reposicion', 'devolucion',
                        'venta', 'ajuste') THEN cantidad ELSE 0 END) OVER w AS sf,
                      SUM(CASE tipo_movimiento WHEN 'reserva' THEN cantidad WHEN 'venta' THEN cantidad
                        WHEN 'liberacion' THEN -cantidad ELSE 0 END) OVER w AS sr
                    FROM movimientos WINDOW w AS (PARTITION BY almacen_id, variante_id
                      ORDER BY fecha_movimiento, movimiento_inventario_id))
              WINDOW w AS (PARTITION BY almacen_id, variante_id
                ORDER BY fecha_movimiento, movimiento_inventario_id))""",
    "reorder_candidates": """SELECT almacen_id, variante_id, proveedor_id, cantidad_disponible,
          punto_reorden FROM niveles JOIN variantes USING (variante_id)
        WHERE cantidad_disponible <= punto_reorden AND proveedor_id IS NOT NULL""",
    "value_purchase_orders": """SELECT orden_compra_id, CAST(sub AS DOUBLE) AS subtotal,
          CAST(iva AS DOUBLE) AS impuesto_total, CAST(sub + iva AS DOUBLE) AS total_oc
        FROM (SELECT *, CAST(sub * CAST(0.19 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS iva
              FROM (SELECT orden_compra_id, CAST(coalesce(precio_costo, 0) * cantidad_recibida
                      AS DECIMAL(12,2)) AS sub FROM compras LEFT JOIN variantes USING (variante_id)))""",
    "lifecycle_due": f"""SELECT pedido_id, estado_actual, {text('actualizado_en', 'actualizado_en')},
          CASE estado_actual WHEN 'pendiente' THEN 'confirmado' WHEN 'pagado' THEN 'preparando'
            WHEN 'preparando' THEN 'empaquetado' WHEN 'empaquetado' THEN 'enviado'
            WHEN 'enviado' THEN 'entregado' END AS estado_siguiente
        FROM (SELECT *, row_number() OVER (PARTITION BY estado_actual
                ORDER BY actualizado_en, pedido_id) AS rn
              FROM pedidos WHERE {DUE} AND estado_actual NOT IN ('entregado', 'cancelado')
                AND (estado_actual <> 'enviado'
                  OR actualizado_en <= {NOW} - INTERVAL 60 SECONDS)) WHERE rn <= 15""",
    "fulfillment_status": f"""SELECT pedido_id, estado_actual,
          coalesce({fulfillment('estado_actual')}, 'pendiente') AS estado_fulfillment FROM pedidos""",
    "state_history": f"""SELECT evento_negocio_id, pedido_id, lag(estado) OVER (PARTITION BY pedido_id
            ORDER BY ocurrido_en, evento_negocio_id) AS estado_anterior, estado AS estado_nuevo,
          {text('ocurrido_en', 'cambiado_en')}
        FROM (SELECT *, CASE tipo_evento WHEN 'pedido_creado' THEN 'pendiente'
                WHEN 'pedido_cancelado' THEN 'cancelado'
                WHEN 'pedido_actualizado' THEN estado_nuevo END AS estado FROM buenos)
        WHERE estado IS NOT NULL AND pedido_id IS NOT NULL""",
    "payment_candidates": f"""SELECT pedido_id, estado_actual, cliente_id,
          CAST(total_final AS DOUBLE) AS total_final, {text('actualizado_en', 'actualizado_en')}
        FROM (SELECT * FROM pedidos WHERE estado_actual IN ('pendiente', 'confirmado')
                AND estado_pago <> 'pagado' AND actualizado_en <= {NOW} - INTERVAL 30 SECONDS
              ORDER BY pedidos.actualizado_en, pedido_id LIMIT 15)""",
    "cancel_refunds": """SELECT pago_id, pedido_id, CAST(monto AS DOUBLE) AS monto,
          'cancelacion_cliente' AS codigo_motivo, 'pendiente' AS estado
        FROM (SELECT g.*, row_number() OVER (PARTITION BY pedido_id ORDER BY g.creado_en DESC,
                pago_id DESC) AS rn FROM pagos g WHERE estado = 'capturado')
          JOIN (SELECT pedido_id FROM pedidos WHERE estado_actual = 'cancelado') USING (pedido_id)
        WHERE rn = 1""",
    "return_candidates": """SELECT pedido_id, cliente_id FROM pedidos p
        WHERE estado_actual = 'entregado' AND NOT EXISTS (SELECT 1 FROM devoluciones d
          WHERE d.pedido_id = p.pedido_id AND estado <> 'rechazada')""",
    "cart_value": """SELECT carrito_id, CAST(SUM(cantidad * precio_unitario) AS DOUBLE) AS valor_total
        FROM detalle_car GROUP BY 1""",
    "cart_order_link": """SELECT estado, COUNT(*) AS carritos, COUNT(n) AS con_pedido,
          COUNT(*) FILTER (WHERE pagados > 0) AS con_pago
        FROM carritos LEFT JOIN (
          SELECT carrito_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE estado_pago = 'pagado') AS pagados
          FROM (SELECT DISTINCT carrito_id, entidad_id AS pedido_id FROM leidos
                WHERE tipo_evento = 'carrito_convertido') LEFT JOIN pedidos USING (pedido_id)
          GROUP BY 1) USING (carrito_id) GROUP BY 1""",
    "payment_attempts": """SELECT pedido_id, COUNT(*) AS intentos,
          COUNT(*) FILTER (WHERE estado = 'fallido') AS fallidos,
          CAST(SUM(CASE WHEN estado = 'capturado' THEN monto ELSE 0 END) AS DOUBLE) AS monto_capturado
        FROM pagos GROUP BY 1""",
    "cancel_release": counted(
        """SELECT almacen_id, variante_id, 'liberacion' AS tipo_movimiento,
             'pedido' AS tipo_referencia, d.pedido_id AS referencia_id, cantidad
           FROM detalle d JOIN pedidos USING (pedido_id)
           WHERE estado_actual IN ('pendiente', 'confirmado') AND almacen_id IS NOT NULL"""),
    "sample_rows": """SELECT pedido_id, estado_actual FROM pedidos
        WHERE estado_actual IN ('pendiente', 'confirmado') AND CAST('0x' || substr(md5(
          CAST(pedido_id AS VARCHAR) || '|42'), 1, 8) AS BIGINT) < CAST(0.05 * 4294967296 AS BIGINT)""",
    "return_movements": counted(
        """SELECT coalesce(almacen_id, (SELECT n.almacen_id FROM niveles n
             WHERE n.variante_id = r.variante_id AND n.cantidad_reservada >= cantidad
             ORDER BY n.cantidad_reservada DESC, n.almacen_id LIMIT 1), 1) AS almacen_id,
             r.variante_id, 'devolucion' AS tipo_movimiento,
             'devolucion' AS tipo_referencia, devolucion_id AS referencia_id,
             cantidad_devuelta AS cantidad
           FROM detalle_dev r JOIN detalle USING (detalle_pedido_id)
           WHERE cantidad_devuelta BETWEEN 1 AND cantidad"""),
    "shipping_address": """SELECT cliente_id, direccion_id, es_predeterminada, ciudad
        FROM (SELECT *, row_number() OVER (PARTITION BY cliente_id
                ORDER BY es_predeterminada DESC, direccion_id) AS rn FROM direcciones) WHERE rn = 1""",
    "shipments_to_create": """SELECT pedido_id, cliente_id FROM pedidos
        WHERE estado_actual = 'enviado' AND pedido_id NOT IN (SELECT pedido_id FROM envios)""",
    "payment_event_log": """SELECT pago_id, CAST(paso AS BIGINT) AS paso,
          CASE paso WHEN 1 THEN 'iniciado' WHEN 2 THEN 'autorizado' ELSE estado END AS tipo_evento,
          CASE WHEN paso = 3 AND estado = 'fallido' THEN 'error' ELSE 'ok' END AS estado_evento,
          CAST(monto AS DOUBLE) AS monto_evento
        FROM pagos, (VALUES (1), (2), (3)) v(paso)""",
    "replenish_movements": counted(
        """SELECT almacen_id, variante_id,
             CASE WHEN orden_compra_id % 2 = 0 THEN 'ingreso' ELSE 'reposicion' END
               AS tipo_movimiento, 'orden_compra' AS tipo_referencia,
             orden_compra_id AS referencia_id, cantidad_recibida AS cantidad
           FROM compras WHERE estado = 'recibida_total'"""),
}
SQL["view_customer_history"] = SQL["dim_customer_scd2"]


def _dq() -> str:
    negative = {
        "pedidos": ("pedidos", "subtotal < 0 OR descuento_total < 0 OR impuesto_total < 0 "
                    "OR costo_envio < 0 OR total_final < 0"),
        "detalle_pedidos": ("detalle", "precio_unitario < 0 OR descuento_linea < 0 "
                            "OR impuesto_linea < 0 OR total_linea < 0 OR cantidad <= 0"),
        "pagos": ("pagos", "monto <= 0"),
        "niveles_stock": ("niveles", "cantidad_fisica < 0 OR cantidad_reservada < 0"),
        "detalle_devoluciones": ("detalle_dev", "cantidad_devuelta <= 0"),
        "precios_producto": ("precios", "precio_lista < 0"),
        "variantes_producto": ("variantes", "precio_costo < 0"),
        "detalle_carritos": ("detalle_car", "precio_unitario < 0 OR cantidad <= 0"),
    }
    tables = {"movimientos_inventario": "movimientos", "dlq_eventos": "cartas"}

    def crossing(table: str, key: str, start: str, end: str) -> str:
        return (f"SELECT 1 FROM (SELECT a, max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN "
                f"UNBOUNDED PRECEDING AND 1 PRECEDING) AS antes FROM (SELECT {key} AS k, "
                f"CAST({start} AS TIMESTAMP) AS a, coalesce(CAST({end} AS TIMESTAMP), "
                f"TIMESTAMP '9999-12-31') AS b FROM {table} WHERE {start} IS NOT NULL)) "
                "WHERE a < antes")

    def outside(table: str, moment: str) -> str:
        return (f"SELECT 1 FROM {table} WHERE CAST({moment} AS DATE) BETWEEN DATE '1995-01-01' AND "
                f"DATE '2030-12-31' AND CAST({moment} AS DATE) NOT IN (SELECT fecha FROM dim_fecha)")
    rules = {
        "C1 total de pedido": "SELECT 1 FROM pedidos WHERE abs(total_final - (subtotal "
            "- descuento_total + impuesto_total + costo_envio)) > 2",
        "C4 lineas repetidas": "SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber "
            "HAVING COUNT(*) > 1",
        "C5 envio activo": "SELECT 1 FROM envios WHERE estado_envio NOT IN ('fallido', 'devuelto') "
            "GROUP BY pedido_id HAVING COUNT(*) > 1",
        "C6 devolucion activa": "SELECT 1 FROM devoluciones WHERE estado <> 'rechazada' "
            "GROUP BY pedido_id HAVING COUNT(*) > 1",
        "C7 cierre de version": "SELECT 1 FROM (SELECT hasta, row_number() OVER (PARTITION BY "
            "cliente_id ORDER BY cambiado_en DESC, cambio_id DESC) = 1 AS actual FROM versiones) "
            "WHERE actual <> (hasta IS NULL)",
        "C7 cruce de versiones": crossing("versiones", "cliente_id", "cambiado_en", "hasta"),
        "C7 cruce de envios": crossing("envios", "pedido_id", "enviado_en", "entregado_en"),
        "C7 version actual": "SELECT 1 FROM versiones WHERE hasta IS NULL GROUP BY cliente_id "
            "HAVING COUNT(*) > 1",
        "C8 fact_pedidos.cliente_sk": "SELECT 1 FROM orders WHERE o_custkey NOT IN "
            "(SELECT c_custkey FROM customer)",
        "C8 fact_pedidos.fecha_sk": outside("orders", "o_orderdate"),
        "C8 fact_detalle_pedidos.producto_sk": "SELECT 1 FROM lineitem WHERE l_partkey NOT IN "
            "(SELECT p_partkey FROM part)",
        "C8 fact_movimientos_inventario.fecha_sk": outside("lineitem", "l_shipdate"),
        "C8 fact_movimientos_inventario.almacen_sk": "SELECT 1 FROM lineitem WHERE l_suppkey NOT IN "
            "(SELECT almacen_id FROM almacenes)",
        "C8 fact_devoluciones.producto_sk": "SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND "
            "l_partkey NOT IN (SELECT p_partkey FROM part)",
        "C8 fact_carritos.cliente_sk": "SELECT 1 FROM s_carritos WHERE user_id NOT IN "
            "(SELECT c_custkey FROM customer)",
        "C8 fact_carritos.fecha_sk": outside("s_carritos", "fecha"),
        "C9 calificacion": "SELECT 1 FROM lineitem WHERE l_linenumber NOT BETWEEN 1 AND 5",
        "C10 calendario": "SELECT 1 FROM orders HAVING date_diff('day', "
            "CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE)) + 1 < 365",
    }
    for name, (table, test) in negative.items():
        rules[f"C3 {name}"] = f"SELECT 1 FROM {table} WHERE {test}"
    for table, key in (("pedidos", "pedido_id"), ("detalle", "detalle_pedido_id"), ("pagos", "pago_id"),
                       ("envios", "envio_id"), ("carritos", "carrito_id"), ("devoluciones", "devolucion_id")):
        name = {"detalle": "detalle_pedidos"}.get(table, table)
        rules[f"C4 {name}.{key}"] = (f"SELECT 1 FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} "
                                     "HAVING COUNT(*) > 1")
    for table, column in C.ENUMERATIONS:
        rules[f"C2 {table}.{column}"] = (
            f"SELECT 1 FROM {tables.get(table, table)} WHERE {column} NOT IN "
            f"({one_of(C.ENUMERATIONS[table, column])})")
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS regla, COUNT(*) AS violaciones FROM ({sql})"
        for rule, sql in rules.items())


SQL["dq_report"] = _dq()


def with_tables(sql: str) -> str:
    """The query with the named tables it needs, in dependency order."""
    needed: list[str] = []

    def visit(body: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", body):
                visit(CTES[name].replace(name, "") if name in CTES[name] else CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {head}\n{sql}" if needed else sql


def all_sql() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in SQL.items()}

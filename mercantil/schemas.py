"""Schemas of the event log, the source tables and the warehouse, as DDL text."""

EVENTS = (
    "evento_negocio_id bigint, tipo_entidad string, entidad_id bigint, tipo_evento string, "
    "payload string, ocurrido_en timestamp"
)

# Columns of the source tables that the engine reads.
SOURCES = {
    "clientes": "cliente_id bigint, correo string, nombre string, apellido string, "
                "segmento string, estado string",
    "direcciones_cliente": "direccion_id bigint, cliente_id bigint, codigo_pais string, "
                           "ciudad string, provincia string, es_predeterminada boolean",
    "marcas": "marca_id bigint, nombre string",
    "categorias": "categoria_id bigint, categoria_padre_id bigint, nombre string",
    "productos": "producto_id bigint, marca_id bigint, categoria_id bigint, nombre string, "
                 "estado_producto string",
    "variantes_producto": "variante_id bigint, producto_id bigint, proveedor_id bigint, sku string, "
                          "color string, talla string, precio_costo decimal(12,2), activa boolean",
    "precios_producto": "precio_id bigint, variante_id bigint, precio_lista decimal(12,2), "
                        "vigente_desde timestamp",
    "almacenes": "almacen_id bigint, codigo string, nombre string, ciudad string, codigo_pais string",
    "pedidos": "pedido_id bigint, numero_pedido string, cliente_id bigint, canal_venta string, "
               "estado_actual string, subtotal decimal(12,2), descuento_total decimal(12,2), "
               "impuesto_total decimal(12,2), costo_envio decimal(12,2), total_final decimal(12,2), "
               "estado_pago string, estado_fulfillment string, creado_en timestamp, "
               "actualizado_en timestamp",
    "detalle_pedidos": "detalle_pedido_id bigint, pedido_id bigint, variante_id bigint, "
                       "almacen_id bigint, cantidad int, precio_unitario decimal(12,2), "
                       "descuento_linea decimal(12,2), impuesto_linea decimal(12,2), "
                       "total_linea decimal(12,2), creado_en timestamp",
    "pagos": "pago_id bigint, pedido_id bigint, proveedor_pago string, metodo_pago string, "
             "monto decimal(12,2), estado string, creado_en timestamp",
    "movimientos_inventario": "movimiento_inventario_id bigint, almacen_id bigint, "
                              "variante_id bigint, tipo_movimiento string, cantidad int, "
                              "tipo_referencia string, referencia_id bigint, "
                              "fecha_movimiento timestamp",
    "envios": "envio_id bigint, pedido_id bigint, almacen_id bigint, estado_envio string, "
              "transportista string, enviado_en timestamp, entregado_en timestamp",
    "devoluciones": "devolucion_id bigint, pedido_id bigint, motivo string, estado string, "
                    "creado_en timestamp",
    "detalle_devoluciones": "detalle_devolucion_id bigint, devolucion_id bigint, "
                            "detalle_pedido_id bigint, variante_id bigint, cantidad_devuelta int",
    "carritos": "carrito_id bigint, cliente_id bigint, estado string, creado_en timestamp",
    "detalle_carritos": "detalle_carrito_id bigint, carrito_id bigint, variante_id bigint, "
                        "cantidad int, precio_unitario decimal(12,2)",
    "niveles_stock": "almacen_id bigint, variante_id bigint, cantidad_fisica int, "
                     "cantidad_reservada int, cantidad_disponible int, punto_reorden int",
}

DIMENSIONS = {
    "dim_fecha": "fecha_sk bigint, fecha date, anio smallint, trimestre smallint, mes smallint, "
                 "semana smallint, dia_mes smallint, dia_semana smallint, dia_nombre string, "
                 "mes_nombre string, es_fin_semana boolean, es_feriado boolean",
    "dim_cliente": "cliente_sk bigint, cliente_id bigint, correo string, nombre_completo string, "
                   "segmento string, estado string, codigo_pais string, ciudad string, "
                   "region string, valido_desde timestamp, valido_hasta timestamp, "
                   "es_actual boolean",
    "dim_producto": "producto_sk bigint, producto_id bigint, nombre_producto string, "
                    "nombre_marca string, nombre_categoria string, categoria_padre string, "
                    "estado_producto string, valido_desde timestamp, valido_hasta timestamp, "
                    "es_actual boolean",
    "dim_variante": "variante_sk bigint, variante_id bigint, producto_sk bigint, sku string, "
                    "color string, talla string, precio_lista_actual decimal(12,2), "
                    "precio_costo decimal(12,2), activa boolean, valido_desde timestamp, "
                    "valido_hasta timestamp, es_actual boolean",
    "dim_almacen": "almacen_sk bigint, almacen_id bigint, codigo string, nombre string, "
                   "ciudad string, codigo_pais string",
    "dim_metodo_pago": "metodo_pago_sk bigint, metodo_pago string, categoria string",
    "dim_estado_pedido": "estado_pedido_sk bigint, estado string, es_terminal boolean, "
                         "es_positivo boolean",
    "dim_canal": "canal_sk bigint, canal string",
    "dim_promocion": "promocion_sk bigint, promocion_id bigint, nombre string, tipo string",
}

FACTS = {
    "fact_pedidos": "pedido_id bigint, numero_pedido string, cliente_sk bigint, fecha_sk bigint, "
                    "canal_sk bigint, estado_pedido_sk bigint, promocion_sk bigint, "
                    "subtotal decimal(12,2), descuento_total decimal(12,2), "
                    "impuesto_total decimal(12,2), costo_envio decimal(12,2), "
                    "total_final decimal(12,2), num_items int, estado_pago string, "
                    "estado_fulfillment string, creado_en timestamp, cargado_en timestamp",
    "fact_detalle_pedidos": "detalle_pedido_id bigint, pedido_id bigint, variante_sk bigint, "
                            "producto_sk bigint, cliente_sk bigint, fecha_sk bigint, "
                            "cantidad int, precio_unitario decimal(12,2), "
                            "descuento_linea decimal(12,2), impuesto_linea decimal(12,2), "
                            "total_linea decimal(12,2), creado_en timestamp, "
                            "cargado_en timestamp",
    "fact_pagos": "pago_id bigint, pedido_id bigint, cliente_sk bigint, fecha_sk bigint, "
                  "metodo_pago_sk bigint, monto decimal(12,2), estado string, "
                  "proveedor_pago string, creado_en timestamp, cargado_en timestamp",
    "fact_movimientos_inventario": "movimiento_id bigint, almacen_sk bigint, variante_sk bigint, "
                                   "fecha_sk bigint, tipo_movimiento string, cantidad int, "
                                   "tipo_referencia string, referencia_id bigint, "
                                   "fecha_movimiento timestamp, cargado_en timestamp",
    "fact_envios": "envio_id bigint, pedido_id bigint, almacen_sk bigint, fecha_envio_sk bigint, "
                   "fecha_entrega_sk bigint, estado_envio string, transportista string, "
                   "dias_entrega int, cargado_en timestamp",
    "fact_carritos": "carrito_id bigint, cliente_sk bigint, fecha_sk bigint, estado string, "
                     "num_items int, valor_total decimal(12,2), convertido boolean, "
                     "cargado_en timestamp",
    "fact_devoluciones": "devolucion_id bigint, pedido_id bigint, variante_sk bigint, "
                         "producto_sk bigint, cliente_sk bigint, fecha_sk bigint, motivo string, "
                         "estado string, cantidad_devuelta int, cargado_en timestamp",
}

_MARK = "struct<ocurrido_en: timestamp, evento_negocio_id: bigint>"

CONTROL = {
    "dlq_eventos": "evento_id bigint, tipo_evento string, payload string, motivo string, "
                   "error_detalle string, creado_en timestamp",
    "marcas_agua": "tabla_fuente string, ultima_carga timestamp, actualizado_en timestamp",
    "eventos_vistos": "evento_negocio_id bigint, dia date",
    "conteos_carga": "escritor string, lote bigint, procesados bigint, errores bigint, cartas bigint, "
                     "insertados bigint, actualizados bigint, cargado_en timestamp",
    "reintentos": f"{EVENTS}, intentos_olap int, error_olap string, pendiente boolean",
    "pedidos_plegados": f"pedido_id bigint, estado_pedido_sk bigint, estado_pedido_sk_en {_MARK}, "
                        f"estado_fulfillment string, estado_fulfillment_en {_MARK}, "
                        f"estado_pago string, estado_pago_en {_MARK}",
    "envios_plegados": f"envio_id bigint, estado_envio string, estado_envio_en {_MARK}, "
                       f"fecha_entrega_sk bigint, fecha_entrega_sk_en {_MARK}, "
                       f"dias_entrega int, dias_entrega_en {_MARK}",
    "carritos_plegados": f"carrito_id bigint, estado string, estado_en {_MARK}, "
                         f"convertido boolean, convertido_en {_MARK}",
}

# Declared constraints of the fact tables, by the source column a loader copies (fixed values).
REQUIRED = {
    "pagos": ["pedido_id"], "envios": ["pedido_id"], "devoluciones": ["pedido_id"],
}
LENGTHS = {
    "pedidos": {"numero_pedido": 30, "estado_pago": 20, "estado_fulfillment": 20},
    "pagos": {"estado": 20, "proveedor_pago": 50},
    "movimientos_inventario": {"tipo_movimiento": 30, "tipo_referencia": 30},
    "envios": {"estado_envio": 30, "transportista": 100},
    "devoluciones": {"motivo": 50, "estado": 20},
    "carritos": {"estado": 20},
}

KEYS = {
    "dim_cliente": ["cliente_id"], "dim_producto": ["producto_id"],
    "dim_variante": ["variante_id"], "dim_almacen": ["almacen_id"],
    "fact_pedidos": ["pedido_id"], "fact_detalle_pedidos": ["detalle_pedido_id"],
    "fact_pagos": ["pago_id"], "fact_movimientos_inventario": ["movimiento_id"],
    "fact_envios": ["envio_id"], "fact_carritos": ["carrito_id"],
    "fact_devoluciones": ["devolucion_id"], "dlq_eventos": ["evento_id"],
    "marcas_agua": ["tabla_fuente"], "reintentos": ["evento_negocio_id"],
    "pedidos_plegados": ["pedido_id"], "envios_plegados": ["envio_id"],
    "carritos_plegados": ["carrito_id"], "eventos_vistos": ["dia"],
    "conteos_carga": ["escritor"],
}

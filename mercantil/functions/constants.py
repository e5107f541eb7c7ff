"""Business constants.

Fixed values: the names below must stay as they are, since results carry them.
"""

# --- order life cycle (fixed values) ---------------------------------------
ORDER_FLOW = [
    "pendiente", "confirmado", "pagado", "preparando", "empaquetado", "enviado", "entregado",
]

# (estado, es_terminal, es_positivo); the surrogate key is the position.
ORDER_STATES = [
    ("pendiente", False, True),
    ("confirmado", False, True),
    ("pagado", False, True),
    ("preparando", False, True),
    ("empaquetado", False, True),
    ("enviado", False, True),
    ("entregado", True, True),
    ("cancelado", True, False),
    ("reembolsado", True, False),
]

FULFILLMENT_BY_STATE = {
    "pendiente": "pendiente",
    "confirmado": "pendiente",
    "pagado": "pendiente",
    "preparando": "preparando",
    "empaquetado": "listo",
    "enviado": "enviado",
    "entregado": "entregado",
    "cancelado": "pendiente",
    "reembolsado": "pendiente",
    "devuelto": "devuelto",
}

# --- seed dimensions (fixed values) ----------------------------------------
# (metodo_pago, categoria); the surrogate key is the position.
PAYMENT_METHODS = [
    ("tarjeta_credito", "tarjeta"),
    ("tarjeta_debito", "tarjeta"),
    ("transferencia", "bancario"),
    ("efectivo", "efectivo"),
    ("billetera_virtual", "digital"),
    ("cuotas", "digital"),
    ("criptomoneda", "digital"),
]

CHANNELS = ["web", "mobile", "marketplace", "call_center", "api"]

# --- events (fixed values) -------------------------------------------------
EVENTS_BY_LOADER = {
    "order_created": ["pedido_creado"],
    "order_updated": ["pedido_actualizado"],
    "order_cancelled": ["pedido_cancelado"],
    "payment": ["pago_capturado", "pago_fallido"],
    "stock": ["stock_repuesto", "stock_reservado", "stock_vendido"],
    "shipment_delivered": ["envio_entregado"],
    "shipment_returned": ["envio_devuelto"],
    "return": ["devolucion_creada"],
    "cart": ["carrito_abandonado", "carrito_convertido"],
}

DLQ_NO_HANDLER = "sin_handler"
DLQ_RETRIES = "error_max_reintentos"
MAX_ATTEMPTS = 3
ERROR_LENGTH = 500

WATERMARK_SOURCES = [
    "pedidos", "pagos", "clientes", "productos", "variantes",
    "envios", "devoluciones", "movimientos_inventario",
]

# --- rules (fixed values) --------------------------------------------------
TAX_RATE = "0.19"
FREE_SHIPPING_OVER = 50000
LIFECYCLE_BATCH = 15
LIFECYCLE_MIN_AGE_SECONDS = 30
TRANSIT_MIN_AGE_SECONDS = 60
POLL_SECONDS = 2
POLL_BATCH = 100
DEFAULT_COUNTRY, DEFAULT_CITY, DEFAULT_REGION = "CL", "Santiago", "Metropolitana"

# --- declared enumerations (fixed values) ----------------------------------
ENUMERATIONS = {
    ("clientes", "segmento"): ["vip", "premium", "estandar", "nuevo", "inactivo"],
    ("clientes", "estado"): ["activo", "inactivo", "bloqueado"],
    ("pedidos", "canal_venta"): CHANNELS,
    ("pedidos", "estado_actual"): [estado for estado, _, _ in ORDER_STATES],
    ("pedidos", "estado_pago"): ["pendiente", "parcial", "pagado", "reembolsado", "fallido"],
    ("pedidos", "estado_fulfillment"): [
        "pendiente", "preparando", "listo", "enviado", "entregado", "devuelto",
    ],
    ("pagos", "metodo_pago"): [metodo for metodo, _ in PAYMENT_METHODS],
    ("pagos", "estado"): [
        "iniciado", "autorizado", "capturado", "fallido", "cancelado", "reembolsado",
    ],
    ("movimientos_inventario", "tipo_movimiento"): [
        "ingreso", "reserva", "liberacion", "venta", "devolucion", "ajuste",
        "traslado_entrada", "traslado_salida", "reposicion",
    ],
    ("envios", "estado_envio"): [
        "pendiente", "preparando", "despachado", "en_camino", "entregado", "fallido", "devuelto",
    ],
    ("devoluciones", "motivo"): [
        "producto_defectuoso", "no_cumple_expectativa", "talla_incorrecta",
        "cambio_decision", "otro",
    ],
    ("devoluciones", "estado"): ["pendiente", "aprobada", "rechazada", "completada"],
    ("carritos", "estado"): ["activo", "convertido", "abandonado", "expirado"],
    ("dlq_eventos", "motivo"): [DLQ_NO_HANDLER, DLQ_RETRIES],
}

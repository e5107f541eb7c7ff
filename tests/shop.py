"""A small shop: source tables written by hand."""

from decimal import Decimal as D

from helpers import ts
from mercantil.schemas import SOURCES as SCHEMAS
from mercantil.sources.tables import Catalog

def order(id_, client=1, state="pendiente", paid="pendiente", day="2024-01-05", total=100):
    return (id_, f"P{id_}", client, "web", state, D(total), D(0), D(0), D(0), D(total), paid,
            "pendiente", ts(day), ts(day))


def line(id_, order_id, variant=100, warehouse=1, quantity=1, price=50):
    return (id_, order_id, variant, warehouse, quantity, D(price), D(0), D(0),
            D(price * quantity), ts("2024-01-05"))


ROWS = {
    "clientes": [(1, "a@x", "Ana", "Soto", "vip", "activo"), (2, "b@x", "Eva", "Paz", "nuevo", "activo")],
    "direcciones_cliente": [(1, 1, "CL", "Talca", "Maule", True)],
    "marcas": [(1, "Marca")],
    "categorias": [(1, None, "Ropa"), (2, 1, "Poleras")],
    "productos": [(10, 1, 2, "Polera", "activo")],
    "variantes_producto": [(100, 10, 5, "S100", "rojo", "M", D(20), True),
                           (101, 10, None, "S101", None, "L", D(20), True)],
    "precios_producto": [(1, 100, D(50), ts("2023-01-01"))],
    "almacenes": [(1, "A1", "Uno", "Talca", "CL"), (2, "A2", "Dos", "Lota", "CL")],
    "pedidos": [order(1), order(2, 2, "enviado"), order(3, 9, "entregado", day="2035-01-01")],
    "detalle_pedidos": [line(11, 1, quantity=2), line(12, 1, 101), line(21, 2, 999)],
    "pagos": [(1, 1, "Flow", "cuotas", D(100), "fallido", ts("2024-01-06")),
              (2, 1, "Flow", "cuotas", D(100), "capturado", ts("2024-01-07"))],
    "movimientos_inventario": [(1, 1, 100, "venta", -2, "pedido", 1, ts("2024-01-08")),
                               (2, 1, 100, "devolucion", 1, "devolucion", 1, ts("2024-01-09"))],
    "envios": [(1, 1, 1, "entregado", "Starken", ts("2024-01-09"), ts("2024-01-07")),
               (2, 2, 1, "en_camino", "Starken", ts("2024-01-09"), None)],
    "devoluciones": [(1, 1, "otro", "aprobada", ts("2024-01-10")), (2, 2, "otro", "rechazada", ts("2024-01-10"))],
    "detalle_devoluciones": [(5, 1, 12, 101, 1), (4, 1, 11, 100, 2)],
    "carritos": [(1, 1, "convertido", ts("2024-01-05")), (2, None, "abandonado", ts("2024-01-05"))],
    "detalle_carritos": [(1, 1, 100, 2, D(50)), (2, 1, 101, 1, D(7))],
    "niveles_stock": [(1, 100, 10, 2, 8, 10), (2, 100, 30, 22, 8, 3), (1, 101, 1, 1, 0, 5)],
}


def shop(spark, **changes) -> Catalog:
    data = {**ROWS, **changes}
    return Catalog({
        name: spark.createDataFrame(data[name], schema) for name, schema in SCHEMAS.items()})


def event(id_, kind, payload, at="2024-01-10T00:00:00"):
    return (id_, "x", None, kind, payload, ts(at))

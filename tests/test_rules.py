"""Business rules and quality checks on hand rows."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import one, rows, ts
from mercantil.functions import constants as C
from mercantil.functions import expressions as X
from mercantil.operators import dims, lifecycle as O, pricing as P, quality as Q, stock as K
from shop import SCHEMAS, line, order, shop


@pytest.fixture(scope="module")
def oltp(spark):
    return shop(spark)


def table(spark, name, data):
    return spark.createDataFrame(data, SCHEMAS[name])


def totals(spark, subtotal, discount=0, fee=4990):
    lines = table(spark, "detalle_pedidos", [line(1, 1, quantity=1, price=subtotal)])
    charges = spark.createDataFrame([(1, D(discount), D(fee))],
                                    "pedido_id bigint, descuento_total decimal(12,2), tarifa_envio decimal(12,2)")
    return one(P.price_orders(lines, charges), "true")


def test_order_total_above_the_threshold(spark):
    got = totals(spark, 60000)
    assert (got.impuesto_total, got.costo_envio, got.total_final) == (D("11400.00"), D("0.00"), D("71400.00"))


def test_shipping_is_charged_at_the_threshold(spark):
    assert totals(spark, 50000).costo_envio == D("4990.00")
    assert totals(spark, "50000.01").costo_envio == D("0.00")


def test_discount_lowers_the_tax_base(spark):
    got = totals(spark, 1000, discount=100)
    assert (got.impuesto_total, got.total_final) == (D("171.00"), D("6061.00"))


def test_line_tax_rounds_half_to_even(spark):
    # 0.19 * 0.50 = 0.095 and 0.19 * 1.50 = 0.285: both round to the even cent.
    lines = spark.createDataFrame(
        [(1, 1, D("0.50"), D(0)), (2, 1, D("1.50"), D(0))],
        "detalle_pedido_id bigint, cantidad int, precio_unitario decimal(12,2), "
        "descuento_linea decimal(12,2)")
    got = P.price_order_lines(lines)
    assert rows(got, "detalle_pedido_id", "impuesto_linea") == [(1, D("0.10")), (2, D("0.28"))]


def test_snapshot_takes_active_variants_with_a_price(spark, oltp):
    ids = spark.createDataFrame([(100,), (100,), (101,), (7,)], "variante_id bigint")
    assert rows(P.product_snapshot(oltp, ids)) == [(100, D("50.00"), "S100", "Polera rojo")]


def test_purchase_order_of_unknown_cost(spark, oltp):
    buys = spark.createDataFrame([(1, 100, 3), (2, 555, 3)],
                                 "orden_compra_id bigint, variante_id bigint, cantidad_recibida int")
    assert rows(P.value_purchase_orders(buys, oltp.variantes_producto)) == [
        (1, D("60.00"), D("11.40"), D("71.40")), (2, D("0.00"), D("0.00"), D("0.00"))]


def test_allocation_prefers_most_available_then_lowest_id(spark, oltp):
    lines = table(spark, "detalle_pedidos", [line(1, 1, 100, None, 8), line(2, 1, 100, None, 9),
                                             line(3, 1, 101, None, 1), line(4, 1, 999, None, 1)])
    got = K.allocate_warehouse(lines, oltp.niveles_stock)
    assert rows(got, "detalle_pedido_id", "almacen_id") == [(1, 1), (2, None), (3, None), (4, None)]
    assert rows(K.reservation_movements(got), "almacen_id", "tipo_movimiento", "cantidad") == [
        (1, "reserva", 8)]


def test_allocation_equals_a_search_over_all_warehouses(spark):
    rng = random.Random(3)
    levels = [(w, v, 0, 0, rng.randrange(0, 12), 0) for w in range(1, 9) for v in range(20)]
    lines = [line(i, i, rng.randrange(22), None, rng.randrange(1, 14)) for i in range(400)]
    got = K.allocate_warehouse(table(spark, "detalle_pedidos", lines), table(spark, "niveles_stock", levels))
    def pick(variant, quantity):
        fit = [(-a, w) for w, v, _, _, a, _ in levels if v == variant and a >= quantity]
        return min(fit)[1] if fit else None
    assert {r.detalle_pedido_id: r.almacen_id for r in got.collect()} == {
        row[0]: pick(row[2], row[4]) for row in lines}


def test_oversold_lines_are_marked(spark, oltp):
    lines = table(spark, "detalle_pedidos", [line(i, i, 100, 1, 3) for i in (1, 2, 3)])
    for size in (1, 2, 100):
        got = K.mark_oversold(lines, oltp.niveles_stock, ["pedido_id"], chunk_rows=size)
        assert rows(got, "detalle_pedido_id", "demanda_acumulada", "excede_stock") == [
            (1, 3, False), (2, 6, False), (3, 9, True)]


def test_delivery_falls_back_to_most_reserved(spark, oltp):
    orders = table(spark, "pedidos", [order(1, state="entregado"), order(2)])
    lines = table(spark, "detalle_pedidos", [
        line(1, 1, 100, 1, 2), line(2, 1, 100, None, 5), line(3, 1, 100, None, 50), line(4, 2, 100, 1, 1)])
    assert rows(K.delivery_movements(orders, lines, oltp.niveles_stock), "almacen_id", "cantidad") == [
        (1, -2), (1, -50), (2, -5)]


def test_cancel_release(spark):
    orders = table(spark, "pedidos", [order(1, state="confirmado"), order(2, state="pagado")])
    lines = table(spark, "detalle_pedidos", [line(1, 1, 100, 1, 2), line(2, 1, 100, None, 2), line(3, 2)])
    assert rows(K.cancel_release(orders, lines), "almacen_id", "tipo_movimiento", "cantidad") == [
        (1, "liberacion", 2)]


def test_return_quantity_is_bounded_by_the_line(spark, oltp):
    detail = table(spark, "detalle_devoluciones", [(1, 1, 11, 100, 2), (2, 1, 11, 100, 3), (3, 1, 12, 101, 0)])
    got = K.return_movements(oltp.devoluciones, detail, oltp.detalle_pedidos, oltp.niveles_stock)
    assert not got.filter("almacen_id IS NULL").count()
    assert rows(got, "variante_id", "cantidad", "tipo_movimiento") == [(100, 2, "devolucion")]


def moves(spark, *items):
    data = [(i, 1, 100, kind, n, "x", 1, ts("2024-01-01") + dt.timedelta(days=40 * i))
            for i, (kind, n) in enumerate(items, start=1)]
    return table(spark, "movimientos_inventario", data)


def test_stock_never_falls_below_zero(spark):
    opening = spark.createDataFrame([(1, 100, 5, 0)],
                                    "almacen_id bigint, variante_id bigint, cantidad_fisica bigint, "
                                    "cantidad_reservada bigint")
    ledger = K.stock_ledger(moves(spark, ("venta", -8), ("ingreso", 3)), opening)
    assert rows(ledger, "movimiento_inventario_id", "cantidad_fisica", "cantidad_reservada") == [
        (1, 0, 0), (2, 3, 0)]


@pytest.mark.parametrize("chunk_rows", [1, 50, 100_000])
def test_ledger_equals_a_loop(spark, chunk_rows):
    rng = random.Random(11)
    kinds = ["ingreso", "reposicion", "devolucion", "venta", "reserva", "liberacion", "ajuste"]
    items = []
    for _ in range(300):
        kind = rng.choice(kinds)
        n = rng.randrange(1, 9)
        items.append((kind, -n if kind == "venta" or (kind == "ajuste" and n % 2) else n))
    got = K.stock_ledger(moves(spark, *items), chunk_rows=chunk_rows)
    physical = reserved = 0
    wanted = {}
    for i, (kind, n) in enumerate(items, start=1):
        if kind in ("ingreso", "reposicion", "devolucion", "venta", "ajuste"):
            physical = max(physical + n, 0)
        if kind in ("reserva", "venta"):
            reserved = max(reserved + n, 0)
        if kind == "liberacion":
            reserved = max(reserved - n, 0)
        wanted[i] = (physical, reserved, physical - reserved)
    assert {r.movimiento_inventario_id: (r.cantidad_fisica, r.cantidad_reservada, r.cantidad_disponible)
            for r in got.collect()} == wanted


def test_reorder_needs_a_supplier(spark, oltp):
    got = K.reorder_candidates(oltp.niveles_stock, oltp.variantes_producto)
    assert [(r.almacen_id, r.variante_id) for r in got.collect()] == [(1, 100)]


def test_lifecycle(spark):
    now = F.lit("2024-01-05 00:00:45").cast("timestamp")
    states = ["pendiente", "confirmado", "pagado", "preparando", "empaquetado", "enviado",
              "entregado", "cancelado"]
    orders = table(spark, "pedidos", [order(i, state=s) for i, s in enumerate(states)]
                   + [order(20 + i, state="pagado") for i in range(5)])
    got = O.lifecycle_due(orders, now, per_state=2)
    # 45 s are enough for all but the order in transit; confirmed ones move by payment.
    assert rows(got, "pedido_id", "estado_siguiente") == [
        (0, "confirmado"), (2, "preparando"), (20, "preparando"), (3, "empaquetado"), (4, "enviado")]
    later = F.lit("2024-01-05 00:01:00").cast("timestamp")
    assert O.lifecycle_due(orders, later).filter("estado_actual = 'enviado'").count() == 1
    early = F.lit("2024-01-05 00:00:29").cast("timestamp")
    assert O.lifecycle_due(orders, early).count() == 0


def test_payment_candidates(spark):
    now = F.lit("2024-02-01").cast("timestamp")
    orders = table(spark, "pedidos", [
        order(1), order(2, state="confirmado", day="2024-01-01"), order(3, paid="pagado"),
        order(4, state="enviado"), order(5, day="2024-02-01")])
    assert [r.pedido_id for r in O.payment_candidates(orders, now).collect()] == [2, 1]
    assert [r.pedido_id for r in O.payment_candidates(orders, now, n=1).collect()] == [2]


def test_refund_is_the_latest_captured(spark):
    orders = table(spark, "pedidos", [order(1, state="cancelado"), order(2), order(3, state="cancelado")])
    pay = lambda i, o, m, s, d: (i, o, "Flow", "cuotas", D(m), s, ts(d))
    pagos = table(spark, "pagos", [pay(1, 1, 5, "capturado", "2024-01-01"), pay(2, 1, 6, "capturado", "2024-01-02"),
                                   pay(3, 1, 7, "fallido", "2024-01-03"), pay(4, 2, 8, "capturado", "2024-01-01"),
                                   pay(5, 3, 9, "fallido", "2024-01-01")])
    assert rows(O.cancel_refunds(orders, pagos), "pago_id", "pedido_id", "monto", "estado") == [
        (2, 1, D("6.00"), "pendiente")]
    assert rows(O.payment_attempts(pagos)) == [
        (1, 3, 1, D("11.00")), (2, 1, 0, D("8.00")), (3, 1, 1, D("0.00"))]
    steps = O.payment_event_log(pagos.filter("pago_id IN (2, 3)"))
    assert rows(steps, "pago_id", "tipo_evento", "estado_evento") == [
        (2, "autorizado", "ok"), (2, "capturado", "ok"), (2, "iniciado", "ok"),
        (3, "autorizado", "ok"), (3, "fallido", "error"), (3, "iniciado", "ok")]


def test_return_after_rejection(spark):
    orders = table(spark, "pedidos", [order(i, state="entregado") for i in (1, 2, 3)] + [order(4)])
    returns = table(spark, "devoluciones", [
        (1, 1, "otro", "rechazada", ts("2024-01-01")), (2, 2, "otro", "aprobada", ts("2024-01-01"))])
    assert rows(O.return_candidates(orders, returns), "pedido_id") == [(1,), (3,)]


def test_shipments_and_addresses(spark, oltp):
    assert rows(O.shipments_to_create(oltp.pedidos, oltp.envios.filter("pedido_id = 1"))) == [(2, 2)]
    addresses = table(spark, "direcciones_cliente", [
        (3, 1, "CL", "a", None, False), (4, 1, "CL", "b", None, True), (6, 2, "CL", "c", None, False),
        (5, 2, "CL", "d", None, False)])
    assert rows(O.shipping_address(addresses), "cliente_id", "direccion_id") == [(1, 4), (2, 5)]


def test_fulfillment_of_an_unknown_state(spark):
    orders = table(spark, "pedidos", [order(1, state="empaquetado"), order(2, state="raro")])
    assert rows(O.fulfillment_status(orders), "pedido_id", "estado_fulfillment") == [
        (1, "listo"), (2, "pendiente")]


def test_date_key(spark):
    days = spark.createDataFrame([("2020-01-01T23:59:59Z",), ("2030-12-31T00:00:00+00:00",), ("2035-01-01",),
                                  ("x",), ("2020-01-02T01:00:00Z",)], "t string")
    key = lambda zone=None: X.date_key(X.day_of(X.instant_of("t"), zone), *dims.CALENDAR)
    assert [r[0] for r in days.select(key()).collect()] == [1, 4018, None, None, 2]
    assert days.select(key("America/Santiago")).collect()[4][0] == 1
    assert dims.dim_date(spark).count() == 4018
    assert dims.dim_date(spark).agg(F.max("fecha_sk")).first()[0] == 4018


def test_surrogate_key_is_the_md5_prefix(spark):
    import hashlib
    got = spark.range(3).select(X.surrogate_key("id", F.lit("x"))).collect()
    def key(text):
        value = int(hashlib.md5(text.encode()).hexdigest()[:16], 16)
        return value - 2**64 if value >= 2**63 else value
    assert [r[0] for r in got] == [key(f"{i}|x") for i in range(3)]


# --- quality ----------------------------------------------------------------

def test_row_rules(spark):
    orders = table(spark, "pedidos", [order(1), order(2, state="raro"), order(3, total=-1)]).withColumn(
        "total_final", F.when(F.col("pedido_id") == 2, F.col("total_final") + 2.01)
        .otherwise(F.col("total_final")))
    assert rows(Q.violations(orders, Q.total_mismatch()), "pedido_id") == [(2,)]
    assert rows(Q.violations(orders, Q.not_listed("pedidos", "estado_actual")), "pedido_id") == [(2,)]
    assert rows(Q.violations(orders, Q.bad_sign("pedidos", orders.columns)), "pedido_id") == [(3,)]
    assert rows(Q.count_violations(orders, {
        "a": Q.total_mismatch(), "b": Q.bad_sign("pedidos", orders.columns)})) == [("a", 1), ("b", 1)]
    stars = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "calificacion int")
    assert Q.violations(stars, Q.bad_rating()).count() == 2


def test_set_rules(spark):
    ship = lambda i, o, s: (i, o, 1, s, "Starken", None, None)
    envios = table(spark, "envios", [ship(1, 1, "en_camino"), ship(2, 1, "entregado"), ship(3, 2, "fallido"),
                                     ship(4, 2, "en_camino"), ship(5, 3, "devuelto"), ship(6, 3, "devuelto")])
    assert rows(Q.several_active_shipments(envios)) == [(1, 2)]
    back = lambda i, o, s: (i, o, "otro", s, ts("2024-01-01"))
    returns = table(spark, "devoluciones", [back(1, 1, "aprobada"), back(2, 1, "rechazada"),
                                            back(3, 2, "aprobada"), back(4, 2, "pendiente")])
    assert rows(Q.several_active_returns(returns)) == [(2, 2)]
    dim = spark.createDataFrame([(1, True, None), (1, True, None), (2, True, ts("2024-01-01")), (3, False, None)],
                                "cliente_id bigint, es_actual boolean, valido_hasta timestamp")
    assert rows(Q.violations(dim, Q.incoherent_version()), "cliente_id") == [(2,), (3,)]
    assert rows(Q.several_current_versions(dim, "cliente_id")) == [(1, 2)]
    fact = spark.createDataFrame([(1,), (9,), (None,)], "cliente_id bigint")
    assert rows(Q.orphan_keys(fact, dim, "cliente_id")) == [(9,)]
    stale = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "pedido_id bigint, estado_pedido_sk bigint")
    orders = table(spark, "pedidos", [order(1), order(2, state="enviado"), order(3)])
    assert rows(Q.stale_order_state(stale, orders), "pedido_id") == [(2,), (3,)]


def test_intervals_and_keys(spark):
    spans = spark.createDataFrame(
        [(1, ts("2024-01-01"), ts("2024-01-05")), (1, ts("2024-01-05"), None), (1, ts("2024-02-01"), None),
         (2, ts("2024-01-01"), ts("2024-03-01")), (2, ts("2024-01-10"), ts("2024-01-11")),
         (2, ts("2024-02-01"), ts("2024-02-02")), (2, ts("2024-03-01"), None), (3, None, None)],
        "k bigint, a timestamp, b timestamp")
    found = Q.overlapping_intervals(spans, "k", "a", "b")
    assert rows(found, "k", "_start") == [
        (1, ts("2024-02-01")), (2, ts("2024-01-10")), (2, ts("2024-02-01"))]
    named = spans.select("k", F.col("a").alias("valido_desde"), F.col("b").alias("valido_hasta"),
                         F.col("b").isNull().alias("es_actual"))
    marked = Q.with_version_marks(named, "k")
    assert rows(Q.violations(marked, Q.overlapping_version()), "k", "valido_desde") == [
        (1, ts("2024-02-01")), (2, ts("2024-01-10")), (2, ts("2024-02-01"))]
    assert rows(Q.violations(marked, Q.second_current_version()), "k") == [(1,)]
    fact = spark.createDataFrame([(1, 5), (9, 5), (None, 6), (9, None)], "cliente_sk bigint, fecha_sk bigint")
    marked = Q.with_dimensions(fact, {
        "cliente_sk": spark.createDataFrame([(1,)], "cliente_sk bigint"),
        "fecha_sk": spark.createDataFrame([(5,)], "fecha_sk bigint")})
    assert rows(Q.count_violations(marked, {
        k: Q.missing_in_dimension(k) for k in ("cliente_sk", "fecha_sk")})) == [("cliente_sk", 2), ("fecha_sk", 1)]
    assert rows(Q.repeated_keys({"x": (fact, "cliente_sk"), "y": (spans, "a"), "z": (fact.limit(0), "fecha_sk")})) == [
        ("x", 1), ("y", 2), ("z", 0)]


@pytest.mark.parametrize("chunk", [3, 10**6])
def test_allocate_competing(spark, chunk):
    rng = random.Random(8)
    lines = [(k, rng.randint(1, 5), rng.choice([0, 1, 2, 7, 30, None])) for k in range(200)]
    levels = [(w, v, rng.choice([0, 3, 40, 40, 90])) for v in range(1, 5) for w in range(1, 5)]
    left = {}
    for w, v, n in sorted(levels, key=lambda x: (-x[2], x[0])):
        left.setdefault(v, []).append([w, n])
    expected = []
    for k, v, n in lines:
        for place in left.get(v, []):
            part = min(n or 0, place[1])
            if part:
                expected.append((k, place[0], part))
                place[1] -= part
                n -= part
        if n:
            expected.append((k, None, n))
    found = K.allocate_competing(
        spark.createDataFrame(lines, "detalle_pedido_id bigint, variante_id bigint, cantidad int"),
        spark.createDataFrame(levels, "almacen_id bigint, variante_id bigint, cantidad_disponible int"),
        ["detalle_pedido_id"], chunk_rows=chunk)
    got = [tuple(r) for r in found.select("detalle_pedido_id", "almacen_id", "cantidad").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_contracts(spark):
    wanted = {"a": spark.createDataFrame([], "x bigint, y string").schema,
              "b": spark.createDataFrame([], "x bigint").schema}
    found = {"a": spark.createDataFrame([], "x int").schema}
    assert rows(Q.contract_violations(spark, found, wanted)) == [
        ("a", "x", "otro tipo"), ("a", "y", "falta columna"), ("b", None, "falta tabla")]
    assert Q.short_calendar(dims.dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 3, 1))).count() == 1
    assert Q.short_calendar(dims.dim_date(spark)).count() == 0
    marks = spark.createDataFrame([("pedidos",)], "tabla_fuente string")
    assert {r.tabla_fuente for r in Q.missing_watermarks(spark, marks).collect()} == set(
        C.WATERMARK_SOURCES) - {"pedidos"}

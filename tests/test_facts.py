"""Fact loaders and the order fold on hand rows."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from helpers import one, rows
from mercantil import schemas
from mercantil.functions.payload import parse_payload
from mercantil.operators import dims as D
from mercantil.operators import facts as L
from mercantil.operators.merge import merge_insert_only
from mercantil.sources.tables import Catalog
from shop import event, order, shop

CALENDAR = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def context(spark, oltp):
    at = F.lit("2024-01-01").cast("timestamp")
    products = D.dim_product_scd2(oltp, at)
    return L.LoadContext(oltp, Catalog({
        "dim_cliente": D.dim_customer_scd2(oltp, at), "dim_producto": products,
        "dim_variante": D.dim_variant_scd2(oltp, products, at),
        "dim_almacen": D.dim_warehouse(oltp.almacenes)}), CALENDAR)


def events(spark, *items):
    return parse_payload(spark.createDataFrame(list(items), schemas.EVENTS))


@pytest.fixture(scope="module")
def ctx(spark):
    return context(spark, shop(spark))


def created(spark, *ids):
    return events(spark, *[event(i, "pedido_creado", f'{{"pedido_id":{i}}}') for i in ids])


def test_orders_and_missing_lookups(spark, ctx):
    got = L.load_fact_orders(created(spark, 1, 3, 77), ctx)
    assert [r.pedido_id for r in got.orderBy("pedido_id").collect()] == [1, 3]
    first, late = one(got, "pedido_id = 1"), one(got, "pedido_id = 3")
    assert (first.fecha_sk, first.num_items, first.canal_sk, first.estado_pedido_sk) == (5, 2, 1, 1)
    assert first.cliente_sk is not None
    # Client 9 is unknown and 2035 lies outside the calendar: keys are null, the row stays.
    assert (late.fecha_sk, late.cliente_sk, late.num_items) == (None, None, 0)


def test_replay_changes_nothing(spark, ctx):
    batch = created(spark, 1, 2)
    once = L.load_fact_orders(batch, ctx).drop("cargado_en")
    again = L.load_fact_orders(batch.unionByName(batch), ctx).drop("cargado_en")
    assert rows(merge_insert_only(once, again, ["pedido_id"])) == rows(once)


def test_order_lines(spark, ctx):
    got = L.load_fact_order_lines(created(spark, 1, 2), ctx)
    assert rows(got, "detalle_pedido_id", "cantidad", "fecha_sk") == [(11, 2, 5), (12, 1, 5), (21, 1, 5)]
    unknown = one(got, "detalle_pedido_id = 21")
    assert (unknown.variante_sk, unknown.producto_sk) == (None, None)
    assert one(got, "detalle_pedido_id = 11").producto_sk is not None


def fold(spark, ctx, *items):
    batch = events(spark, *items)
    folded = L.fold_orders(L.order_contributions(batch, ctx.oltp.pagos))
    return one(L.apply_fold(L.load_fact_orders(created(spark, 1), ctx), folded), "pedido_id = 1")


def update(id_, state, at="2024-01-10T00:00:00"):
    return event(id_, "pedido_actualizado", f'{{"pedido_id":1,"estado_nuevo":"{state}"}}', at)


def test_later_event_wins_in_any_order(spark, ctx):
    items = [update(5, "preparando"), update(6, "enviado", "2024-01-11T00:00:00"),
             event(7, "pedido_cancelado", '{"pedido_id":1}', "2024-01-09T00:00:00")]
    for order_ in itertools.permutations(items):
        got = fold(spark, ctx, *order_)
        assert (got.estado_pedido_sk, got.estado_fulfillment, got.estado_pago) == (
            6, "enviado", "reembolsado")


def test_equal_times_are_decided_by_the_id(spark, ctx):
    captured = event(8, "pago_capturado", '{"pago_id":2,"pedido_id":1}')
    got = fold(spark, ctx, captured, update(9, "pagado"), update(7, "confirmado"))
    assert (got.estado_pedido_sk, got.estado_pago) == (3, "pagado")


def test_unknown_state_keeps_the_key(spark, ctx):
    got = fold(spark, ctx, update(5, "devuelto"))
    assert (got.estado_pedido_sk, got.estado_fulfillment) == (1, "devuelto")
    got = fold(spark, ctx, update(5, "otra_cosa"))
    assert (got.estado_pedido_sk, got.estado_fulfillment) == (1, "pendiente")


@pytest.mark.parametrize("state", ["pendiente", "confirmado", "pagado", "preparando", "empaquetado",
                                   "enviado", "entregado", "cancelado", "reembolsado"])
def test_every_state_sets_a_fulfillment(spark, ctx, state):
    assert fold(spark, ctx, update(5, state)).estado_fulfillment is not None


def test_cancelling_refunds_without_a_payment(spark, ctx):
    got = fold(spark, ctx, event(5, "pedido_cancelado", '{"pedido_id":1}'))
    assert (got.estado_pedido_sk, got.estado_pago, got.estado_fulfillment) == (
        8, "reembolsado", "pendiente")


def test_folds_merge_like_one(spark, ctx):
    items = [update(i, s, f"2024-01-{10 + i % 3}T00:00:00") for i, s in enumerate(
        ["pendiente", "pagado", "enviado", "devuelto", "confirmado", "x"], start=1)]
    whole = L.fold_orders(L.state_contributions(events(spark, *items)))
    for cut in range(1, len(items)):
        left = L.fold_orders(L.state_contributions(events(spark, *items[:cut])))
        right = L.fold_orders(L.state_contributions(events(spark, *items[cut:])))
        assert rows(L.merge_folds(right, left)) == rows(whole)


def test_failed_then_captured(spark, ctx):
    batch = events(spark, event(1, "pago_fallido", '{"pago_id":1,"pedido_id":1}'),
                   event(2, "pago_capturado", '{"pago_id":2,"pedido_id":1,"cliente_id":2}'),
                   event(3, "pago_capturado", '{"pago_id":99,"pedido_id":1}'))
    got = L.load_fact_payments(batch, ctx)
    assert rows(got, "pago_id", "estado", "metodo_pago_sk", "fecha_sk") == [
        (1, "fallido", 6, 6), (2, "capturado", 6, 7)]
    # The client of the event goes before the client of the order.
    assert one(got, "pago_id = 1").cliente_sk != one(got, "pago_id = 2").cliente_sk
    assert fold(spark, ctx, event(2, "pago_capturado", '{"pago_id":2,"pedido_id":1}')
                ).estado_pago == "pagado"


def test_stock_keeps_the_stored_sign(spark, ctx):
    got = L.load_fact_stock(events(spark, event(1, "stock_vendido", '{"movimiento_id":1,"cantidad":2}')), ctx)
    row = one(got, "movimiento_id = 1")
    assert (row.cantidad, row.tipo_movimiento, row.fecha_sk) == (-2, "venta", 8)
    # Movements without an event can be read directly.
    assert L.movement_facts(ctx.oltp.movimientos_inventario, ctx).count() == 2


def test_delivery_before_shipping_counts_no_days(spark, ctx):
    got = L.load_fact_shipments(events(spark, event(1, "envio_entregado", '{"envio_id":1}')), ctx)
    row = one(got, "envio_id = 1")
    assert (row.dias_entrega, row.estado_envio, row.fecha_entrega_sk) == (0, "entregado", 7)


def test_missing_delivery_time(spark, ctx):
    batch = events(spark, event(1, "envio_entregado", '{"envio_id":2}'))
    assert one(L.load_fact_shipments(batch, ctx), "envio_id = 2").dias_entrega is None
    filled = L.LoadContext(ctx.oltp, ctx.dims, CALENDAR, missing_days=3)
    assert one(L.load_fact_shipments(batch, filled), "envio_id = 2").dias_entrega == 3


def test_null_dates_do_not_overwrite(spark, ctx):
    delivered = L.load_fact_shipments(
        events(spark, event(1, "envio_entregado", '{"envio_id":1}')), ctx).drop("_entregado")
    gone = context(spark, shop(spark, envios=[(1, 1, 1, "fallido", "Starken", None, None)]))
    later = L.load_fact_shipments(events(spark, event(2, "envio_entregado", '{"envio_id":1}')), gone)
    row = one(L.merge_shipments(delivered, later), "envio_id = 1")
    assert (row.estado_envio, row.fecha_entrega_sk, row.dias_entrega, row.fecha_envio_sk) == (
        "fallido", 7, 0, 9)


def test_returned_shipment_changes_state_only(spark, ctx):
    back = L.load_fact_shipments(events(spark, event(3, "envio_devuelto", '{"envio_id":1}')), ctx)
    assert one(back, "true").estado_envio == "devuelto"
    old = back.drop("_entregado").withColumn("dias_entrega", F.lit(None).cast("int"))
    row = one(L.merge_shipments(old.withColumn("estado_envio", F.lit("entregado")), back), "true")
    assert (row.estado_envio, row.dias_entrega) == ("devuelto", None)


def test_returns_take_the_first_detail(spark, ctx):
    batch = events(spark, event(1, "devolucion_creada", '{"devolucion_id":1}'),
                   event(2, "devolucion_creada", '{"devolucion_id":2}'))
    got = L.load_fact_returns(batch, ctx)
    assert rows(got, "devolucion_id", "cantidad_devuelta") == [(1, 2), (2, 0)]
    assert one(got, "devolucion_id = 2").variante_sk is None
    assert one(got, "devolucion_id = 1").producto_sk is not None


def test_carts(spark, ctx):
    batch = events(spark, event(1, "carrito_abandonado", '{"carrito_id":1}'),
                   event(2, "carrito_abandonado", '{"carrito_id":2}'))
    got = L.load_fact_carts(batch, ctx)
    # The stored state decides, not the event.
    assert [(r.carrito_id, r.estado, r.num_items, float(r.valor_total), r.convertido)
            for r in got.orderBy("carrito_id").collect()] == [
        (1, "convertido", 2, 107.0, True), (2, "abandonado", 0, 0.0, False)]
    changed = got.withColumn("estado", F.lit("expirado")).withColumn("convertido", F.lit(False)).withColumn(
        "num_items", F.lit(9))
    merged = L.merge_carts(got, changed)
    assert rows(merged, "carrito_id", "estado", "num_items") == [(1, "expirado", 2), (2, "expirado", 0)]

"""The event pipeline: dead letters, retries, replays, streams and restarts."""

import datetime as dt
import json
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from helpers import one, rows, ts
from mercantil import schemas
from mercantil.functions.payload import CORRUPT, parse_payload
from mercantil.operators import facts as L
from mercantil.plans import bi, views
from mercantil.sources.snapshots import KeyedTable
from mercantil.sources.tables import Catalog
from mercantil.streaming import events as E
from mercantil.streaming import loader
from mercantil.streaming.health import ProgressLog
from mercantil.streaming.loader import Warehouse
from shop import event, order, shop

CALENDAR = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))
LOG = [
    event(1, "pedido_creado", '{"pedido_id":1}', "2024-01-05T00:00:00"),
    event(2, "pedido_actualizado", '{"pedido_id":1,"estado_nuevo":"confirmado"}', "2024-01-06T00:00:00"),
    event(3, "pago_fallido", '{"pago_id":1,"pedido_id":1}', "2024-01-06T00:00:00"),
    event(4, "pago_capturado", '{"pago_id":2,"pedido_id":1}', "2024-01-07T00:00:00"),
    event(5, "pedido_creado", '{"pedido_id":2}', "2024-01-05T00:00:00"),
    event(6, "stock_vendido", '{"movimiento_id":1}', "2024-01-08T00:00:00"),
    event(7, "envio_entregado", '{"envio_id":1}', "2024-01-09T00:00:00"),
    event(8, "devolucion_creada", '{"devolucion_id":1}', "2024-01-10T00:00:00"),
    event(9, "envio_devuelto", '{"envio_id":1}', "2024-01-10T00:00:00"),
    event(10, "carrito_convertido", '{"carrito_id":1}', "2024-01-10T00:00:00"),
    event(11, "cosa_rara", '{"a":1}', "2024-01-10T00:00:00"),
    event(12, "pedido_creado", '{bad', "2024-01-10T00:00:00"),
    event(13, "pedido_actualizado", None, "2024-01-10T00:00:00"),
    event(14, "pedido_actualizado", '{"pedido_id":2,"estado_nuevo":"entregado"}', "2024-01-11T00:00:00"),
]
FACTS = ["fact_pedidos", "fact_detalle_pedidos", "fact_pagos", "fact_movimientos_inventario",
         "fact_envios", "fact_carritos", "fact_devoluciones"]


def frame(spark, items):
    return spark.createDataFrame(list(items), schemas.EVENTS)


def house(spark, tmp_path, name="w", **changes):
    return Warehouse(spark, str(tmp_path / name), shop(spark, **changes), CALENDAR, buckets=3)


def state(warehouse):
    star = warehouse.star()
    facts = {name: rows(getattr(star, name).drop("cargado_en")) for name in FACTS}
    return {**facts, "dlq": rows(star.dlq_eventos, "evento_id", "motivo")}


def stable(facts):
    """Facts without version keys, which depend on the batch a client came in."""
    keys = {"fact_pedidos": [0, 3, 5, 12, 13, 14], "fact_pagos": [0, 1, 3, 4, 5, 6]}
    return {name: [tuple(r[i] for i in keys[name]) for r in facts[name]] for name in keys}


def test_parse_and_route(spark):
    routed = E.route_events(parse_payload(frame(spark, LOG)))
    assert one(routed, "evento_negocio_id = 12")[CORRUPT] == "{bad"
    null = one(routed, "evento_negocio_id = 13")
    assert (null.pedido_id, null[CORRUPT], null.cargador) == (None, None, "order_updated")
    assert rows(E.dlq_unhandled(routed), "evento_id", "motivo") == [(11, "sin_handler")]
    assert one(routed, "evento_negocio_id = 11").cargador is None
    assert one(E.route_events(routed.drop("cargador"), {"cosa_rara": "mio"}),
               "evento_negocio_id = 11").cargador == "mio"


def test_a_field_of_the_wrong_type_is_a_failure(spark):
    bad = parse_payload(frame(spark, [event(1, "pedido_creado", '{"pedido_id":"uno"}')]))
    assert E.failed_events(E.route_events(bad)).count() == 1


def test_error_text_is_cut(spark):
    long = event(1, "pedido_creado", "{" + "x" * 900)
    failed = E.failed_events(E.route_events(parse_payload(frame(spark, [long]))).withColumn(
        "intentos_olap", F.lit(2)))
    assert len(one(E.dlq_failed(failed), "true").error_detalle) == 500
    assert E.to_retry(failed).count() == 0


def test_poll(spark):
    log = spark.createDataFrame(
        [(i, ts(f"2024-01-{30 - i:02d}"), i % 4 == 0, i % 5) for i in range(1, 25)],
        "evento_negocio_id bigint, ocurrido_en timestamp, procesado_olap boolean, intentos_olap int")
    got = [r.evento_negocio_id for r in E.poll(log, 3).collect()]
    assert got == [22, 21, 17]


def test_dedup(spark):
    log = frame(spark, LOG + LOG)
    assert rows(E.dedup_events(log)) == rows(frame(spark, LOG))


def test_watermarks_never_move_back(spark):
    routed = E.route_events(parse_payload(frame(spark, LOG)))
    seen = E.watermarks(routed)
    assert rows(seen, "tabla_fuente", "ultima_carga") == [
        ("devoluciones", ts("2024-01-10")), ("envios", ts("2024-01-09")),
        ("movimientos_inventario", ts("2024-01-08")), ("pagos", ts("2024-01-07")),
        ("pedidos", ts("2024-01-05"))]
    older = seen.withColumn("ultima_carga", F.lit("2020-01-01").cast("timestamp"))
    assert rows(E.update_watermarks(seen, older), "tabla_fuente", "ultima_carga") == rows(
        seen, "tabla_fuente", "ultima_carga")


def test_load_and_replay(spark, tmp_path):
    w = house(spark, tmp_path)
    w.load_batch(frame(spark, LOG), 0)
    first = state(w)
    assert first["dlq"] == [(11, "sin_handler")]
    orders = {r.pedido_id: r for r in w.orders().collect()}
    assert orders[1].estado_pago == "pagado" and orders[1].estado_pedido_sk == 2
    assert orders[2].estado_fulfillment == "entregado"
    assert one(w.star().fact_envios, "true").estado_envio == "devuelto"
    assert one(w.star().fact_devoluciones, "true").cantidad_devuelta == 2
    w.load_batch(frame(spark, LOG), 0)
    assert state(w) == first
    # The same events in a new batch: one more attempt for the bad one, same facts.
    w.load_batch(frame(spark, LOG), 1)
    assert {k: v for k, v in state(w).items() if k != "dlq"} == {
        k: v for k, v in first.items() if k != "dlq"}


def test_bad_payload_ends_in_the_dead_letters(spark, tmp_path):
    w = house(spark, tmp_path)
    w.load_batch(frame(spark, [LOG[11], LOG[0]]), 0)
    for batch in (1, 2, 3):
        found = rows(w.star().dlq_eventos, "evento_id", "motivo")
        assert found == ([] if batch < 3 else [(12, "error_max_reintentos")])
        w.load_batch(frame(spark, []), batch)
    assert w.table("reintentos").read().filter("pendiente").count() == 0
    assert rows(w.star().dlq_eventos, "evento_id") == [(12,)]


def test_batch_splits_and_order_do_not_matter(spark, tmp_path):
    whole = house(spark, tmp_path, "one")
    whole.load_batch(frame(spark, LOG), 0)
    parts = house(spark, tmp_path, "many")
    for i, chunk in enumerate((LOG[10:], LOG[3:10], LOG[:3])):
        parts.load_batch(frame(spark, chunk), i)
    assert stable(state(parts)) == stable(state(whole))


def test_dimension_versions_follow_the_source(spark, tmp_path):
    w = house(spark, tmp_path)
    w.load_batch(frame(spark, LOG[:1]), 0)
    clients = [(1, "a@x", "Ana", "Soto", "estandar", "activo"), (2, "b@x", "Eva", "Paz", "nuevo", "activo")]
    w = house(spark, tmp_path, clientes=clients)
    w.load_batch(frame(spark, [LOG[4], LOG[3]]), 1)
    dim = w.star().dim_cliente
    assert rows(dim, "cliente_id", "segmento", "es_actual") == [
        (1, "estandar", True), (1, "vip", False), (2, "nuevo", True)]
    # The order keeps the version it was loaded with, the payment takes the new one.
    old, new = one(dim, "segmento = 'vip'"), one(dim, "segmento = 'estandar'")
    assert one(w.orders(), "pedido_id = 1").cliente_sk == old.cliente_sk
    assert one(w.star().fact_pagos, "true").cliente_sk == new.cliente_sk
    # Closed versions drop out of the segment report unless it is restated.
    star = w.star()
    assert rows(bi.customer_segments(star), "segmento", "total_pedidos") == []
    assert rows(bi.customer_segments(star, restate=True), "segmento", "total_pedidos") == [
        ("estandar", 1)]


def write_events(folder, name, items):
    folder.mkdir(exist_ok=True)
    keys = ["evento_negocio_id", "tipo_entidad", "entidad_id", "tipo_evento", "payload", "ocurrido_en"]
    text = "\n".join(json.dumps(dict(zip(keys, item)), default=lambda t: t.isoformat()) for item in items)
    (folder / f"{name}.json").write_text(text)


def test_stream_restarts_from_its_checkpoint(spark, tmp_path):
    log = ProgressLog()
    spark.streams.addListener(log)
    inbox = tmp_path / "inbox"
    write_events(inbox, "1", LOG[:5])
    write_events(inbox, "2", LOG[5:9])
    w = house(spark, tmp_path)
    events = E.read_events(spark, str(inbox), files_per_trigger=1)
    w.stream(events, "t", available_now=True).awaitTermination()
    write_events(inbox, "3", LOG[9:])
    w.stream(E.read_events(spark, str(inbox)), "t", available_now=True).awaitTermination()
    spark.streams.removeListener(log)
    batch = house(spark, tmp_path, "batch")
    batch.load_batch(frame(spark, LOG), 0)
    assert stable(state(w)) == stable(state(batch))
    assert rows(w.star().dlq_eventos, "evento_id") == [(11,)]
    assert w.table("fact_pedidos").read().count() == 2


def test_own_loader(spark, tmp_path):
    def loader(events, ctx):
        return events.filter("tipo_evento = 'cosa_rara'").select(
            F.col("evento_negocio_id").alias("id"), "tipo_evento")
    w = house(spark, tmp_path)
    w.extra = {"cosa_rara": ("fact_raros", loader)}
    w.extra_schemas = {"fact_raros": ("id bigint, tipo_evento string", ["id"])}
    w.load_batch(frame(spark, LOG[10:11]), 0)
    assert rows(w.table("fact_raros").read()) == [(11, "cosa_rara")]
    assert w.star().dlq_eventos.count() == 0


def test_views_over_a_loaded_warehouse(spark, tmp_path):
    w = house(spark, tmp_path)
    w.load_batch(frame(spark, LOG), 0)
    made = views.register_views(w.star())
    assert "vw_dlq_monitor" in made and "vw_stock_critico" in made
    assert spark.sql("SELECT count(*) c FROM vw_clientes_actuales").first().c == 2
    assert spark.sql("SELECT producto_id, stock_actual FROM vw_stock_critico ORDER BY 2").first() == (10, 0)
    for query in (bi.daily_sales, bi.top_products, bi.cart_conversion, bi.carrier_performance,
                  bi.returns_by_reason, bi.ticket_by_channel, bi.payment_methods,
                  bi.customer_segments, bi.inventory_rotation, bi.cohort_retention):
        assert query(w.star()).count() >= 1, query


def test_keyed_table(spark, tmp_path):
    schema = "k bigint, v string"
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=4, max_parts=3)
    from mercantil.operators.merge import merge_upsert, new_rows
    add = lambda old, new: new_rows(old, new, ["k"])
    for batch in range(8):
        data = spark.createDataFrame([(i, f"b{batch}") for i in range(batch * 5, batch * 5 + 10)], schema)
        assert table.insert(data, "w", batch, add)
        assert not table.insert(data, "w", batch, add)
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 45 and table.read().count() == 45
    assert got[7] == "b0" and got[10] == "b1" and got[44] == "b7"
    parts = [p for p in table._manifest()["parts"]]
    assert max(sum(p[0] == b for p in parts) for b in range(4)) <= 3
    change = spark.createDataFrame([(7, "new")], schema)
    table.merge(change, "other", 0, lambda old, new: merge_upsert(old, new, ["k"], replace=["v"]))
    assert one(table.read(), "k = 7").v == "new" and table.read().count() == 45
    assert table.last_batch("w") == 7 and table.last_batch("nobody") == -1
    before = rows(table.read())
    assert table.vacuum(keep=1) > 0
    assert rows(table.read()) == before


def test_unfinished_write_is_invisible(spark, tmp_path):
    schema = "k bigint, v string"
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=2)
    data = spark.createDataFrame([(1, "a")], schema)
    table.insert(data, "w", 0, lambda old, new: new)
    table._write(spark.createDataFrame([(2, "b")], schema), table._manifest())
    assert rows(table.read()) == [(1, "a")]


def test_keyed_source_tables_are_read_by_bucket(spark, tmp_path):
    from mercantil.sources.snapshots import KeyedCatalog
    from shop import SCHEMAS
    placed = {
        "clientes": "cliente_id", "direcciones_cliente": "cliente_id", "marcas": "marca_id",
        "categorias": "categoria_id", "productos": "producto_id", "variantes_producto": "variante_id",
        "precios_producto": "variante_id", "almacenes": "almacen_id", "pedidos": "pedido_id",
        "detalle_pedidos": "pedido_id", "pagos": "pago_id",
        "movimientos_inventario": "movimiento_inventario_id", "envios": "envio_id",
        "devoluciones": "devolucion_id", "detalle_devoluciones": "devolucion_id",
        "carritos": "carrito_id", "detalle_carritos": "carrito_id",
    }
    plain = shop(spark)
    tables = {}
    for name, key in placed.items():
        tables[name] = KeyedTable(spark, str(tmp_path / "src" / name), SCHEMAS[name], [key], buckets=8)
        tables[name].insert(getattr(plain, name), "copy", 0, lambda old, new: new)
    keyed = KeyedCatalog(tables)
    one_id = spark.createDataFrame([(1,)], "pedido_id bigint")
    assert keyed.rows_for("pedidos", one_id).count() < 3
    assert keyed.rows_for("pagos", one_id).count() == 2
    w = Warehouse(spark, str(tmp_path / "k"), keyed, CALENDAR, buckets=3)
    for i, chunk in enumerate((LOG[:6], LOG[6:])):
        w.load_batch(frame(spark, chunk), i)
    whole = house(spark, tmp_path, "plain")
    for i, chunk in enumerate((LOG[:6], LOG[6:])):
        whole.load_batch(frame(spark, chunk), i)
    assert state(w) == state(whole)


def test_folds_are_condensed(spark, tmp_path):
    from mercantil.operators import facts as L
    table = KeyedTable(spark, str(tmp_path / "f"), schemas.CONTROL["pedidos_plegados"],
                       ["pedido_id"], buckets=1, max_parts=2)
    for i in range(5):
        batch = parse_payload(frame(spark, [event(
            100 + i, "pedido_actualizado", '{"pedido_id":1,"estado_nuevo":"pagado"}',
            f"2024-01-{i + 1:02d}T00:00:00")]))
        table.insert(L.fold_orders(L.state_contributions(batch)), "w", i,
                     lambda old, new: new, compact=L.refold)
    assert table.read().count() <= 2
    assert one(L.refold(table.read()), "true").estado_pedido_sk_en.evento_negocio_id == 104


def test_start_up_check(spark, tmp_path):
    w = house(spark, tmp_path)
    assert w.verify() == [] and w.verify() == []
    marks = w.star().marcas_agua
    assert marks.count() == 8
    w.load_batch(frame(spark, LOG[:1]), 0)
    assert one(w.star().marcas_agua, "tabla_fuente = 'pedidos'").ultima_carga == ts("2024-01-05")
    assert w.star().marcas_agua.count() == 8
    short = Warehouse(spark, str(tmp_path / "s"), w.oltp.replace(
        pagos=w.oltp.pagos.drop("monto"), carritos=w.oltp.carritos.withColumn("estado", F.lit(1))),
        (dt.date(2024, 1, 1), dt.date(2024, 2, 1)))
    assert sorted(short.verify()) == ["calendario corto", "falta columna: pagos.monto",
                                      "otro tipo: carritos.estado"]


def test_a_delivery_keeps_the_attempts_of_its_event(spark):
    from mercantil.streaming.events import dedup_events

    rows = spark.createDataFrame([(1, "2024-01-01", 0), (1, "2024-01-02", 2), (2, "2024-01-01", 0)],
                                 "evento_negocio_id long, ocurrido_en string, intentos_olap int")
    found = {r.evento_negocio_id: r.intentos_olap for r in dedup_events(rows).collect()}
    assert found == {1: 2, 2: 0}


def test_row_errors(spark):
    """Each fault of a source row is told for the events that name it, and for no other."""
    from mercantil.streaming.row_errors import with_row_errors
    shop_ = shop(spark)
    text = lambda df, c, value, key: df.withColumn(c, F.when(F.col(key) == 1, F.lit(value)).otherwise(F.col(c).cast("string")))
    lines = shop_.detalle_carritos.withColumn("precio_unitario", F.col("precio_unitario").cast("decimal(30,2)") * 100_000_000)
    source = shop_.replace(
        pedidos=text(shop_.pedidos, "creado_en", "pronto", "pedido_id"),
        pagos=shop_.pagos.withColumn("pedido_id", F.when(F.col("pago_id") == 2, F.col("pedido_id"))),
        devoluciones=shop_.devoluciones.withColumn("motivo", F.repeat("motivo", 20)),
        envios=text(shop_.envios, "pedido_id", "99999999999999999999", "envio_id"),
        detalle_carritos=lines)
    routed = E.route_events(parse_payload(frame(spark, LOG)))
    found = {r.evento_negocio_id: r.error_fila for r in with_row_errors(routed, source).collect() if r.error_fila}
    assert found == {
        1: "pedidos.creado_en: valor fuera de rango o ilegible: pronto",
        3: "pagos.pedido_id: falta",
        7: "envios.pedido_id: valor fuera de rango o ilegible: 99999999999999999999",
        8: "devoluciones.motivo: más de 50 caracteres",
        9: "envios.pedido_id: valor fuera de rango o ilegible: 99999999999999999999",
        10: "carritos.valor_total: valor fuera de rango: 10700000000.00"}
    assert with_row_errors(routed, shop_).filter("error_fila IS NOT NULL").isEmpty()


def test_an_overflow_fails_its_event_only_and_loads_once_mended(spark, tmp_path):
    wide = shop(spark).detalle_carritos.withColumn("precio_unitario", F.lit("99999999999").cast("decimal(30,2)"))
    w = house(spark, tmp_path)
    good, w.oltp = w.oltp, w.oltp.replace(detalle_carritos=wide)
    assert w.load_batch(frame(spark, LOG), 0) and not w.load_batch(frame(spark, LOG), 0)
    assert rows(w.table("reintentos").read().filter("pendiente"), "evento_negocio_id") == [(10,), (12,)]
    assert w.star().fact_carritos.count() == 0 and w.orders().count() == 2
    w.oltp = good
    assert w.drain() == 2
    assert one(w.star().fact_carritos, "true").num_items == 2
    # The unreadable one is a dead letter now, without another file.
    assert rows(w.star().dlq_eventos, "evento_id", "motivo") == [(11, "sin_handler"), (12, "error_max_reintentos")]
    # Settled events are known by id: delivered again, none starts over.
    w.load_batch(frame(spark, LOG), 1)
    assert w.table("reintentos").read().filter("pendiente").isEmpty()
    assert w.ledger().table.read().count() == len(LOG)


def test_shipments_and_carts_fold_in_any_order(spark, tmp_path):
    log = [event(1, "envio_devuelto", '{"envio_id":1}', "2024-01-08T00:00:00"),
           event(2, "envio_entregado", '{"envio_id":1}', "2024-01-09T00:00:00"),
           event(3, "carrito_abandonado", '{"carrito_id":1}', "2024-01-09T00:00:00"),
           event(4, "carrito_convertido", '{"carrito_id":1}', "2024-01-10T00:00:00")]
    found = []
    for name, parts in (("a", [log]), ("b", [log[1:], log[:1]])):
        w = house(spark, tmp_path, name)
        for k, part in enumerate(parts):
            w.load_batch(frame(spark, part), k)
        found.append((rows(w.shipments().drop("cargado_en", "almacen_sk")), rows(w.carts().drop("cargado_en", "cliente_sk"))))
    assert found[0] == found[1]
    assert one(w.shipments(), "true").estado_envio == "entregado"


def test_a_running_stream_tries_again_without_new_files(spark, tmp_path):
    import time
    inbox = tmp_path / "inbox"
    write_events(inbox, "1", [LOG[11]])
    w = house(spark, tmp_path)
    query = w.stream(E.read_events(spark, str(inbox)), "t")
    try:
        for _ in range(120):
            if rows(w.star().dlq_eventos, "evento_id") == [(12,)]:
                break
            time.sleep(1)
    finally:
        query.stop()
    assert rows(w.star().dlq_eventos, "evento_id", "motivo") == [(12, "error_max_reintentos")]


def test_counters_of_batches(spark, tmp_path):
    w = house(spark, tmp_path)
    w.load_batch(frame(spark, LOG[:6]), 0)
    w.load_batch(frame(spark, LOG[6:]), 1)
    w.load_batch(frame(spark, LOG[6:]), 1)
    got = {r.lote: r.asDict() for r in w.counters().collect()}
    assert sorted(got) == [0, 1]
    facts = sum(getattr(w.star(), name).count() for name in FACTS)
    assert got[0]["insertados"] + got[1]["insertados"] == facts
    # Event 12 can't be read, 11 has no loader; 13 has no payload, which is not an error.
    assert [got[k]["procesados"] for k in (0, 1)] == [6, 6]
    assert [got[k]["errores"] for k in (0, 1)] == [0, 1]
    assert [got[k]["cartas"] for k in (0, 1)] == [0, 1]
    # Orders 1 and, by event 14, 2; the shipment and the cart.
    assert [got[k]["actualizados"] for k in (0, 1)] == [1, 3]


def test_counters_know_new_rows_from_condensed_ones(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k int, v int", ["k"], 1, max_parts=2)
    for batch in range(6):
        rows_ = spark.createDataFrame([(10 * batch + i, i) for i in range(batch)], "k int, v int")
        table.insert(rows_, "a", batch, lambda old, new: new)
        assert table.added("a", batch) == batch and table.added("a", batch - 1) == 0
    assert table.read().count() == 15 and table.added("b", 0) == 0


def test_a_batch_looks_source_rows_up_once(spark, tmp_path):
    """Checks, dimensions, facts and folds share the rows that the events of a batch name."""
    class Counted(Catalog):
        asked = []

        def rows_for(self, name, ids):
            Counted.asked.append(name)
            return super().rows_for(name, ids)

    w = house(spark, tmp_path)
    w.oltp = Counted(w.oltp._builders)
    w.load_batch(frame(spark, LOG[6:9:2]), 0)
    assert Counted.asked.count("envios") == 1
    assert one(w.shipments(), "true").estado_envio == "devuelto"


def shuffle_files(spark):
    """Ids of the shuffles that have files on this machine."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {int(n.split("_")[1]) for n in names if n.startswith("shuffle_")}


def gone(spark, before):
    """Whether no shuffle files are left but those of ``before``; Spark deletes them on the side."""
    for _ in range(40):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.25)
    return False


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    before = shuffle_files(spark)
    counts = spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count()
    counts.write.parquet(str(tmp_path / "t"))
    assert gone(spark, before)
    # A result that is asked for again is made again.
    assert rows(counts) == rows(counts) == [(k, 100) for k in range(10)]


def test_a_long_batch_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    """Neither its queries nor its caches: several batches would else need the disk of all."""
    before = shuffle_files(spark)
    w = house(spark, tmp_path)
    monkeypatch.setattr(loader, "RELEASE_SECONDS", 0)
    for k in range(2):
        w.load_batch(frame(spark, LOG[7 * k:7 * k + 7]), k)
    assert gone(spark, before)
    assert one(w.shipments(), "true").estado_envio == "devuelto"


def test_shipment_events_are_dealt_once(spark, tmp_path, monkeypatch):
    """Facts and folds of shipments get events that are dealt by shipment already."""
    dealt = []
    for name in ("load_fact_shipments", "shipment_contributions"):
        def spy(events, ctx, real=getattr(L, name)):
            # The plan of what is cached, its last shuffle first.
            dealt.append(re.search(r"Exchange (\w+\(\w+)", events._jdf.queryExecution().withCachedData().toString()).group(1))
            return real(events, ctx)
        monkeypatch.setattr(L, name, spy)
    w = house(spark, tmp_path)
    w.load_batch(frame(spark, LOG[6:9:2]), 0)
    assert dealt == ["hashpartitioning(envio_id"] * 2
    assert one(w.shipments(), "true").estado_envio == "devuelto"


def test_a_faulty_shipment_fails_its_events_only(spark, tmp_path):
    """Its events wait or become dead letters, the other shipments of the batch load."""
    stored = shop(spark).envios
    fault = stored.withColumn("envio_id", F.lit(99).cast("bigint")).withColumn("transportista", F.lit("x" * 101))
    w = house(spark, tmp_path)
    w.oltp = w.oltp.replace(envios=stored.unionByName(fault))
    log = [event(1, "envio_entregado", '{"envio_id":1}', "2024-01-09T00:00:00"),
           event(2, "envio_entregado", '{"envio_id":99}', "2024-01-09T00:00:00"),
           event(3, "envio_devuelto", '{"envio_id":99}', "2024-01-10T00:00:00"),
           event(4, "envio_entregado", '{"envio_id":12345}', "2024-01-10T00:00:00")]
    w.load_batch(frame(spark, log), 0)
    assert rows(w.shipments(), "envio_id") == [(1,)]
    assert rows(w.table("reintentos").read().filter("pendiente"), "evento_negocio_id") == [(2,), (3,)]
    w.drain()
    assert rows(w.star().dlq_eventos, "evento_id") == [(2,), (3,)] and rows(w.shipments(), "envio_id") == [(1,)]


def test_rows_that_are_only_added_need_no_look(spark, tmp_path, monkeypatch):
    """Without a choice of rows, an insert neither caches them nor reads the table."""
    table = KeyedTable(spark, str(tmp_path / "t"), "k int, v int", ["k"], 2, max_parts=2)
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *a: 1 / 0)
    for batch in range(5):
        table.insert(spark.createDataFrame([(k, batch) for k in range(4)], "k int, v int"), "a", batch)
        assert table.added("a", batch) == 4
    assert not table.insert(spark.createDataFrame([(1, 1)], "k int, v int"), "a", 4)
    assert rows(table.read()) == [(k, v) for k in range(4) for v in range(5)]
    assert max(Counter(bucket for bucket, _ in table._manifest()["parts"]).values()) <= 3


def test_a_row_that_its_order_tells_is_sent_once(spark):
    """Deduplication by all columns sends each event once, not as row and as order."""
    log = frame(spark, [*LOG, *LOG]).withColumn("intentos_olap", F.lit(0))
    found = E.dedup_events(log)
    assert "min_by" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == rows(frame(spark, LOG).withColumn("intentos_olap", F.lit(0)))


def test_settled_days_are_told_apart(spark, tmp_path):
    """An id is settled for its own day; days may be looked up in rows that are not deduplicated."""
    w = house(spark, tmp_path)
    every = frame(spark, [event(1, "x", None, "2024-01-05T00:00:00"), event(2, "x", None, "2024-01-06T00:00:00"),
                          event(None, "x", None, "2024-01-05T00:00:00")])
    w.ledger().settle(every.filter("evento_negocio_id = 1 OR evento_negocio_id IS NULL"), "a", 0)
    again = frame(spark, [event(1, "x", None, "2024-01-05T00:00:00"), event(1, "x", None, "2024-01-07T00:00:00"),
                          event(None, "x", None, "2024-01-05T00:00:00"), event(2, "x", None, "2024-01-05T00:00:00")])
    left = w.ledger().unseen(again, among=again.unionByName(every))
    assert rows(left, "evento_negocio_id", "ocurrido_en") == [
        (1, ts("2024-01-07")), (2, ts("2024-01-05")), (None, ts("2024-01-05"))]

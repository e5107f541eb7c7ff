"""Every query by name, bound to the given tables.

Library functions keep decimals, short integers, dates and timestamps;
``comparable`` turns results into types that any engine prints alike.
"""

from __future__ import annotations

import copy
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercantil import schemas
from mercantil.functions import constants as C
from mercantil.functions import expressions as X
from mercantil.functions.payload import CORRUPT, NAMES, parse_payload
from mercantil.operators import dims as D
from mercantil.operators import facts as L
from mercantil.operators import lifecycle as O
from mercantil.operators import merge as M
from mercantil.operators import pricing as P
from mercantil.operators import quality as Q
from mercantil.operators import scd2 as S
from mercantil.operators import stock as K
from mercantil.plans import bi, views
from mercantil.session import configure, shared_dir
from mercantil.sources import retail as R
from mercantil.sources.snapshots import KeyedTable
from mercantil.sources.star import constant_dims, star_catalog
from mercantil.sources.tables import RAW_SCHEMAS, Catalog, raw_catalog
from mercantil.streaming import events as E
from mercantil.streaming.health import pipeline_health
from mercantil.streaming.ledger import EventLedger
from mercantil.streaming.loader import Warehouse
from mercantil.streaming.row_errors import with_row_errors

# Start of all versions in a first load, and the moment rules are evaluated at.
LOAD_TIME = "1995-01-01 00:00:00"
NOW = "2001-06-01 00:00:00"
SEEN_AT = "2024-02-01 00:00:00"


def at(text: str):
    return F.lit(text).cast("timestamp")


class Source:
    """Catalogs over one folder of given tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.raw = raw_catalog(spark, root.rstrip("/"))
        self.root = root.rstrip("/")
        self.oltp = R.source_catalog(self.raw)
        self.star = star_catalog(spark, self.raw, self.oltp)
        self.log = R.event_log(self.oltp)
        ts = at(LOAD_TIME)
        self.dims = Catalog({
            "dim_cliente": lambda: D.dim_customer_scd2(self.oltp, ts),
            "dim_producto": lambda: D.dim_product_scd2(self.oltp, ts),
            "dim_variante": lambda: D.dim_variant_scd2(self.oltp, self.dims.dim_producto, ts),
            "dim_almacen": lambda: D.dim_warehouse(self.oltp.almacenes),
            **constant_dims(spark, R.CALENDAR_START, R.CALENDAR_END),
        })
        self.ctx = L.LoadContext(self.oltp, self.dims, (R.CALENDAR_START, R.CALENDAR_END))

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        path = _folder(self, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def held(self, *names: str) -> Source:
        """This source with some of its tables written once, as they are read several times.

        Where there are several, the lines that they are views of are written first.
        """
        lines = self._written(R.numbered_lines(self.raw.lineitem), "lines") if len(names) > 1 else None
        oltp = R.source_catalog(self.raw, lines)
        # Without a join or a window of its own, a view of written lines is as good as a table.
        tables = {name: self._written(getattr(oltp, name), name) for name in names if lines is None or name == "envios"}
        other = copy.copy(self)
        other.oltp = oltp.replace(**tables)
        other.log = R.event_log(other.oltp)
        other.ctx = replace(self.ctx, oltp=other.oltp)
        return other

    def parsed(self, kind: str) -> DataFrame:
        return parse_payload(getattr(self.log, kind))

    def stream(self) -> DataFrame:
        """Events of the ``events`` table, parsed."""
        return parse_payload(self.oltp.eventos_negocio)

    def routed(self) -> DataFrame:
        return E.route_events(self.stream())

    def good(self) -> DataFrame:
        return self.routed().filter(F.col("cargador").isNotNull() & F.col(CORRUPT).isNull())

    def created_orders(self) -> DataFrame:
        return L.load_fact_orders(self.parsed("orders"), self.ctx)

    def customer_changes(self) -> DataFrame:
        """Change log of customers: the priority of each order as their segment."""
        return self.raw.orders.select(
            F.col("o_custkey").alias("cliente_id"), F.col("o_orderpriority").alias("segmento"),
            F.col("o_orderdate").alias("cambiado_en"), F.col("o_orderkey").alias("cambio_id"))

    def customer_versions(self) -> DataFrame:
        return S.scd2_history(self.customer_changes(), "cliente_id", "cliente_sk", ["segmento"],
                              "cambiado_en", "cambio_id")


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double, integers as bigint, dates and instants as text."""
    def plain(field: T.StructField):
        col, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(field.name)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return col.cast("bigint").alias(field.name)
        if isinstance(kind, T.DateType):
            return F.date_format(col, "yyyy-MM-dd").alias(field.name)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return col
    return df.select(*[plain(field) for field in df.schema.fields])


# --- dimensions -------------------------------------------------------------

def _dim_seeds(s: Source) -> DataFrame:
    """Seed lists with the number of rows that use each entry."""
    orders, pagos = s.oltp.pedidos, s.oltp.pagos
    def use(df, key, dim, sk, kind, name):
        n = df.groupBy(key.alias(sk)).agg(F.count("*").alias("usos"))
        return F.broadcast(dim).join(n, sk, "left").select(
            F.lit(kind).alias("dimension"), F.col(sk).alias("clave"), F.col(name).alias("valor"),
            F.coalesce("usos", F.lit(0)).alias("usos"))
    return (
        use(orders, X.order_state_key("estado_actual"), s.dims.dim_estado_pedido,
            "estado_pedido_sk", "estado", "estado")
        .unionByName(use(orders, X.channel_key("canal_venta"), s.dims.dim_canal, "canal_sk",
                         "canal", "canal"))
        .unionByName(use(pagos, X.payment_method_key("metodo_pago"), s.dims.dim_metodo_pago,
                         "metodo_pago_sk", "metodo", "metodo_pago"))
    )


def _date_key(s: Source) -> DataFrame:
    """Days of ISO strings built from event times, against a calendar that ends mid-month."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    day = X.day_of(X.instant_of(text))
    start, end = R.dt.date(2020, 1, 1), R.dt.date(2024, 1, 15)
    return s.raw.events.select(
        "event_id", text.alias("texto"), X.date_key(day, start, end).alias("fecha_sk"))


def _closed(s: Source) -> DataFrame:
    """Customers with an order of status P lose their current version."""
    ids = s.raw.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("cliente_id"))
    dim = D.dim_customer_scd2(s.oltp, at(LOAD_TIME))
    return S.scd2_close(dim, ids, "cliente_id", at(NOW)).select(
        "cliente_sk", "cliente_id", "valido_desde", "valido_hasta", "es_actual")


def _customer_dim(s: Source) -> DataFrame:
    """Loaded once, then merged with a snapshot that moved some customers.

    Clients with negative balance become 'inactivo'; those with an even id
    only change their mail, which opens no version.
    """
    first = D.dim_customer_scd2(s.oltp, at(LOAD_TIME))
    later = s.oltp.clientes.withColumn(
        "estado", F.when(F.col("estado") == "bloqueado", "inactivo").otherwise(F.col("estado"))
    ).withColumn("correo", F.when(F.col("cliente_id") % 2 == 0, "nuevo@example.com")
                 .otherwise(F.col("correo")))
    return D.dim_customer_scd2(s.oltp.replace(clientes=later), at(NOW), dim=first)


def _product_dim(s: Source) -> DataFrame:
    """Loaded once, then products of brand 3 are renamed."""
    first = D.dim_product_scd2(s.oltp, at(LOAD_TIME))
    renamed = s.oltp.productos.withColumn(
        "nombre", F.when(F.col("marca_id") == 3, F.concat(F.col("nombre"), F.lit(" II")))
        .otherwise(F.col("nombre")))
    return D.dim_product_scd2(s.oltp.replace(productos=renamed), at(NOW), dim=first)


def _variant_dim(s: Source) -> DataFrame:
    """Loaded once, then even variants are dropped from sale."""
    products = s.dims.dim_producto
    first = D.dim_variant_scd2(s.oltp, products, at(LOAD_TIME))
    later = s.oltp.variantes_producto.withColumn(
        "activa", F.col("activa") & (F.col("variante_id") % 2 == 1))
    return D.dim_variant_scd2(
        s.oltp.replace(variantes_producto=later), products, at(NOW), dim=first)


def _warehouse_dim(s: Source) -> DataFrame:
    """Even warehouses known under an old name keep it; odd ones are inserted."""
    known = D.dim_warehouse(s.oltp.almacenes.filter("almacen_id % 2 = 0")
                            .withColumn("nombre", F.concat(F.lit("Antiguo "), F.col("nombre"))))
    return D.dim_warehouse(s.oltp.almacenes, known)


def _promotion_dim(s: Source) -> DataFrame:
    """Promotions known under an old name take the new one."""
    known = D.dim_promotion(s.oltp.promociones.filter("promocion_id % 2 = 0")
                            .withColumn("nombre", F.lit("Antigua")))
    return D.dim_promotion(s.oltp.promociones, known)


# --- facts ------------------------------------------------------------------

def _drop_stamp(df: DataFrame) -> DataFrame:
    return df.drop("cargado_en", "_entregado")


def _created_by_stream(s: Source) -> DataFrame:
    """Facts of the orders whose creation is in the ``events`` table."""
    return L.load_fact_orders(s.good(), s.ctx)


def _fold(s: Source, contributions: DataFrame) -> DataFrame:
    fold = L.fold_orders(contributions)
    return L.apply_fold(_created_by_stream(s), fold).select(
        "pedido_id", "estado_pedido_sk", "estado_fulfillment", "estado_pago", "total_final")


def _shipments(s: Source) -> DataFrame:
    s = s.held("envios")
    return _drop_stamp(L.load_fact_shipments(s.parsed("shipments"), s.ctx))


def _shipments_returned(s: Source) -> DataFrame:
    """Facts from deliveries of all shipments, then the returns merged in."""
    s = s.held("envios")
    everything = parse_payload(s.oltp.envios.filter("entregado_en IS NOT NULL").selectExpr(
        *R._event("'envio_entregado'", "entregado_en", "envio_id * 8 + 6", "envio_id")))
    delivered = L.load_fact_shipments(
        everything, L.LoadContext(
            s.oltp.replace(envios=s.oltp.envios.withColumn(
                "estado_envio", F.lit("entregado"))), s.dims, s.ctx.calendar))
    returned = L.load_fact_shipments(
        s.parsed("shipments").filter("tipo_evento = 'envio_devuelto'"), s.ctx)
    return _drop_stamp(L.merge_shipments(delivered, returned))


# --- merges -----------------------------------------------------------------

def _merge_insert(s: Source) -> DataFrame:
    """Raw lines merged into a table that holds those of odd orders."""
    rows = s.raw.lineitem.select(
        F.expr(R.LINE_KEY).alias("detalle_pedido_id"), *[F.col(c) for c in R.LINE_ORDER])
    known = s.raw.lineitem.filter("l_orderkey % 2 = 1").select(
        F.expr(R.LINE_KEY).alias("detalle_pedido_id")).distinct().select(
        "detalle_pedido_id", F.lit(0).cast("bigint").alias("l_partkey"),
        *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in R.LINE_ORDER[1:]])
    return M.merge_insert_only(known, rows, ["detalle_pedido_id"], R.LINE_ORDER)


def _merge_upsert(s: Source) -> DataFrame:
    """Carts up to mid January, upserted with those from 10 January on."""
    carts = L.load_fact_carts(s.parsed("carts"), s.ctx)
    old = carts.filter("fecha_sk <= 10607").withColumn("convertido", F.lit(False)).withColumn(
        "estado", F.lit("activo")).withColumn("num_items", F.lit(0))
    return _drop_stamp(L.merge_carts(old, carts.filter("fecha_sk >= 10602")))


def _merge_update(s: Source) -> DataFrame:
    """Orders take the state of their last payment; no payment, no change."""
    last = O.latest_captured(s.oltp.pagos).select("pedido_id", F.lit("pagado").alias("estado_pago"))
    target = s.oltp.pedidos.select("pedido_id", "cliente_id", "estado_pago", "total_final")
    return M.merge_update_only(target, last, ["pedido_id"], ["estado_pago"])


# --- pipeline ---------------------------------------------------------------

#: Files that a log is delivered in, and those that one micro-batch takes.
FILES, FILES_PER_BATCH = 4, 2


def _delivered(s: Source, log: DataFrame, name: str) -> tuple[str, DataFrame]:
    """A log written as files, and the stream that reads some of them at a time."""
    inbox = _folder(s, f"{name}-inbox")
    extra = {"tipo_entidad": F.lit("x"), "entidad_id": F.lit(None).cast("bigint")}
    envelopes = log.withColumns({name: value for name, value in extra.items() if name not in log.columns}).select(
        *[c.split()[0] for c in schemas.EVENTS.split(", ")])
    envelopes.repartition(FILES, "evento_negocio_id").write.parquet(inbox)
    return inbox, E.read_events(s.spark, inbox, "parquet", files_per_trigger=FILES_PER_BATCH)


def _read_events(s: Source) -> DataFrame:
    """The log as a stream in several micro-batches, stopped and started again for the later half.

    The second run goes on where the first one's checkpoint ends.
    """
    path, log = _folder(s, "read"), s.oltp.eventos_negocio
    inbox, events = _delivered(s, log.filter("evento_negocio_id % 2 = 0"), "read")

    def run() -> None:
        (events.select(*log.columns).writeStream.format("parquet").option("checkpointLocation", f"{path}/_checkpoint")
         .trigger(availableNow=True).start(f"{path}/log").awaitTermination())

    run()
    late, _ = _delivered(s, log.filter("evento_negocio_id % 2 <> 0"), "late")
    s.spark.read.schema(schemas.EVENTS).parquet(late).write.mode("append").parquet(inbox)
    run()
    return s.spark.read.schema(log.schema).parquet(f"{path}/log")


def _parse_payload(s: Source) -> DataFrame:
    return s.stream().select("evento_negocio_id", *NAMES, CORRUPT)


def _route_events(s: Source) -> DataFrame:
    return s.routed().groupBy("cargador", "tipo_evento").agg(
        F.count("*").alias("eventos"), F.min("ocurrido_en").alias("primero"),
        F.max("ocurrido_en").alias("ultimo"))


def _failed(s: Source) -> DataFrame:
    """Unreadable events, the earlier half of the ids being at their third attempt."""
    attempts = F.when(F.col("evento_negocio_id") % 2 == 0, 2).otherwise(0)
    return E.failed_events(s.routed().withColumn("intentos_olap", attempts))


def _dlq(s: Source) -> DataFrame:
    return E.dlq_unhandled(s.routed(), at(SEEN_AT)).unionByName(
        E.dlq_failed(_failed(s), at(SEEN_AT)))


def _dlq_put(s: Source) -> DataFrame:
    """Letters put twice, once into a table that knows the ids divisible by 7."""
    letters = _dlq(s)
    known = letters.filter("evento_id % 7 = 0").withColumn("motivo", F.lit("error_max_reintentos"))
    return E.dlq_put(E.dlq_put(known, letters), letters)


def _dedup(s: Source) -> DataFrame:
    """The log read twice, the second copy one minute later."""
    log = s.oltp.eventos_negocio
    again = log.withColumn("ocurrido_en", F.col("ocurrido_en") + F.expr("INTERVAL '1' MINUTE"))
    return E.dedup_events(log.unionByName(again)).select(
        "evento_negocio_id", "tipo_evento", "payload", "ocurrido_en")


def _watermarks(s: Source) -> DataFrame:
    start = s.spark.createDataFrame([(name,) for name in E.C.WATERMARK_SOURCES],
                                    "tabla_fuente string").select(
        "tabla_fuente", at("2020-01-01 00:00:00").alias("ultima_carga"),
        at("2020-01-01 00:00:00").alias("actualizado_en"))
    return E.update_watermarks(start, E.watermarks(s.routed(), at(SEEN_AT)))


def _health(s: Source) -> DataFrame:
    good = s.good()
    missing = good.filter("cargador = 'payment'").select("pago_id").join(
        s.oltp.pagos, "pago_id", "left_anti")
    return pipeline_health(
        E.to_retry(_failed(s)), _dlq(s), _created_by_stream(s),
        L.load_fact_shipments(s.parsed("shipments"), s.ctx),
        L.load_fact_carts(good, s.ctx), E.watermarks(s.routed(), at(SEEN_AT)), missing)


def _folder(s: Source, name: str) -> str:
    return f"{shared_dir(s.spark)}/mercantil/{name}-{uuid.uuid4().hex}"


def _house(s: Source, name: str, oltp: Catalog | None = None) -> Warehouse:
    return Warehouse(s.spark, _folder(s, name), oltp or s.oltp, (R.CALENDAR_START, R.CALENDAR_END), buckets=8)


def _streamed(s: Source, house: Warehouse, kinds: tuple[str, ...] | None = None) -> Warehouse:
    """The ``events`` table, or some types of it, run as a stream into a warehouse folder."""
    # The pattern matches one file as well as a folder of files.
    raw = E.read_events(s.spark, f"{s.root}/events*.parquet", "parquet", schema=RAW_SCHEMAS["events"])
    events = R.stream_events(raw)
    if kinds:
        events = events.filter(F.col("tipo_evento").isin(*kinds))
    house.stream(events, "events", available_now=True).awaitTermination()
    return house


def _in_batches(s: Source, house: Warehouse, log: DataFrame, batches: int) -> Warehouse:
    """Events dealt to batches by a hash of their number, so that later ones come first as well."""
    dealt = log.withColumn("tipo_entidad", F.lit("x")).withColumn("entidad_id", F.lit(None).cast("bigint"))
    for k in range(batches):
        house.load_batch(dealt.filter(F.pmod(F.xxhash64("evento_negocio_id"), F.lit(batches)) == k), k)
    return house


def _stream_orders(s: Source) -> DataFrame:
    return _streamed(s, _house(s, "stream")).orders().select(
        "pedido_id", "numero_pedido", "estado_pedido_sk", "estado_fulfillment", "estado_pago",
        "num_items", "total_final")


def _stream_carts(s: Source) -> DataFrame:
    kinds = tuple(E.C.EVENTS_BY_LOADER["cart"])
    return _streamed(s, _house(s, "carts"), kinds).carts().select(
        "carrito_id", "fecha_sk", "estado", "num_items", "valor_total", "convertido")


def _stream_payments(s: Source) -> DataFrame:
    kinds = tuple(E.C.EVENTS_BY_LOADER["payment"])
    return _streamed(s, _house(s, "payments"), kinds).star().fact_pagos.select(
        "pago_id", "pedido_id", "fecha_sk", "metodo_pago_sk", "monto", "estado", "proveedor_pago")


def _stream_shipments(s: Source) -> DataFrame:
    """Every shipment delivered, and returned an hour later if it was, in two batches without order."""
    s = s.held("envios")
    delivered = s.oltp.envios.filter("entregado_en IS NOT NULL").selectExpr(
        *R._event("'envio_entregado'", "entregado_en", "envio_id * 8 + 6", "envio_id"))
    returned = s.oltp.envios.filter("estado_envio = 'devuelto'").selectExpr(
        *R._event("'envio_devuelto'", "entregado_en + INTERVAL '1' HOUR", "envio_id * 8 + 3", "envio_id"))
    log = delivered.unionByName(returned)
    # Their stored state says nothing of returns here.
    oltp = s.oltp.replace(envios=s.oltp.envios.withColumn("estado_envio", F.lit("entregado")))
    return _in_batches(s, _house(s, "shipments", oltp), log, 2).shipments().select(
        "envio_id", "pedido_id", "fecha_envio_sk", "fecha_entrega_sk", "estado_envio", "transportista", "dias_entrega")


def _loaded(s: Source, log: DataFrame, name: str) -> Catalog:
    """The star after a log came in as several files, some of them a micro-batch."""
    house = _house(s, name)
    house.stream(_delivered(s, log, name)[1], name, available_now=True).awaitTermination()
    return house.star()


def _stream_stock(s: Source) -> DataFrame:
    s = s.held("movimientos_inventario")
    return _loaded(s, s.log.stock, "stock").fact_movimientos_inventario.select(
        "movimiento_id", "fecha_sk", "tipo_movimiento", "cantidad", "tipo_referencia", "referencia_id")


def _stream_returns(s: Source) -> DataFrame:
    s = s.held("devoluciones", "detalle_devoluciones")
    return _loaded(s, s.log.returns, "returns").fact_devoluciones.select(
        "devolucion_id", "pedido_id", "fecha_sk", "motivo", "estado", "cantidad_devuelta")


def _health_counters(s: Source) -> DataFrame:
    """What the loader counted while the ``events`` table came in as a stream."""
    return _streamed(s, _house(s, "counters")).counters().agg(
        *[F.sum(c).alias(c) for c in ("procesados", "errores", "cartas", "insertados", "actualizados")])


def _retry_stream(s: Source) -> DataFrame:
    """What becomes of the stream's faulty events, tried three times with no further file.

    An event that still waited would be a row with reason 'en_espera'.
    """
    house = _streamed(s, _house(s, "retry"))
    house.drain()
    waiting = house.table("reintentos").read().filter("pendiente").select(
        F.col("evento_negocio_id").alias("evento_id"), "tipo_evento", F.lit("en_espera").alias("motivo"),
        F.col("error_olap").alias("error_detalle"))
    return house.star().dlq_eventos.select("evento_id", "tipo_evento", "motivo", "error_detalle").unionByName(waiting)


#: Deliveries of the log; a delivery repeats that of the event before it, some of which occurred days ago.
DELIVERIES = 5


def _dedup_stream(s: Source) -> DataFrame:
    """The log delivered in several files, each with the rows of the one before again.

    A query that stops and starts again with each file drops every event that an earlier
    file settled; ``lote`` is the file that an event came with first.
    """
    inbox, path = _folder(s, "inbox"), _folder(s, "dedup")
    ledger = EventLedger(KeyedTable(s.spark, f"{path}/eventos_vistos", schemas.CONTROL["eventos_vistos"], ["dia"], 8))
    schema = f"{schemas.EVENTS}, lote int"
    seen = KeyedTable(s.spark, f"{path}/eventos", schema, ["evento_negocio_id"], 8)

    def load(batch: DataFrame, batch_id: int) -> None:
        fresh = E.dedup_events(ledger.unseen(batch)).persist()
        seen.insert(fresh, "dedup", batch_id)
        ledger.settle(fresh, "dedup", batch_id)
        fresh.unpersist()

    for k in range(DELIVERIES):
        part = F.pmod(F.col("evento_negocio_id"), F.lit(DELIVERIES))
        s.oltp.eventos_negocio.filter((part == k) | (part == k - 1)).withColumn("lote", F.lit(k)).write.parquet(
            f"{inbox}/{k}")
        stream = E.read_events(s.spark, f"{inbox}/*", "parquet", schema=schema)
        (stream.writeStream.foreachBatch(load).option("checkpointLocation", f"{path}/_checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    return seen.read().select("evento_negocio_id", "tipo_evento", "ocurrido_en", "lote")


def _row_errors(s: Source) -> DataFrame:
    """Dead letters of orders, payments and carts whose source rows don't fit.

    Some orders have no readable date, some payments no order, and some prices are so large
    that they, or the value of their cart, are beyond the money type.
    """
    factor = F.expr("CASE WHEN detalle_carrito_id % 103 = 0 THEN 1000000000 WHEN detalle_carrito_id % 101 = 0 "
                    "THEN 10000000 ELSE 1 END")
    oltp = s.oltp.replace(
        pedidos=s.oltp.pedidos.withColumn("creado_en", F.when(
            F.col("pedido_id") % 97 == 0, "sin fecha").otherwise(F.col("creado_en").cast("string"))),
        pagos=s.oltp.pagos.withColumn("pedido_id", F.when(F.col("pago_id") % 89 != 0, F.col("pedido_id"))),
        detalle_carritos=s.oltp.detalle_carritos.withColumn(
            "precio_unitario", (F.col("precio_unitario") * factor).cast("decimal(30,2)")))
    log = s.log.orders.unionByName(s.log.payments).unionByName(s.log.carts)
    routed = E.route_events(parse_payload(log)).withColumn("intentos_olap", F.lit(2))
    failed = E.failed_events(with_row_errors(routed, oltp, ("order_created", "payment", "cart")))
    return E.dlq_failed(failed, at(SEEN_AT)).select("evento_id", "tipo_evento", "motivo", "error_detalle")


# --- rules ------------------------------------------------------------------

def _price_lines(s: Source) -> DataFrame:
    lines = s.oltp.detalle_pedidos.drop("impuesto_linea", "total_linea")
    return P.price_order_lines(lines).select(
        "detalle_pedido_id", "bruto_linea", "neto_linea", "impuesto_linea", "total_linea")


def _price_orders(s: Source) -> DataFrame:
    """Every fifth order has a tenth off; shipping costs 4990 below the threshold."""
    charges = s.oltp.pedidos.select(
        "pedido_id", F.expr("CASE WHEN pedido_id % 5 = 0 THEN CAST(100 AS DECIMAL(12,2)) END")
        .alias("descuento_total"), F.lit(4990).cast(X.MONEY).alias("tarifa_envio"))
    return P.price_orders(s.oltp.detalle_pedidos, charges)


def _allocated(s: Source) -> DataFrame:
    lines = s.oltp.detalle_pedidos.select(
        "detalle_pedido_id", "pedido_id", "variante_id", "almacen_id",
        (F.col("cantidad") * 2).alias("cantidad"))
    return K.allocate_warehouse(lines, s.oltp.niveles_stock)


def _oversold(s: Source) -> DataFrame:
    return K.mark_oversold(
        _allocated(s), s.oltp.niveles_stock, ["pedido_id", "detalle_pedido_id"]).select(
        "detalle_pedido_id", "almacen_id", "demanda_acumulada", "excede_stock")


def _ledger(s: Source) -> DataFrame:
    opening = s.oltp.niveles_stock.select(
        "almacen_id", "variante_id", F.lit(5).cast("bigint").alias("cantidad_fisica"),
        F.lit(1).cast("bigint").alias("cantidad_reservada"))
    return K.stock_ledger(s.oltp.movimientos_inventario, opening).select(
        "movimiento_inventario_id", "almacen_id", "variante_id", "cantidad_fisica",
        "cantidad_reservada", "cantidad_disponible")


def _lifecycle(s: Source) -> DataFrame:
    return O.lifecycle_due(s.oltp.pedidos, at(NOW))


def _cart_links(s: Source) -> DataFrame:
    """Carts tied to orders by conversion events: one order per cart of a user."""
    events = s.stream().withColumn(
        "pedido_id", F.when(F.col("tipo_evento") == "carrito_convertido", F.col("entidad_id"))
        .otherwise(F.col("pedido_id")))
    links = O.cart_order_link(events)
    orders = s.oltp.pedidos.select("pedido_id", "estado_pago")
    return O.cart_funnel(s.oltp.carritos, links, orders)


# --- quality ----------------------------------------------------------------

#: Keys of the facts that must be in a dimension, and ids of source tables that must be unique.
DIMENSION_KEYS = {
    "fact_pedidos": ["cliente_sk", "fecha_sk"], "fact_detalle_pedidos": ["producto_sk"],
    "fact_movimientos_inventario": ["fecha_sk", "almacen_sk"],
    "fact_devoluciones": ["producto_sk"], "fact_carritos": ["cliente_sk", "fecha_sk"],
}
SOURCE_KEYS = {
    "pedidos": "pedido_id", "detalle_pedidos": "detalle_pedido_id", "pagos": "pago_id",
    "envios": "envio_id", "carritos": "carrito_id", "devoluciones": "devolucion_id",
}


def _dq_report(s: Source) -> DataFrame:
    s = s.held("detalle_pedidos", "envios", "devoluciones", "detalle_devoluciones")
    o, star = s.oltp, s.star
    listed: dict[str, list[str]] = {}
    for table, column in C.ENUMERATIONS:
        listed.setdefault(table, []).append(column)
    signed = ["pedidos", "detalle_pedidos", "pagos", "niveles_stock", "detalle_devoluciones",
              "precios_producto", "variantes_producto", "detalle_carritos"]
    row_rules: dict[str, tuple[DataFrame, dict]] = {}
    for table in dict.fromkeys([*listed, *signed]):
        df = _dlq(s) if table == "dlq_eventos" else getattr(o, table)
        rules = {f"C2 {table}.{c}": Q.not_listed(table, c) for c in listed.get(table, [])}
        if table in signed:
            rules[f"C3 {table}"] = Q.bad_sign(table, df.columns)
        if table == "pedidos":
            rules["C1 total de pedido"] = Q.total_mismatch()
        row_rules[table] = (df, rules)
    versions = Q.with_version_marks(s.customer_versions(), "cliente_id")
    row_rules["versiones"] = (versions, {
        "C7 cierre de version": Q.incoherent_version(),
        "C7 version actual": Q.second_current_version(),
        "C7 cruce de versiones": Q.overlapping_version()})
    # The given tables hold no reviews; line numbers stand in for ratings.
    ratings = s.raw.lineitem.select(F.col("l_linenumber").alias("calificacion"))
    row_rules["resenas"] = (ratings, {"C9 calificacion": Q.bad_rating()})
    dims = {"cliente_sk": star.dim_cliente, "fecha_sk": F.broadcast(star.dim_fecha),
            "producto_sk": star.dim_producto, "almacen_sk": star.dim_almacen}
    for fact, keys in DIMENSION_KEYS.items():
        row_rules[fact] = (
            Q.with_dimensions(getattr(star, fact), {k: dims[k] for k in keys}),
            {f"C8 {fact}.{k}": Q.missing_in_dimension(k) for k in keys})
    keys = Q.repeated_keys({
        f"C4 {table}.{key}": (getattr(o, table), key) for table, key in SOURCE_KEYS.items()})
    return Q.dq_report(row_rules, {
        "C4 lineas repetidas": Q.duplicate_keys(s.raw.lineitem, ["l_orderkey", "l_linenumber"]),
        "C5 envio activo": Q.several_active_shipments(o.envios),
        "C6 devolucion activa": Q.several_active_returns(o.devoluciones),
        "C7 cruce de envios": Q.overlapping_intervals(
            o.envios, "pedido_id", "enviado_en", "entregado_en"),
        "C10 calendario": Q.short_calendar(D.calendar_for(s.raw.orders, "o_orderdate")),
    }).unionByName(keys)


# Prices are looked at for every variant that was sold.
def _snapshot(s: Source) -> DataFrame:
    return P.product_snapshot(s.oltp, s.oltp.detalle_pedidos.select("variante_id"))


def _movement_columns(df: DataFrame) -> DataFrame:
    """Movements summed, as they carry no id of their own yet."""
    return df.groupBy("almacen_id", "variante_id", "tipo_movimiento", "tipo_referencia",
                      "referencia_id").agg(F.sum("cantidad").alias("cantidad"),
                                           F.count("*").alias("filas"))


QUERIES: dict[str, Callable[[Source], DataFrame]] = {
    # BI queries
    "daily_sales": lambda s: bi.daily_sales(s.star),
    "top_products": lambda s: bi.top_products(s.star),
    "cart_conversion": lambda s: bi.cart_conversion(s.star),
    "carrier_performance": lambda s: bi.carrier_performance(s.star),
    "returns_by_reason": lambda s: bi.returns_by_reason(s.star),
    "ticket_by_channel": lambda s: bi.ticket_by_channel(s.star),
    "payment_methods": lambda s: bi.payment_methods(s.star),
    "customer_segments": lambda s: bi.customer_segments(s.star),
    "inventory_rotation": lambda s: bi.inventory_rotation(s.star),
    "cohort_retention": lambda s: bi.cohort_retention(s.star),
    # views
    "view_geo_sales": lambda s: views.geo_sales(s.star),
    "view_current_customers": lambda s: views.current_customers(s.customer_versions()),
    "view_customer_history": lambda s: views.customer_history(_customer_dim(s)),
    "view_carrier_summary": lambda s: views.carrier_summary(s.star),
    "view_returns_summary": lambda s: views.returns_summary(s.star),
    "view_critical_stock": lambda s: views.critical_stock(
        s.oltp.niveles_stock, s.oltp.variantes_producto),
    "view_dlq_monitor": lambda s: views.dlq_monitor(_dlq(s)),
    "view_dlq_by_reason": lambda s: views.dlq_by_reason(_dlq(s)),
    # headline numbers
    "kpi_sales": lambda s: bi.kpi_sales(s.star),
    "kpi_carts": lambda s: bi.kpi_carts(s.star),
    "kpi_payments": lambda s: bi.kpi_payments(s.star),
    "kpi_retention": lambda s: bi.kpi_retention(s.star),
    # dimensions
    "dim_date": lambda s: D.calendar_for(s.raw.orders, "o_orderdate"),
    "scd2_close": _closed,
    "scd2_history": lambda s: s.customer_versions(),
    "dim_customer_scd2": _customer_dim,
    "dim_product_scd2": _product_dim,
    "dim_variant_scd2": _variant_dim,
    "latest_price": lambda s: D.latest_price(s.oltp.precios_producto),
    "dim_warehouse": _warehouse_dim,
    "dim_seeds": _dim_seeds,
    "dim_promotion": _promotion_dim,
    "date_key": _date_key,
    # facts
    "load_fact_orders": lambda s: _drop_stamp(s.created_orders()),
    "load_fact_order_lines": lambda s: _drop_stamp(
        L.load_fact_order_lines(s.parsed("orders"), s.ctx)),
    "fold_order_status": lambda s: _fold(s, L.state_contributions(s.good(), ("order_updated",))),
    "fold_order_cancel": lambda s: _fold(s, L.state_contributions(s.good(), ("order_cancelled",))),
    "fold_orders": lambda s: _fold(s, L.order_contributions(s.good(), s.oltp.pagos)),
    "load_fact_payments": lambda s: _drop_stamp(
        L.load_fact_payments(s.parsed("payments"), s.ctx)),
    "load_fact_stock": lambda s: _drop_stamp(L.load_fact_stock(s.parsed("stock"), s.ctx)),
    "load_fact_shipments": _shipments,
    "load_shipments_returned": _shipments_returned,
    "load_fact_returns": lambda s: _drop_stamp(L.load_fact_returns(s.parsed("returns"), s.ctx)),
    "load_fact_carts": lambda s: _drop_stamp(L.load_fact_carts(s.parsed("carts"), s.ctx)),
    # pipeline
    "read_events": _read_events,
    "parse_payload": _parse_payload,
    "route_events": _route_events,
    "dlq_unhandled": lambda s: E.dlq_unhandled(s.routed(), at(SEEN_AT)),
    "dlq_failed": lambda s: E.dlq_failed(_failed(s), at(SEEN_AT)),
    "dlq_put": _dlq_put,
    "dedup_events": _dedup,
    "update_watermarks": _watermarks,
    "backlog_by_state": lambda s: O.backlog_by_state(s.oltp.pedidos),
    "pipeline_health": _health,
    "stream_orders": _stream_orders,
    "stream_payments": _stream_payments,
    "stream_shipments": _stream_shipments,
    "stream_carts": _stream_carts,
    "stream_stock": _stream_stock,
    "stream_returns": _stream_returns,
    "health_counters": _health_counters,
    "retry_stream": _retry_stream,
    "dedup_stream": _dedup_stream,
    "row_errors": _row_errors,
    # merges
    "merge_insert_only": _merge_insert,
    "merge_upsert": _merge_upsert,
    "merge_update_only": _merge_update,
    # rules
    "price_order_lines": _price_lines,
    "price_orders": _price_orders,
    "product_snapshot": _snapshot,
    "allocate_warehouse": _allocated,
    "allocate_competing": lambda s: K.allocate_competing(
        s.oltp.detalle_pedidos.select("detalle_pedido_id", "pedido_id", "variante_id", "cantidad"),
        s.oltp.niveles_stock, ["pedido_id", "detalle_pedido_id"]).drop("pedido_id"),
    "mark_oversold": _oversold,
    "reservation_movements": lambda s: _movement_columns(K.reservation_movements(_allocated(s))),
    "delivery_movements": lambda s: _movement_columns(K.delivery_movements(
        s.oltp.pedidos, s.oltp.detalle_pedidos, s.oltp.niveles_stock)),
    "stock_ledger": _ledger,
    "reorder_candidates": lambda s: K.reorder_candidates(
        s.oltp.niveles_stock, s.oltp.variantes_producto),
    "value_purchase_orders": lambda s: P.value_purchase_orders(
        s.oltp.ordenes_compra, s.oltp.variantes_producto),
    "lifecycle_due": _lifecycle,
    "fulfillment_status": lambda s: O.fulfillment_status(s.oltp.pedidos),
    "state_history": lambda s: O.state_history(s.good()),
    "payment_candidates": lambda s: O.payment_candidates(s.oltp.pedidos, at(NOW)),
    "cancel_refunds": lambda s: O.cancel_refunds(s.oltp.pedidos, s.oltp.pagos),
    "return_candidates": lambda s: O.return_candidates(s.oltp.pedidos, s.oltp.devoluciones),
    "cart_value": lambda s: P.cart_value(s.oltp.detalle_carritos),
    "cart_order_link": _cart_links,
    "payment_attempts": lambda s: O.payment_attempts(s.oltp.pagos),
    "sample_rows": lambda s: O.sample_rows(
        s.oltp.pedidos.select("pedido_id", "estado_actual"), "pedido_id", 0.05, 42,
        "estado_actual IN ('pendiente', 'confirmado')"),
    "cancel_release": lambda s: _movement_columns(
        K.cancel_release(s.oltp.pedidos, s.oltp.detalle_pedidos)),
    "return_movements": lambda s: _movement_columns(K.return_movements(
        s.oltp.devoluciones, s.oltp.detalle_devoluciones, s.oltp.detalle_pedidos,
        s.oltp.niveles_stock)),
    "shipping_address": lambda s: O.shipping_address(s.oltp.direcciones_cliente),
    "shipments_to_create": lambda s: O.shipments_to_create(s.oltp.pedidos, s.oltp.envios),
    "payment_event_log": lambda s: O.payment_event_log(s.oltp.pagos),
    "replenish_movements": lambda s: _movement_columns(
        K.replenish_movements(s.oltp.ordenes_compra)),
    # quality
    "dq_report": _dq_report,
}


def bound(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = QUERIES[name]
    return lambda spark, root: comparable(build(Source(spark, root)))

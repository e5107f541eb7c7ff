"""Events to star schema, batch by batch.

``Warehouse.load_batch`` is the body of ``foreachBatch`` and serves plain
batch runs as well. Every table merge is keyed and remembers the batch, so
running a batch again after a failure changes nothing.
"""

from __future__ import annotations

import datetime as dt
import gc
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercantil import schemas
from mercantil.functions import constants as C
from mercantil.functions.payload import parse_payload
from mercantil.operators import dims as D
from mercantil.operators import facts as L
from mercantil.operators import quality as Q
from mercantil.operators.merge import merge_upsert, new_rows
from mercantil.operators.scd2 import scd2_apply
from mercantil.sources.snapshots import KeyedTable
from mercantil.sources.star import constant_dims
from mercantil.sources.tables import BatchCatalog, Catalog, TypedCatalog
from mercantil.streaming import events as E
from mercantil.streaming.ledger import EventLedger
from mercantil.streaming.row_errors import CHECKED, row_errors, with_errors

Loader = Callable[[DataFrame, L.LoadContext], DataFrame]
#: A batch that took longer frees its shuffle files at its end; a short one has few.
RELEASE_SECONDS, RELEASE_WAIT = 15, 2
#: Loaders that look shipments up.
SHIPMENTS = {"shipment_delivered", "shipment_returned"}


@dataclass
class Warehouse:
    """A warehouse folder and the source tables it is loaded from.

    ``path`` must be reachable by all executors. ``extra`` adds loaders of your
    own: ``{event type: (fact table, loader)}`` with insert-only facts.
    """

    spark: SparkSession
    path: str
    oltp: Catalog
    calendar: tuple[dt.date, dt.date] = D.CALENDAR
    buckets: int = 64
    missing_days: int | None = None
    extra: dict[str, tuple[str, Loader]] = field(default_factory=dict)
    extra_schemas: dict[str, tuple[str, list[str]]] = field(default_factory=dict)
    # Tables loaded at the same time; their jobs share the cluster.
    parallel: int = 4

    def table(self, name: str) -> KeyedTable:
        if name in self.extra_schemas:
            schema, keys = self.extra_schemas[name]
        else:
            schema = {**schemas.DIMENSIONS, **schemas.FACTS, **schemas.CONTROL}[name]
            keys = schemas.KEYS[name]
        # Control tables of a handful of rows need one bucket only.
        buckets = 1 if name in ("marcas_agua", "conteos_carga") else self.buckets
        return KeyedTable(self.spark, f"{self.path}/{name}", schema, keys, buckets)

    def ledger(self) -> EventLedger:
        """Ids of the events that are settled."""
        return EventLedger(self.table("eventos_vistos"))

    def counters(self) -> DataFrame:
        """Counts of every batch loaded: events, errors, dead letters, rows of facts."""
        return self.table("conteos_carga").read()

    # --- reading ------------------------------------------------------------

    def star(self) -> Catalog:
        """The star schema as loaded so far."""
        stored = [
            "dim_cliente", "dim_producto", "dim_variante", "dim_almacen", "fact_detalle_pedidos",
            "fact_pagos", "fact_movimientos_inventario", "fact_devoluciones", "dlq_eventos", "marcas_agua",
        ]
        tables = {name: (lambda n=name: self.table(n).read()) for name in stored}
        tables["fact_pedidos"] = self.orders
        tables["fact_envios"] = self.shipments
        tables["fact_carritos"] = self.carts
        for name in ("niveles_stock", "variantes_producto"):
            if name in self.oltp:
                tables[name] = (lambda n=name: getattr(self.oltp, n))
        return Catalog({**constant_dims(self.spark, *self.calendar), **tables})

    def orders(self) -> DataFrame:
        """Created orders with the folded state of all events seen so far."""
        return self._folded("fact_pedidos", "pedidos_plegados", "pedido_id", L.FOLDED)

    def shipments(self) -> DataFrame:
        """Shipments with the state that all their events seen so far lead to."""
        return self._folded("fact_envios", "envios_plegados", "envio_id", L.SHIPMENT_FOLDED)

    def carts(self) -> DataFrame:
        return self._folded("fact_carritos", "carritos_plegados", "carrito_id", L.CART_FOLDED)

    def _folded(self, fact: str, folds: str, key: str, columns: list[str]) -> DataFrame:
        once = L.refold(self.table(folds).read(), key, columns)
        return L.apply_fold(self.table(fact).read(), once, key, columns)

    # --- start-up -----------------------------------------------------------

    def contract(self, required: dict[str, str] | None = None) -> DataFrame:
        """Source tables and columns that are missing or of another type.

        ``required`` maps tables to DDL text; by default all tables that
        loaders read.
        """
        if required is None:
            required = {n: d for n, d in schemas.SOURCES.items() if n != "niveles_stock"}
        wanted = {n: self.spark.createDataFrame([], d).schema for n, d in required.items()}
        found = {n: getattr(self.oltp, n).schema for n in required if n in self.oltp}
        return Q.contract_violations(self.spark, found, wanted)

    def verify(self) -> list[str]:
        """Problems that keep loads from working; adds missing watermark rows."""
        problems = [
            f"{r.problema}: {r.tabla}{'.' + r.columna if r.columna else ''}"
            for r in self.contract().collect()]
        if Q.short_calendar(self.star().dim_fecha).count():
            problems.append("calendario corto")
        marks = self.table("marcas_agua")
        missing = Q.missing_watermarks(self.spark, marks.read())
        marks.merge(missing, "verify", marks.last_batch("verify") + 1, E.update_watermarks)
        return problems

    # --- loading ------------------------------------------------------------

    def load_batch(self, batch: DataFrame, batch_id: int, writer: str = "stream") -> bool:
        """Load one batch of event envelopes, and try the waiting events again.

        False, and nothing done, if ``writer`` has finished a batch of this or a higher
        number. Events settled by an earlier batch are left out.
        """
        if batch_id <= self.table("reintentos").last_batch(writer):
            return False
        begun = time.monotonic()
        self._load_events(batch, batch_id, writer)
        if time.monotonic() - begun > RELEASE_SECONDS:
            # Spark drops the shuffle files behind a cache once the driver's garbage is collected,
            # and py4j tells it on the side, about once a second, what Python no longer holds.
            gc.collect()
            time.sleep(RELEASE_WAIT)
            self.spark.sparkContext._jvm.System.gc()
        return True

    def _load_events(self, batch: DataFrame, batch_id: int, writer: str) -> None:
        now = F.current_timestamp()
        waiting = self.table("reintentos").read().filter("pendiente").drop("error_olap", "pendiente")
        fresh = batch.select(*[c.split()[0] for c in schemas.EVENTS.split(", ")]).withColumn("intentos_olap", F.lit(0))
        every = fresh.unionByName(waiting)
        both = self.ledger().unseen(E.dedup_events(every), among=every)
        read = E.route_events(parse_payload(both), {event: event for event in self.extra})
        cached: list[DataFrame] = []

        def keep(df: DataFrame) -> DataFrame:
            cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return df

        try:
            read = keep(read)
            # At most one row per loader.
            newest = read.filter(E.is_good(read)).groupBy("cargador").agg(F.max("ocurrido_en").alias("t")).collect()
            present = {r.cargador for r in newest}
            dealt = {"envio_id": keep(self._shipment_events(read))} if present & SHIPMENTS else {}
            oltp = BatchCatalog(self.oltp, {
                at: keep(df) for at, df in self._named_rows(read, present, dealt).items()})
            errors = row_errors(read, oltp, present, dealt)
            # Mostly there is none, and the events are as they were read.
            errors = None if errors is None or keep(errors).isEmpty() else errors
            routed = with_errors(read, errors) if errors is None else keep(with_errors(read, errors))
            shipped = dealt["envio_id"].filter("_bueno") if dealt else None
            if dealt and errors is not None:
                shipped = shipped.join(errors, "evento_negocio_id", "left_anti")
            self._load(routed, {r.cargador: r.t for r in newest}, batch_id, writer, now, oltp, shipped)
        finally:
            for df in cached:
                df.unpersist()

    def _shipment_events(self, read: DataFrame) -> DataFrame:
        """Events that name a shipment, dealt by it once for all that look shipments up."""
        return read.filter("envio_id IS NOT NULL").select(
            "envio_id", *L.EVENT_ORDER, "tipo_evento", E.is_good(read).alias("_bueno")).repartition("envio_id")

    def _named_rows(
        self, read: DataFrame, present: set[str], dealt: dict[str, DataFrame],
    ) -> dict[tuple[str, str], DataFrame]:
        """Source rows that the events of a batch name, by table and key; to be cached.

        Checks, dimensions and facts look them up by the same key. Orders are also looked up
        by returns, whose events need not name them.
        """
        fields = {(table, key): field for loader, (field, tables) in CHECKED.items() if loader in present
                  for table, key in tables.items() if table in self.oltp and (table != "pedidos" or "return" not in present)}
        held = {}
        for (table, key), field in fields.items():
            ids = dealt.get(field, read).select(F.col(field).alias(key)).filter(F.col(key).isNotNull()).distinct()
            held[table, key] = self.oltp.rows_for(table, ids).join(ids, key, "left_semi")
        return held

    def drain(self) -> int:
        """Try the waiting events again until none is left; returns the rounds it took.

        Each round is an attempt, so ``MAX_ATTEMPTS`` rounds settle everything: an event
        loads once its cause is mended, or becomes a dead letter.
        """
        run = uuid.uuid4().hex
        for k in range(C.MAX_ATTEMPTS):
            if self.table("reintentos").read().filter("pendiente").isEmpty():
                return k
            self.load_batch(self.spark.createDataFrame([], schemas.EVENTS), k, f"drain:{run}")
        return C.MAX_ATTEMPTS

    def _load(
        self, routed: DataFrame, newest: dict, batch_id: int, writer: str, now: Column, source: Catalog,
        shipped: DataFrame | None = None,
    ) -> None:
        good, present = routed.filter(E.is_good(routed)), set(newest)
        # Versions start at the newest event of the batch, so a replay repeats them.
        start = F.lit(max((t for t in newest.values() if t), default=None)).cast("timestamp")
        ctx = self._load_dims(good, present, batch_id, writer, start, source, shipped)

        steps: list[Callable[[], object]] = []
        facts, folds = [], []

        def insert(name: str, rows: DataFrame) -> None:
            table = self.table(name)
            facts.append(table)
            steps.append(lambda: table.insert(
                rows, writer, batch_id, lambda old, new: new_rows(old, new, table.keys)))

        def fold(name: str, key: str, columns: list[str], contributions: DataFrame) -> None:
            # Folds add up when read, so a batch only appends its own.
            rows = L.fold(contributions, key, columns)
            folds.append(self.table(name))
            steps.append(lambda: self.table(name).insert(
                rows, writer, batch_id, compact=lambda all_: L.refold(all_, key, columns)))

        if "order_created" in present:
            insert("fact_pedidos", L.load_fact_orders(good, ctx))
            insert("fact_detalle_pedidos", L.load_fact_order_lines(good, ctx))
        if present & {"order_updated", "order_cancelled", "payment"}:
            payments = good.select("pago_id").filter("pago_id IS NOT NULL").distinct()
            fold("pedidos_plegados", "pedido_id", L.FOLDED,
                 L.order_contributions(good, ctx.oltp.rows_for("pagos", payments)))
        if "payment" in present:
            insert("fact_pagos", L.load_fact_payments(good, ctx))
        if "stock" in present:
            insert("fact_movimientos_inventario", L.load_fact_stock(good, ctx))
        if present & SHIPMENTS:
            insert("fact_envios", L.load_fact_shipments(shipped, ctx))
            fold("envios_plegados", "envio_id", L.SHIPMENT_FOLDED, L.shipment_contributions(shipped, ctx))
        if "return" in present:
            insert("fact_devoluciones", L.load_fact_returns(good, ctx))
        if "cart" in present:
            insert("fact_carritos", L.load_fact_carts(good, ctx))
            fold("carritos_plegados", "carrito_id", L.CART_FOLDED, L.cart_contributions(good, ctx))
        for event, (table, loader) in self.extra.items():
            if event in present:
                insert(table, loader(good, ctx))
        *others, ledger, retries = self._control_steps(routed, batch_id, writer, now)
        self._run(steps + others)
        # A run repeated before this point sees the same events again, and then the same retries.
        ledger()
        self._count(routed, facts, folds, batch_id, writer, now)
        retries()

    def _count(self, routed, facts, folds, batch_id: int, writer: str, now: Column) -> None:
        """Add the counts of a batch, one row; rows of tables are known from their own writes."""
        def added(tables) -> Column:
            return F.lit(sum(t.added(writer, batch_id) for t in tables)).cast("bigint")

        known, good = F.col("cargador").isNotNull(), E.is_good(routed)
        counts = routed.agg(F.count_if(good).alias("procesados"), F.count_if(known & ~good).alias("errores")).select(
            F.lit(writer).alias("escritor"), F.lit(batch_id).cast("bigint").alias("lote"), "procesados", "errores",
            added([self.table("dlq_eventos")]).alias("cartas"), added(facts).alias("insertados"),
            added(folds).alias("actualizados"), now.alias("cargado_en"))
        self.table("conteos_carga").insert(counts, writer, batch_id)

    def _run(self, steps: list[Callable[[], object]]) -> None:
        """Run independent table loads side by side and wait for all."""
        with ThreadPoolExecutor(self.parallel) as pool:
            for done in [pool.submit(inheritable_thread_target(self.spark)(step)) for step in steps]:
                done.result()

    def _control_steps(self, routed, batch_id, writer, now: Column) -> list[Callable[[], object]]:
        """Dead letters, watermarks, settled ids and retries."""
        failed = E.failed_events(routed)
        letters = E.dlq_unhandled(routed, now).unionByName(E.dlq_failed(failed, now))

        def put() -> None:
            self.table("dlq_eventos").insert(
                letters, writer, batch_id, lambda old, new: new_rows(old, new, ["evento_id"]))

        def mark() -> None:
            self.table("marcas_agua").merge(
                E.watermarks(routed, now), writer, batch_id, E.update_watermarks)

        # An event that was tried again is settled unless it failed once more.
        columns = self.table("reintentos").columns()
        waiting = E.to_retry(failed).withColumn("pendiente", F.lit(True)).select(*columns)
        settled = (
            routed.filter("intentos_olap > 0")
            .join(waiting.select("evento_negocio_id"), "evento_negocio_id", "left_anti")
            .withColumn("error_olap", F.lit(None).cast("string"))
            .withColumn("pendiente", F.lit(False)).select(*columns)
        )
        retries = waiting.unionByName(settled)
        changed = [c for c in columns if c != "evento_negocio_id"]

        def remember() -> None:
            done = routed.join(waiting.select("evento_negocio_id"), "evento_negocio_id", "left_anti")
            self.ledger().settle(done, writer, batch_id)

        def retry() -> None:
            self.table("reintentos").merge(
                retries, writer, batch_id,
                lambda old, new: merge_upsert(old, new, ["evento_negocio_id"], replace=changed))

        return [put, mark, remember, retry]

    def _load_dims(
        self, good, present, batch_id, writer, start: Column, source: Catalog, shipped: DataFrame | None,
    ) -> L.LoadContext:
        """Bring dimension versions up to date for the ids the batch touches.

        Returns what the fact loaders look values up in, cut down to those ids.
        """
        oltp = TypedCatalog(source, schemas.SOURCES)

        def rows(name: str, ids: DataFrame) -> DataFrame:
            return oltp.rows_for(name, ids).join(ids.distinct(), ids.columns, "left_semi")

        customers, variants, warehouses = [], [], []
        if "order_created" in present:
            ids = L.touched_ids(good, "order_created", "pedido_id")
            customers.append(rows("pedidos", ids).select("cliente_id"))
            variants.append(rows("detalle_pedidos", ids).select("variante_id"))
        if "payment" in present:
            payments = L.events_for(good, "payment")
            customers.append(payments.select("cliente_id"))
            customers.append(rows("pedidos", payments.select("pedido_id")).select("cliente_id"))
        if "stock" in present:
            ids = L.touched_ids(good, "stock", "movimiento_id").withColumnRenamed(
                "movimiento_id", "movimiento_inventario_id")
            moves = rows("movimientos_inventario", ids)
            variants.append(moves.select("variante_id"))
            warehouses.append(moves.select("almacen_id"))
        if present & SHIPMENTS:
            warehouses.append(rows("envios", shipped.select("envio_id")).select("almacen_id"))
        if "return" in present:
            ids = L.touched_ids(good, "return", "devolucion_id")
            orders = rows("devoluciones", ids).select("pedido_id")
            customers.append(rows("pedidos", orders).select("cliente_id"))
            variants.append(rows("detalle_devoluciones", ids).select("variante_id"))
        if "cart" in present:
            ids = L.touched_ids(good, "cart", "carrito_id")
            customers.append(rows("carritos", ids).select("cliente_id"))

        dims = {name: self.table(name).read for name in
                ("dim_cliente", "dim_producto", "dim_variante", "dim_almacen")}
        cached: list[DataFrame] = []

        def touched(parts: list[DataFrame], key: str) -> DataFrame:
            """Distinct ids of one dimension; they are read several times."""
            whole = parts[0]
            for part in parts[1:]:
                whole = whole.unionByName(part)
            ids = whole.filter(F.col(key).isNotNull()).distinct().persist(
                StorageLevel.MEMORY_AND_DISK)
            cached.append(ids)
            return ids

        def merge(name: str, incoming: DataFrame, ids: DataFrame, sk: str, tracked: list[str]):
            key = ids.columns[0]
            self.table(name).merge(
                incoming.join(ids, key, "left_semi"), writer, batch_id,
                lambda old, new: scd2_apply(old, new, key, sk, tracked, start))
            dims[name] = self.table(name).read_for(ids)

        narrow = {"oltp": oltp}

        def load_customers() -> None:
            ids = touched(customers, "cliente_id")
            source = oltp.narrowed(ids, "clientes", "direcciones_cliente")
            merge("dim_cliente", D.customer_snapshot(source), ids, "cliente_sk", D.CUSTOMER_TRACKED)

        def load_variants() -> None:
            ids = touched(variants, "variante_id")
            source = oltp.narrowed(ids, "variantes_producto", "precios_producto")
            narrow["oltp"] = oltp.narrowed(ids, "variantes_producto")
            products = touched([source.variantes_producto.join(ids, "variante_id", "left_semi")
                                .select("producto_id")], "producto_id")
            merge("dim_producto", D.product_snapshot(oltp.narrowed(products, "productos")),
                  products, "producto_sk", D.PRODUCT_TRACKED)
            merge("dim_variante", D.variant_snapshot(source, dims["dim_producto"]),
                  ids, "variante_sk", D.VARIANT_TRACKED)

        def load_warehouses() -> None:
            ids = touched(warehouses, "almacen_id")
            known = oltp.rows_for("almacenes", ids).join(ids, "almacen_id", "left_semi")
            self.table("dim_almacen").insert(
                D.dim_warehouse(known), writer, batch_id,
                lambda old, new: new_rows(old, new, ["almacen_id"]))

        steps: list[Callable[[], object]] = []
        if customers:
            steps.append(load_customers)
        if variants:
            steps.append(load_variants)
        if warehouses:
            steps.append(load_warehouses)
        try:
            self._run(steps)
        finally:
            for ids in cached:
                ids.unpersist()
        return L.LoadContext(narrow["oltp"], Catalog(dims), self.calendar, self.missing_days)

    # --- streaming ----------------------------------------------------------

    def stream(
        self, events: DataFrame, name: str = "warehouse", available_now: bool = False,
        dedup_delay: str | None = None,
    ):
        """Start the stream; its checkpoint lives beside the tables.

        Late events are always applied. ``dedup_delay`` adds stateful
        deduplication, which drops events later than that. A running stream gets a
        heartbeat, so that waiting events are tried again when no new file comes; after
        ``available_now`` call ``drain``.
        """
        source = E.dedup_stream(events, dedup_delay) if dedup_delay else events
        if not available_now:
            source = E.with_heartbeat(source)

        def load(batch: DataFrame, batch_id: int) -> None:
            # Batch numbers start again with a new checkpoint, and so does the query id.
            run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            self.load_batch(batch, batch_id, f"{name}:{run}")

        writer = (
            source.writeStream.queryName(name)
            .foreachBatch(load)
            .option("checkpointLocation", f"{self.path}/_checkpoints/{name}")
        )
        if available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{C.POLL_SECONDS} seconds").start()

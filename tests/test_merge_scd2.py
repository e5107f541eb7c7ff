"""Merges and Type 2 versions on hand rows."""

from pyspark.sql import functions as F
import pytest

from helpers import one, rows, ts
from mercantil.operators import dims as D
from mercantil.operators import merge as M
from mercantil.operators import scd2 as S
from mercantil.sources.tables import Catalog

T1, T2, T3 = 1, 2, 3
SNAP = "cliente_id bigint, correo string, segmento string, region string"


def at(day):
    return F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp")


def snap(spark, *data):
    return spark.createDataFrame(list(data), SNAP)


def apply(dim, incoming, day):
    return S.scd2_apply(
        dim, incoming, "cliente_id", "cliente_sk", ["segmento", "region"], at(day))


def first(spark, *data):
    return S.new_versions(snap(spark, *data), "cliente_id", "cliente_sk", at(T1))


def check_invariants(dim):
    assert dim.filter("es_actual <> (valido_hasta IS NULL)").count() == 0
    per_key = dim.filter("es_actual").groupBy("cliente_id").count()
    assert per_key.filter("count > 1").count() == 0
    assert dim.count() == dim.select("cliente_sk").distinct().count()


def test_tracked_change_opens_a_version(spark):
    dim = first(spark, (1, "a", "estandar", "RM"), (2, "b", "vip", "RM"))
    after = apply(dim, snap(spark, (1, "a", "vip", "RM")), T2)
    check_invariants(after)
    assert after.count() == 3
    old = one(after, "cliente_id = 1 AND NOT es_actual")
    new = one(after, "cliente_id = 1 AND es_actual")
    assert (old.segmento, new.segmento) == ("estandar", "vip")
    assert old.valido_hasta == new.valido_desde == ts("2024-01-02")


def test_equal_and_late_changes_keep_intervals_apart(spark):
    dim = first(spark, (1, "a", "nuevo", "N"))
    dim = apply(dim, snap(spark, (1, "a", "vip", "N")), T3)
    for day, segment in ((T3, "plata"), (T2, "oro")):
        dim = apply(dim, snap(spark, (1, "a", segment, "N")), day)
        check_invariants(dim)
    ordered = sorted(dim.collect(), key=lambda r: r.valido_desde)
    assert [r.segmento for r in ordered] == ["nuevo", "vip", "plata", "oro"]
    assert all(a.valido_desde < a.valido_hasta == b.valido_desde for a, b in zip(ordered, ordered[1:]))


def test_untracked_change_opens_none(spark):
    dim = first(spark, (1, "a", "vip", "RM"))
    assert rows(apply(dim, snap(spark, (1, "new", "vip", "RM")), T2)) == rows(dim)


def test_nulls_are_equal(spark):
    dim = first(spark, (1, "a", "vip", None))
    assert rows(apply(dim, snap(spark, (1, "a", "vip", None)), T2)) == rows(dim)
    assert apply(dim, snap(spark, (1, "a", "vip", "RM")), T2).count() == 2


def test_repeating_a_snapshot_changes_nothing(spark):
    dim = first(spark, (1, "a", "vip", "RM"))
    news = snap(spark, (1, "a", "nuevo", "RM"), (3, "c", "vip", None))
    once = apply(dim, news, T2)
    assert rows(apply(once, news, T3)) == rows(once)


def test_close(spark):
    dim = first(spark, (1, "a", "vip", "RM"), (2, "b", "vip", "RM"))
    ids = spark.createDataFrame([(1,), (1,), (9,)], "cliente_id bigint")
    after = S.scd2_close(dim, ids, "cliente_id", at(T2))
    check_invariants(after)
    assert rows(after, "cliente_id", "es_actual") == [(1, False), (2, True)]
    assert rows(S.scd2_close(after, ids, "cliente_id", at(T3))) == rows(after)


@pytest.mark.parametrize("chunk_rows", [1, 3, 400])
def test_history_from_changes(spark, chunk_rows):
    log = spark.createDataFrame([
        (1, "a", ts("2024-01-01"), 1), (1, "a", ts("2024-01-02"), 2), (1, "b", ts("2024-01-05"), 3),
        (1, "a", ts("2024-01-05"), 4), (2, "x", ts("2024-01-01"), 5), (1, None, ts("2024-02-01"), 6),
        (1, None, ts("2024-02-02"), 7),
    ], "cliente_id bigint, segmento string, cuando timestamp, id bigint")
    dim = S.scd2_history(log, "cliente_id", "cliente_sk", ["segmento"], "cuando", "id",
                         chunk_rows=chunk_rows)
    check_invariants(dim)
    assert rows(dim, "cliente_id", "segmento", "valido_desde", "valido_hasta") == rows(
        spark.createDataFrame([
            (1, "a", ts("2024-01-01"), ts("2024-01-05")),
            (1, "b", ts("2024-01-05"), ts("2024-01-05")),
            (1, "a", ts("2024-01-05"), ts("2024-02-01")),
            (1, None, ts("2024-02-01"), None), (2, "x", ts("2024-01-01"), None),
        ], "a bigint, b string, c timestamp, d timestamp"))


def source(spark, clients, addresses):
    return Catalog({
        "clientes": spark.createDataFrame(
            clients, "cliente_id bigint, correo string, nombre string, apellido string, "
            "segmento string, estado string"),
        "direcciones_cliente": spark.createDataFrame(
            addresses, "direccion_id bigint, cliente_id bigint, codigo_pais string, ciudad string, "
            "provincia string, es_predeterminada boolean"),
    })


def test_default_place_without_address(spark):
    oltp = source(spark, [(1, "m", "Ana", "Soto", "vip", "activo"), (2, "n", "Eva", "Paz", "vip", "activo")],
                  [(7, 2, "CL", "Talca", None, True), (8, 2, "CL", "Arica", "X", True),
                   (9, 1, "CL", "Temuco", "Y", False)])
    got = D.customer_snapshot(oltp)
    assert rows(got, "cliente_id", "nombre_completo", "codigo_pais", "ciudad", "region") == [
        (1, "Ana Soto", "CL", "Santiago", "Metropolitana"),
        (2, "Eva Paz", "CL", "Talca", "Metropolitana")]


def test_category_falls_back_to_itself(spark):
    oltp = Catalog({
        "marcas": spark.createDataFrame([(1, "M")], "marca_id bigint, nombre string"),
        "categorias": spark.createDataFrame(
            [(1, None, "Ropa"), (2, 1, "Poleras")],
            "categoria_id bigint, categoria_padre_id bigint, nombre string"),
        "productos": spark.createDataFrame(
            [(10, 1, 1, "A", "activo"), (11, 1, 2, "B", "activo")],
            "producto_id bigint, marca_id bigint, categoria_id bigint, nombre string, "
            "estado_producto string"),
    })
    assert rows(D.product_snapshot(oltp), "producto_id", "categoria_padre") == [
        (10, "Ropa"), (11, "Ropa")]


def test_missing_price_equals_zero(spark):
    def oltp(prices):
        return Catalog({
            "variantes_producto": spark.createDataFrame(
                [(1, 10, "s", None, None, 5, True)],
                "variante_id bigint, producto_id bigint, sku string, color string, talla string, "
                "precio_costo int, activa boolean"),
            "precios_producto": spark.createDataFrame(
                prices, "precio_id bigint, variante_id bigint, precio_lista decimal(12,2), "
                "vigente_desde timestamp")})
    products = spark.createDataFrame([(5, 10, True)],
                                     "producto_sk bigint, producto_id bigint, es_actual boolean")
    dim = D.dim_variant_scd2(oltp([]), products, at(T1))
    assert rows(D.dim_variant_scd2(oltp([]), products, at(T2), dim=dim)) == rows(dim)
    from decimal import Decimal
    zero = oltp([(1, 1, Decimal(0), ts("2024-01-01"))])
    assert rows(D.dim_variant_scd2(zero, products, at(T2), dim=dim)) == rows(dim)
    priced = oltp([(1, 1, Decimal(3), ts("2024-01-01")), (2, 1, Decimal(4), ts("2024-01-01")),
                   (3, 1, Decimal(9), None)])
    after = D.dim_variant_scd2(priced, products, at(T2), dim=dim)
    assert one(after, "es_actual").precio_lista_actual == Decimal("4.00")


def test_warehouse_is_inserted_once(spark):
    schema = "almacen_id bigint, codigo string, nombre string, ciudad string, codigo_pais string"
    known = D.dim_warehouse(spark.createDataFrame([(1, "A", "Uno", "Talca", "CL")], schema))
    news = spark.createDataFrame([(1, "A", "Otro", "Arica", "CL"), (2, "B", "Dos", "Lota", "CL")], schema)
    assert rows(D.dim_warehouse(news, known), "almacen_id", "nombre") == [(1, "Uno"), (2, "Dos")]
    assert rows(D.dim_warehouse(news, known, overwrite=True), "almacen_id", "nombre", "ciudad") == [
        (1, "Otro", "Arica"), (2, "Dos", "Lota")]


def test_insert_only(spark):
    target = spark.createDataFrame([(1, "old", 0)], "k bigint, v string, n int")
    news = spark.createDataFrame([(1, "x", 1), (2, "b", 2), (2, "a", 3)], "k bigint, v string, n int")
    once = M.merge_insert_only(target, news, ["k"])
    assert rows(once) == [(1, "old", 0), (2, "a", 3)]
    assert rows(M.merge_insert_only(once, news, ["k"])) == rows(once)
    assert rows(M.merge_insert_only(target, news, ["k"], ["n"])) == [(1, "old", 0), (2, "b", 2)]


def test_upsert_rules(spark):
    schema = "k bigint, r string, f string, o string"
    target = spark.createDataFrame([(1, "r", "f", "o"), (2, "r", "f", "o"), (4, "r", "f", "o")], schema)
    news = spark.createDataFrame([(1, None, None, "x"), (2, "R", "F", "x"), (3, "R", "F", "x")], schema)
    once = M.merge_upsert(target, news, ["k"], replace=["r"], fill=["f"])
    got = {r.k: (r.r, r.f, r.o) for r in once.collect()}
    assert got == {1: (None, "f", "o"), 2: ("R", "F", "o"), 3: ("R", "F", "x"), 4: ("r", "f", "o")}
    again = M.merge_upsert(once, news, ["k"], replace=["r"], fill=["f"])
    assert {r.k: (r.r, r.f, r.o) for r in again.collect()} == got


def test_update_only(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    news = spark.createDataFrame([(1, "z"), (2, None), (3, "q")], "k bigint, v string")
    assert rows(M.merge_update_only(target, news, ["k"], ["v"])) == [(1, "z"), (2, "b")]

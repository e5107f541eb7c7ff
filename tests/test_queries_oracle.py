"""Every query against its SQL twin in DuckDB, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    return con


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, data, duck, name):
    result = entry.queries()[name](spark, data)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(names)
    wanted = table(cursor.fetchall(), names)
    assert table(result.collect(), result.columns) == wanted
    assert wanted, "an empty result proves nothing"


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_sample_is_a_part_of_the_rows(spark, data):
    from mercantil.plans.registry import Source
    sample = {r.pedido_id for r in entry.queries()["sample_rows"](spark, data).collect()}
    again = {r.pedido_id for r in entry.queries()["sample_rows"](spark, data).collect()}
    open_orders = {
        r.pedido_id for r in Source(spark, data).oltp.pedidos
        .filter("estado_actual IN ('pendiente', 'confirmado')").select("pedido_id").collect()}
    assert sample and sample == again and sample < open_orders


def test_entry_runs(spark):
    if not (DATA / "sf0.001").exists():
        pytest.skip("no test data")
    assert entry.entry(spark).count() > 0

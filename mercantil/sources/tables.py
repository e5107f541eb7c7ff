"""Readers with explicit schemas (no inference job, pruned scans)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
              "props string",
}


class Catalog:
    """Named DataFrames built on first use: ``catalog.pedidos``."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame] | DataFrame]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            builder = self._builders[name]
            self._built[name] = builder if isinstance(builder, DataFrame) else builder()
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        return name in self._builders

    def names(self) -> list[str]:
        return list(self._builders)

    def replace(self, **tables: DataFrame | Callable[[], DataFrame]) -> Catalog:
        return Catalog({**self._builders, **tables})

    def rows_for(self, name: str, ids: DataFrame) -> DataFrame:
        """A table holding at least the rows whose key is among ``ids``.

        Here it is the whole table; a catalog that can find rows by key reads
        less. ``ids`` has the key as its only column.
        """
        return getattr(self, name)

    def narrowed(self, ids: DataFrame, *names: str) -> Catalog:
        """This catalog with some tables cut down by ``rows_for``."""
        return self.replace(**{
            name: (lambda n=name: self.rows_for(n, ids)) for name in names if name in self})


class BatchCatalog(Catalog):
    """A catalog over ``base`` with ``rows`` of some tables at hand, by table and key column.

    ``rows`` hold all that one batch looks up by that key, so a table is read once however
    many loaders need it.
    """

    def __init__(self, base: Catalog, rows: Mapping[tuple[str, str], DataFrame]):
        super().__init__({name: (lambda n=name: getattr(base, n)) for name in base.names()})
        self._base, self._rows = base, dict(rows)

    def rows_for(self, name: str, ids: DataFrame) -> DataFrame:
        found = self._rows.get((name, *ids.columns))
        return self._base.rows_for(name, ids) if found is None else found

    def replace(self, **tables: DataFrame | Callable[[], DataFrame]) -> Catalog:
        kept = {at: df for at, df in self._rows.items() if at[0] not in tables}
        return BatchCatalog(self._base.replace(**tables), kept)


class TypedCatalog(Catalog):
    """A catalog whose tables have the declared types; a value that doesn't fit is null.

    ``streaming.row_errors`` finds these values, so that one of them fails its event and
    not the batch. Columns of the declared type pass unchanged.
    """

    def __init__(self, base: Catalog, declared: Mapping[str, str]):
        super().__init__({name: (lambda n=name: self._typed(n, getattr(base, n))) for name in base.names()})
        self._base, self._declared = base, declared

    def _typed(self, name: str, df: DataFrame) -> DataFrame:
        wanted = {f.name: f.dataType for f in T.StructType.fromDDL(self._declared.get(name, "")).fields}
        return df.select(*[
            F.col(f.name).try_cast(wanted[f.name]).alias(f.name)
            if f.name in wanted and f.dataType != wanted[f.name] else F.col(f.name)
            for f in df.schema.fields])

    def untyped(self) -> Catalog:
        return self._base

    def rows_for(self, name: str, ids: DataFrame) -> DataFrame:
        return self._typed(name, self._base.rows_for(name, ids))

    def replace(self, **tables: DataFrame | Callable[[], DataFrame]) -> Catalog:
        return TypedCatalog(self._base.replace(**tables), self._declared)


def raw_catalog(spark: SparkSession, root: str) -> Catalog:
    """The given Parquet tables under ``root``."""
    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{root}/{name}.parquet")
    return Catalog({name: reader(name) for name in RAW_SCHEMAS})


def snapshot_catalog(
    spark: SparkSession, root: str, schemas: Mapping[str, T.StructType], fmt: str = "parquet",
) -> Catalog:
    """A folder of table snapshots, one folder per table, in Parquet, ORC, JSON or CSV."""
    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(schemas[name]).format(fmt).load(f"{root}/{name}")
    return Catalog({name: reader(name) for name in schemas})


def jdbc_catalog(
    spark: SparkSession, url: str, keys: Mapping[str, tuple[str, int, int]],
    partitions: int = 64, schema: str = "public", **options: str,
) -> Catalog:
    """Source tables read over JDBC in parallel key ranges.

    ``keys`` maps a table to ``(numeric column, lowest, highest)``. The driver
    jar for ``url`` must be on the classpath.
    """
    def reader(name: str) -> Callable[[], DataFrame]:
        column, low, high = keys[name]
        return lambda: (
            spark.read.format("jdbc")
            .options(url=url, dbtable=f"{schema}.{name}", partitionColumn=column,
                     lowerBound=low, upperBound=high, numPartitions=partitions, **options)
            .load()
        )
    return Catalog({name: reader(name) for name in keys})

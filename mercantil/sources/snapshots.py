"""Keyed Parquet tables that a batch can change bucket by bucket.

Parquet has no row updates, so a batch rewrites only the buckets its keys fall
into, or adds a file to them when it only inserts. Files are never changed in
place: each write goes to a new folder, and a small manifest of a new version
makes it visible. A run that dies before its manifest leaves files that nobody
reads, and a batch that was merged already is skipped, so replays are harmless.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercantil.sources.tables import Catalog


@dataclass(frozen=True)
class KeyedTable:
    """A table split into ``buckets`` by the hash of ``keys``.

    Size ``buckets`` so that one is a few hundred megabytes. A manifest names
    at most ``buckets * max_parts`` folders: a bucket that collected
    ``max_parts`` of them is rewritten as one with the next insert. There is
    one writer at a time; a second one fails when it commits.
    """

    spark: SparkSession
    path: str
    schema: str
    keys: Sequence[str]
    buckets: int = 64
    max_parts: int = 16

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def columns(self) -> list[str]:
        return self._empty().columns

    def last_batch(self, writer: str) -> int:
        """Last batch merged by ``writer``, -1 for none."""
        return self._manifest()["batches"].get(writer, -1)

    def added(self, writer: str, batch_id: int) -> int:
        """Rows that the last batch of ``writer`` wrote, 0 if ``batch_id`` is not that batch.

        For ``insert`` these are the new rows alone. Counted from the footers of committed
        files, so tasks that ran twice count once.
        """
        manifest = self._manifest()
        if manifest["batches"].get(writer, -1) != batch_id:
            return 0
        folder = manifest.get("written", {}).get(writer)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}").count() if folder else 0

    def is_empty(self) -> bool:
        """Whether no batch has written any row."""
        return not self._manifest()["parts"]

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or only some buckets of it."""
        return self._read(self._manifest(), buckets)

    def read_for(self, ids: DataFrame) -> DataFrame:
        """The buckets that hold the keys in ``ids``, found by a small job."""
        return self.read([r.b for r in ids.select(self.bucket().alias("b")).distinct().collect()])

    def merge(
        self, rows: DataFrame, writer: str, batch_id: int,
        how: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> bool:
        """Replace touched buckets by ``how(their rows, incoming rows)``.

        False if this batch was merged before.
        """
        return self._change(rows, writer, batch_id, how, replace=True)

    def insert(
        self, rows: DataFrame, writer: str, batch_id: int,
        keep: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
        compact: Callable[[DataFrame], DataFrame] | None = None,
    ) -> bool:
        """Add ``keep(their rows, incoming rows)`` to touched buckets.

        ``keep`` returns the rows to add, such as those of unknown keys; only
        the columns it uses are read from the table; without it all rows are
        added. ``compact`` may condense the rows of buckets that are rewritten.
        """
        return self._change(rows, writer, batch_id, keep, replace=False, compact=compact)

    def vacuum(self, keep: int = 10) -> int:
        """Delete folders and manifests older than the last ``keep`` versions.

        Do not run it while a writer is active or an older version is read.
        """
        fs, root = self._fs("")
        names = self._manifest_names()
        used = {folder for name in names[-keep:] for _, folder in self._load(name)["parts"]}
        gone = 0
        for status in fs.listStatus(root) if fs.exists(root) else []:
            name = status.getPath().getName()
            if name.startswith("data-") and name not in used:
                gone += bool(fs.delete(status.getPath(), True))
        for name in names[:-keep]:
            fs.delete(self._fs(f"_versions/{name}")[1], False)
        return gone

    def _change(self, rows, writer, batch_id, how, replace: bool, compact=None) -> bool:
        manifest = self._manifest()
        if batch_id <= manifest["batches"].get(writer, -1):
            return False
        replaced: set[int] = set()
        parts = Counter(bucket for bucket, _ in manifest["parts"])
        if not manifest["parts"] or how is None:
            # The first load touches what it touches, and so do rows that are only added; no need to look first.
            folder, filled = self._write(rows if how is None else how(self._empty(), rows), manifest)
            replaced = {b for b in filled if parts[b] >= self.max_parts}
        else:
            # Rows are read for their buckets and again for their values.
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                touched = sorted(
                    r.b for r in rows.select(self.bucket().alias("b")).distinct().collect())
                result = how(self._read(manifest, touched), rows)
                replaced = set(touched) if replace else {
                    b for b in touched if parts[b] >= self.max_parts}
                folder, filled = self._write(result, manifest) if touched else ("", set())
            finally:
                rows.unpersist()
        parts, new = manifest["parts"], [[bucket, folder] for bucket in sorted(filled)]
        if replace:
            parts = [part for part in parts if part[0] not in replaced] + new
        else:
            parts = self._condensed(manifest, parts + new, replaced, compact)
        self._save({
            "version": manifest["version"] + 1,
            "batches": {**manifest["batches"], writer: batch_id},
            "written": {**manifest.get("written", {}), writer: folder if filled else ""},
            "parts": parts,
        })
        return True

    def _condensed(self, manifest: dict, parts: list, buckets: set[int], compact) -> list:
        """``parts`` with one folder for all that is in each of ``buckets``."""
        if not buckets:
            return parts
        rows = self._read({**manifest, "parts": parts}, sorted(buckets))
        folder, filled = self._write(compact(rows) if compact else rows, manifest)
        return [part for part in parts if part[0] not in buckets] + [[b, folder] for b in sorted(filled)]

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _read(self, manifest: dict, buckets: Sequence[int] | None) -> DataFrame:
        wanted = None if buckets is None else set(buckets)
        folders = [
            f"{self.path}/{folder}/bucket={bucket}" for bucket, folder in manifest["parts"]
            if wanted is None or bucket in wanted
        ]
        if not folders:
            return self._empty()
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _write(self, rows: DataFrame, manifest: dict) -> tuple[str, set[int]]:
        folder = f"data-{manifest['version'] + 1:010d}-{uuid.uuid4().hex[:8]}"
        (
            rows.select(*self.columns()).withColumn("bucket", self.bucket())
            # AQE splits buckets beyond the advisory size, so a hot key is no single task.
            .hint("rebalance", "bucket")
            .write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.path}/{folder}")
        )
        fs, made = self._fs(folder)
        names = [status.getPath().getName() for status in fs.listStatus(made)]
        return folder, {int(n.split("=")[1]) for n in names if n.startswith("bucket=")}

    # --- manifest: one small file per version -------------------------------

    def _fs(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _manifest_names(self) -> list[str]:
        fs, folder = self._fs("_versions")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(name for name in names if name.startswith("v"))

    def _manifest(self) -> dict:
        names = self._manifest_names()
        return self._load(names[-1]) if names else {"version": 0, "batches": {}, "parts": []}

    def _load(self, name: str) -> dict:
        fs, path = self._fs(f"_versions/{name}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _save(self, manifest: dict) -> None:
        """Write aside and rename, so that a manifest is seen whole or not at all."""
        fs, aside = self._fs(f"_versions/.{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        _, final = self._fs(f"_versions/v{manifest['version']:010d}")
        if fs.exists(final) or not fs.rename(aside, final):
            raise RuntimeError(f"another writer changed {self.path}")


class KeyedCatalog(Catalog):
    """Keyed tables as a catalog; loaders then read only the buckets they need.

    Place each source table by the id its rows are looked up with: orders and
    their lines by ``pedido_id``, prices by ``variante_id``, addresses by
    ``cliente_id``, details of returns by ``devolucion_id``.
    """

    def __init__(self, tables: dict[str, KeyedTable]):
        super().__init__({name: table.read for name, table in tables.items()})
        self._tables = tables

    def rows_for(self, name: str, ids: DataFrame) -> DataFrame:
        table = self._tables.get(name)
        if table is None or list(table.keys) != ids.columns:
            return getattr(self, name)
        return table.read_for(ids)

    def replace(self, **tables) -> Catalog:
        # A replaced table is no longer found by key, the others still are.
        changed = KeyedCatalog(self._tables)
        changed._builders.update(tables)
        changed._tables = {n: t for n, t in self._tables.items() if n not in tables}
        return changed

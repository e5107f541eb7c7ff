"""Helpers shared by the text operators.

Every operator takes the names of its id and text column, selects only these and
renames them to ``_id`` and ``_t``, so extra columns of any name do no harm. A null
text counts as empty; a null id is carried along and sorts after all others.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercantil.session import shared_dir

#: Largest file or object sent to all executors, in bytes.
BROADCAST_LIMIT = 64 << 20
#: Rank of a null id: after all others.
LAST_ID = (1 << 63) - 1


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application."""
    root = Path(__file__).resolve().parents[2]
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    context = spark.sparkContext
    if str(root) in known or context.applicationId in _SHIPPED:
        return
    target = Path(tempfile.mkdtemp(prefix="mercantil-")) / "mercantil.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted((root / "mercantil").rglob("*.py")):
            archive.write(path, path.relative_to(root))
    context.addPyFile(str(target))  # the driver serves it to the executors
    _SHIPPED.add(context.applicationId)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``_id`` (long) and ``_t`` (string, never null)."""
    ship(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_t"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage with a table every executor can reach, so a lost executor
    costs a read instead of a new computation.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_bytes(path: str) -> bytes:
    """A vocabulary file, refused when it is too large to send to all executors."""
    with open(path, "rb") as f:
        data = f.read(BROADCAST_LIMIT + 1)
    if len(data) > BROADCAST_LIMIT:
        raise ValueError(f"{path} is larger than {BROADCAST_LIMIT} bytes")
    return data


def sliced(batches, rows: int = 1000):
    """Arrow batches in pieces of at most ``rows`` rows, so that few texts are held as objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Memo(dict):
    """Cache of ``make(key)``; emptied when it holds ``limit`` entries."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value

"""Small helpers to write tables as Python rows."""

import datetime as dt

from pyspark.sql import DataFrame


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Sorted rows as tuples, nulls last."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def one(df: DataFrame, condition: str):
    found = df.filter(condition).collect()
    assert len(found) == 1, found
    return found[0]

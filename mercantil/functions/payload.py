"""Event payloads: flat JSON objects turned into columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields that loaders read, over all event types.
FIELDS = [
    T.StructField("pedido_id", T.LongType()),
    T.StructField("cliente_id", T.LongType()),
    T.StructField("estado_anterior", T.StringType()),
    T.StructField("estado_nuevo", T.StringType()),
    T.StructField("pago_id", T.LongType()),
    T.StructField("movimiento_id", T.LongType()),
    T.StructField("envio_id", T.LongType()),
    T.StructField("devolucion_id", T.LongType()),
    T.StructField("carrito_id", T.LongType()),
]
CORRUPT = "documento_malo"
SCHEMA = T.StructType([*FIELDS, T.StructField(CORRUPT, T.StringType())])
NAMES = [field.name for field in FIELDS]


def parse_payload(events: DataFrame) -> DataFrame:
    """Add one column per payload field, and ``documento_malo``.

    A null payload reads as an empty object. An unreadable document, or a
    field of the wrong type, fills ``documento_malo`` with the text instead of
    failing the job.
    """
    text = F.coalesce("payload", F.lit("{}"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return (
        events.withColumn("_p", F.from_json(text, SCHEMA, options))
        .select(*events.columns, *[F.col(f"_p.{name}").alias(name) for name in (*NAMES, CORRUPT)])
    )

"""Exact duplicates by two-pass Bloom filtering, with DataFrame functions only.

Pass one hashes each normalised text and counts filter positions. A filter is cut
into buckets of 32,768 bits, so it is a table that grows with the rows and is never
held whole by one task; only positions hit more than once are set. Pass two looks
each row up in its bucket's bits: rows whose positions are all set may be repeated
and are shuffled by their hash, the rest pass straight through. SHA-256 values decide.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.llm.common import LAST_ID, stored, texts

#: Characters that do not count when texts are compared.
BLANKS = " \t\n\x0b\x0c\r"
BUCKET_BITS = 32768
#: Rows meant for one bucket: 16 bits for each, two of them set.
BUCKET_ROWS = 2048


def _number(value: int) -> Column:
    return F.lit(Decimal(value)).cast("decimal(20,0)")


def normalized(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalized(text), 256))


def _positions(key: Column, buckets: Column) -> list[Column]:
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    size = F.lit(BUCKET_BITS)
    return [F.pmod(first, buckets).alias("_bucket"),
            F.pmod(second, size).cast("int").alias("_p1"),
            F.pmod(F.shiftrightunsigned(second, 20), size).cast("int").alias("_p2")]


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), position % 8) == 1


def _groups(rows: DataFrame) -> DataFrame:
    """``_id, _sha, _n`` (stored, one row per document) with what each group keeps.

    Adds ``_same`` (rows equal in id, hash and length), ``_size``, ``_keep_id`` and
    ``_keep_n``.
    """
    buckets = F.lit(max(1, -(-rows.count() // BUCKET_ROWS))).cast("long")
    rows = rows.select("*", *_positions(F.col("_sha"), buckets))
    hits = (rows.select("_bucket", F.explode(F.array_distinct(F.array("_p1", "_p2"))).alias("_p"))
            .groupBy("_bucket", "_p").agg(F.count(F.lit(1)).alias("_hits"))
            .filter("_hits > 1"))
    bits = hits.groupBy("_bucket").agg(F.bitmap_construct_agg(F.col("_p").cast("long")).alias("_bits"))
    tested = rows.join(bits, "_bucket", "left").select(
        "_id", "_sha", "_n",
        F.coalesce(_is_set(F.col("_bits"), F.col("_p1")) & _is_set(F.col("_bits"), F.col("_p2")),
                   F.lit(False)).alias("_maybe"))
    same = (tested.filter("_maybe").groupBy("_id", "_sha", "_n")
            .agg(F.count(F.lit(1)).alias("_same")))
    # Longest text, then smallest id, as one number that aggregates by hash.
    rank = (F.col("_n").cast("decimal(20,0)") * _number(1 << 64)
            + (_number(LAST_ID)
               - F.coalesce("_id", F.lit(LAST_ID)).cast("decimal(20,0)"))).cast("decimal(38,0)")
    best = (same.groupBy("_sha").agg(F.sum("_same").alias("_size"), F.max(rank).alias("_best")))
    keep = _number(LAST_ID) - F.col("_best") % _number(1 << 64)
    repeated = same.join(best, "_sha").select(
        "_id", "_sha", "_n", "_same", "_size",
        F.when(keep == LAST_ID, F.lit(None)).otherwise(keep).cast("long").alias("_keep_id"),
        F.floor(F.col("_best") / _number(1 << 64)).cast("int").alias("_keep_n"))
    single = tested.filter("NOT _maybe").select(
        "_id", "_sha", "_n", F.lit(1).cast("long").alias("_same"), F.lit(1).cast("long").alias("_size"),
        F.col("_id").alias("_keep_id"), F.col("_n").alias("_keep_n"))
    return single.unionByName(repeated)


def _narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return stored(texts(df, id_col, text_col).select(
        "_id", digest(F.col("_t")).alias("_sha"), F.char_length("_t").alias("_n")), "hashes")


def _is_kept() -> Column:
    return F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_n") == F.col("_keep_n"))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the id that stays, group size, kept, hash.

    Texts are equal when identical without blanks; null counts as empty, and all
    empty texts are one group. The row with most code points stays, then the one
    with the smallest id (null last). Of rows equal in id, text and length, one is
    kept. An empty table gives no rows.
    """
    return (_groups(_narrow(df, id_col, text_col))
            .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "_same")).alias("_copy"))
            .select(F.col("_id").alias("doc_id"), F.col("_keep_id").alias("keep_id"),
                    F.col("_size").alias("group_size"), (_is_kept() & (F.col("_copy") == 1)).alias("kept"),
                    F.lower(F.hex("_sha")).alias("text_sha256")))


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    from pyspark.sql import Window

    acted = (_groups(_narrow(df, id_col, text_col))
             .withColumn("_act", F.when(~_is_kept(), "drop").when(F.col("_same") > 1, "thin"))
             .filter("_act IS NOT NULL").select("_id", "_sha", "_n", "_act"))
    names = df.columns
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                    F.col(f"`{id_col}`").cast("long").alias("_i"),
                    digest(text).alias("_s"), F.char_length(text).alias("_l"))
    marked = own.join(acted, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_s") == F.col("_sha"))
                      & (F.col("_l") == F.col("_n")), "left")
    through = marked.filter("_act IS NULL").select("_row.*")
    one = Window.partitionBy("_i", "_s", "_l").orderBy(F.to_json("_row"))
    thinned = (marked.filter("_act = 'thin'").withColumn("_rank", F.row_number().over(one))
               .filter("_rank = 1").select("_row.*"))
    return through.unionByName(thinned)

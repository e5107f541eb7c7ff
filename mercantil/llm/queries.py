"""The registered queries of the text operators, with the parameters used in production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercantil.llm import (
    byte_bpe, conversation_repair, decontaminate, exact_dedup, jaccard_join, licenses, periodic_runs,
    perplexity_rules, quality, suffix_dedup, token_files, toxicity, unigram_count,
)
from mercantil.llm.common import documents, scratch
from mercantil.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.without_repeats(documents(configure(spark), folder)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tokens = byte_bpe.bpe_tokens(documents(spark, folder), path, pattern)
    return byte_bpe.bpe_texts(tokens, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet")
    return decontaminate.leaks(documents(spark, folder), benchmark)


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_classes(documents(configure(spark), folder))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "token_files")
    token_files.write_ids(documents(spark, folder), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.file_report(spark, path)


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")


def _judged(scores: DataFrame, held_out, threshold: float) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = documents(spark, folder), toxicity.fold_number(F.col("doc_id"), 5) == 0
    _, scores = quality.rated(docs, _labels(spark, folder).filter(~held_out))
    return _judged(scores, held_out, quality.THRESHOLD)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = documents(spark, folder), toxicity.fold_number(F.col("doc_id"), 4) == 2
    lexicon = toxicity.learn(docs, _labels(spark, folder).filter(~held_out))
    return _judged(toxicity.toxicity_scores(docs, lexicon), held_out, toxicity.THRESHOLD)


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder.rstrip('/')}/pages.parquet")
    return licenses.license_scan(pages, "page_id", "html", licenses.url_path(F.col("url")), html=True)


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(configure(spark), folder))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return unigram_count.token_counts(documents(spark, folder),
                                      public_tokenizers.path("piece_bpe_32k.model"))


def op11_perplexity_rules(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity_rules.quality_rules(documents(configure(spark), folder))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = configure(spark).read.parquet(f"{folder.rstrip('/')}/conversations.parquet")
    reports, _ = conversation_repair.repair(conversation_repair.damaged(given))
    # A conversation that lost all its rows is reported too.
    every = given.select(F.col("conv_id").cast("long").alias("_conv")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(reports, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_conv").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.folded(documents(spark, folder)))
    # Longest first, then by start and period.
    ranked = F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period")))
    best = F.array_min(ranked)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"),
        (-best.less).alias("length"), best.period.alias("period"),
        F.floor(F.lit(-1000) * best.less / best.period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_decontaminate": op3_decontaminate,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_token_files": op5_token_files,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_licenses": op8_licenses,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_perplexity_rules": op11_perplexity_rules,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op9_exact_dedup": """
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS sha
            FROM documents),
        best AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
                   count(*) OVER (PARTITION BY sha) AS group_size
            FROM rows WINDOW w AS (PARTITION BY sha ORDER BY n DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha AS text_sha256 FROM best""",
}

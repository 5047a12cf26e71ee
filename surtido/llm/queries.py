"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surtido.llm import (
    bpe, clustering, decontamination, langid, lines, packing, quality, sharding, simhash,
    suffixes, toxicity, warc, whitening,
)
from surtido.llm.common import shared_folder
from surtido.llm.sql import ORACLES

RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.learn(docs.where(~F.coalesce(held_out, F.lit(False))))
    found = langid.predict(docs, model)
    return found.withColumn("held_out", F.coalesce(held_out, F.lit(False))).select(
        "doc_id", "held_out", "lang_pred", "score")


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return encoded.select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias(
            "ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    return toxicity.predict(docs, model).select(
        "row.doc_id", F.col("p")[0].alias("quality_score"), F.col("p")[1].alias("toxic_score"),
        (F.col("p")[1] >= toxicity.LEAST_TOXIC).alias("toxic"))


def op4_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages"), shared_folder(spark))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(table(spark, folder, "documents"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffixes.remove_repeated(docs).select(
        "row.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias(
            "n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = lines.drop_lines(docs, lines.keep_bitmaps(docs))
    return rows.select("row.doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.shard_documents(table(spark, folder, "documents"),
                                    sharding.balanced_tree(8))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                       "slot", "grown_shard")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, table(spark, folder, "benchmark"))


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        tokenizer = file.read()
    packed, _ = packing.pack(table(spark, folder, "documents").select("doc_id", "text"), tokenizer)
    return packed.select("row.doc_id", "piece", "start", "length", F.crc32("ids").alias(
        "ids_crc32"), "sequence_id", "offset")


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    white, model = whitening.whiten(rows)
    shares = [v / model.trace for v in model.values.tolist()] if model else []
    return white.select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"),
                        F.lit(model.n if model else 0).cast("long").alias("n")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.array(*map(F.lit, shares)).cast("array<double>")[F.col("at")].alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"))


def op13_clustering(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = clustering.cluster(table(spark, folder, "embeddings"))
    return found.select(
        "vec_id", "cluster", "distance", F.expr("try_cast(cluster_inertia AS bigint)").alias(
            "cluster_inertia"), F.expr("try_cast(inertia AS bigint)").alias("inertia"),
        clustering.centroid_hash(F.col("centroid")).alias("centroid_sha256"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_language_id, op2_bpe, op3_toxicity, op4_warc_revisits, op5_quality_rules, op6_simhash,
    op7_suffix_dedup, op8_line_dedup, op9_sharding, op10_decontamination, op11_packing,
    op12_whitening, op13_clustering)}

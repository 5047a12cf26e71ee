"""A training-data pipeline over ``documents``: each stage keeps, cuts or encodes rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surtido.llm import bpe, decontamination, lines, simhash, toxicity
from surtido.llm.common import discard, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go; texts without words stay.

    Null texts stay, repeated rows are judged alike, an empty table gives no rows, further
    columns ride along.
    """
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.learn(docs, labels)
    toxic = F.col("p")[model.categories.index("toxic")] >= toxicity.LEAST_TOXIC
    return toxicity.predict(docs, model).where(~toxic).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated lines go, except in the document with the smallest doc_id.

    ``n_chars`` counts what is left of a text that lost lines; other rows stay as they are, null
    texts null. A null doc_id comes after all others; an empty table gives no rows; further
    columns ride along.
    """
    rows = lines.drop_lines(docs, lines.keep_bitmaps(docs))
    lost = F.col("n_dropped") > 0
    values = {c: F.col("row")[c] for c in docs.columns if c != "text"}
    values["text"] = F.col("text")
    if "n_chars" in values:
        values["n_chars"] = F.when(lost, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(values["n_chars"])
    return rows.select(*[values[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays.

    Null and empty texts are near each other; repeated rows are one; a row without a doc_id
    stays only in a group without any; further columns ride along.
    """
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a copy of a benchmark item go.

    Null texts hold none and stay, as everything does if there are no items; repeated rows are
    judged alike; further columns ride along.
    """
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontamination.annotate(docs, items).where(F.size("matches") == 0).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids, decoded_sha256``: token ids, and their bytes' hash.

    Needs the columns doc_id, lang, source and text; others are left out. A null text counts
    as empty and has no ids; repeated rows are encoded alike; an empty table gives no rows.
    """
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN).select(
        "row.doc_id", "row.lang", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

# Trained models, 64-bit hashes and alignments have no SQL form; tests compare with plain ones.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    What a stage has read is deleted when its own rows are written; the last one reads the
    rows of the fourth when the result is read.
    """
    docs, before = spark.read.parquet(f"{folder}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, folder)

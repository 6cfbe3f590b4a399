"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the
columns of documents. A stage's result is written as Parquet and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from retaloom.llm import decontaminate, dedup, jaccard, langid, packing
from retaloom.llm.common import crc_mod, stored

CAPACITY = 4096
SURE = 0.5  # least probability of a document's language


def _beside(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one, so that no new column takes the place of one."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("others"), "text")


def _as_before(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col(f"others.`{c}`") for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those for which no language is likelier than
    all others together. Trained as the query of its own is, on the rows' own languages."""
    network = langid.train(docs, crc_mod("doc_id", 5) != 0)
    if network is None:  # nothing to learn from: only the letters decide
        return docs.where(F.col("text").rlike(r"\p{L}"))
    known = langid.predict(_beside(docs), network)
    return _as_before(known.where((F.col("lang_pred") != "und") & (F.col("score") >= SURE)), docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked at five words and a similarity of 0.8."""
    return jaccard.keep_one(docs, n=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item, or a whole short one."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _as_before(decontaminate.contamination(_beside(docs), benchmark, n=10).where("n_hit = 0"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY, 1)
    return packing.pack(cut, CAPACITY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Trained and tokenised stages have no SQL; tests hold them against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the packed pieces of what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

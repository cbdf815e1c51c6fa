"""The corpus pipeline: documents in, packed training sequences out.

Every stage works on all that its predecessor kept and drops what it rejects. All but the last return the columns of
documents; the last returns a row for each piece of a packed sequence.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordspan.functions.names import free
from wordspan.llm import langid, toxicity
from wordspan.llm.common import remainder, stage, table
from wordspan.llm.exact_dedup import longest
from wordspan.llm.ngram_join import near_documents
from wordspan.llm.packing import pack_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null ones too, and those whose language is less likely than not, whichever it is."""
    return langid.accepted(docs, langid.fit(docs, remainder("doc_id", 4) != 2))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.7 or more; learns from labelled documents of the stage's own input."""
    return toxicity.ordinary(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the longest document of each group of equal texts. Rows that share id and text all stay or all go."""
    return longest(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies; rows with a null id come after all ids.

    Rows with a null id are told apart by a hash of their text, in the room above the largest id.
    """
    most = docs.agg(F.max("doc_id")).first()[0] or 0
    room = min((1 << 63) - 1 - max(most, 0), 1 << 62)
    key = F.coalesce("doc_id", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(room)) + F.lit(max(most, 0) + 1))
    (own,) = free(docs.columns, "key")
    keyed = docs.withColumn(own, key)
    found = near_documents(keyed.select(own, "text"), id_col=own)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(own)).distinct()
    return keyed.join(kept, own, "left_semi").drop(own)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 2048 tokens; null ids are carried, repeated rows packed each."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("best_fit_packing", packed),
]
#: Classifiers and packing can't be written in SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read back. Null texts go with the first; an empty table gives none."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = step(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stage(docs)
    return docs

"""Samples parted into valid ones and rejects with reasons, by one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordspan.functions.names import free
from wordspan.functions.once import once
from wordspan.functions.text import tokens

VALID = "valid"


def judged(samples: DataFrame) -> DataFrame:
    """Adds reason and message to samples (text, labels, model, idx); the first reason that applies, else "valid".

    no index, no text (null or blank), no model, no labels (null or none), misaligned (not a label for each word), bad
    labels (null, or neither 0 nor 1). The message says what was found.
    """
    words, bad = free(samples.columns, "words", "bad")
    label = lambda x: F.coalesce(~x.isin(0, 1), F.lit(True))
    held = once(samples, **{words: F.coalesce(F.size(tokens(F.col("text"))), F.lit(0)), bad: F.coalesce(F.filter("labels", label), F.array().cast("array<int>"))})
    n, size = F.col(words), F.coalesce(F.size("labels"), F.lit(0))
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    faults: dict[str, tuple[Column, Column]] = {
        "no index": (F.col("idx").isNull(), F.lit("idx is null")),
        "no text": (n <= 0, F.when(F.col("text").isNull(), "text is null").otherwise("text is blank")),
        "no model": (blank(F.col("model")), F.lit("model is null or blank")),
        "no labels": (size <= 0, F.lit("no label")),
        "misaligned": (n != size, F.concat(n.cast("string"), F.lit(" words, "), size.cast("string"), F.lit(" labels"))),
        "bad labels": (F.size(bad) > 0, F.concat(F.size(bad).cast("string"), F.lit(" labels, the first "), F.coalesce(F.get(bad, F.lit(0)).cast("string"), F.lit("null")))),
    }
    reason, message = F.lit(VALID), F.lit("")
    for name, (found, said) in reversed(faults.items()):
        reason, message = F.when(found, name).otherwise(reason), F.when(found, said).otherwise(message)
    return once(held, reason=reason, message=message).drop(words, bad)


def parted(samples: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Writes all samples once, a folder for each reason; returns the valid ones as given, and the rejects with reasons."""
    found = judged(samples)
    found.write.partitionBy("reason").parquet(path)
    back = samples.sparkSession.read.schema(found.schema).parquet(path)
    return back.where(F.col("reason") == VALID).drop("reason", "message"), back.where(F.col("reason") != VALID)

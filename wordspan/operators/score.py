"""Scoring with an injected model that runs in the tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordspan.functions.labels import is_valid
from wordspan.functions.probability import named_label
from wordspan.operators import metrics

#: Lists of words to lists of probabilities, null where a word was cut off.
WordScorer = Callable[[list[list[str]]], list[list[float | None]]]


def scored_words(samples: DataFrame, make: Callable[[], WordScorer], key: str, batch: int = 64) -> DataFrame:
    """key, word_pos, word, y, p of samples (key, words, labels), scored in batches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make()
        for pdf in frames:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                words = [list(w) for w in part["words"]]
                rows = [(k, pos, w, int(y), q) for k, ws, ys, ps in zip(part[key], words, part["labels"], scorer(words), strict=True) for pos, (w, y, q) in enumerate(zip(ws, ys, ps, strict=True))]
                yield pd.DataFrame(rows, columns=[key, "word_pos", "word", "y", "p"])

    return samples.select(key, "words", "labels").mapInPandas(run, f"{key} {dict(samples.dtypes)[key]}, word_pos int, word string, y int, p double")


#: Texts to a probability for each.
DocumentScorer = Callable[[list[str]], list[float]]


def scored_documents(samples: DataFrame, make: Callable[[], DocumentScorer], key: str, text_col: str = "text", batch: int = 64) -> DataFrame:
    """key and doc_p of every text, scored in batches in the tasks; null texts are scored as empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make()
        for pdf in frames:
            texts = pdf[text_col].fillna("").tolist()
            found = [p for i in range(0, len(texts), batch) for p in scorer(texts[i : i + batch])]
            yield pd.DataFrame({key: pdf[key], "doc_p": found})

    return samples.select(key, text_col).mapInPandas(run, f"{key} {dict(samples.dtypes)[key]}, doc_p double")


def predictions(words: DataFrame, key: str, threshold: float = 0.5) -> DataFrame:
    """Adds named (ai, human or a dash) to words (key, word_pos, word, p), and what holds for the whole text on each.

    doc_p is the mean over scored words, null without any; n_words, n_skipped and ai_pct (of the scored words) count them.
    """
    named = words.withColumn("named", named_label(F.col("p"), threshold))
    whole = named.groupBy(key).agg(F.avg("p").alias("doc_p"), F.count("*").alias("n_words"), F.count_if(F.col("p").isNull()).alias("n_skipped"), F.count_if(F.col("named") == "ai").alias("ai"))
    share = F.coalesce(F.try_divide(100.0 * F.col("ai"), F.col("n_words") - F.col("n_skipped")), F.lit(0.0))
    return named.join(whole.withColumn("ai_pct", share).drop("ai"), key)


def evaluated(samples: DataFrame, make: Callable[[], WordScorer], key: str, *by: str, batch: int = 64) -> DataFrame:
    """Metrics of a model on samples (key, words, labels), for each group: what a trainer asks for after an epoch.

    accuracy, label_rate, predicted_rate, scored, skipped and the columns of metrics.reward. Samples whose words and
    labels don't agree are left out. `by` names columns of the samples.
    """
    good = samples.where(is_valid(F.col("words"), F.col("labels")))
    words = scored_words(good, make, key, batch)
    if by:
        words = words.join(good.select(key, *by), key)
    rates = metrics.rates(words, *by)
    both = metrics.reward(words, *by)
    return both.join(rates, list(by)) if by else both.crossJoin(F.broadcast(rates))

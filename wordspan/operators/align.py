"""Word labels for subword models: tokens with aligned labels, padded batches, and words' probabilities back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordspan.functions.labels import IGNORED, align, pad
from wordspan.functions.names import free

#: Words to (token ids, word ids with None for special tokens).
Tokenizer = Callable[[list[str]], tuple[list[int], list[int | None]]]


def tokenized(samples: DataFrame, tokenizer: Tokenizer, most: int, id_col: str, words_col: str = "words", labels_col: str = "labels") -> DataFrame:
    """id, input_ids, attention_mask and labels of samples, cut at `most` tokens. The tokenizer runs in the tasks.

    Samples with null words or labels, or not a label for each word, raise ValueError; sources.rejects parts them off.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for key, words, labels in zip(pdf[id_col], pdf[words_col], pdf[labels_col], strict=True):
                if words is None or labels is None or len(words) != len(labels):
                    raise ValueError(f"{id_col} {key}: {'no' if words is None else len(words)} words, {'no' if labels is None else len(labels)} labels")
            cut = [tokenizer(list(w)) for w in pdf[words_col]]
            yield pdf[[id_col, labels_col]].assign(input_ids=[i[:most] for i, _ in cut], word_ids=[w[:most] for _, w in cut])

    kind = dict(samples.dtypes)
    made = samples.select(id_col, words_col, labels_col).mapInPandas(run, f"{id_col} {kind[id_col]}, {labels_col} array<int>, input_ids array<int>, word_ids array<int>")
    ones = F.transform("input_ids", lambda _: F.lit(1))
    return made.select(id_col, "input_ids", ones.alias("attention_mask"), align(F.col(labels_col), F.col("word_ids")).alias("labels"))


def padded(rows: DataFrame, batch: str, pad_id: int = 0) -> DataFrame:
    """Token rows filled up to the longest of their batch."""
    (width,) = free(rows.columns, "width")
    fill = {"input_ids": pad_id, "attention_mask": 0, "labels": IGNORED}
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(batch))
    return rows.withColumn(width, longest).withColumns({c: pad(F.col(c), F.col(width), v) for c, v in fill.items()}).drop(width)


def word_probabilities(subwords: DataFrame, samples: DataFrame, key: str, fill: float | None = None) -> DataFrame:
    """key, word_pos, y, p for every word of samples (key, labels): its first subword's probability, else `fill`.

    subwords: key, tok, word_id (null for special tokens), p.
    """
    first = subwords.where("word_id is not null").groupBy(key, F.col("word_id").alias("word_pos")).agg(F.min(F.struct("tok", "p"))["p"].alias("p"))
    words = samples.select(key, F.posexplode("labels").alias("word_pos", "y"))
    out = words.join(first, [key, "word_pos"], "left")
    return out if fill is None else out.withColumn("p", F.coalesce("p", F.lit(fill)))


def document_probability(words: DataFrame, key: str) -> DataFrame:
    """The mean over scored words."""
    return words.groupBy(key).agg(F.avg("p").alias("doc_p"))


#: What words beyond a cut count as.
FALLBACK = {"human": 0.0, "ai": 1.0, "neutral": 0.5}

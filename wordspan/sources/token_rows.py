"""Token rows kept between runs, under a key made of what they depend on."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordspan.operators.align import Tokenizer, tokenized


def content_key(samples: DataFrame, tokenizer_name: str, most: int, *columns: str) -> str:
    """A key of the rows (in any order), the tokenizer and the length; two sums and a count over all rows."""
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    parts = [F.lit(tokenizer_name), F.lit(most).cast("string"), F.count("*").cast("string"), *(F.coalesce(s, F.lit("0")) for s in sums)]
    return samples.agg(F.sha2(F.concat_ws("|", *parts), 256).alias("key")).first()["key"][:32]


def cached(samples: DataFrame, tokenizer: Tokenizer, tokenizer_name: str, most: int, folder: str, id_col: str) -> DataFrame:
    """The token rows of samples (id, words, labels): read if a run before has written them, else made and written.

    A marker is written after the rows, so rows of a run that broke off are made again.
    """
    spark = samples.sparkSession
    path = f"{folder.rstrip('/')}/tokens-{content_key(samples, tokenizer_name, most, id_col, 'words', 'labels')}"
    made = tokenized(samples, tokenizer, most, id_col)
    try:
        spark.read.parquet(f"{path}/done")
    except AnalysisException:
        made.write.mode("overwrite").parquet(f"{path}/rows")
        spark.range(1).write.mode("overwrite").parquet(f"{path}/done")
    return spark.read.schema(made.schema).parquet(f"{path}/rows")

"""From samples to training sets: union, reproducible shuffle, split by ratio, and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordspan.functions.labels import has_boundary, is_valid
from wordspan.functions.names import free
from wordspan.functions.text import tokens
from wordspan.operators.scan import joined, running
from wordspan.sources.corpus import ranked
from wordspan.sources.staging import staged


def merge(*sources: DataFrame) -> DataFrame:
    """All rows of all sources."""
    return reduce(DataFrame.unionByName, sources)


def shuffle_key(seed: int, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(k.cast("string") for k in keys)))


def shuffled(samples: DataFrame, seed: int, keys: list[str]) -> DataFrame:
    """Adds pos, the place in an order that only the seed and the keys decide. Keys name a row."""
    keyed = samples.withColumn("__key", shuffle_key(seed, *map(F.col, keys)))
    bucket = F.conv(F.substring("__key", 1, 3), 16, 10).cast("int")
    return ranked(keyed, bucket, [F.col("__key"), *map(F.col, keys)], "pos").drop("__key")


def split(shuffled_samples: DataFrame, train: float = 0.80, validation: float = 0.05, test: float = 0.15) -> DataFrame:
    """Adds split: the first floor(n * train) places are train, the next floor(n * validation) validation, the rest test."""
    if abs(train + validation + test - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")
    n = shuffled_samples.count()
    a = int(n * train)
    b = a + int(n * validation)
    return shuffled_samples.withColumn("split", F.when(F.col("pos") < a, "train").when(F.col("pos") < b, "validation").otherwise("test"))


def head(shuffled_samples: DataFrame, n: int) -> DataFrame:
    """The first n places."""
    return shuffled_samples.where(F.col("pos") < n)


def audit(windows: DataFrame, *by: str, least: int = 35, most: int = 350, expected: int | None = None) -> DataFrame:
    """Counts of windows, and of those of a wrong length, with labels that don't fit, of one class only (or not of the
    class expected), and without a boundary."""
    n, label = F.size(tokens(F.col("text"))), F.col("label")
    one_class = F.size(F.array_distinct(label)) < 2
    pure = one_class if expected is None else ~F.forall(label, lambda x: x == expected)
    bound = ~has_boundary(label) if expected is None else has_boundary(label)
    counts = {"bad_length": (n < least) | (n > most), "bad_align": ~is_valid(tokens(F.col("text")), label), "bad_class": pure, "bad_boundary": bound}
    return windows.groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in counts.items()))


def check(audited: DataFrame) -> None:
    """Raises ValueError if any audit found a fault."""
    bad = [r.asDict() for r in audited.where("bad_length + bad_align + bad_class + bad_boundary > 0").take(5)]
    if bad:
        raise ValueError(f"windows with faults: {bad}")


def split_groups(samples: DataFrame, seed: int, groups: list[str], train: float = 0.80, validation: float = 0.05, test: float = 0.15) -> DataFrame:
    """Adds split so that all rows of a group (a source document) get the same; null keys are keys too.

    Groups stand in an order that only the seed and their keys decide. A group goes where the rows of the groups before
    it end: to train while they are fewer than floor(n * train), and so on. Each split is within one group of its ratio.
    """
    if abs(train + validation + test - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")
    weight, key, upto, prefix = free(samples.columns, "weight", "key", "upto", "of_")
    sizes = staged(samples.groupBy(*groups).agg(F.count("*").alias(weight)))
    n = sizes.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    keyed = sizes.withColumn(key, shuffle_key(seed, *map(F.col, groups)))
    bucket = F.conv(F.substring(key, 1, 3), 16, 10).cast("int")
    ran = running(keyed, [], [key, *groups], bucket, sums={upto: F.col(weight)})
    a = int(n * train)
    b = a + int(n * validation)
    start = F.col(upto) - F.col(weight)
    placed = ran.select(*groups, F.when(start < a, "train").when(start < b, "validation").otherwise("test").alias("split"))
    return joined(samples, placed, groups, prefix)

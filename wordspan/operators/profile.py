"""Word-count statistics of groups of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stats(counted: DataFrame, *by: str) -> DataFrame:
    """n, least, most, mean and median (of even groups the mean of the middle two) of column wc."""
    return counted.groupBy(*by).agg(F.count("*").alias("n"), F.min("wc").alias("least"), F.max("wc").alias("most"), F.avg("wc").alias("mean"), F.median("wc").alias("median"))


def extremes(counted: DataFrame, by: str, order: list[str]) -> DataFrame:
    """The ids (columns `order`) of the first shortest and first longest text of each group."""
    first = F.min(F.struct("wc", *order))
    last = F.min(F.struct((-F.col("wc")).alias("neg"), *order))
    out = counted.groupBy(by).agg(first.alias("a"), last.alias("b"))
    return out.select(by, F.col("a.wc").alias("least"), *(F.col(f"a.{c}").alias(f"least_{c}") for c in order), (-F.col("b.neg")).alias("most"), *(F.col(f"b.{c}").alias(f"most_{c}") for c in order))


def upper_median(values: Column, n: Column) -> Column:
    """The value at place n div 2 of the sorted values."""
    return F.element_at(F.array_sort(values), F.floor(n / 2).cast("int") + 1)


def spread(counted: DataFrame, *by: str) -> DataFrame:
    """least, upper median and most of wc. Values are counted first, so groups of any size fit."""
    from pyspark.sql import Window

    sizes = counted.groupBy(*by, "wc").agg(F.count("*").alias("m"))
    w = Window.partitionBy(*by)
    placed = sizes.withColumns({"upto": F.sum("m").over(w.orderBy("wc")), "n": F.sum("m").over(w)})
    middle = F.min(F.when(F.col("upto") > F.floor(F.col("n") / 2), F.col("wc")))
    return placed.groupBy(*by).agg(F.min("wc").alias("least"), middle.alias("upper_median"), F.max("wc").alias("most"))

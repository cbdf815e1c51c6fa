"""Columns that are worked out once a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a generator of one row.

    The optimizer copies the expression of a plain column into every filter and projection above it that it can merge
    with. A generator's output it leaves alone, so a costly expression that is used again is not evaluated again.
    """
    return df.select("*", F.inline_outer(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))

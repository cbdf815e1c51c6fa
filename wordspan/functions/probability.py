"""Probabilities and hard labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def softmax_of_two(x0: Column, x1: Column) -> Column:
    """The second class's probability, without overflow."""
    top = F.greatest(x0, x1)
    return F.exp(x1 - top) / (F.exp(x0 - top) + F.exp(x1 - top))


def hard_label(p: Column) -> Column:
    """Rounded half to even, so 0.5 counts as human."""
    return F.rint(p).cast("int")


def named_label(p: Column, threshold: float = 0.5) -> Column:
    return F.when(p.isNull(), "—").when(p >= threshold, "ai").otherwise("human")


def argmax_of_two(x0: Column, x1: Column) -> Column:
    """1 only if the second is larger."""
    return F.when(x1 > x0, 1).otherwise(0)


def render(words: Column, p: Column, limit: int = 60, threshold: float = 0.5) -> Column:
    """The first words in a line: generated ones as [w*], unscored ones as (w?)."""
    marked = F.zip_with(F.slice(words, 1, limit), F.slice(p, 1, limit), lambda w, q: F.when(q.isNull(), F.concat(F.lit("("), w, F.lit("?)"))).when(q >= threshold, F.concat(F.lit("["), w, F.lit("*]"))).otherwise(w))
    return F.array_join(marked, " ")

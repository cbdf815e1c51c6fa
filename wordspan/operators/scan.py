"""Running sums and maxima over ordered rows of a group, where one group may be most of the rows.

A window over a group is one task's work. Here rows are cut into segments by a bucket that rises with the order; each
segment is reduced to its totals, the totals (a row for each segment) are run over in order, and rows run over their own
segment only, from what the segments before it carry over. No task orders more than a segment of a group.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordspan.functions.names import free


def joined(left: DataFrame, right: DataFrame, by: list[str], prefix: str) -> DataFrame:
    """Rows with those of another table that has one row for each key; null keys are keys. `prefix` isn't in a name."""
    named = right.withColumnsRenamed({b: f"{prefix}{b}" for b in by})
    met = left.join(named, reduce(and_, (left[b].eqNullSafe(named[f"{prefix}{b}"]) for b in by)))
    return met.drop(*(f"{prefix}{b}" for b in by))


def running(rows: DataFrame, by: list[str], order: list[str | Column], bucket: Column, sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None) -> DataFrame:
    """Adds, by name, the sum or maximum of a column over a group's rows up to and with each row, in a total order.

    `bucket` is an int that never falls as the order rises; it decides how rows are dealt, not what comes out. Null
    values count for nothing: a sum of none is 0, a maximum of none null. `rows` is read twice and must not depend on chance.
    """
    sums, maxima = sums or {}, maxima or {}
    given = {n: (F.sum, c) for n, c in sums.items()} | {n: (F.max, c) for n, c in maxima.items()}
    segment, *values = free([*rows.columns, *given], "segment", *(f"value_{k}" for k in range(len(given))))
    (prefix,) = free([c[:3] for c in rows.columns], "of_")
    kept = rows.withColumns({segment: bucket, **{v: c for v, (_, c) in zip(values, given.values(), strict=True)}})
    totals = kept.groupBy(*by, segment).agg(*(f(v).alias(v) for v, (f, _) in zip(values, given.values(), strict=True)))
    before = Window.partitionBy(*by).orderBy(segment).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*by, segment, *(f(v).over(before).alias(f"carried_{v}") for v, (f, _) in zip(values, given.values(), strict=True)))
    within = Window.partitionBy(*by, segment).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    met = joined(kept, carried, [*by, segment], prefix)
    out = {}
    for v, (name, (f, _)) in zip(values, given.items(), strict=True):
        own, old = f(v).over(within), F.col(f"carried_{v}")
        out[name] = F.coalesce(old, F.lit(0)) + F.coalesce(own, F.lit(0)) if f is F.sum else F.greatest(old, own)
    return met.withColumns(out).drop(segment, *values, *(f"carried_{v}" for v in values))
